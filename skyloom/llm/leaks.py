"""Benchmark decontamination: CGK embedding and bit-sampling LSH over item-sized windows, then exact edit distance."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm.common import parts_for, read_table, register, text_of, unused

EDITS = 0.2  # edits allowed for each word of an item: similarity of 0.8 or more
WALKS, SAMPLES, COORDINATES = 8, 6, 4
STEPS = 64  # of the longest walk; it covers about half as many words
SHARD_CHARS = 8_000_000  # benchmark text that one broadcast holds
MARKS = ".,;:!?|()\"'"
WORDS_AT_ONCE = 200_000
FOUND = "doc_id long, item_id long, first_word long, end_word long, distance long, item_words long"


def words_of(text: str) -> list[str]:
    """Lower-cased words without marks at their ends."""
    return [w for w in (x.strip(MARKS) for x in text.lower().split()) if w]


def best_match(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to any run of ``words``: (distance, first, end); of equal ones the leftmost end."""
    n, m = len(item), len(words)
    steps = np.arange(m + 1)
    row, origin = np.zeros(m + 1, np.int64), steps.copy()
    for i in range(n):
        # substitution or deletion first, then insertions as a running minimum
        change = row[:-1] + (words != item[i])
        drop = row[1:] + 1
        cost = np.concatenate([[i + 1], np.minimum(change, drop)])
        begin = np.concatenate([[0], np.where(change <= drop, origin[:-1], origin[1:])])
        level = cost - steps
        lowest = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == lowest, steps, 0))
        row, origin = lowest + steps, begin[source]
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


def shared(counts: Counter, part: np.ndarray) -> int:
    """Words that an item and a run have in common, with their multiplicities."""
    left, n = counts.copy(), 0
    for w in part.tolist():
        if left.get(w, 0) > 0:
            left[w] -= 1
            n += 1
    return n


def segments(n: int) -> tuple[int, list[int]]:
    """Length and offsets of the pieces that are embedded of an item of n words; together they hold every word.

    Edits that gather in one place spoil the pieces there and leave the others.
    """
    least = min(STEPS // 2, 1 << (n.bit_length() - 1))
    return least, sorted({*range(0, n - least + 1, least), n - least})


class Index:
    """Items of one shard: their vocabulary, and walks and hash tables of their segments by length."""

    def __init__(self, items: list[tuple[int, str]], seed: int = 7):
        listed = [(item_id, words_of(text or "")) for item_id, text in items]
        listed = [(i, w) for i, w in listed if w]
        self.vocabulary: dict[str, int] = {}
        for _, words in listed:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.names = [i for i, _ in listed]
        self.items = [np.array([self.vocabulary[w] for w in words], np.int64) for _, words in listed]
        self.counts = [Counter(x.tolist()) for x in self.items]
        self.sizes = sorted({len(x) for x in self.items})
        rng = np.random.default_rng(seed)
        # bit j of a word's row tells whether the walk moves on at step j
        self.bits = rng.integers(0, 2**63, (WALKS, len(self.vocabulary) + 1)).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, (WALKS, len(self.vocabulary) + 1)).astype(np.uint64)
        self.factors = rng.integers(1, 2**62, COORDINATES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.classes = defaultdict(list)
        for number, x in enumerate(self.items):
            least, offsets = segments(len(x))
            self.classes[least] += [(number, offset) for offset in offsets]
        self.places = {least: rng.integers(0, 2 * least, (WALKS, SAMPLES, COORDINATES)) for least in sorted(self.classes)}
        self.tables = {}
        for least, members in self.classes.items():
            numbers = sorted({n for n, _ in members})
            joined = np.concatenate([np.append(self.items[n], np.zeros(STEPS, np.int64)) for n in numbers])
            begins = dict(zip(numbers, np.cumsum([0] + [len(self.items[n]) + STEPS for n in numbers[:-1]]).tolist()))
            starts = np.array([begins[n] + offset for n, offset in members])
            for walk, sample, codes in self.codes(joined, starts, least):
                order = np.argsort(codes, kind="stable")
                self.tables[least, walk, sample] = codes[order], np.array(members)[order]

    def codes(self, words: np.ndarray, starts: np.ndarray, least: int):
        """CGK walks from every start, and the hash of each sample of embedded coordinates."""
        for walk in range(WALKS):
            at, seen = starts.copy(), {}
            wanted = set(self.places[least][walk].ravel().tolist())
            for step in range(max(wanted) + 1):
                here = words[at]
                if step in wanted:
                    seen[step] = here.astype(np.uint64)
                at = at + (self.bits[walk][here] >> np.uint64(step) & np.uint64(1)).astype(np.int64)
            for sample in range(SAMPLES):
                code = np.zeros(len(starts), np.uint64)
                for factor, place in zip(self.factors, self.places[least][walk, sample].tolist()):
                    code = (code + seen[place] + np.uint64(1)) * factor
                    code ^= code >> np.uint64(31)
                yield walk, sample, code

    def candidates(self, words: np.ndarray, usable: np.ndarray, begins: np.ndarray) -> set[tuple[int, int, int]]:
        """(start, item, document) where the embedding of a segment agrees on some sample; start is the place of the whole item.

        Documents begin at ``begins``, with room for any item before and after them. A run within the allowed edits of an item of n words has n less the edits of the item's words
        among its first n, and so do its parts before and after the start of a segment. Starts whose
        item would lack so many words are left out first; that loses nothing.
        """
        known = np.concatenate([[0], np.cumsum(words > 0)]).astype(np.int32)
        out = set()
        for least, members in self.classes.items():
            good = np.zeros(len(words), bool)
            for n in {len(self.items[m]) for m, _ in members}:
                reach = np.minimum(np.arange(n, n + len(words)), len(words))
                enough = known[reach] - known[:-1] >= n - int(EDITS * n)
                for offset in segments(n)[1]:
                    good[offset:] |= enough[:len(words) - offset]
            starts = np.flatnonzero(good & usable)
            if not len(starts):
                continue
            for walk, sample, codes in self.codes(words, starts, least):
                keys, who = self.tables[least, walk, sample]
                low = np.searchsorted(keys, codes)
                hits = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == codes)
                high = np.searchsorted(keys, codes[hits], "right")
                docs = np.searchsorted(begins, starts[hits], "right") - 1
                for s, d, a, b in zip(starts[hits].tolist(), docs.tolist(), low[hits].tolist(), high.tolist()):
                    out.update((s - offset, number, d) for number, offset in who[a:b].tolist())
        return out

    def matches(self, words: np.ndarray, usable: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, first, end, distance) of verified runs, disjoint for each item."""
        out, covered = [], defaultdict(int)
        for start, number, d in sorted(self.candidates(words, usable, begins)):
            item = self.items[number]
            n, edits = len(item), int(EDITS * len(item))
            # edits before a segment shift the start by their number at most
            if start + edits < covered[number]:
                continue
            low = max(covered[number], start - edits, int(begins[d]))
            part = words[low:min(start + n + edits, int(ends[d]))]
            if shared(self.counts[number], part) < n - edits:
                continue
            distance, first, end = best_match(item, part)
            while 0 < distance <= edits:
                # the place was an estimate: look on around the run until nothing nearer is found
                around = max(covered[number], low + first - edits, int(begins[d]))
                again = best_match(item, words[around:min(low + end + edits, int(ends[d]))])
                if again[0] >= distance:
                    break
                low, (distance, first, end) = around, again
            if distance <= edits:
                out.append((d, number, low + first, low + end, distance))
                covered[number] = low + end
        return out


class _Ids(dict):
    """Raw word to the number of its stripped form; 0 is outside the items, -1 nothing but marks."""

    LIMIT = 500_000

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        bare = word.lower().strip(MARKS)
        out = self.vocabulary.get(bare, 0) if bare else -1
        if len(word) <= 40:
            self[word] = out
        return out


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each place where a document holds a benchmark item, edited by at most a fifth of its words.

    Words are lower-cased, without marks at their ends; places are word numbers, end exclusive,
    disjoint for each item. The items are broadcast in shards of ``SHARD_CHARS`` characters, with
    one pass over the documents for each shard. An item of fewer than five words must occur as it
    is; null and empty items match nothing. Null and empty texts hold nothing; repeated rows are
    searched alike; empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = parts_for(chars, SHARD_CHARS, 1)
    rows = docs.select("doc_id", text_of().alias("text"))
    out = None
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard).select("item_id", "text")
        # bounded by SHARD_CHARS
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in part.collect()]))
        found = rows.mapInArrow(_searcher(index), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def _searcher(index):
    names = [f.split()[0] for f in FOUND.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        if not ix.items:
            return
        ids = _Ids(ix.vocabulary)
        pad = np.zeros(STEPS + 2 * ix.sizes[-1], np.int64)

        def flush(docs: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            joined = np.concatenate([pad, *(x for _, words in docs for x in (words, pad))])
            sizes = np.array([len(w) for _, w in docs])
            begins = len(pad) + np.cumsum(sizes + len(pad)) - sizes - len(pad)
            usable = np.zeros(len(joined), bool)
            for b, n in zip(begins.tolist(), sizes.tolist()):
                usable[b:b + n] = True
            found = []
            for d, number, first, end, distance in ix.matches(joined, usable, begins, begins + sizes):
                found.append((docs[d][0], ix.names[number], first - int(begins[d]), end - int(begins[d]), distance, len(ix.items[number])))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(len(names))], names)

        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(ids) > ids.LIMIT:
                    ids.clear()
                parts = text.split()
                words = np.fromiter(map(ids.__getitem__, parts), np.int64, len(parts))
                words = words[words >= 0]
                if not len(words):
                    continue
                held.append((doc_id, words))
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return search


def drop_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that hold no item, with all columns. A null doc_id is kept only if no row with a null doc_id leaks."""
    name = unused(docs, "leaking")
    leaking = find_leaks(docs, items).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


@register("op3_decontamination")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
