"""Repeated passages: every run of 20 words that starts earlier elsewhere is found and cut out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyloom.llm.common import read_table, register, text_of

WINDOW = 20
GRAM = 8  # words of an anchor
SPREAD = WINDOW - GRAM + 1  # anchors that a window holds
ROWS_AT_ONCE = 1_000_000
NO_ID = -(1 << 63)  # stands for a null doc_id: before all others

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


class _Hashes(dict):
    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            self[word] = out
        return out


_HASHES = _Hashes()


def words_of(text: str) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHES) > _HASHES.LIMIT:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` words, by doubling."""
    out, have, bits = words, 1, bin(length)[3:]
    for bit in bits:
        out = out[:-have] * _U(pow(_BASE, have, 1 << 64)) + out[have:]
        have *= 2
        if bit == "1":
            out = out[:-1] * _U(_BASE) + words[have:have + len(out) - 1]
            have += 1
    return _mix(out)


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Extreme of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every window (the least hash of its 8-word runs), and the anchors by the places where they stand.

    Equal windows have equal anchors, so a window can only repeat if its anchor stands somewhere else.
    """
    grams = run_hashes(words, GRAM)
    least = _extreme(grams, SPREAD, np.minimum)
    padded = np.concatenate([np.zeros(SPREAD - 1, np.uint64), least, np.zeros(SPREAD - 1, np.uint64)])
    return least, grams[_extreme(padded, SPREAD, np.maximum) == grams]


def _tied(docs: DataFrame) -> DataFrame:
    """doc (null ids first of all), tie, text. ``tie`` is 0 unless some doc_id names different texts."""
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), text_of().alias("text"))
    h = F.xxhash64("text")
    clash = rows.groupBy("doc").agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a != b")
    return rows.select("doc", (F.lit(0).cast("long") if clash.isEmpty() else h).alias("tie"), "text")


def _numbered(rows: list[np.ndarray]) -> np.ndarray:
    """Row number of every element of a list of arrays."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """(doc, tie, anchors): the anchors of each document that stand in two or more places of the corpus.

    Each batch first counts for itself: an anchor that it holds twice leaves one row for the
    exchange, however often it stands there.
    """
    schema = pa.schema([("key", pa.int64()), ("anchor", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("n", pa.int32()), ("own", pa.bool_())])

    def flush(doc: list, tie: list, found: list[np.ndarray]) -> pa.RecordBatch:
        anchor, who = np.concatenate(found), _numbered(found)
        value, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
        several = count[back] > 1
        # one row for each document with an anchor of several places, one for the anchor itself
        pairs = np.unique(np.stack([back[several], who[several]]), axis=1)
        known, witness = value[pairs[0]], value[count > 1]
        key = np.concatenate([anchor[~several], witness, _mix(known ^ _mix(pairs[1].astype(np.uint64)))])
        owner = np.concatenate([who[~several], np.zeros(len(witness), np.int64), pairs[1]])
        sizes = [int((~several).sum()), len(witness), len(known)]
        columns = [
            key.view(np.int64), np.concatenate([anchor[~several], witness, known]).view(np.int64), np.array(doc, np.int64)[owner],
            np.array(tie, np.int64)[owner], np.repeat([1, 2, 2], sizes).astype(np.int32), np.repeat([True, False, True], sizes),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, tie, found, size = [], [], [], 0
        for batch in batches:
            for d, t, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "text"))):
                words = words_of(text)
                if len(words) < WINDOW:
                    continue
                doc.append(d)
                tie.append(t)
                found.append(anchors(word_hashes(words))[1])
                size += len(found[-1])
                if size > ROWS_AT_ONCE:
                    yield flush(doc, tie, found)
                    doc, tie, found, size = [], [], [], 0
        if found:
            yield flush(doc, tie, found)

    counted = rows.select("doc", "tie", "text").mapInArrow(run, "key long, anchor long, doc long, tie long, n int, own boolean")
    total = F.sum("n").over(Window.partitionBy("key"))
    repeated = counted.withColumn("total", total).where("total > 1 and own")
    # as many as the document has places
    return repeated.groupBy("doc", "tie").agg(F.collect_set("anchor").alias("anchors"))


def later_windows(rows: DataFrame) -> DataFrame:
    """(doc, tie, gone): runs (lo, hi) of starts whose windows also start earlier; hi is -1 in rows still to be judged.

    Windows whose anchor repeats are hashed. Each batch keeps the first of its equal windows for the
    exchange and reports the others at once, so a passage that very many documents share sends one
    row for each batch; of those the first in the corpus stays.
    """
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def flush(doc: list, tie: list, starts: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
        who, start, value = _numbered(starts), np.concatenate(starts), np.concatenate(hashes)
        doc_of, tie_of = np.array(doc, np.int64)[who], np.array(tie, np.int64)[who]
        order = np.lexsort((start, tie_of, doc_of, value))
        value, start, doc_of, tie_of = value[order], start[order], doc_of[order], tie_of[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        late = (doc_of != doc_of[head]) | (tie_of != tie_of[head]) | (start != start[head])
        back = np.lexsort((start[late], tie_of[late], doc_of[late]))
        d, t, s = doc_of[late][back], tie_of[late][back], start[late][back]
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > s[:-1] + 1)
        lo = np.flatnonzero(fresh)
        hi = np.append(lo[1:], len(d)) - 1 if len(d) else lo
        own = _mix(_mix(d[lo].view(np.uint64)) ^ s[lo].astype(np.uint64))
        # in the order of the documents, in which the exchange packs them best
        value, doc_of, tie_of, start = (x[new][np.lexsort((start[new], tie_of[new], doc_of[new]))] for x in (value, doc_of, tie_of, start))
        columns = [
            np.concatenate([value, own]).view(np.int64), np.concatenate([doc_of, d[lo]]), np.concatenate([tie_of, t[lo]]),
            np.concatenate([start, s[lo]]).astype(np.int32), np.concatenate([np.full(len(value), -1), s[hi]]).astype(np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, tie, starts, hashes, size = [], [], [], [], 0
        for batch in batches:
            known = batch.column("anchors")
            for i, (d, t, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "text")))):
                words = words_of(text)
                if len(words) < WINDOW:
                    continue
                hashed = word_hashes(words)
                at = np.flatnonzero(np.isin(anchors(hashed)[0].view(np.int64), known[i].values.to_numpy()))
                if not len(at):
                    continue
                doc.append(d)
                tie.append(t)
                starts.append(at)
                hashes.append(run_hashes(hashed, WINDOW)[at])
                size += len(at)
                if size > ROWS_AT_ONCE:
                    yield flush(doc, tie, starts, hashes)
                    doc, tie, starts, hashes, size = [], [], [], [], 0
        if starts:
            yield flush(doc, tie, starts, hashes)

    joined = rows.select("doc", "tie", "text").join(repeated_anchors(rows), ["doc", "tie"])
    windows = joined.mapInArrow(run, "key long, doc long, tie long, lo int, hi int")
    place = F.rank().over(Window.partitionBy("key", F.col("hi") < 0).orderBy("doc", "tie", "lo"))
    late = windows.withColumn("place", place).where((F.col("hi") >= 0) | (F.col("place") > 1))
    # as many as the document has windows
    return late.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", F.greatest("lo", "hi").alias("hi"))).alias("gone"))


def cut_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row.

    Words are runs of anything but ASCII white space, unchanged; a word goes if some window of 20
    words that covers it also starts earlier: in a smaller doc_id, or before in the same document.
    Windows are judged on the input. A null doc_id comes before all others. Null and empty texts have
    no words (the hash is that of the empty string); texts below 20 words lose nothing. Rows that
    repeat a doc_id and its text are one document, so they lose the same words; should a doc_id name
    different texts, these are ordered by a hash. An empty table gives an empty result; other
    columns are not read. Equal windows are told by 64-bit hashes of their words.
    """
    rows = _tied(docs)
    gone = later_windows(rows)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            spans = batch.column("gone")
            for i, (doc, text) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist())):
                words = words_of(text)
                n = len(words)
                if spans[i].is_valid:
                    runs = spans[i].values
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, runs.field("lo").to_numpy(), 1)
                    np.add.at(edge, runs.field("hi").to_numpy() + WINDOW, -1)
                    words = [w for w, c in zip(words, np.cumsum(edge[:-1]).tolist()) if not c]
                kept = b" ".join(words)
                row = (None if doc == NO_ID else doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    # the same exchange of the texts as in later_windows
    joined = rows.join(gone, ["doc", "tie"], "left").select("doc", "text", "gone")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


@register("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cut_repeats(read_table(spark, folder, "documents"))
