"""Ranked lexical search: hashed max-sketches bound every score, the best bounds are scored exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyloom.llm.common import parts_for, read_table, register, text_of
from skyloom.session import stored

PLACES = 1_024  # coordinates of a sketch
MANY = 255  # a coordinate with this value stands for any frequency from there on
BEST = 10
SHARD_TERMS = 60_000  # item terms whose weights one pass over the sketches holds
SHARD_ITEMS = 1_000
STEPS = 64  # bins of bounds for each doubling
FIRST_BEST = 4  # times BEST bounds are scored before the threshold is known
DOCS_AT_ONCE = 256

# bytes that end a term become blanks and A-Z become a-z; bytes from 0x80 on belong to terms
_FOLD = bytes(ord(" ") if b < 0x80 and not chr(b).isalnum() else b for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Places(dict):
    LIMIT = 500_000

    def __missing__(self, term: bytes) -> int:
        if len(self) > self.LIMIT:
            self.clear()
        out = xxhash.xxh3_64_intdigest(term) % PLACES
        if len(term) <= 40:
            self[term] = out
        return out


_PLACES = _Places()


def sketch(counts: Counter) -> bytes:
    """For every coordinate the largest frequency among the terms that hash to it.

    Within one document the impact of a term rises with its frequency and with nothing else, so
    the impact of this frequency is the maximum of the impacts that fold into the coordinate.
    """
    out = np.zeros(PLACES, np.uint8)
    if counts:
        places = np.fromiter(map(_PLACES.__getitem__, counts), np.int64, len(counts))
        times = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MANY)
        np.maximum.at(out, places, times.astype(np.uint8))
    return out.tobytes()


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n, sketch) of every document with a term; ``mark`` is a hash of the text that tells rows of one doc_id apart."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch, out = whole.slice(at, DOCS_AT_ONCE), []
                for doc, mark, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "text"))):
                    if terms := terms_of(text):
                        out.append((doc, mark, len(terms), sketch(Counter(terms))))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.types[i]) for i in range(4)], schema=schema)

    return _marked(docs).mapInArrow(fold, "doc_id long, mark long, n long, sketch binary")


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("mark"), text_of().alias("text"))


def holders(docs: DataFrame, wanted: frozenset[bytes]) -> DataFrame:
    """(term, df) of the wanted terms, counted over all documents; each task adds up before the shuffle."""
    schema = pa.schema([("term", pa.binary()), ("df", pa.int64())])
    spread = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(spread.value.intersection(terms_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)

    parts = docs.select(text_of().alias("text")).mapInArrow(count, "term binary, df long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // n_terms


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """Items whose terms fit one broadcast: exact weights, and their sums by coordinate for the bounds."""

    def __init__(self, items: dict[int, list[bytes]], found: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.ids = sorted(items)
        self.weights = {t: weight(n_docs, found[t]) for ts in items.values() for t in ts if t in found}
        self.holds: dict[bytes, list[int]] = {}
        self.sums = np.zeros((PLACES, len(self.ids)))
        for j, item in enumerate(self.ids):
            # a term that no document holds adds to no score
            for t in items[item]:
                if t in found:
                    self.holds.setdefault(t, []).append(j)
                    self.sums[_PLACES[t], j] += self.weights[t]

    def bounds(self, lengths: np.ndarray, sketches: list[bytes]) -> np.ndarray:
        """Upper bounds (documents, items) of the scores: whole numbers below 2^53, so the products are exact."""
        tf = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, PLACES).astype(np.float64)
        m = np.array([length_factor(int(n), self.n_docs, self.n_terms) for n in lengths], np.float64)[:, None]
        impacts = np.ceil(1e9 * tf / (1000 * tf + 8 * m))
        impacts[tf == MANY] = 1e6
        return impacts @ self.sums

    def scores(self, text: str, wanted: list[int]) -> list[int]:
        """Exact scores of one document for the items at the wanted places."""
        counts = Counter(terms_of(text))
        m = length_factor(sum(counts.values()), self.n_docs, self.n_terms)
        out = dict.fromkeys(wanted, 0)
        for t in self.holds.keys() & counts.keys():
            add = self.weights[t] * impact(counts[t], m)
            for j in self.holds[t]:
                if j in out:
                    out[j] += add
        return [out[j] for j in wanted]


def _bin(bounds: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(bounds, 1)) * STEPS).astype(np.int32)


def bound_counts(sketches: DataFrame, shard) -> DataFrame:
    """(place, bin, docs): how many documents have a bound in each logarithmic bin, for every item."""
    schema = pa.schema([("place", pa.int32()), ("bin", pa.int32()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for bounds, _ in _bounded(batches, shard.value):
            rows, places = np.nonzero(bounds > 0)
            pairs, many = np.unique(places.astype(np.int64) << 32 | _bin(bounds[rows, places]), return_counts=True)
            total.update(dict(zip(pairs.tolist(), many.tolist())))
        keys = np.fromiter(total, np.int64, len(total))
        yield pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(list(total.values()), pa.int64())], schema=schema)

    parts = sketches.select("n", "sketch").mapInArrow(count, "place int, bin int, docs long")
    return parts.groupBy("place", "bin").agg(F.sum("docs").alias("docs"))


def _bounded(batches: Iterator[pa.RecordBatch], shard: Shard) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    for whole in batches:
        for at in range(0, whole.num_rows, DOCS_AT_ONCE):
            batch = whole.slice(at, DOCS_AT_ONCE)
            if batch.num_rows:
                yield shard.bounds(batch.column("n").to_numpy(), batch.column("sketch").to_pylist()), batch


def candidates(sketches: DataFrame, shard, least: np.ndarray, below: np.ndarray) -> DataFrame:
    """(doc_id, mark, places): documents with the items whose bound lies from ``least`` to under ``below``."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("places", pa.list_(pa.int32()))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, batch in _bounded(batches, shard.value):
            hit = (bounds > 0) & (bounds >= least) & (bounds < below)
            rows = np.flatnonzero(hit.any(axis=1))
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("mark").take(take), pa.array([np.flatnonzero(hit[r]).astype(np.int32) for r in rows], pa.list_(pa.int32()))], schema=schema)

    found = sketches.mapInArrow(choose, "doc_id long, mark long, places array<int>")
    # rows that repeat a doc_id and a text have the same bounds
    return found.groupBy("doc_id", "mark").agg(F.first("places").alias("places"))


def rescored(docs: DataFrame, chosen: DataFrame, shard) -> DataFrame:
    """(place, doc_id, score) of the chosen documents, from their whole texts."""
    schema = pa.schema([("place", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, doc, value = [], [], []
            for d, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "places"))):
                place += places
                doc += [d] * len(places)
                value += shard.value.scores(text, places)
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(doc, pa.int64()), pa.array(value, pa.int64())], schema=schema)

    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    names = chosen.select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "places")
    return _marked(docs).join(names, same).select("doc_id", "text", "places").mapInArrow(score, "place int, doc_id long, score long")


def best_of(scores: DataFrame, best: int) -> DataFrame:
    """The highest scores of every item; Spark cuts each task's part to ``best`` rows before the shuffle."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents for every item: item_id, rank, doc_id, score.

    One pass over the texts counts how many documents hold each term of an item, another folds
    every document into a sketch (see :func:`sketch`) and counts documents and terms. The weights
    of an item, summed by coordinate, times the impacts of a sketch bound the item's score from
    above. Documents with the highest bounds are scored exactly; their ``best``-th score is a
    threshold, and every document whose bound reaches it is scored as well. What stays below the
    threshold cannot enter the ranking, so the result is that of scoring everything.

    Null and termless texts match nothing. Rows that share an item_id are one item with the terms
    of all of them; rows without an item_id are left out. Equal scores go by ascending doc_id, a
    null doc_id last; rows that repeat a doc_id are ranked each. Empty tables give an empty result;
    other columns are not read. Items are taken in shards of at most ``SHARD_TERMS`` terms, with
    two or three passes over the sketches for each.
    """
    spark = docs.sparkSession
    sketches = stored(sketched(docs))
    sums = sketches.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    out = None
    for shard_items in _shards(items):
        wanted = frozenset(t for ts in shard_items.values() for t in ts)
        if not sums["docs"] or not wanted:
            continue
        found = {bytes(r["term"]): r["df"] for r in holders(docs, wanted).collect()}
        plain = Shard(shard_items, found, sums["docs"], sums["terms"])
        shard = spark.sparkContext.broadcast(plain)
        least = _first_bounds(bound_counts(sketches, shard), len(plain.ids), best * FIRST_BEST)
        all_above = np.full(len(plain.ids), np.inf)
        first = stored(best_of(rescored(docs, stored(candidates(sketches, shard, least, all_above)), shard), best))
        # the lowest of ``best`` exact scores; with fewer of them every document that may score counts
        threshold = np.ones(len(plain.ids))
        for r in first.groupBy("place").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") >= best).collect():
            threshold[r["place"]] = r["low"]
        rest = stored(candidates(sketches, shard, threshold, least))
        both = first.select("place", "doc_id", "score").unionByName(rescored(docs, rest, shard))
        names = spark.createDataFrame([(j, item) for j, item in enumerate(plain.ids)], "place int, item_id long")
        shown = stored(best_of(both, best).join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score"))
        shard.unpersist()
        out = shown if out is None else out.unionByName(shown)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _first_bounds(counts: DataFrame, places: int, many: int) -> np.ndarray:
    """For every item the lower end of the bin at which the highest bounds number ``many`` or more (0: all)."""
    down = Window.partitionBy("place").orderBy(F.desc("bin"))
    above = counts.withColumn("above", F.sum("docs").over(down)).where(F.col("above") >= many)
    out = np.zeros(places)
    for r in above.groupBy("place").agg(F.max("bin").alias("bin")).collect():
        out[r["place"]] = 2.0 ** (r["bin"] / STEPS) * (1 - 1e-12)
    return out


def _shards(items: DataFrame) -> Iterator[dict[int, list[bytes]]]:
    """Distinct terms of the items, in shards; a shard's items reach the driver, the others wait."""
    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    chars = rows.agg(F.sum(F.length("text")).alias("chars"), F.countDistinct("item_id").alias("items")).first()
    shards = max(parts_for(chars["chars"] or 0, 2 * SHARD_TERMS), parts_for(chars["items"], SHARD_ITEMS))
    for at in range(shards):
        found: dict[int, set[bytes]] = {}
        for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == at).collect():
            found.setdefault(r["item_id"], set()).update(terms_of(r["text"]))
        yield {item: sorted(ts) for item, ts in found.items() if ts}


# Terms, weights and impacts as in the contract; documents and items need ids of their own here.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
h AS (SELECT doc_id, r, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*) AS big_n, CAST(sum(n) AS hugeint) AS big_l FROM h),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM h) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS bigint) AS w FROM t, g GROUP BY term, big_n),
i AS (SELECT t.r, t.term, (1000000000 * tf) // (1000 * tf + 8 * CAST(10 + (90 * n * big_n) // big_l AS bigint)) AS imp FROM t JOIN h ON t.r = h.r, g),
s AS (SELECT item_id, doc_id, i.r, CAST(sum(w * imp) AS bigint) AS score FROM i JOIN w ON i.term = w.term JOIN q ON q.term = i.term JOIN h ON h.r = i.r GROUP BY item_id, doc_id, i.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10"""


@register("op12_ranked_search", SQL)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
