"""Best-fit packing of token pieces into sequences by minimum bin slack."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyloom.llm.common import crc_of, read_table, register, text_of, word_cache
from skyloom.session import stored

CAPACITY = 2048
END_ID = 0
CHUNK_ROWS, MOST_CHUNKS = 2_000, 4_096
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of at most ``capacity`` tokens.

    Only documents longer than that are cut; the remainder comes first. ``with_ids`` adds the ids
    as little-endian unsigned 32-bit integers. ``row`` numbers the rows of ``docs``, so that
    repeated and null doc_ids stay apart.
    """
    import numpy as np

    end = np.asarray([end_id], "<u4").tobytes()
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, " ")
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = cache.encode(text) + end
                total = len(ids) // 4
                start, piece = 0, 0
                while start < total:
                    stop = start + (total % capacity or capacity) if start == 0 else start + capacity
                    part = ids[4 * start:4 * stop]
                    for name, value in zip(out, (row, doc_id, piece, start, stop - start, crc_of(part), part)):
                        out[name].append(value)
                    start, piece = stop, piece + 1
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    return rows.mapInArrow(cut, schema)


def fullest(available: dict[int, int], room: int, hot: int | None = None) -> dict[int, int]:
    """The combination of available lengths with the largest total up to ``room``: bitset subset sums.

    Bit s of the set says that total s can be reached. Counts are split into powers of two, so a
    length costs a few shifts; the sets before each step give the combination back. Longer lengths
    come first, so among equal totals they are preferred; but most of all the length ``hot``.
    """
    most = min(available.get(hot, 0), room // hot) if hot else 0
    mask, reach, steps = (1 << (max(room, 0) + 1)) - 1, 1, []
    for length in sorted((n for n, c in available.items() if c > 0 and n <= room and n != hot), reverse=True):
        left, take = min(available[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, take = left - take, take * 2
        if reach >> (room - most * hot if hot else room) & 1:
            break
    best, total, chosen = -1, 0, {}
    for times in range(most, -1, -1):
        own = times * hot if hot else 0
        beside = (reach & ((1 << (max(room, 0) - own + 1)) - 1)).bit_length() - 1
        if own + beside > best:
            best, total, chosen = own + beside, beside, {hot: times} if times else {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def bin_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack over a histogram of lengths: (how many bins, lengths of one bin).

    Each bin takes the longest length left and the fullest combination beside it. The same bin is
    repeated while its lengths last, so every step leaves too few of some length for another one: the
    number of steps depends on ``capacity``, not on the number of pieces. A length that very many
    pieces share must be used while there is something to go with it, so the bins are also made
    with the length that fills most room preferred; the way that ends with fewer bins is kept.
    """
    heavy = max(histogram, key=lambda n: (n * histogram[n], n), default=None)
    ways = [_patterns(histogram, capacity, hot) for hot in (None, heavy)]
    return min(ways, key=lambda way: sum(times for times, _ in way))


def _patterns(histogram: dict[int, int], capacity: int, hot: int | None) -> list[tuple[int, dict[int, int]]]:
    left = {n: c for n, c in histogram.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        content = fullest(rest, capacity - longest, hot)
        content[longest] = content.get(longest, 0) + 1
        times = min(left[n] // c for n, c in content.items())
        out.append((times, content))
        for n, c in content.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
    return out


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (row, piece, length of 1 to ``capacity``) with sequence_id and offset.

    Only the histogram of lengths, at most ``capacity`` rows, reaches the driver. Pieces are
    numbered within their length in two levels (count per chunk, number in the chunk), so a length
    that most pieces share is spread over many tasks; a table of number ranges per length then gives
    the place. An empty table stays empty.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges, used, base = [], dict.fromkeys(histogram, 0), 0
    for times, content in bin_patterns(histogram, capacity):
        offset = 0
        for length, each in sorted(content.items(), reverse=True):
            ranges.append((length, used[length], used[length] + times * each, each, base, offset))
            used[length] += times * each
            offset += each * length
        base += times
    chunks = max(1, min(MOST_CHUNKS, sum(histogram.values()) // CHUNK_ROWS))
    keyed = pieces.withColumn("_chunk", F.pmod(F.xxhash64("row", "piece"), F.lit(chunks)).cast("int"))
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("length", "_chunk").agg(F.count("*").alias("_n")).select(
        "length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    own = F.row_number().over(Window.partitionBy("length", "_chunk").orderBy("row", "piece")) - 1
    ranked = keyed.withColumn("_own", own).join(starts, ["length", "_chunk"]).withColumn("_rank", F.col("_first") + F.col("_own"))
    table = spark.createDataFrame(ranges, "length long, _lo long, _hi long, _each long, _base long, _offset long")
    # a few rows for each of at most ``capacity`` lengths
    placed = ranked.join(F.broadcast(table), "length").where((F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    at = F.col("_rank") - F.col("_lo")
    return placed.select(
        *pieces.columns, (F.col("_base") + F.floor(at / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_each")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its sequence.

    Null and empty texts are one piece that holds the end id. Repeated rows and null doc_ids are
    documents of their own. Other columns are not read; an empty table gives an empty result.
    """
    pieces = stored(token_pieces(docs, path, capacity, end_id))
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"), default_tokenizer())
