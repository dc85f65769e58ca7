"""Near duplicates by SimHash: Golay-code keys of fingerprint segments, joined and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm import golay
from skyloom.llm.common import parts_for, read_table, register, text_of
from skyloom.llm.components import components, extended
from skyloom.session import stored

WORDS, SEED = 3, 42
BITS, DISTANCE = 64, 3
# first bit and width of the three segments; three errors leave one segment with one error at most
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CHUNK = 1_024  # members of a bucket that are compared with each other at once
HASHES_AT_ONCE = 1 << 16
FINGERPRINTS_PER_PART = 20_000

_U = np.uint64


def fingerprint(text: str) -> int:
    """Majority bits of the XXH64 values (seed 42) of all three-word shingles, as a signed 64-bit number.

    Only A-Z are lower-cased and only blank, tab and line ends separate words, which is what
    ``bytes.lower`` and ``bytes.split`` do to UTF-8. A text below three words is one shingle; one
    without words has the fingerprint 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(1, len(words) - WORDS + 1))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at:at + HASHES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(sign, "doc_id long, fp long")


def _packed(kind: int, parts: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Parts of given widths and the number of the kind of key, side by side in 64 bits."""
    out = np.full(np.broadcast_shapes(*(x.shape for x, _ in parts)), kind, np.int64)
    for x, width in parts:
        out = (out << width) | x
    return out.reshape(len(out), -1)


def segment_keys(marks: np.ndarray) -> np.ndarray:
    """Keys (len(marks), many) of 64-bit fingerprints: two of at most three differing bits share one.

    If some segment has no error, one of the others has one at most: each segment as it is, with
    the Golay keys of each other segment (six kinds of 33 or 34 bits). Otherwise every segment has
    one error: the nearest codeword of one of the first two segments, the Golay keys of the other
    and those of the third, and the parities of the segments, which all change together (two kinds
    of 38 bits). In the latter a pair meets at the nearest codeword of one member in the first and
    that of the other in the second segment.
    """
    parts = [((marks >> _U(first)) & _U((1 << width) - 1)).astype(np.int64) for first, width in SEGMENTS]
    near = [golay.keys(p).astype(np.int64) for p in parts]
    out = []
    for i, (_, width) in enumerate(SEGMENTS):
        for j in range(3):
            if j != i:
                out.append(_packed(3 * i + j, [(parts[i][:, None], width), (near[j], golay.INFORMATION)]))
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    turned = ((odd[0] ^ odd[1]) << 1 | (odd[1] ^ odd[2]))[:, None, None]
    third = near[2][:, None, :]
    # both kinds carry one number, for a pair meets with the key of one kind and that of the other
    for a, b in ((near[0][:, :1], near[1]), (near[0], near[1][:, :1])):
        out.append(_packed(9, [(a[:, :, None], golay.INFORMATION), (b[:, :, None], golay.INFORMATION), (third, golay.INFORMATION), (turned, 2)]))
    return np.concatenate(out, axis=1)


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, fp) for every distinct key of every fingerprint."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            found = np.sort(segment_keys(fps.view(np.uint64)), axis=1)
            new = np.ones(found.shape, bool)
            new[:, 1:] = found[:, 1:] != found[:, :-1]
            yield pa.RecordBatch.from_arrays([pa.array(found[new]), pa.array(np.repeat(fps, new.sum(axis=1)))], schema=schema)

    return nodes.select("fp").mapInArrow(spread, "key long, fp long")


def linked_fingerprints(nodes: DataFrame) -> DataFrame:
    """(node, comp) of all fingerprints ``fp`` that have a link; comp is the smallest fingerprint of the component.

    In each bucket every member is compared with the least fingerprint there, so a bucket of close
    copies hangs together after one linear step. Buckets that still hold several components are cut
    into chunks by hash, and every two chunks meet under a key of their own, so the work of a bucket
    is shared out; there only members of different components are compared. No pair of at most three differing bits that could join
    two components is left out.
    """
    # one shuffle by key serves the counts and the join with them
    rows = keyed(nodes).repartition("key")
    several = rows.groupBy("key").agg(F.min("fp").alias("hub"), F.max("fp").alias("top"), F.count("*").alias("n")).where("hub < top")
    members = stored(rows.join(several.select("key", "hub", "n").hint("shuffle_hash"), "key"))
    near = F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= DISTANCE
    links = stored(members.where((F.col("hub") != F.col("fp")) & near).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct())
    comps = components(links)
    # a bucket of two is settled by its hub
    placed = members.where("n > 2").join(comps.withColumnRenamed("node", "fp"), "fp", "left")
    placed = stored(placed.select("key", "fp", "n", F.coalesce("comp", "fp").alias("comp")))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    left = placed.join(mixed, "key").withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    left = left.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    left = stored(left.select("key", "fp", "comp", "chunk", "chunks"))
    upto = left.select("key", F.col("fp").alias("fp_b"), F.col("comp").alias("comp_b"), F.col("chunk").alias("j"), F.explode(F.sequence(F.lit(0), "chunk")).alias("i"))
    onward = left.select("key", F.col("fp").alias("fp_a"), F.col("comp").alias("comp_a"), F.col("chunk").alias("i"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("j"))
    meets = onward.join(upto, ["key", "i", "j"]).where((F.col("comp_a") != F.col("comp_b")) & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= DISTANCE))
    more = stored(meets.select(F.least("comp_a", "comp_b").alias("a"), F.greatest("comp_a", "comp_b").alias("b")).distinct())
    return comps if more.isEmpty() else extended(comps, more)


def simhash_classes(docs: DataFrame) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id, linked.

    ``fingerprint`` is 16 lower-case hexadecimal digits; rows whose fingerprints differ in three
    bits or fewer are linked, and component_id is the smallest doc_id that links reach.
    ``linked`` tells whether another row is in the component.

    Null text is the empty text: no words, fingerprint 0, linked like any other. A null doc_id
    counts as larger than any number, so a component has a null id only if all its doc_ids are null.
    Repeated rows and rows that repeat a doc_id stay rows of their own. An empty table gives an
    empty result; other columns are not read.
    """
    rows = stored(with_fingerprints(docs))
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    # a narrow row becomes some 80 keys, so the parts are smaller than their bytes would make them
    comps = linked_fingerprints(nodes.repartition(parts_for(nodes.count(), FINGERPRINTS_PER_PART), "fp"))
    known = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    known = stored(known)
    classes = known.groupBy("comp").agg(F.min("least").alias("component_id"), (F.sum("n") > 1).alias("linked"))
    by_mark = stored(known.join(classes, "comp").select("fp", "component_id", "linked"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_mark, "fp").select("doc_id", shown.alias("fingerprint"), "component_id", "linked")


@register("op13_simhash")
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_classes(read_table(spark, folder, "documents"))
