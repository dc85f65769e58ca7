"""Exact duplicates: fuse filters of a snapshot screen new digests, exact buckets and bytes decide."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.llm import fuse
from skyloom.llm.common import dealt, hot_keys, parts_for, read_table, register, repeated, rows_that_stay, text_of
from skyloom.session import stored

KEYS_PER_FILTER = 200_000
LEAST_FILTERS = 32
BATCHES = 4


def default_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def filter_key(digest: str = "digest") -> Column:
    return F.xxhash64(digest)


def build_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """One static filter per shard of the snapshot's digests: (shard, filter)."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "filter": [fuse.build(frame["key"].to_numpy())]})

    keys = buckets.select(F.pmod(filter_key(), F.lit(shards)).cast("int").alias("shard"), filter_key().alias("key"))
    return keys.groupBy("shard").applyInPandas(one, "shard int, filter binary")


def screen(digests: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Digests that a filter does not rule out; each meets only the filter of its own shard."""

    def one(new: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        if not len(new) or not len(kept):
            return pd.DataFrame({"digest": pd.Series(dtype=object)})
        return new.loc[fuse.contains(kept["filter"].iloc[0], new["key"].to_numpy()), ["digest"]]

    keyed = digests.select("digest", F.pmod(filter_key(), F.lit(shards)).cast("int").alias("shard"), filter_key().alias("key"))
    return keyed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(one, "digest binary")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_groups(docs: DataFrame, incoming: Column, digest=default_digest) -> DataFrame:
    """Every row with its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    ``incoming`` tells rows of the new batch (null counts as new) from rows of the immutable
    snapshot. The snapshot is grouped to exact buckets of digests and gets static filters, sharded
    by digest. The new batch is grouped by itself; of its digests those that pass a filter join
    the exact buckets, the others are new for certain. Wherever a digest occurs more than once the
    bytes of every text are compared with those of the row that stays; should a digest stand
    for different texts, its rows are grouped by the texts themselves.

    Null text is the empty text; texts of any length count whole. The row with the largest doc_id
    stays; a null doc_id is smaller than any other, and of rows that repeat a doc_id and a text one
    stays. An empty table gives an empty result. Other columns are not read.
    """
    text = text_of()
    rows = stored(docs.select(
        "doc_id", digest(text).alias("digest"), F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.coalesce(incoming, F.lit(True)).alias("incoming"), F.monotonically_increasing_id().alias("row"),
    ))
    single = rows.select("digest", "incoming", F.struct("doc_id", "row").alias("best"), F.lit(1).cast("long").alias("n"))
    snapshot = stored(_grouped(single.where(~F.col("incoming"))))
    batch = stored(_grouped(single.where("incoming")))
    shards = parts_for(snapshot.count(), KEYS_PER_FILTER, LEAST_FILTERS)
    filters = stored(build_filters(snapshot, shards))
    passed = stored(screen(batch, filters, shards))
    known = batch.join(passed, "digest", "left_semi")
    fresh = batch.join(passed, "digest", "left_anti")
    groups = stored(_grouped(snapshot.unionByName(known)).unionByName(fresh))

    several = groups.where("n > 1").select("digest", F.col("best.doc_id").alias("keep_id"))
    # the copies of a frequent text are dealt over several places, and the text that stays is sent to each
    hot = hot_keys(groups.select("digest", "n"), "digest", rows.count())
    own = dealt(docs.select("doc_id", text.alias("text"), digest(text).alias("digest")), "digest", hot, ["doc_id"])
    texts = stored(own.join(repeated(several, "digest", hot), ["digest", "salt"]).select("digest", "salt", "doc_id", "text", "keep_id"))
    stays = texts.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("text").alias("kept_text"))
    compared = texts.join(repeated(stays, "digest", hot), ["digest", "salt"])
    clashes = stored(compared.where(F.col("text") != F.col("kept_text")).select("digest").distinct())
    clean, out = rows, []
    if not clashes.isEmpty():
        clean = rows.join(clashes, "digest", "left_anti")
        # a doc_id may repeat with different texts, so the clashing rows are taken with their text
        torn = docs.select("doc_id", text.alias("text"), digest(text).alias("digest"), F.monotonically_increasing_id().alias("row"))
        torn = stored(torn.join(clashes, "digest", "left_semi"))
        by_text = torn.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("n"))
        out = [_shown(torn.join(by_text, ["digest", "text"]).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)))]
    shown = _shown(dealt(clean, "digest", hot, ["row"]).join(repeated(groups, "digest", hot), ["digest", "salt"]))
    return shown if not out else shown.unionByName(out[0])


def _shown(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256",
    )


def newest_batch(column: str = "doc_id") -> Column:
    """The rows treated as the incoming batch: one of ``BATCHES`` by hash of the id."""
    return F.pmod(F.xxhash64(column), F.lit(BATCHES)) == 0


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of :func:`exact_groups` that stay, with all columns of ``docs``."""
    kept = exact_groups(docs, newest_batch()).where("kept")
    return rows_that_stay(docs, kept.select("doc_id", F.unhex("text_sha256").alias("digest")))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t"""


@register("op10_exact_dedup", SQL)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(read_table(spark, folder, "documents"), newest_batch())
