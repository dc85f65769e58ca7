"""Near duplicates: BagMinHash signatures of word shingles, banded, then verified by multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from skyloom.llm.common import dealt, hot_keys, read_table, register, repeated, rows_that_stay, text_digest, text_of
from skyloom.llm.components import components, extended
from skyloom.session import stored

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 5
COMPONENTS = BANDS * ROWS
PARITY_WORDS = 16  # 64-bit words of the parities that bound a pair's difference from below
HUB_GROWTH = 16
HUBS_PER_SALT = 8  # members of a hot band that one salt holds, for each hub that is sent to it
DOCS_AT_ONCE = 512

_U = np.uint64
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WORDS)], np.uint64)


class _WordHashes(dict):
    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        out = xxhash.xxh3_64_intdigest(word.lower())
        if len(word) <= 40:
            self[word] = out
        return out

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_HASHES = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of all runs of five words, with repeats; a shorter text is one shingle, an empty one has none."""
    words = _HASHES.of(text)
    n = len(words)
    if n == 0:
        return words
    if n < WORDS:
        return _mix((words * _POWERS[:n]).sum(keepdims=True) + _U(n))
    out = np.zeros(n - WORDS + 1, np.uint64)
    for i in range(WORDS):
        out += words[i:n - WORDS + 1 + i] * _POWERS[i]
    return _mix(out)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of the multiplicities; two empty multisets are equal."""
    if not len(a) and not len(b):
        return 1.0
    keys, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(where[:len(a)], minlength=len(keys)), np.bincount(where[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def bag_minhash(bags: list[np.ndarray]) -> np.ndarray:
    """Signatures (documents, COMPONENTS): equal in a share of places whose mean is the weighted Jaccard similarity.

    Weights are whole numbers, cut into dyadic blocks of levels (1, 2, 3-4, 5-8, ...). Every shingle
    and block has a Poisson process whose rate grows with the block; a point carries a place of the
    signature and a level of its block, and counts if the shingle's weight reaches that level. A
    process goes on only while its next point could still lower some place of its document.
    The signature holds the code of the first point at each place.
    """
    docs = len(bags)
    sizes = np.array([len(b) for b in bags])
    doc = np.repeat(np.arange(docs), sizes)
    both = np.concatenate(bags) if docs else np.zeros(0, np.uint64)
    order = np.lexsort((both, doc))
    both, doc = both[order], doc[order]
    new = np.ones(len(both), bool)
    new[1:] = (both[1:] != both[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    weight = np.diff(np.append(starts, len(both)))
    key, doc = both[starts], doc[starts]
    # one item for each block that a weight reaches: block 0 is level 1, block k holds levels 2^(k-1)+1 to 2^k
    blocks = np.ceil(np.log2(weight)).astype(np.int64) + 1
    item = np.repeat(np.arange(len(key)), blocks)
    block = np.arange(len(item)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    key, doc, weight = _mix(key[item] + _U(0x632BE59BD9B4E019) * block.astype(np.uint64)), doc[item], weight[item]
    span = np.where(block > 0, 1 << np.maximum(block - 1, 0), 1)
    below = np.where(block > 0, span, 0)
    time = np.zeros(len(key))
    first = np.full(docs * COMPONENTS, np.inf)
    codes = np.zeros(docs * COMPONENTS, np.uint32)
    step = 0
    while len(key):
        step += 1
        h = _mix(key + _U(step * 0xD1342543DE82EF95 % 2**64))
        time = time - np.log(((h >> _U(11)).astype(np.float64) + 0.5) / 2.0**53) / span
        h2 = _mix(h)
        place = doc * COMPONENTS + ((h2 & _U(0xFFFFFFFF)) * _U(COMPONENTS) >> _U(32)).astype(np.int64)
        level = below + 1 + (h2 >> _U(33)).astype(np.int64) % span
        hit = (level <= weight) & (time < first[place])
        at, t = place[hit], time[hit]
        np.minimum.at(first, at, t)
        won = first[at] == t
        codes[at[won]] = (h[hit][won] >> _U(16)).astype(np.uint32)
        last = first.reshape(docs, COMPONENTS).max(axis=1)
        on = time < last[doc]
        key, doc, weight, span, below, time = (x[on] for x in (key, doc, weight, span, below, time))
    return codes.reshape(docs, COMPONENTS)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64)[None, :] + _U(1)
    for r in range(ROWS):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + rows[:, :, r])
    return out.view(np.int64)


def parities(bags: list[np.ndarray]) -> np.ndarray:
    """One bit for each of 64 * PARITY_WORDS bins of every bag: whether the bin holds an odd number of shingles.

    A bin whose bits differ has a shingle that only one of two bags holds, so no fewer shingles
    differ than bits.
    """
    bins = 64 * PARITY_WORDS
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    place = (np.concatenate(bags) % _U(bins)).astype(np.int64) if bags else np.zeros(0, np.int64)
    odd = (np.bincount(doc * bins + place, minlength=len(bags) * bins) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(bags), PARITY_WORDS)


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, bands, size, parity) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("size", pa.int64()), ("parity", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(at, DOCS_AT_ONCE)
                own = {}
                places = [own.setdefault(t, len(own)) for t in batch.column("text").to_pylist()]
                bags = [shingles(t) for t in own]
                keys, odd = band_keys(bag_minhash(bags)).tolist(), parities(bags).tolist()
                bands, parity = ([x[p] if len(bags[p]) else [] for p in places] for x in (keys, odd))
                sizes = [len(bags[p]) for p in places]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *(pa.array(x, k) for x, k in zip((bands, sizes, parity), schema.types[2:]))], schema=schema)

    rows = docs.select("doc_id", text_digest().alias("digest"), text_of().alias("text"))
    return rows.mapInArrow(sign, "doc_id long, digest binary, bands array<long>, size long, parity array<long>")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Similarity of each pair (a, b) of digests, from all shingles of both texts."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("sim", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, bag = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")))
            out = []
            for a, b, text_a, text_b in rows:
                if a != hub:
                    hub, bag = a, shingles(text_a)
                out.append((a, b, weighted_jaccard(bag, shingles(text_b))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.types[i]) for i in range(3)], schema=schema)

    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))
    # the pairs of a hub are dealt over several places, and its text is sent to each
    hot = hot_keys(pairs.groupBy("a").agg(F.count("*").alias("n")), "a", pairs.count())
    placed = dealt(pairs.join(right, "b"), "a", hot, ["b"]).join(repeated(left, "a", hot), ["a", "salt"]).drop("salt")
    return placed.mapInArrow(compare, "a binary, b binary, sim double")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Class of every row: doc_id, class_id (smallest doc_id of the class), class_size, n_links, kept, text_sha256.

    Equal texts are one node. Two nodes are linked if their multisets of five-word shingles (words
    by white space, lower-cased) have a weighted Jaccard similarity of ``similarity`` or more and
    their signatures share a band; classes are the connected components. In every bucket of
    a band all members are first compared with one hub, the member that meets most others in its
    buckets: of copies of one original, the one nearest to it. Buckets that still hold several
    components go on with the next hubs in that order, ``HUB_GROWTH`` times as many in each round, against members
    of other components, until no such pair is untested. Pairs are left out only where a bound shows
    that they are below ``similarity``: the triangle inequality with the hub, the sizes of the bags
    and the bins whose parities differ. So copies of one text are never paired, nor are members of a
    class that already hangs together, and no pair that shares a band and would join two classes is
    left out. n_links counts the links found at the row's text.

    Null text is empty; empty texts are equal to each other and to nothing else. Texts below five
    words are one shingle. Null doc_ids are larger than any other; of rows that repeat a doc_id and a
    text one is kept. An empty table gives an empty result; other columns are not read.
    """
    rows = stored(_signed(docs))
    nodes = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("bands", "size", "parity")]))
    banded = nodes.select("digest", F.posexplode("bands").alias("at", "band"))
    several = banded.groupBy("band").agg(F.count("*").alias("met")).where("met > 1")
    shared = stored(banded.join(several, "band"))
    degree = shared.groupBy("digest").agg(F.sum("met").alias("met"))
    most = F.min(F.struct((-F.col("met")).alias("o"), F.xxhash64("digest").alias("h"), "digest"))
    shared = shared.drop("met").join(degree, "digest")
    members = stored(shared.join(shared.groupBy("band").agg(most.alias("hub")).select("band", F.col("hub.digest").alias("hub")), "band"))
    wanted = members.select("digest").distinct().join(nodes.select("digest", "least"), "digest")
    own = docs.select(text_digest().alias("digest"), text_of().alias("text"), "doc_id")
    texts = own.join(wanted, "digest").where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("digest").agg(F.min("text").alias("text"))
    texts = stored(texts)

    pairs = stored(members.where("hub != digest").select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct())
    first = stored(compared(pairs, texts))
    links = first.where(F.col("sim") >= similarity).select("a", "b")
    members = members.join(first.select(F.col("a").alias("hub"), F.col("b").alias("digest"), "sim"), ["hub", "digest"], "left")
    members = stored(members.select("band", "at", "digest", "met", F.coalesce("sim", F.lit(1.0)).alias("sim")))
    tested, hubs, comps = pairs, 1, components(links)
    # a member's place among the hubs of its band: comparing places needs no number for each member
    place = F.struct((-F.col("met")).alias("o"), F.xxhash64("digest").alias("h"), "digest")
    order = Window.partitionBy("band").orderBy("place")
    left = members
    while True:
        placed = left.select("band", "at", "digest", "met", "sim").join(comps.withColumnRenamed("node", "digest"), "digest", "left")
        placed = placed.withColumn("comp", F.coalesce("comp", "digest"))
        mixed = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
        mixed = mixed.where((F.col("lo") != F.col("hi")) & (F.col("n") > hubs))
        left = stored(placed.join(mixed.select("band"), "band", "left_semi"))
        if left.isEmpty():
            break
        old, hubs = hubs, hubs * HUB_GROWTH
        hot = hot_keys(left.groupBy("band").agg(F.count("*").alias("n")), "band", left.count(), HUBS_PER_SALT * hubs)
        full = left.join(nodes.select("digest", "bands", "size", "parity"), "digest").withColumn("place", place)
        full = stored(dealt(full, "band", hot, ["digest"]))
        # the first of every salt are enough to find the first of the band; members before the new hubs have met everyone already
        few = full.select("band", "salt", "place", "digest", "comp", "bands", "size", "parity", "sim")
        few = few.withColumn("rank", F.row_number().over(Window.partitionBy("band", "salt").orderBy("place"))).where(F.col("rank") <= hubs)
        heads = few.withColumn("rank", F.row_number().over(order)).where((F.col("rank") > old) & (F.col("rank") <= hubs))
        heads = heads.select("band", *[F.col(c).alias(f"hub_{c}") for c in ("digest", "comp", "bands", "size", "parity", "sim", "place")])
        heads = repeated(heads, "band", hot)
        # a pair counts in the first of its common bands only
        same = F.zip_with("bands", "hub_bands", lambda x, y: (x == y).cast("int"))
        near = F.abs(F.col("sim") - F.col("hub_sim")) <= 1 - similarity + 1e-9
        near &= F.least("size", "hub_size") >= F.greatest("size", "hub_size") * similarity - 1e-6
        # of n shingles in both bags, no more than n * (1 - similarity) / (1 + similarity) differ in a link
        odd = reduce(add, (F.bit_count(F.get("parity", F.lit(i)).bitwiseXOR(F.get("hub_parity", F.lit(i)))) for i in range(PARITY_WORDS)))
        near &= odd <= (F.col("size") + F.col("hub_size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
        more = full.join(heads, ["band", "salt"]).where((F.col("place") > F.col("hub_place")) & (F.col("comp") != F.col("hub_comp")) & near & (F.array_position(same, 1) == F.col("at") + 1))
        more = more.withColumnRenamed("hub_digest", "hub")
        more = more.select(F.least("hub", "digest").alias("a"), F.greatest("hub", "digest").alias("b")).distinct()
        done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more = stored(more.join(done, ["a", "b"], "left_anti"))
        tested = tested.unionByName(more)
        fresh = stored(compared(more, texts).where(F.col("sim") >= similarity).select("a", "b"))
        links = links.unionByName(fresh)
        comps = extended(comps, fresh)

    ends = links.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count("*").alias("n_links"))
    known = nodes.select("digest", "least", "n").join(comps.withColumnRenamed("node", "digest"), "digest", "left").join(ends, "digest", "left")
    known = stored(known.select("digest", "least", "n", F.coalesce("comp", "digest").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    classes = known.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.col("least").isNull(), "least", "digest"))["digest"].alias("keeper"))
    by_text = stored(known.join(classes, "comp").select("digest", "class_id", "class_size", "n_links", (F.col("digest") == F.col("keeper")).alias("keeps")))
    return rows.select("doc_id", "digest").join(by_text, "digest").select(
        "doc_id", "class_id", "class_size", "n_links", (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of ``docs``."""
    kept = near_classes(docs).where("kept").select("doc_id", F.unhex("text_sha256").alias("digest"))
    return rows_that_stay(docs, kept)


@register("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(read_table(spark, folder, "documents"))
