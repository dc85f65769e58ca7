"""Exact and near duplicates against brute force, and the defined results of edge cases."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import common, exact, fuse, near
from skyloom.llm.common import rows_that_stay
from skyloom.llm.components import components, extended

DOCS = "doc_id long, text string, lang string, digest string, _own string"
ROWS = [
    (1, "same text here", None, "x", None), (5, "same text here", "en", None, "y"), (3, None, None, None, None), (4, "", "de", None, None),
    (7, "w " * 30_000, None, None, None), (8, "w " * 30_000, None, None, None), (9, "alone", None, None, None),
    (9, "alone", None, None, None), (None, "no id", None, None, None), (None, "same text here", None, None, None),
]


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        given = [i for i in ids if i is not None]
        keep = max(given) if given else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 5_000])
def test_fuse_filter_has_no_false_negatives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2**63, 2**63 - 1, n)
    data = fuse.build(np.concatenate([keys, keys]))
    assert fuse.contains(data, keys).all()
    assert fuse.contains(data, rng.integers(-2**63, 2**63 - 1, 20_000)).mean() < 0.001


@pytest.mark.parametrize("bits", [None, 1, 4])
def test_exact_groups_even_if_digests_clash(spark, bits):
    docs = spark.createDataFrame(ROWS, DOCS)
    digest = exact.default_digest if bits is None else lambda t: F.unhex(F.substring(F.sha2(t.cast("binary"), 256), 1, bits))
    got = exact.exact_groups(docs, exact.newest_batch(), digest).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute_exact(ROWS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_dropping_copies_keeps_columns_and_one_of_repeated_rows(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, len(r.text or "")) for r in left.collect()), key=repr) == sorted(
        [(5, 14), (4, 0), (8, 60_000), (9, 5), (None, 5)], key=repr
    )
    assert rows_that_stay(docs.limit(0), docs.limit(0).select("doc_id", F.lit(b"").alias("digest"))).count() == 0


def test_signature_agreement_is_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(3)
    a, b, true = [], [], []
    for _ in range(300):
        bag = np.repeat(rng.integers(0, 2**63, 60).astype(np.uint64), rng.integers(1, 9, 60))
        other = bag.copy()
        at = rng.choice(len(bag), len(bag) // 10, replace=False)
        other[at] = rng.integers(0, 2**63, len(at))
        a.append(bag)
        b.append(other)
        true.append(near.weighted_jaccard(bag, other))
    same = (near.bag_minhash(a) == near.bag_minhash(b)).mean(axis=1)
    assert abs(same.mean() - np.mean(true)) < 0.01 and np.std(same - np.array(true)) < 0.06


def near_rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(40, 120))]
        for copy in range(rnd.randint(1, 9)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows + [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "one two three"), (None, "null id " * 9)]


def brute_near(rows):
    bags = {t or "": near.shingles(t or "") for _, t in rows}
    texts = list(bags)
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if a and b and near.weighted_jaccard(bags[a], bags[b]) >= near.SIMILARITY:
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for i, t in rows:
        classes[root(t or "")].append(i)
    return {i: (min((x for x in ids if x is not None), default=None), len(ids)) for ids in classes.values() for i in ids}


@pytest.mark.parametrize("growth", [2, 16])
def test_near_classes_are_those_of_all_pairs(spark, monkeypatch, growth):
    monkeypatch.setattr(near, "HUB_GROWTH", growth)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bands", F.lit("clash"))
    got = near.near_classes(docs).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == brute_near(rows)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})


def borderline_groups():
    """Texts in groups: two at a similarity of 0.80 that meet only in buckets of a third, which is linked to neither but to many others.

    Kept are groups whose two texts agree in fewer than 58 places of their signatures.
    """
    def edited(text, name, *places):
        return [f"{name}{i}" if i in places else w for i, w in enumerate(text)]

    groups = []
    for g in range(2_500):
        base = [f"g{g}w{i}" for i in range(95)]
        hub = edited(base, f"g{g}h", 22, 72)
        groups.append([edited(base, f"g{g}a", 20), edited(base, f"g{g}b", 70), hub, *(edited(hub, f"g{g}s{i}", 45) for i in range(9))])
    groups = [[" ".join(t) for t in texts] for texts in groups]
    marks = near.bag_minhash([near.shingles(t) for texts in groups for t in texts[:3]]).reshape(-1, 3, near.COMPONENTS)
    bands = near.band_keys(marks.reshape(-1, near.COMPONENTS)).reshape(-1, 3, near.BANDS)
    a, b, hub = bands[:, 0], bands[:, 1], bands[:, 2]
    weak = (marks[:, 0] == marks[:, 1]).sum(axis=1) < 58
    meets = (a == b).any(axis=1) & ((a != b) | (a == hub)).all(axis=1)
    return [groups[i] for i in np.flatnonzero(weak & meets)]


def test_borderline_pairs_under_a_foreign_hub_are_linked(spark):
    groups = borderline_groups()
    assert len(groups) > 5
    for a, b, hub, *_ in groups:
        sims = [near.weighted_jaccard(near.shingles(x), near.shingles(y)) for x, y in ((a, b), (a, hub), (b, hub))]
        assert 0.8 <= sims[0] < 0.83 and max(sims[1:]) < 0.8
    rows = [(12 * g + i, t) for g, texts in enumerate(groups) for i, t in enumerate(texts)]
    classes = {r.doc_id: r.class_id for r in near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(classes[12 * g] == classes[12 * g + 1] == 12 * g for g in range(len(groups)))


def test_parities_never_show_more_than_the_difference():
    rng = np.random.default_rng(8)
    for size in (1, 60, 5_000):
        bag = rng.integers(0, 2**63, size).astype(np.uint64)[rng.integers(0, size, 2 * size)]
        other = np.concatenate([bag[size // 5:], rng.integers(0, 2**63, size // 4).astype(np.uint64)])
        a, b = near.parities([bag, other]).view(np.uint64)
        keys, where = np.unique(np.concatenate([bag, other]), return_inverse=True)
        differ = np.abs(np.bincount(where[:len(bag)], minlength=len(keys)) - np.bincount(where[len(bag):], minlength=len(keys))).sum()
        assert 0 <= np.bitwise_count(a ^ b).sum() <= differ
        assert not (near.parities([bag])[0] ^ near.parities([bag[::-1]])[0]).any()


def test_near_classes_of_one_large_group(spark):
    words = [f"v{i}" for i in range(90)]
    rows = [(i, " ".join(words[:40] + [f"x{i}"] + words[40:])) for i in range(300)]
    got = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 300)}
    assert sum(r.n_links for r in got) < 300 * 60  # far below all pairs


def test_near_copies_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert near.drop_near_copies(docs).collect() == [] and near.drop_near_copies(docs).columns == docs.columns


def test_components_of_chains_and_later_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    comps = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.comp for r in comps.collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    more = extended(comps, spark.createDataFrame([(101, 40), (200, 201)], "a long, b long"))
    assert {r.node: r.comp for r in more.collect()} == {**dict.fromkeys([*range(41), 100, 101, 102], 0), 200: 200, 201: 200}


def test_hot_keys_are_few_and_both_sides_meet(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(500)] + [("warm", i) for i in range(70)] + [(f"k{i}", i) for i in range(100)], "key string, at long")
    hot = common.hot_keys(rows.groupBy("key").agg(F.count("*").alias("n")), "key", rows.count())
    assert {r["key"]: r["salts"] for r in hot.collect()} == {"hot": 8, "warm": 2}
    left, right = common.dealt(rows, "key", hot, ["at"]), common.repeated(rows.select("key").distinct(), "key", hot)
    assert left.count() == rows.count() and right.count() == 100 + 8 + 2
    met = left.join(right, ["key", "salt"])
    assert met.count() == rows.count() and met.where("key = 'hot'").select("salt").distinct().count() == 8


def test_many_copies_of_one_text(spark):
    rows = [(i, "one text that many hold" if i % 3 else f"own text {i}") for i in range(600)] + [(None, "one text that many hold"), (7, "own text 9")]
    got = exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), exact.newest_batch()).collect()
    last, size = {}, {}
    for i, t in rows:
        last[t] = max(last.get(t, -1), -1 if i is None else i)
        size[t] = size.get(t, 0) + 1
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in rows}
    assert len(got) == len(rows) and all((r.keep_id, r.group_size) == (last[digest[r.text_sha256]], size[digest[r.text_sha256]]) for r in got)
    assert sum(r.kept for r in got) == len(last)


def test_labels_of_a_node_with_many_links(spark):
    links = [("m", f"x{i:04d}") for i in range(700)] + [(f"x{i:04d}", f"y{i:04d}") for i in range(0, 700, 7)] + [("a", "y0007"), ("p", "q")]
    comps = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert len(comps) == 1 + 700 + 100 + 1 + 2 and {c for n, c in comps.items() if n not in "pq"} == {"a"} and comps["q"] == "p"
