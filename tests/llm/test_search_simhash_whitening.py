"""Ranked search, SimHash components and whitening against plain Python and numpy, with odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyloom.llm import golay, ranking, simhash, whitening

FOLDER = "/root/testdata/sf0.001"


# --- ranked search -------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_ranks(docs, items, best=10):
    counted = [(d, Counter(TERM.findall(folded(t)))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(TERM.findall(folded(t)))
    out = []
    for i, terms in wanted.items():
        scores = []
        for d, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, math.inf if d is None else d, d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:best], 1)]
    return sorted(out, key=repr)


def ranks(spark, docs, items, **how):
    table = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, score string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in ranking.ranked(table, bench, **how).collect()), key=repr)


def some_docs(seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "été", "a_b", "x-y", "10", "日本"]
    docs = [(i, " ".join(rnd.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rnd.randint(1, 80)))) for i in range(150)]
    docs += [(200, docs[3][1]), (3, docs[3][1]), (201, None), (202, ""), (203, " ,.;"), (None, docs[5][1]), (204, "w1 " * 30_000), (205, "W1 w1\tw1\nw2"), (5, "w3 w4 w119")]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 12)))) for i in range(12)] + [(20, None), (21, ""), (22, "nowhere w119"), (22, "w118"), (None, "w1"), (23, "W2, w2. w2!")]
    return docs, items


def test_ranks_match_scoring_everything(spark, monkeypatch):
    docs, items = some_docs()
    want = brute_ranks(docs, items)
    assert ranks(spark, docs, items) == want
    # a sketch of four places bounds everything loosely and loses nothing; so do many small shards
    monkeypatch.setattr(ranking, "SHARD_ITEMS", 4)
    assert ranks(spark, docs, items) == want
    assert ranks(spark, docs, items, best=3) == brute_ranks(docs, items, 3)
    assert ranks(spark, docs[:0], items) == [] and ranks(spark, docs, items[:0]) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_bounds_are_never_below_scores(seed):
    docs, items = some_docs(seed)
    counted = [Counter(ranking.terms_of(t or "")) for _, t in docs]
    found = dict(Counter(t for c in counted for t in c))
    live = [c for c in counted if c]
    own = {i: sorted(set(ranking.terms_of(t))) for i, t in items if t and i is not None}
    shard = ranking.Shard(own, found, len(live), sum(sum(c.values()) for c in live))
    bounds = shard.bounds(np.array([sum(c.values()) for c in live]), [ranking.sketch(c) for c in live])
    for row, (_, text) in zip(bounds, [d for d, c in zip(docs, counted) if c]):
        scores = shard.scores(text, list(range(len(shard.ids))))
        assert all(b >= s for b, s in zip(row, scores)) and any(s > 0 for s in scores) == bool((row > 0).any() and max(scores) > 0)


def test_terms_are_the_maximal_runs_of_the_contract():
    rnd = random.Random(7)
    letters = [chr(c) for c in range(128)] + list("éÉßİ日𝒳  ")
    for _ in range(300):
        text = "".join(rnd.choice(letters) for _ in range(40))
        assert [t.decode() for t in ranking.terms_of(text)] == TERM.findall(folded(text))


# --- SimHash -------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fingerprint); smallest doc_id reachable by links of three bits or fewer."""
    marks = sorted({f for _, f in rows})
    parent = {f: f for f in marks}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(marks):
        for b in marks[i + 1:]:
            if bin(a ^ b).count("1") <= 3:
                parent[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return {f: least.get(root(f)) for f in marks}


def test_fingerprints_and_components_of_odd_rows(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randrange(9)) for _ in range(400)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        for k in range(6):
            words = t.split()
            words[rnd.randrange(400)] = "changed"
            rows.append((100 + 10 * i + k, " ".join(words).upper() if k == 1 else "\t".join(words)))
    rows += [(900, None), (901, ""), (902, " \n\x0b "), (903, "A b"), (904, "a B"), (905, "É b c"), (3, base[3]), (3, base[4]), (None, base[5]), (None, "only null ids here of all"), (906, "x " * 60_000), (907, "a b c")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = simhash.simhash_classes(docs).collect()
    marks = [(i, brute_fingerprint(t)) for i, t in rows]
    want = brute_components(marks)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == sorted(((i, f"{f:016x}", want[f]) for i, f in marks), key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].fingerprint == "0" * 16 and by_id[901].component_id == 900 and by_id[902].linked and by_id[903].fingerprint == by_id[904].fingerprint
    assert simhash.simhash_classes(docs.limit(0)).collect() == []


def test_any_three_flipped_bits_leave_a_common_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 30_000, dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, 30_000, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    x, y = np.sort(simhash.segment_keys(a), axis=1), simhash.segment_keys(b)
    for own, other in zip(x.tolist(), y.tolist()):
        assert not set(own).isdisjoint(other)


def test_the_code_is_perfect():
    high, patterns = golay.tables()
    assert patterns.shape == (2_048, 6) and sorted({len(set(p)) for p in patterns.tolist()}) == [1, 6]
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 500)
    code = np.array([(i << 11) | golay.remainder(i << 11) for i in range(4_096)])
    for w, keys in zip(words, golay.keys(words)):
        away = np.bitwise_count(code ^ w)
        assert away.min() <= 3 and (away <= 3).sum() == 1 and keys[0] == int(away.argmin())
        near = {int(np.bitwise_count(code ^ (w ^ (1 << i))).argmin()) for i in range(23)} | {keys[0]}
        assert set(keys.tolist()) == near


@pytest.mark.parametrize("chunk", [8, 1_024])
def test_a_large_bucket_with_chains_keeps_every_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    centre = int(rng.integers(0, 2**62))
    marks = {centre}
    # a cloud whose members differ in up to eight bits, chains that leave it in steps of three bits, and strangers
    for _ in range(400):
        m = centre
        for bit in rng.choice(64, int(rng.integers(1, 9)), replace=False):
            m ^= 1 << int(bit)
        marks.add(m)
    for _ in range(5):
        m = centre
        for _ in range(6):
            for bit in rng.choice(64, 3, replace=False):
                m ^= 1 << int(bit)
            marks.add(m)
    marks |= {int(x) for x in rng.integers(0, 2**63, 100)}
    signed = [m - 2**64 if m >= 2**63 else m for m in sorted(marks)]
    nodes = spark.createDataFrame([(m,) for m in signed], "fp long")
    comps = {r["node"]: r["comp"] for r in simhash.linked_fingerprints(nodes).collect()}
    want = brute_components([(i, m) for i, m in enumerate(sorted(marks))])
    got = {}
    for i, m in enumerate(sorted(marks)):
        s = m - 2**64 if m >= 2**63 else m
        got.setdefault(comps.get(s, s), []).append(i)
    assert sorted(tuple(v) for v in got.values()) == sorted(tuple(i for i, m in enumerate(sorted(marks)) if want[m] == w) for w in set(want.values()))


# --- whitening -----------------------------------------------------------------------------


def whitened(df, **how):
    out = whitening.whiten(df, **how).toPandas()
    return out.sort_values(["vec_id", "component"]).reset_index(drop=True)


def checked(vectors, out, components):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    got = out.whitened.to_numpy().reshape(n, components)
    want = centred @ u / np.sqrt(e)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-8
    assert (out.deviation.to_numpy().reshape(n, components)[:, 0] == ((n * x - sums) ** 2).sum(axis=1)).all()
    assert np.abs(out.explained.to_numpy()[:components] / (e / np.trace(v)) - 1).max() < 1e-8
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9 and set(out.n) == {n}


def test_components_match_numpy_with_odd_rows(spark):
    rng = np.random.default_rng(6)
    basis = rng.normal(size=(40, 40)) * np.exp(-np.arange(40) / 6)[:, None]
    vectors = (rng.normal(size=(300, 40)) @ basis).astype(np.float32)
    good = [(i, [float(c) for c in v], "x", 1) for i, v in enumerate(vectors)]
    bad = [(1_000, None, "x", 1), (1_001, [float("nan")] * 40, "x", 1), (1_002, [math.inf] + [0.0] * 39, "x", 1), (1_003, [None] + [0.0] * 39, "x", 1), (1_004, [1.0, 2.0], "x", 1), (1_005, [], "x", 1), (1_006, [1e30] + [0.0] * 39, "x", 1)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, whitened string, n int")
    out = whitened(df.repartition(3), components=12)
    assert set(out.vec_id) == set(range(300))
    checked(vectors, out, 12)
    # repeated rows count twice
    twice = whitened(df.unionByName(df.where("vec_id < 50")).withColumn("vec_id", F.monotonically_increasing_id()), components=5)
    assert set(twice.n) == {350}


def test_flat_low_rank_and_tiny_inputs(spark):
    rng = np.random.default_rng(7)
    frame = lambda vs: spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vs)], "vec_id long, embedding array<double>")
    flat = np.concatenate([np.eye(30), -np.eye(30)]) * 4
    out = whitened(frame(flat), components=6)
    assert len(out) == 60 * 6 and out.identity_error[0] < 1e-9 and np.allclose(out.explained, 1 / 30, rtol=1e-6)
    low = np.round(rng.normal(size=(80, 3)) * 4) @ np.round(rng.normal(size=(3, 50)) * 2)
    out = whitened(frame(low), components=8)
    assert set(out.component) == {1, 2, 3}
    checked(low, out, 3)
    assert len(whitened(frame(np.ones((5, 4))))) == 0 and len(whitened(frame(np.ones((1, 4))))) == 0
    assert len(whitened(frame(np.ones((1, 4))).limit(0))) == 0
    huge = rng.normal(size=(20, 3)) * 1e12
    out = whitened(frame(huge), components=2)
    assert out.deviation.isna().all() and len(out) == 40


def test_whitening_query_returns_every_vector(spark):
    out = whitened(spark.read.parquet(f"{FOLDER}/embeddings.parquet"))
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").toPandas().embedding
    checked(np.stack(vectors), out, 32)
