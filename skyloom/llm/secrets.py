"""Secret scan in column expressions: fixed patterns, and Markov models of random strings and identifiers."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.llm.common import read_table, register, text_of

VALUE = "[A-Za-z0-9+/_.=-]"
# Fixed patterns of the job: kind, pattern, group whose length counts, least length.
KINDS = [
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?(""" + VALUE + "+)", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
]
# The same matches without the runs that are too short anyway, so that prose gives no hits to list.
QUICK = {"access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
# Runs between dots, and their pieces between slashes.
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}(?![\p{L}\p{N}])"
PIECE = r"(?<![\p{L}\p{N}+_=-])[A-Za-z0-9+_=-]{16,}(?![\p{L}\p{N}])"
IDENTIFIER = r"(?<![\p{L}\p{N}+/_=.-])[A-Za-z_][A-Za-z0-9_-]{7,}(?![\p{L}\p{N}+/_=-])"
ALPHABET = "^ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1  # 0 is any other character
# Kinds of characters of an identifier; the others separate words and tell nothing about them.
GROUPS = {"start": "^", "lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "low line": "_", "hyphen": "-"}
SHARE, PSEUDO, GROUP_PSEUDO = 0.2, 100.0, 20.0  # weight of a row's fallback: a share of its count and a constant; and of the fallback's own
POSTERIOR = 0.99
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,hit:string>>"


def spans(text: Column, pattern: str, rank: int, kind: str) -> Column:
    """All leftmost non-overlapping matches with their places in code points.

    The text between matches comes from a split by the same pattern, so running sums of lengths are
    the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    start = F.struct(F.lit(0).alias("at"), F.lit([]).cast(SPAN).alias("out"))

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).cast(SPAN).alias("out"))

    found = F.aggregate(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), start, add)["out"]
    return F.when(text.rlike(pattern), found).otherwise(F.lit([]).cast(SPAN))


def _long_enough(pattern: str, group: int, least: int):
    return lambda s: F.length(F.regexp_extract(s["hit"], pattern, group)) >= least


def base_spans(text: Column) -> dict[str, Column]:
    out = {}
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        found = spans(text, QUICK.get(kind, pattern), rank, kind)
        out[kind] = F.filter(found, _long_enough(pattern, group, least))
    return out


def _pairs(token: Column) -> Column:
    """Neighbouring characters of a token with a start mark before it."""
    marked = F.concat(F.lit("^"), token)
    return F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.substring(marked, i, F.lit(2)))


def _at(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(random, token), each token once: what the fixed patterns find are random strings, identifiers of two or more documents are ordinary.

    A random string that no pattern knows hardly ever recurs, so it does not pass for an identifier.
    """
    text = text_of()
    base = base_spans(text)
    values = F.concat(
        F.transform(base["assign"], lambda s: F.regexp_extract(s["hit"], KINDS[0][1], 2)),
        F.transform(base["access"], lambda s: s["hit"]), F.transform(base["hex"], lambda s: s["hit"]),
    )
    # identifiers count once for each document, and none that is part of a found value
    split = docs.select(values.alias("values"), F.array_distinct(F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))).alias("words"))
    words = F.filter("words", lambda w: ~F.exists("values", lambda v: F.contains(v, w) | F.contains(w, v)))
    tokens = split.select(F.inline(F.concat(
        F.transform("values", lambda v: F.struct(F.lit(True).alias("random"), v.alias("token"))),
        F.transform(words, lambda w: F.struct(F.lit(False).alias("random"), w.alias("token"))),
    )))
    return tokens.groupBy("random", "token").agg(F.count("*").alias("n")).where("random or n > 1").drop("n")


def chain_weights(counts: dict[bool, dict[tuple[str, str], int]]) -> dict[tuple[str, str], float]:
    """Log likelihood ratio, random against ordinary, of every pair of characters of identifiers.

    Both classes are first-order chains. A pair's probability falls back on the pair of kinds of
    characters (lower case after digit, ...), spread evenly over the kind, by a weight that grows
    with the row's count; the pairs of kinds fall back on their share in both classes together. So a pair
    that neither class has seen weighs what its kinds weigh, however unequally the classes are trained.
    """
    group = {c: g for g, cs in GROUPS.items() for c in cs}
    row = {k: {} for k in counts}
    kinds = {k: {} for k in counts}
    after = {k: {} for k in counts}
    for k, pairs in counts.items():
        for (a, b), n in pairs.items():
            row[k][a] = row[k].get(a, 0) + n
            kinds[k][group[a], group[b]] = kinds[k].get((group[a], group[b]), 0) + n
            after[k][group[a]] = after[k].get(group[a], 0) + n
    both = {g: 0.5 * sum(sum(n for (_, y), n in kinds[k].items() if y == g) / max(sum(after[k].values()), 1) for k in counts) for g in GROUPS}

    def probability(k: bool, a: str, b: str) -> float:
        x, y = group[a], group[b]
        back = (kinds[k].get((x, y), 0) + GROUP_PSEUDO * both[y]) / (after[k].get(x, 0) + GROUP_PSEUDO) / len(GROUPS[y])
        n = row[k].get(a, 0)
        pseudo = PSEUDO + SHARE * n
        return (counts[k].get((a, b), 0) + pseudo * back) / (n + pseudo)

    out = {}
    for a in group:
        for b in group:
            p, q = probability(True, a, b), probability(False, a, b)
            out[a, b] = math.log(p / q) if p > 0 and q > 0 else 0.0
    return out


def train(samples: DataFrame) -> tuple[list[float], float]:
    """Weight of each pair of characters, and the sum above which a token is random.

    Pairs with a slash, dot, plus or equals sign weigh 0: identifiers do not hold them, so they would
    only tell that a path is no identifier. The threshold asks for ``POSTERIOR`` at the share of random
    strings among the samples. Without samples all weights are 0 and nothing is found.
    """
    # at most two rows for each pair of the alphabet reach the driver
    pairs = samples.select("random", F.explode(_pairs(F.col("token"))).alias("pair"))
    found = pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()
    known = set("".join(GROUPS.values()))
    counts: dict[bool, dict] = {True: {}, False: {}}
    first = {True: 0, False: 0}
    for r in found:
        a, b = r["pair"]
        first[r["random"]] += r["n"] * (a == "^")
        if a in known and b in known:
            counts[r["random"]][a, b] = r["n"]
    weights = [0.0] * SIZE**2
    for (a, b), w in chain_weights(counts).items():
        weights[(ALPHABET.index(a) + 1) * SIZE + ALPHABET.index(b) + 1] = w
    prior = math.log((first[False] + 1) / (first[True] + 1))
    return weights, max(0.0, prior) + math.log(POSTERIOR / (1 - POSTERIOR))


def ratio(token: Column, weights: list[float]) -> Column:
    """Log likelihood of the token as a random string against an identifier."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    step = lambda sum_, p: sum_ + F.element_at(table, _at(F.substring(p, 1, 1)) * SIZE + _at(F.substring(p, 2, 1)) + 1)
    return F.aggregate(_pairs(token), F.lit(0.0), step)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, joined by commas.
    Kind markov is a run of 16 or more token characters between dots, or a piece of one between
    slashes, that the models call random and that touches no span of a fixed pattern; a run stands
    for its pieces if none of them is more random. Null and empty texts have no spans (the hash is that of the
    empty string); repeated rows are scanned alike; other columns are not read. The models are
    trained on all rows of ``docs``.
    """
    weights, threshold = train(labelled_samples(docs))
    text = text_of()
    found = docs.select("doc_id", *[s.alias(kind) for kind, s in base_spans(text).items()], spans(text, CANDIDATE, len(KINDS), "markov").alias("_runs"), spans(text, PIECE, len(KINDS), "markov").alias("_pieces"))
    base = F.array_sort(F.concat(*[k for k, *_ in KINDS]))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    touch = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    random = lambda c: F.filter(
        F.transform(c, lambda x: F.struct(x.alias("span"), ratio(x["hit"], weights).alias("ratio"))),
        lambda x: (x["ratio"] > threshold) & ~F.exists("_base", lambda b: touch(b, x["span"])),
    )
    judged = found.select("*", base.alias("_base")).select("*", random("_runs").alias("_long"), random("_pieces").alias("_short"))
    judged = judged.withColumn("_long", F.filter("_long", lambda x: ~F.exists("_short", lambda y: touch(x["span"], y["span"]) & (y["ratio"] > x["ratio"]))))
    judged = judged.withColumn("_short", F.filter("_short", lambda y: ~F.exists("_long", lambda x: touch(x["span"], y["span"]))))
    joined = judged.select("*", F.transform(F.concat("_long", "_short"), lambda x: x["span"]).alias("_more"))
    return joined.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in KINDS],
        F.sha2(F.array_join(F.transform("_base", named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat("_base", "_more")), named), ",").alias("spans"),
    )


@register("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(read_table(spark, folder, "documents"))
