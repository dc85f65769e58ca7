"""URL filter: rules first, then naive Bayes over host names segmented into words."""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.llm.common import parts_for, read_table, register
from skyloom.session import stored

# Rules of the job: (host, path, verdict).
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
LONGEST_WORD = 20
HOSTS_AT_ONCE = 5_000  # host names that one task splits with one dictionary
URLS_PER_SALT = 2_000  # urls of one host that meet its words in one place
FEATURES = 1 << 20  # hashed tokens of the Bayes model


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; null without one."""
    name = verdict = F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, host + path).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


def word_counts(html: DataFrame, column: str) -> DataFrame:
    """(w, n) of all words of all visible text, up to ``LONGEST_WORD`` letters."""
    plain = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"(?s)<[^>]*>", " ")
    words = html.select(F.explode(F.split(F.lower(plain), r"[^a-z]+")).alias("w"))
    return words.where(F.length("w").between(1, LONGEST_WORD)).groupBy("w").agg(F.count("*").alias("n"))


def segment(name: str, model: dict[str, float]) -> list[str]:
    """Most probable split of a name into words: unigram Viterbi.

    A stretch outside the model costs ten times more for each of its letters, so unknown names stay
    whole rather than falling apart.
    """
    unknown = [-math.log(1e4) - n * math.log(10) for n in range(LONGEST_WORD + 1)]
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        value, start = max(
            (best[s] + model.get(name[s:end], unknown[end - s]), s) for s in range(max(0, end - LONGEST_WORD), end)
        )
        best.append(value)
        back.append(start)
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    return words[::-1]


def host_pieces(host: str) -> list[str]:
    return [piece for label in host.split(".") for piece in re.findall(r"[a-z]+|[^a-z]+", label)]


def is_name(piece: str) -> bool:
    return piece.isascii() and piece.isalpha()


def host_tokens(host: str, split) -> list[str]:
    """Words of the host's labels, and what stands between letters as it is."""
    return [f"h:{w}" for piece in host_pieces(host) for w in (split(piece) if is_name(piece) else [piece])]


def path_tokens(path: str) -> list[str]:
    """Parts of the path; numbers count by their number of digits."""
    return [f"p:{len(piece)} digits" if piece.isdigit() else f"p:{piece}" for piece in re.findall(r"[^\W_]+", path.lower())]


def substrings(piece: str) -> set[str]:
    return {piece[i:j] for i in range(len(piece)) for j in range(i + 1, min(len(piece), i + LONGEST_WORD) + 1)}


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) for distinct host names, split by the unigram model of all counted words.

    The hosts go in chunks. Each chunk asks for the counts of every run of letters that its names
    hold, each run once, and is split with the dictionary that comes back. So every word of the corpus
    can be used, no dictionary is larger than its chunk needs, and nothing but the total of all
    counts passes through the driver.
    """
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    chunks = parts_for(hosts.count(), HOSTS_AT_ONCE)
    chunked = hosts.select("host", F.pmod(F.xxhash64("host"), F.lit(chunks)).cast("int").alias("chunk")).repartition(chunks, "chunk")
    wanted = pa.schema([("chunk", pa.int32()), ("w", pa.string())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[int, set[str]] = {}
            for chunk, host in zip(batch.column("chunk").to_pylist(), batch.column("host").to_pylist()):
                for piece in filter(is_name, host_pieces(host)):
                    own.setdefault(chunk, set()).update(substrings(piece))
            for chunk, runs in own.items():
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(runs), pa.int32()), pa.array(list(runs), pa.string())], schema=wanted)

    asked = chunked.select("chunk", "host").mapInArrow(ask, "chunk int, w string").distinct()
    known = asked.join(counts, "w").select("chunk", "w", "n")

    def split(names: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        model = {w: math.log(n / total) for w, n in zip(words["w"], words["n"])}
        cut = functools.lru_cache(maxsize=None)(lambda piece: segment(piece, model))
        return pd.DataFrame({"host": names["host"], "words": [host_tokens(h, cut) for h in names["host"]]})

    return chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(split, "host string, words array<string>")


def _with_features(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``features``: hashed tokens of each url. Hosts are split once each and sent to their urls, those of a large host in several places."""
    hosts = stored(urls.groupBy("host").agg(F.count("*").alias("urls")))
    words = segmented(hosts, counts)
    salts = hosts.select("host", F.ceil(F.col("urls") / URLS_PER_SALT).cast("int").alias("salts"))
    spread = words.join(salts, "host").select("host", "words", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    placed = urls.join(salts.where("salts > 1"), "host", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("page_id", "path"), F.col("salts")).cast("int"), F.lit(0)))
    joined = placed.join(spread, ["host", "salt"]).select("page_id", "host", "path", "rule", "said", "words")
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("said", pa.string()), ("features", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, names = batch.column("path").to_pylist(), batch.column("words").to_pylist()
            features = [[zlib.crc32(t.encode("utf-8", "surrogatepass")) % FEATURES for t in (*w, *path_tokens(p))] for p, w in zip(paths, names)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in schema.names[:-1]), pa.array(features, schema.types[-1])], schema=schema)

    return joined.mapInArrow(run, "page_id long, host string, path string, rule string, said string, features array<int>")


def bayes_weights(featured: DataFrame) -> np.ndarray:
    """Weight of each hashed token for block, from the rows whose rule says so.

    Multinomial models of both classes with a Dirichlet prior: the token's share in both classes
    together, with as much mass as there are different tokens. A token that is equally common in
    both classes weighs 0 whatever their sizes, and so does one that no ruled url has.
    """
    labelled = featured.where("said is not null").select((F.col("said") == "block").alias("block"), "features")
    # at most two rows for each hashed token
    counts = labelled.select("block", F.explode("features").alias("f")).groupBy("f").agg(F.count_if("block").alias("block"), F.count_if(~F.col("block")).alias("allow")).toArrow()
    f, block, allow = (counts.column(c).to_numpy() for c in ("f", "block", "allow"))
    weights = np.zeros(FEATURES)
    if len(f) and block.sum() and allow.sum():
        prior = len(f) * (block + allow) / (block + allow).sum()
        weights[f] = np.log((block + prior) / (block.sum() + len(f))) - np.log((allow + prior) / (allow.sum() + len(f)))
    return weights


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, prior: float = 0.0) -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (the method's log odds) for every url.

    The words of all pages give the unigram model that splits host names; the urls that a rule
    decides train the naive Bayes model, which judges the others. Without urls of both verdicts all
    weights are 0. ``prior`` is the log odds of block
    before any token; even by default, because how many urls the rules block says nothing about the
    others. Urls that are null or have no ``://`` have no tokens and get the prior's verdict; odds of
    0 mean allow. Repeated rows are judged alike; other columns are not read; an empty table
    gives an empty result.
    """
    name, verdict = rule_columns(RULES if rules is None else rules)
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = stored(urls.select("*", name.alias("rule"), verdict.alias("said")))
    featured = stored(_with_features(urls, stored(word_counts(pages, "html"))))
    # 8 MB, however many tokens there are
    table = pages.sparkSession.sparkContext.broadcast(bayes_weights(featured))

    @F.pandas_udf("double")
    def odds(features: pd.Series) -> pd.Series:
        return features.map(lambda f: prior + float(table.value[f.astype(int)].sum()))

    scored = featured.withColumn("block_odds", odds("features"))
    said = F.coalesce("said", F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", said.alias("verdict"), "block_odds")


@register("op8_url_filter")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read_table(spark, folder, "pages"))
