"""Shared pieces of the corpus operators: reading tables, null rules, keyed filtering."""

from __future__ import annotations

import array
import functools
import json
import re
import sys
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``build(spark, folder)`` as a query, with SQL where DuckDB can express it."""

    def wrap(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the text as 32 bytes."""
    return F.unhex(F.sha2(text_of(column).cast("binary"), 256))


def rows_that_stay(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id, digest), with all their columns.

    Of rows that repeat a doc_id and a text one stays; the pass that drops the others runs only if a
    doc_id repeats at all.
    """
    own, doc_id, digest = (unused(docs, c) for c in ("own", "id", "digest"))
    marked = docs.withColumn(own, text_digest())
    names = stored(kept.select(F.col("doc_id").alias(doc_id), F.col("digest").alias(digest)))
    left = marked.join(names, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(own) == F.col(digest)), "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        left = left.dropDuplicates(["doc_id", own])
    return left.drop(own)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Number of partitions that keeps each at about ``per_part`` rows, however many rows there are."""
    return max(least, -(-rows // per_part))


HOT_SHARE, HOT_LEAST = 1_000, 64


def hot_keys(counts: DataFrame, key: str, total: int, least: int = HOT_LEAST) -> DataFrame:
    """(key, salts) of the keys that own more than a thousandth of ``total`` rows (and more than ``least``).

    ``counts`` holds each key with its number of rows ``n``. There are fewer than ``HOT_SHARE`` such keys
    however large the table is, so this table is broadcast. ``least`` is larger where every salt
    gets many rows of the other side.
    """
    limit = max(least, total // HOT_SHARE)
    salts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    return stored(counts.where(F.col("n") > limit).select(key, salts.alias("salts")))


def dealt(rows: DataFrame, key: str, hot: DataFrame, by: list[str]) -> DataFrame:
    """Rows with a ``salt`` that deals those of a hot key over several places, by a hash of ``by``."""
    salts = F.coalesce("salts", F.lit(1))
    return rows.join(F.broadcast(hot), key, "left").withColumn("salt", F.pmod(F.xxhash64(*by), salts).cast("int")).drop("salts")


def repeated(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows once for every ``salt`` of their key: the other side of :func:`dealt`."""
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return rows.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(salts)).drop("salts")


def held_out_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3: remainder 1 is never trained on (a null id counts as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: 256 + n for n, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def _as_bytes(ids: list[int]) -> bytes:
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


# letters that are the same under NFC and whose lower case and pre-tokens are those of Python and Arrow; marks are ASCII
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-įı-ſ", r"!-/:-@\[-`{-~"
WORD_AND_MARKS = f"^(?P<word>[{LETTERS}]+)(?P<marks>[{MARKS}]*)$"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile(f"[{LETTERS}{MARKS}0-9\t\n\r]*").fullmatch
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[{MARKS}]+").findall


def _cuts_words(tokenizer) -> bool:
    """Whether pre-tokens are the matches of ``WORDS`` and the last id of each tells that it ends."""
    steps = json.loads(tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers", [{}])
    return steps[0].get("pattern") == {"Regex": WORDS} and bool(tokenizer.model.end_of_word_suffix)


class WordCache(dict):
    """Ids of space-separated pieces as little-endian uint32 bytes, encoded once by the tokenizers library.

    A pre-token never spans the boundary before a space that follows or precedes a visible
    character, so a text's ids are those of its pieces in order. Pieces for which that does not
    hold are stored as None, and the whole text is then encoded at once. ``lead`` is the space that
    belongs to a piece (byte-level vocabularies) or empty (vocabularies that drop white space).
    """

    LIMIT = 600_000
    WORDS_LIMIT = 400_000  # where a whole batch is encoded at once, beside its pieces

    def __init__(self, path: str, lead: str):
        self.tokenizer, self.lead, self.older = _tokenizer(path), lead, {}
        self.model = self.tokenizer.model
        self.last_ids = None
        if not lead and _cuts_words(self.tokenizer):
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last_ids = np.zeros(1 + max(vocabulary.values()), bool)
            self.last_ids[[i for token, i in vocabulary.items() if token.endswith(self.model.end_of_word_suffix)]] = True
            self.bare = type(self.tokenizer)(self.model)
        self.marks = functools.lru_cache(maxsize=1_000)(self.whole)

    def whole(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, piece: str) -> bytes:
        """Ids of a piece that is one word of Latin letters: one pre-token, which the model takes as it is."""
        piece = self.lead + piece if self.lead else piece.lower()
        return _as_bytes([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(BYTE_LETTERS))])

    def __missing__(self, piece: str):
        stem = piece.rstrip(".,;:!?")
        if piece in self.older:
            out = self.older[piece]
        elif piece.isalpha() and max(piece) < "\u0180" and "\u0130" not in piece:
            out = self.word(piece)
        elif self.last_ids is not None and "<|" not in piece and PLAIN(piece):
            # words, digits and marks are pre-tokens of their own
            out = b"".join([self[p] if p[0].isalpha() else self.marks(p) for p in PARTS(piece.lower())])
        elif stem and stem != piece and stem[-1].isascii() and stem[-1].isalpha():
            # a pre-token of letters ends before punctuation, so a word and its marks are encoded apart
            out = self[stem]
            out = None if out is None else out + self.marks(piece[len(stem):])
        else:
            # an empty piece or one that starts with white space may continue a run of white space
            safe = not self.lead or (piece and not piece[0].isspace())
            out = self.whole(self.lead + piece) if safe else None
        if len(piece) <= 40:
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if len(self) > self.LIMIT:
            self.older = dict(self)
            self.clear()
        first, *rest = text.split(" ")
        try:
            return self.whole(first) + b"".join([self[p] for p in rest])
        except TypeError:
            return self.whole(text)

    def encode_all(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end`` behind it, and the places where texts end (a 0 before them).

        For vocabularies that drop white space: every distinct piece is looked up once, whichever text it is in.
        """
        if len(self) > self.WORDS_LIMIT:
            self.older = dict(self)
            self.clear()
        texts = texts.cast(pa.large_string())
        if self.last_ids is not None:
            texts = pc.replace_substring(texts, "\n", " ")  # no pre-token holds either
        pieces = pc.split_pattern(texts, " ")
        found, edges = pieces.flatten().dictionary_encode(), pieces.offsets.to_numpy()
        del pieces, texts  # several times the batch
        table = self.pieces(found.dictionary, end)
        ids = table.take(pa.array(np.insert(found.indices.to_numpy(), edges[1:], len(table) - 1)))
        return ids.flatten().to_numpy(), ids.offsets.to_numpy()[edges + np.arange(len(edges))]

    def pieces(self, pieces: pa.Array, end: int) -> pa.Array:
        """Lists of ids of distinct pieces, and of ``end`` alone behind them."""
        words, marks, simple = [], [], np.zeros(len(pieces), bool)
        pairs = np.full((len(pieces) + 1, 2), -1)
        if self.last_ids is not None:
            cut = pc.extract_regex(pieces, WORD_AND_MARKS)
            simple = cut.is_valid().to_numpy(zero_copy_only=False)
            cut = cut.drop_null()
            found = [pc.utf8_lower(cut.field("word")).dictionary_encode(), cut.field("marks").dictionary_encode()]
            words, marks = (f.dictionary.to_numpy(zero_copy_only=False).tolist() for f in found)
            pairs[:-1][simple] = np.stack([found[0].indices.to_numpy(), found[1].indices.to_numpy() + len(words)], axis=1)
            self.learn([w for w in words if w not in self])
        others = pieces.to_numpy(zero_copy_only=False)[~simple]
        pairs[np.append(~simple, True), 0] = np.arange(len(others) + 1) + len(words) + len(marks)
        encoded = [self[w] for w in words] + [self.marks(m) for m in marks] + [self[p] for p in others] + [_as_bytes([end]), b""]
        pairs[pairs < 0] = len(encoded) - 1
        places = np.cumsum([0, *map(len, encoded)]) // 4
        lists = pa.LargeListArray.from_arrays(pa.array(places), pa.array(np.frombuffer(b"".join(encoded), "<u4")))
        ids = lists.take(pa.array(pairs.ravel()))
        return pa.LargeListArray.from_arrays(ids.offsets[::2], ids.flatten())

    def learn(self, words: list[str]) -> None:
        """Put words of Latin letters, in lower case, into the cache; each is one pre-token, which the model takes as it is."""
        known = [w for w in words if w in self.older]
        self.update((w, self.older[w]) for w in known)
        words = [w for w in words if w not in self] if known else words
        if not words:
            return
        letters = [w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_LETTERS) for w in words]
        ids = np.array(self.bare.encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.last_ids[ids]) + 1)
        if len(ends) != len(words):
            raise ValueError("the ids do not tell where words end")
        raw, starts = ids.tobytes(), [0, *ends[:-1].tolist()]
        self.update((w, raw[a:b]) for w, a, b in zip(words, starts, ends.tolist()))


@functools.lru_cache(maxsize=4)
def word_cache(path: str, lead: str) -> WordCache:
    """One cache per Python worker; it outlives a task and forgets what it has not used for long."""
    return WordCache(path, lead)


def crc_of(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
