"""Token ids, files and packing: exact round trips and brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skyloom.llm import coder, packing, tokenfiles
from skyloom.llm.common import WordCache

ROWS = [
    (4, "Hello  world,\n it's\tme. "), (1, None), (2, ""), (9, "the " * 5_000), (9, "the " * 5_000), (3, "naïve Ñandú ß 12 <|endoftext|> ."), (None, "no id"),
]
PATHS = {name: packing.default_tokenizer(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name,lead", [("byte_bpe_50k.json", " "), ("word_bpe_49k.json", "")])
def test_cached_words_give_the_ids_of_the_whole_text(name, lead):
    plain, cache = Tokenizer.from_file(PATHS[name]), WordCache(PATHS[name], lead)
    cache.LIMIT = 50
    rnd = random.Random(1)
    parts = ["a", "The", "word.", "x,", " ", "  ", "\n", "\t", "'s", "é", "́", "ª", "İ", "ſ", "22", "<|endoftext|>", "!", "　", " ", "Σ", "_", "\r\n"]
    for _ in range(4_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        ids = np.frombuffer(cache.encode(text), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_batch_of_texts_has_the_ids_of_each_and_encodes_a_word_once():
    path = PATHS["word_bpe_49k.json"]
    plain, cache = Tokenizer.from_file(path), WordCache(path, "")
    cache.WORDS_LIMIT = 50
    rnd = random.Random(3)
    parts = ["a", "The", "word.", "x,", " ", "  ", "\n", "\t", "'s", "'", "don't", "3.14", "é", "́", "ª", "İ", "ſ", "ŉ", "ÿ", "Ÿ", "22", "<|endoftext|>", "<|", "!", "　", " ", "Σ", "_", "\r\n", "\x1c", "×", "²", "K", "Å", "ẞ", "語", "-", "~`"]
    for size in (0, 1, 7, 400, 400, 400):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(size)]
        ids, ends = cache.encode_all(pa.array(texts, pa.string()), 2)
        want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert got == want and ends[0] == 0 and len(ids) == ends[-1], [t for t, g, w in zip(texts, got, want) if g != w]

    cache, learned = WordCache(path, ""), []
    cache.learn, learn = lambda words: (learned.extend(words), learn(words)), cache.learn
    cache.whole, cache.word = None, None  # plain words are not encoded one by one
    cache.marks = lambda mark: b""
    cache.encode_all(pa.array(["One two, TWO; three\ntwo... one?", "two one", "three!"]), 2)
    assert sorted(learned) == ["one", "three", "two"]


def test_frequencies_are_learned_once_for_all_blocks_of_a_file():
    rng = np.random.default_rng(4)
    share = 1 / np.arange(1, 20_001)
    ids = rng.permutation(40_000)[rng.choice(20_000, 150_000, p=share / share.sum())]
    data = coder.pack([1], [len(ids)], ids, 16)
    assert (coder.unpack(data)[2] == ids).all()
    counts = np.bincount(ids)
    counts = counts[counts > 0]
    entropy = -(counts * np.log2(counts / len(ids))).sum() / len(ids)
    # the coder that began every block with no frequencies took 2.7 bits more than the entropy
    assert len(data) * 8 / len(ids) < entropy + 1.5


@pytest.mark.parametrize("n,bits", [(200_000, 16), (200_000, 20), (70_000, 27)])
def test_ids_too_rare_for_the_frequencies_are_kept(n, bits):
    rng = np.random.default_rng(5)
    ids = np.where(rng.random(n) < 0.5, 7, rng.integers(0, 1 << bits, n))
    every = np.arange(1 << 16)[:n]
    for own in (ids, every, np.zeros(n, np.int64), np.append(np.zeros(n, np.int64), (1 << bits) - 1)):
        assert (coder.unpack(coder.pack([1], [len(own)], own, bits))[2] == own).all()


@pytest.mark.parametrize("n,bits,block", [(0, 16, 64), (1, 16, 64), (63, 16, 64), (2_000, 12, 128), (3_000, 20, 256), (9_000, 16, 4096)])
@pytest.mark.parametrize("high", [2, 50, 1 << 12])
def test_token_file_round_trip(n, bits, block, high):
    ids = np.random.default_rng(n).integers(0, high, n)
    ids[n // 2:] = ids[:n - n // 2]  # long repeats
    data = coder.pack([7, None], [n, 0], ids, bits, block)
    names, counts, back = coder.unpack(data)
    assert names == [7, None] and counts.tolist() == [n, 0] and (back == ids).all()


def test_repeated_ids_take_little_room_and_damage_is_found():
    ids = np.tile(np.random.default_rng(0).integers(0, 40_000, 50), 200)
    data = coder.pack([1], [len(ids)], ids, 16)
    assert len(data) < len(ids) / 2
    for at in (len(data) - 9, 60):
        with pytest.raises((ValueError, zlib.error)):
            coder.unpack(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:])
    with pytest.raises(ValueError):
        coder.pack([1], [1], np.array([70_000]), 16)


@pytest.mark.parametrize("most", [6_000_000, 3_000])
def test_files_hold_the_documents_in_order(spark, monkeypatch, most):
    monkeypatch.setattr(tokenfiles, "FILE_TOKENS", most)
    path = PATHS["word_bpe_49k.json"]
    plain = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, start string")
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenfiles.token_files(docs, path).collect()]
    want, at = [], 0
    for i, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0])):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tokenfiles.token_files(docs.limit(0), path).collect() == []


def test_files_are_cut_where_documents_end_and_a_small_rest_makes_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_TOKENS", 100)
    docs = spark.createDataFrame([(i, "the " * 29) for i in range(13)], "doc_id long, text string").coalesce(1)
    manifest = tokenfiles.write_token_files(docs, str(tmp_path / "files"), PATHS["word_bpe_49k.json"])
    rows = manifest.orderBy("part", "file").collect()
    assert sum(r.docs for r in rows) == 13 and all(r.tokens == 30 * r.docs for r in rows)
    for part in {r.part for r in rows}:
        sizes = [r.tokens for r in rows if r.part == part]
        assert len(sizes) == 1 or (min(sizes) >= 25 and max(sizes) <= 150)


def brute_pieces(text, path, capacity):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [0]
    cut = len(ids) % capacity or capacity
    edges = [0, *range(cut, len(ids) + 1, capacity)]
    return [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for a, b in zip(edges, edges[1:])]


def test_packed_pieces_are_whole_and_gapless(spark):
    path = PATHS["byte_bpe_50k.json"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, length int")
    got = packing.pack_documents(docs, path, 64).collect()
    want = [(i, n, *p) for i, t in ROWS for n, p in enumerate(brute_pieces(t, path, 64))]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=repr) == sorted(want, key=repr)
    check_layout(got, 64)
    assert packing.pack_documents(docs.limit(0), path).collect() == []


def check_layout(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_many_pieces_with_a_hot_length(spark):
    rnd = random.Random(2)
    lengths = [700 if rnd.random() < 0.3 else min(2048, int(rnd.lognormvariate(5.5, 1.2)) + 1) for _ in range(9_000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long").selectExpr("row", "0 AS piece", "length")
    bins = check_layout(packing.place(pieces).collect(), 2048)
    assert bins <= -(-sum(lengths) // 2048) + 1


@pytest.mark.parametrize("seed", range(20))
def test_fullest_combination_is_that_of_all_subsets(seed):
    rnd = random.Random(seed)
    available = {rnd.randint(1, 30): rnd.randint(0, 4) for _ in range(6)}
    room = rnd.randint(0, 60)
    sums = {0}
    for length, count in available.items():
        sums = {s + k * length for s in sums for k in range(count + 1)}
    got = packing.fullest(available, room)
    assert sum(n * c for n, c in got.items()) == max(s for s in sums if s <= room)
    assert all(c <= available[n] for n, c in got.items())
