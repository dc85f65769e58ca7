"""Adaptive context-mixing range coder for token ids, many blocks in step.

Every block is coded by itself, so blocks are lanes of array operations: step t codes token t of all
blocks. A token is one of three: the id that followed the last two ids before (order 2), the id that
followed the last id (order 1), or any id by its frequency (order 0).

The ids that follow, how sure they are and how the orders are mixed are learned anew in every
block; the shares of the orders move by how often each held at this sureness. The frequencies of order 0 are
those of the whole file and stand in its header. Ids too rare for a place there are written as they
are, behind the words of their block.

All numbers of the range coder are whole and below 2^53, so arithmetic on doubles is exact; the one
rounded product, of the range and a share, is the same on both sides.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
MAGIC = b"TOKIDS02"
HEAD = struct.Struct("<8sIIQQIII")  # magic, bits, block size, documents, tokens, bytes of the index and of the frequencies, crc32 of both
BLOCK_HEAD = struct.Struct("<IIIII")  # tokens, bytes, ids written as they are, crc32 of the bytes, crc32 of the ids
MOST_BITS = 27

# the range is 2^24 to 2^48 before a token; the shares leave 2^16 for order 0, and an id of order 0 leaves at least 1
_WORD, _TOP = float(1 << 24), float(1 << 48)
_UP_TO_2, _UP_TO_1 = (1 / 128, 63 / 64), (1 / 64, 255 / 256)  # least and most of the shares of order 2, and of both
_RATE = 1 / 16
_GOALS = [limit * _RATE for limit in (*_UP_TO_2, *_UP_TO_1)]
_TOTAL = 1 << 16
_T1, _T2 = 10, 11
_STIR, _STIR_BEFORE = np.uint32(2_654_435_769), np.uint32(2_246_822_519)
_RARE = 0
_SHIFT1, _SHIFT2, _SURE, _BOTH, _SAME = (np.uint32(v) for v in (32 - _T1, 32 - _T2, 5, 30, 32))
_ONCE1, _MOST1, _ONCE2, _MOST2 = (np.uint32(v) for v in (2, 6, 8, 24))


class Frequencies:
    """Order 0: symbols by falling frequency behind the one for all rare ids; frequencies add up to ``_TOTAL``."""

    def __init__(self, rare: int, ids: np.ndarray, freqs: np.ndarray, bits: int):
        order = np.argsort(-freqs, kind="stable")
        self.rare, self.ids, self.freqs, self.bits = rare, ids[order], freqs[order], bits
        freq = np.concatenate([[rare], self.freqs])
        # one symbol more, for tokens that order 0 does not code: it takes the whole range
        self.none = len(freq)
        self.freq = np.append(freq, _TOTAL).astype(np.float64)
        self.below = np.append(np.cumsum(freq) - freq, 0).astype(np.float64)
        self.slots = np.repeat(np.arange(len(freq)), freq)
        self.id_of = np.concatenate([[0], self.ids, [0]]).astype(np.uint32)

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> Frequencies:
        if bits <= 24:
            counts = np.bincount(ids)
            names = np.flatnonzero(counts)
            counts = counts[names]
        else:
            names, counts = np.unique(ids, return_counts=True)
        n, total = max(1, len(ids)), _TOTAL
        if (counts * total < n).any():
            total -= 1  # the rare symbol has a place of its own
        often = counts * total >= n
        names, counts, few = names[often], counts[often], int(counts[~often].sum())
        freqs, rest = np.divmod(counts * total, n)
        rare = few * total // n + 1 if few else 0
        if len(names):
            spare = _TOTAL - rare - int(freqs.sum())
            freqs[np.argsort(-rest, kind="stable")[:spare]] += 1
            freqs[np.argmax(freqs)] += _TOTAL - rare - int(freqs.sum())
        else:
            rare = _TOTAL
        return cls(rare, names, freqs, bits)

    def symbols(self) -> np.ndarray:
        """The symbol of every id."""
        out = np.full(int(self.ids.max(initial=0)) + 2, _RARE)  # the last place stands for all higher ids
        out[self.ids] = np.arange(1, len(self.ids) + 1)
        return out

    def pack(self) -> bytes:
        order = np.argsort(self.ids)
        gaps = np.diff(self.ids[order], prepend=0)
        return zlib.compress(struct.pack("<I", self.rare) + gaps.astype("<u4").tobytes() + (self.freqs[order] - 1).astype("<u2").tobytes())

    @classmethod
    def unpack(cls, data: bytes, bits: int) -> Frequencies:
        data = zlib.decompress(data)
        n = (len(data) - 4) // 6
        ids = np.cumsum(np.frombuffer(data, "<u4", n, 4).astype(np.int64))
        return cls(struct.unpack_from("<I", data)[0], ids, np.frombuffer(data, "<u2", n, 4 + 4 * n).astype(np.int64) + 1, bits)


class _Lanes:
    """State of the model and of the range coder for ``n`` blocks, longest first."""

    def __init__(self, n: int, frequencies: Frequencies):
        self.order0 = frequencies
        # tables of all lanes lie one after the other; a lane's part starts at its number times the size
        lane = np.arange(n)
        self.lane1, self.lane2, self.lane5 = lane << _T1, lane << _T2, lane << 5
        # an id that followed, times 32, and how often it held (0 to 3), times 2 for order 1 and times 8 for order 2
        self.one, self.two = np.zeros(n << _T1, np.uint32), np.zeros(n << _T2, np.uint32)
        # share of order 2, and of orders 2 and 1, by how sure both are and whether they agree
        sure = np.arange(32)
        two, one = sure >> 3 > 0, (sure & 6 > 0) & (sure & 1 == 0)
        self.share2 = np.tile(np.where(two, 0.25, _UP_TO_2[0]), n)
        self.share1 = np.tile(np.where(two, 0.25, 1 / 128) + np.where(one, 0.25, 1 / 128), n)
        self.last, self.before = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.range = np.full(n, _TOP)

    def predict(self, k: int) -> None:
        """What orders 2 and 1 expect of the first ``k`` lanes, and their parts of the range."""
        stirred = self.last[:k] * _STIR
        self.h1 = (stirred >> _SHIFT1).astype(np.intp) + self.lane1[:k]
        self.h2 = (stirred + self.before[:k] >> _SHIFT2).astype(np.intp) + self.lane2[:k]
        np.multiply(stirred, _STIR_BEFORE, out=self.before[:k])
        self.e1, self.e2 = self.one.take(self.h1, mode="clip"), self.two.take(self.h2, mode="clip")
        self.c1, self.c2 = self.e1 >> _SURE, self.e2 >> _SURE
        apart = self.e1 ^ self.e2
        self.at = ((apart & _BOTH) + (apart < _SAME)).astype(np.intp) + self.lane5[:k]
        self.s2, self.s1 = self.share2.take(self.at, mode="clip"), self.share1.take(self.at, mode="clip")
        self.end2, self.end1 = self.range[:k] * self.s2, self.range[:k] * self.s1
        np.floor(self.end2, out=self.end2)
        np.floor(self.end1, out=self.end1)

    def take_part(self, k: int, is2: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the part of the order that holds, and the unit of order 0 in it."""
        below = np.where(is2, 0.0, np.where(other, self.end1, self.end2))
        above = np.where(is2, self.end2, np.where(other, self.range[:k], self.end1))
        above -= below
        above *= 1 / _TOTAL
        return below, np.floor(above, out=above)

    def learn(self, k: int, token: np.ndarray, is2: np.ndarray, is1: np.ndarray, other: np.ndarray) -> None:
        """Move the shares to what came, and let the id follow its contexts."""
        for table, share, came in ((self.share2, self.s2, np.where(is2, _GOALS[1], _GOALS[0])), (self.share1, self.s1, np.where(other, _GOALS[2], _GOALS[3]))):
            share *= 1 - _RATE
            share += came
            table[self.at] = share
        fresh = token << _SURE
        held = np.where(is1, self.e1, fresh)
        self.one[self.h1] = np.minimum(held + _ONCE1, fresh + _MOST1, out=held)
        held = np.where(is2, self.e2, fresh)
        self.two[self.h2] = np.minimum(held + _ONCE2, fresh + _MOST2, out=held)
        self.last[:k] = token


def _steps(lengths: np.ndarray):
    """(step, number of lanes) of all steps; only the last block may be shorter."""
    n, most = len(lengths), int(lengths.max())
    return ((t, n if t < lengths[-1] else n - 1) for t in range(most))


def encode_blocks(ids: np.ndarray, frequencies: Frequencies, block: int = BLOCK) -> list[tuple[bytes, np.ndarray]]:
    """Range coder's bytes and ids written as they are, of every block of ``block`` ids."""
    n = -(-len(ids) // block)
    if not n:
        return []
    lengths = np.minimum(len(ids) - np.arange(n) * block, block)
    grid = np.zeros((n, block), np.uint32)
    grid.ravel()[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.T[:int(lengths.max())])
    coder, order0, symbols = _Lanes(n, frequencies), frequencies, frequencies.symbols()
    low = np.zeros(n)
    words, given, raw = np.zeros((len(grid) + 2, n), np.uint32), np.zeros((len(grid) + 2, n), bool), np.zeros(grid.shape, bool)
    for t, k in _steps(lengths):
        token = grid[t, :k]
        coder.predict(k)
        is2, is1 = token == coder.c2, token == coder.c1
        other = ~(is2 | is1)
        below, unit = coder.take_part(k, is2, other)
        symbol = np.where(other, symbols.take(token, mode="clip"), order0.none)
        np.equal(symbol, _RARE, out=raw[t, :k])
        span, bottom = order0.freq.take(symbol, mode="clip"), order0.below.take(symbol, mode="clip")
        span *= unit
        bottom *= unit
        bottom += below
        bottom += low[:k]
        short = np.less(span, _WORD, out=given[t, :k])
        word = bottom * (1 / _WORD)
        np.floor(word, out=word)
        words[t, :k] = word
        scale = np.where(short, _WORD, 1.0)
        word *= _WORD
        word *= short
        bottom -= word
        np.multiply(bottom, scale, out=low[:k])
        np.multiply(span, scale, out=coder.range[:k])
        coder.learn(k, token, is2, is1, other)
    words[-2], words[-1], given[-2:] = low // _WORD, low % _WORD, True
    ends = np.cumsum(given.sum(axis=0))
    out = words.T[given.T].astype("<u4")
    while (carry := out >> 24).any():
        out &= (1 << 24) - 1
        out[:-1] += carry[1:]
    plain = np.split(out.view(np.uint8).reshape(-1, 4)[:, :3], ends[:-1])
    return [(p.tobytes(), r) for p, r in zip(plain, np.split(grid.T[raw.T], np.cumsum(raw.sum(axis=0))[:-1]))]


def decode_blocks(payloads: list[bytes], raws: list[np.ndarray], lengths: list[int], frequencies: Frequencies) -> np.ndarray:
    """All ids of blocks whose bytes, ids written as they are and numbers of ids are given; all but the last are equally long."""
    n = len(payloads)
    if not n:
        return np.zeros(0, np.uint32)
    lengths = np.asarray(lengths)
    parts = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 3).astype(np.int32)
    words = (parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16).astype(np.float64)
    at = np.cumsum([0] + [len(p) // 3 for p in payloads[:-1]])
    rare, rare_at = np.concatenate([*raws, [0]]).astype(np.uint32), np.cumsum([0] + [len(r) for r in raws[:-1]])
    coder, order0 = _Lanes(n, frequencies), frequencies
    code = words[at] * _WORD + words[at + 1]
    at += 2
    out = np.zeros((int(lengths.max()), n), np.uint32)
    for t, k in _steps(lengths):
        coder.predict(k)
        value = code[:k]
        is2, other = value < coder.end2, value >= coder.end1
        below, unit = coder.take_part(k, is2, other)
        value = value - below
        # exact, as the quotient's distance from a whole number is far above rounding
        symbol = np.where(other, order0.slots.take((value / unit).astype(np.intp), mode="clip"), order0.none)
        token = np.where(other, order0.id_of.take(symbol, mode="clip"), np.where(is2, coder.c2, coder.c1))
        if order0.rare:
            raw = symbol == _RARE
            token = np.where(raw, rare.take(rare_at[:k], mode="clip"), token)
            rare_at[:k] += raw
        span, start = order0.freq.take(symbol, mode="clip"), order0.below.take(symbol, mode="clip")
        span *= unit
        start *= unit
        value -= start
        short = span < _WORD
        scale = np.where(short, _WORD, 1.0)
        value *= scale
        word = words.take(at[:k], mode="clip")
        word *= short
        np.add(value, word, out=code[:k])
        np.multiply(span, scale, out=coder.range[:k])
        at[:k] += short
        coder.learn(k, token, is2, token == coder.c1, other)
        out[t, :k] = token
    return out.T.ravel()[:int(lengths.sum())]


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """A whole file: header, index of documents, frequencies, blocks; each part with its checksum."""
    if bits > MOST_BITS:
        raise ValueError(f"ids of more than {MOST_BITS} bits are not coded")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    given = np.array([d is not None for d in doc_ids], bool)
    index = zlib.compress(
        np.packbits(given).tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(counts, "<u8").tobytes(), 1
    )
    frequencies = Frequencies.of(ids, bits)
    table = frequencies.pack()
    out = [HEAD.pack(MAGIC, bits, block, len(doc_ids), len(ids), len(index), len(table), zlib.crc32(index + table)), index, table]
    plain = _plain_type(bits)
    for i, (coded, raw) in enumerate(encode_blocks(ids, frequencies, block)):
        own, payload = ids[i * block:(i + 1) * block].astype("<u4"), coded + raw.astype(plain).tobytes()
        out += [BLOCK_HEAD.pack(len(own), len(payload), len(raw), zlib.crc32(payload), zlib.crc32(own.tobytes())), payload]
    return b"".join(out)


def _plain_type(bits: int) -> np.dtype:
    return np.dtype("<u2" if bits <= 16 else "<u4")


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, counts, ids) of a file; ValueError if any checksum is wrong."""
    magic, bits, block, docs, tokens, size, table, crc = HEAD.unpack_from(data)
    at = HEAD.size + size + table
    index = data[HEAD.size:HEAD.size + size]
    if magic != MAGIC or zlib.crc32(data[HEAD.size:at]) != crc:
        raise ValueError("no token file, or its index is damaged")
    frequencies = Frequencies.unpack(data[HEAD.size + size:at], bits)
    index, held = zlib.decompress(index), -(-docs // 8)
    given = np.unpackbits(np.frombuffer(index, np.uint8, held), count=docs).astype(bool)
    names = np.frombuffer(index, "<i8", docs, held)
    counts = np.frombuffer(index, "<u8", docs, held + 8 * docs).astype(np.int64)
    plain, payloads, raws, lengths, sums = _plain_type(bits), [], [], [], []
    for _ in range(-(-tokens // block)):
        n, size, raw, crc, own = BLOCK_HEAD.unpack_from(data, at)
        at += BLOCK_HEAD.size
        payload = data[at:at + size]
        at += size
        if zlib.crc32(payload) != crc:
            raise ValueError(f"block {len(lengths)} is damaged")
        coded = size - raw * plain.itemsize
        payloads.append(payload[:coded])
        raws.append(np.frombuffer(payload, plain, raw, coded))
        lengths.append(n)
        sums.append(own)
    ids = decode_blocks(payloads, raws, lengths, frequencies)
    for i, own in enumerate(sums):
        if zlib.crc32(ids[i * block:(i + 1) * block].astype("<u4").tobytes()) != own:
            raise ValueError(f"block {i} does not decode to its ids")
    return [int(d) if g else None for d, g in zip(names, given)], counts, ids
