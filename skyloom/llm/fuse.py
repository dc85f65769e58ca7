"""Static 3-wise binary fuse filters over 64-bit keys (Graf and Lemire, 2022), built with array operations."""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QIIQ")
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_S33 = np.uint64(33)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h = (h ^ (h >> _S33)) * _MIX[0]
    h = (h ^ (h >> _S33)) * _MIX[1]
    return h ^ (h >> _S33)


def _slots(h: np.ndarray, segment: int, spread: int) -> np.ndarray:
    """Three slots in neighbouring segments, shape (3, n)."""
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(spread)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build(keys: np.ndarray, seed: int = 1) -> bytes:
    """Filter bytes for distinct keys (repeats are dropped): 16-bit prints, no false negatives."""
    keys = np.unique(np.asarray(keys).astype(np.int64).view(np.uint64))
    n = len(keys)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 0)
    segment = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    while True:
        spread, size = segments * segment, (segments + 2) * segment
        h = _mixed(keys, seed)
        slots = _slots(h, segment, spread)
        order = _peel(slots, size, n)
        if order is not None:
            break
        seed += 1
        segments += 1 + segments // 50 if seed % 8 == 0 else 0
    table, prints = np.zeros(size, np.uint16), _prints(h)
    for who, at in reversed(order):
        own = slots[:, who]
        # the slot a key was peeled by is still zero, so the xor of all three is that of the other two
        table[at] = prints[who] ^ table[own[0]] ^ table[own[1]] ^ table[own[2]]
    return _HEAD.pack(seed, segment, segments, n) + table.tobytes()


def _peel(slots: np.ndarray, size: int, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, slots): each key is then alone in its slot. None if some keys cannot be peeled."""
    count = np.bincount(slots.ravel(), minlength=size)
    held = np.zeros(size, np.int64)
    number = np.arange(n)
    for row in slots:
        np.bitwise_xor.at(held, row, number)
    front, order, done = np.flatnonzero(count == 1), [], 0
    while len(front):
        who, pick = np.unique(held[front], return_index=True)
        order.append((who, front[pick]))
        done += len(who)
        touched = slots[:, who]
        for row in touched:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(held, row, who)
        front = np.unique(touched)
        front = front[count[front] == 1]
    return order if done == n else None


def contains(data: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every stored key and for about one in 65,536 others."""
    seed, segment, segments, n = _HEAD.unpack_from(data)
    keys = np.asarray(keys).astype(np.int64).view(np.uint64)
    if n == 0:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(data, np.uint16, offset=_HEAD.size)
    h = _mixed(keys, seed)
    a, b, c = _slots(h, segment, segments * segment)
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)
