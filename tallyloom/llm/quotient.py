"""Counting quotient filters over packed word ids: lossless, sorted, mergeable counters.

The ids of an n-gram are packed into two halves of equal width. A Feistel network over the halves permutes the
pack; it is undone by running its rounds backwards, so nothing is lost. The high bits of the permuted key, spread evenly, are
the quotient: its upper bits name the chunk in which a key is merged, its lower bits a slot inside the chunk. What
is left is the remainder, stored in full. A filter holds, in order of the permuted key, how many keys each
slot has, their remainders and their counters; two filters of the same chunk merge by merging sorted keys.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

U = np.uint64
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)  # odd multipliers
LONG = 255  # a counter byte that says: the count stands among the long ones


class Packing:
    """n-grams of ids below ``2**bits`` as two halves of ``half`` bits, at most 64."""

    def __init__(self, n: int, bits: int, chunk_bits: int) -> None:
        self.n, self.bits, self.left = n, bits, -(-n // 2)
        self.half = self.left * bits
        if self.half > 64:
            raise ValueError("word ids take at most 32 bits")
        self.mask = U((1 << self.half) - 1)
        self.chunk_bits = min(chunk_bits, self.half)
        self.slot_bits = min(12, self.half - self.chunk_bits)

    def _mix(self, x: np.ndarray, by: int) -> np.ndarray:
        y = (x + U(1)) * U(by)
        return ((y ^ (y >> U(29))) * U(ROUNDS[0]) >> U(64 - self.half)) & self.mask

    def permuted(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """High and low half of the permuted pack of ``ids``, one array for each place."""
        a, b = np.zeros(len(ids[0]), U), np.zeros(len(ids[0]), U)
        for x in ids[: self.left]:
            a = a << U(self.bits) | x.astype(U)
        for x in ids[self.left :]:
            b = b << U(self.bits) | x.astype(U)
        for i, by in enumerate(ROUNDS):
            if i % 2:
                b = b ^ self._mix(a, by)
            else:
                a = a ^ self._mix(b, by)
        return a, b

    def restored(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """The ids back from the permuted halves."""
        for i, by in reversed(list(enumerate(ROUNDS))):
            if i % 2:
                b = b ^ self._mix(a, by)
            else:
                a = a ^ self._mix(b, by)
        one, places = U((1 << self.bits) - 1), range(self.n)
        out = []
        for i in places:
            x, back = (a, self.left - 1 - i) if i < self.left else (b, self.n - 1 - i)
            out.append(((x >> U(back * self.bits)) & one).astype(np.int64))
        return out

    def distinct(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys in order, each once: halves, summed weights (occurrences by default), and each row's place."""
        if 2 * self.half <= 64:
            keys, at = np.unique(a << U(self.half) | b, return_inverse=True)
            high, low = keys >> U(self.half), keys & self.mask
        else:
            order = np.lexsort((b, a))
            x, y = a[order], b[order]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            at = np.empty(len(x), np.int64)
            at[order] = np.cumsum(new) - 1
            high, low = x[new], y[new]
        if weight is None:
            return high, low, np.bincount(at, minlength=len(high)), at
        sums = np.zeros(len(high), np.int64)  # whole numbers, as floats would round
        np.add.at(sums, at, weight)
        return high, low, sums, at

    def chunk_of(self, a: np.ndarray) -> np.ndarray:
        return (a >> U(self.half - self.chunk_bits)).astype(np.int64) if self.chunk_bits else np.zeros(len(a), np.int64)

    def _rest(self) -> tuple[int, int]:
        """Bits of the high half that the slot leaves, and bytes of a whole remainder."""
        bits = self.half - self.chunk_bits - self.slot_bits
        return bits, -(-(bits + self.half) // 8)

    def encoded(self, a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> bytes:
        """The filter of one chunk's keys, which come in order."""
        bits, size = self._rest()
        slot = (a >> U(bits)) & U((1 << self.slot_bits) - 1)
        used, many = np.unique(slot, return_counts=True)
        high = a & U((1 << bits) - 1)
        raw = np.empty((len(a), 16), np.uint8)
        if bits + self.half <= 64:
            raw[:, :8] = (high << U(self.half) | b if self.half < 64 else b).astype("<u8").view(np.uint8).reshape(-1, 8)
        else:
            raw[:, :8] = (b | (high << U(self.half) if self.half < 64 else U(0))).astype("<u8").view(np.uint8).reshape(-1, 8)
            raw[:, 8:] = (high >> U(64 - self.half) if self.half < 64 else high).astype("<u8").view(np.uint8).reshape(-1, 8)
        short = np.minimum(counts, LONG).astype(np.uint8)
        wide = counts[counts >= LONG].astype("<i8")
        head = np.array([len(a), len(used), len(wide)], "<i8")
        return b"".join(
            [head.tobytes(), used.astype("<u2").tobytes(), many.astype("<i4").tobytes(), np.ascontiguousarray(raw[:, :size]).tobytes(), short.tobytes(), wide.tobytes()]
        )

    def decoded(self, chunk: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Halves and counts of a filter, in order."""
        bits, size = self._rest()
        keys, slots, wide = (int(x) for x in np.frombuffer(data, "<i8", 3))
        at = 24
        used = np.frombuffer(data, "<u2", slots, at)
        at += 2 * slots
        many = np.frombuffer(data, "<i4", slots, at)
        at += 4 * slots
        raw = np.zeros((keys, 16), np.uint8)
        raw[:, :size] = np.frombuffer(data, np.uint8, keys * size, at).reshape(keys, size)
        at += keys * size
        counts = np.frombuffer(data, np.uint8, keys, at).astype(np.int64)
        counts[counts == LONG] = np.frombuffer(data, "<i8", wide, at + keys)
        low, more = raw[:, :8].copy().view("<u8").ravel(), raw[:, 8:].copy().view("<u8").ravel()
        b = low & self.mask
        if self.half < 64:
            high = (low >> U(self.half)) | (more << U(64 - self.half))
        else:
            high = more
        high = high & U((1 << bits) - 1)
        slot = np.repeat(used, many).astype(U)
        a = high | slot << U(bits)
        if self.chunk_bits:
            a = a | U(chunk) << U(self.half - self.chunk_bits)
        return a, b, counts
