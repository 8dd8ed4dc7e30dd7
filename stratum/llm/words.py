"""Vectorised cutting and hashing of UTF-8 text: whole batches of documents in numpy, no Python per word.

A stretch of bytes is hashed as a sum, modulo 2**64, of a random number per byte value times a random number per place,
then mixed. Places have independent factors, not powers of one base, so no pattern of bytes cancels out. The hash stands
for the stretch between tasks where shingles are counted; as a cache key it only proposes, and the bytes decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .common import STEP_BYTES, byte_steps

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
#: A-Z share the value of a-z.
FOLDED = TABLE.copy()
FOLDED[65:91] = TABLE[97:123]
#: Blanks that end a word: the space and the controls from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: A-Z as a-z.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
_factors = np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def factors(n: int) -> np.ndarray:
    """A fixed random odd number for each place of a stretch."""
    global _factors
    if len(_factors) < n:
        _factors = mix(np.arange(1, max(n, 1024) + 1, dtype=np.uint64) * _ODD) | U(1)
    return _factors


def hash_stretches(data: np.ndarray, starts: np.ndarray, table: np.ndarray = TABLE) -> np.ndarray:
    """A hash of each stretch ``data[starts[i]:starts[i+1]]``; stretches are not empty and cover ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(data))
    inside = np.arange(len(data), dtype=np.int64) - np.repeat(starts, lengths)
    summed = np.add.reduceat(table[data] * factors(int(lengths.max()))[inside], starts)
    return mix(summed ^ (lengths.astype(np.uint64) * U(0xD6E8FEB86659FD93)))


def text_steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows of about ``limit`` bytes; null is empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    for a, b in byte_steps(np.diff(bounds), limit):
        yield a, b, data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between blanks: ``(hash with A-Z folded, words per document, first byte, byte after)``."""
    docs = len(offsets) - 1
    blank = BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge = edge[:-1]
    start = edge.copy()
    start[1:] |= blank[1:] != blank[:-1]
    if len(start):
        start[0] = True
    starts = np.flatnonzero(start)
    hashes = hash_stretches(data, starts, FOLDED)
    word = ~blank[starts] if len(starts) else np.zeros(0, bool)
    ends = np.append(starts[1:], len(data))
    first = starts[word]
    counts = np.diff(np.searchsorted(first, offsets)) if docs else np.zeros(0, np.int64)
    return hashes[word], counts, first, ends[word]


def spread_out(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places ``first[i] .. first[i] + size[i] - 1``, one stretch after the other."""
    jump = np.repeat(first - (np.cumsum(size) - size), size)
    return np.arange(len(jump)) + jump


class StretchCache:
    """Values (short integer arrays) of stretches, learned in bulk and looked up by hash and bytes.

    ``learn`` gets the new stretches as bytes and returns the order in which it answers, all values in a row and
    how many belong to each stretch. Bounded: when ``limit`` stretches or ``byte_limit`` of their bytes are known, all are
    forgotten and learning goes on. A stretch whose hash is known for other bytes is learned for itself, every time.
    """

    def __init__(
        self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]], dtype, limit: int, byte_limit: int = 64 << 20
    ):
        self.learn, self.dtype, self.limit, self.byte_limit = learn, dtype, limit, byte_limit
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 16, self.dtype), 0
        self.text_first, self.text_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.text, self.text_filled = np.zeros(1 << 16, np.uint8), 0

    @staticmethod
    def grown(pool: np.ndarray, filled: int, values: np.ndarray) -> np.ndarray:
        while filled + len(values) > len(pool):
            pool = np.concatenate([pool, np.zeros_like(pool)])
        pool[filled:filled + len(values)] = values
        return pool

    def add(self, hashes: np.ndarray, stretches: list[bytes], shown: np.ndarray, sizes: np.ndarray) -> None:
        """``shown`` are the bytes of the stretches in a row as later ones are compared with them."""
        asked, values, counts = self.learn(stretches)
        begins = (np.cumsum(sizes) - sizes)[asked] + self.text_filled
        self.text = self.grown(self.text, self.text_filled, shown)
        self.pool = self.grown(self.pool, self.filled, values)
        slots = np.arange(len(self.first), len(self.first) + len(hashes))
        self.first = np.concatenate([self.first, self.filled + np.cumsum(counts) - counts])
        self.size = np.concatenate([self.size, counts])
        self.text_first, self.text_size = np.concatenate([self.text_first, begins]), np.concatenate([self.text_size, sizes[asked]])
        self.filled, self.text_filled = self.filled + len(values), self.text_filled + len(shown)
        # merge, as both sides are sorted after this step's few new hashes are
        new = np.argsort(hashes[asked], kind="stable")
        fresh, fresh_slots = hashes[asked][new], slots[new]
        at = np.searchsorted(self.hashes, fresh)
        self.hashes, self.slot = np.insert(self.hashes, at, fresh), np.insert(self.slot, at, fresh_slots)

    def look_up(
        self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, shown: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """``(values of all stretches in a row, how many each has)``.

        ``shown`` is ``data`` with all differences removed that do not change a value (letter case, say).
        """
        if not len(hashes):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        shown = data if shown is None else shown
        lengths = ends - starts
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        head = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        unique, example = ranked[head], order[head]
        inverse = np.empty(len(hashes), np.int64)
        inverse[order] = np.cumsum(head) - 1
        raw = None
        for attempt in range(2):
            at = np.minimum(np.searchsorted(self.hashes, unique), max(len(self.hashes) - 1, 0))
            known = self.hashes[at] == unique if len(self.hashes) else np.zeros(len(unique), bool)
            new = example[~known]
            if not len(new):
                break
            full = len(self.hashes) + len(new) > self.limit or self.text_filled + int(lengths[new].sum()) > self.byte_limit
            if full and len(self.hashes) and not attempt:
                self.forget()
                continue
            raw = raw or data.tobytes()
            texts = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self.add(unique[~known], texts, shown[spread_out(starts[new], lengths[new])], lengths[new])
            break
        slot = self.slot[np.searchsorted(self.hashes, unique)][inverse]
        first, size = self.first[slot], self.size[slot]
        # the hash proposes, the bytes decide
        wrong = self.text_size[slot] != lengths
        alike = np.flatnonzero(~wrong)
        differs = self.text[spread_out(self.text_first[slot[alike]], lengths[alike])] != shown[spread_out(starts[alike], lengths[alike])]
        if differs.any():
            wrong[alike[np.unique(np.searchsorted(np.cumsum(lengths[alike]), np.flatnonzero(differs), side="right"))]] = True
        pool = self.pool
        if wrong.any():
            odd = np.flatnonzero(wrong)
            raw = raw or data.tobytes()
            asked, values, counts = self.learn([raw[a:b] for a, b in zip(starts[odd].tolist(), ends[odd].tolist())])
            first[odd[asked]], size[odd[asked]] = self.filled + np.cumsum(counts) - counts, counts
            pool = np.concatenate([self.pool[:self.filled], values])
        return pool[spread_out(first, size)], size
