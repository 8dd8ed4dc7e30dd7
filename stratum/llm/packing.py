"""Best-fit packing of token pieces into sequences by patterns and non-negative least squares.

Lengths are counted in a histogram. Patterns of a few coarse lengths that fill a sequence are enumerated, their
repeat counts are fitted to the histogram by non-negative least squares and rounded down, and what is left goes
best-fit, longest first. All of this works on the histogram, in bulk: every step uses up a length, a pattern or a
class of equally filled sequences, so the plan's size depends on ``limit``, not on the number of documents.
The plan is a list of rank intervals per length; Spark numbers the pieces of each length (in salted parts, so a
common length is spread over tasks) and looks each number up.

Defined results: a null text counts as empty; an empty document is one piece (its end id alone).
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, settled
from .words import FOLDED, LOWERED, TABLE, StretchCache, hash_stretches, text_steps

LIMIT, END_ID = 4096, 1
#: Coarse lengths per sequence in the patterns, and documents per pattern.
GRID, DEPTH = 64, 4
#: Salted parts in which the pieces of one length are numbered.
PARTS = 64
#: Different stretches that a task remembers.
CACHE_ENTRIES = 600_000
#: Kinds of bytes: 0 blank, 1 letter, digit or part of a two-byte letter, 2 full stop or comma, 3 other symbols and
#: what may be one, 4 lead bytes of characters beyond one-byte letters.
KIND = np.full(256, 3, np.uint8)
KIND[[32, 9, 10, 13]] = 0
KIND[[i for i in range(128) if chr(i).isalnum()]] = 1
KIND[[ord("."), ord(",")]] = 2
KIND[0x80:0xC0] = 1
KIND[0xC3] = 1
KIND[0xC4:] = 4


class WordEncoder:
    """Ids of a BPE tokenizer that lower-cases, drops white space and ends words: a stretch between blanks is
    encoded on its own and kept in a bounded cache.

    Plain words go in bulk through the same model without the regular expressions; the word-end mark in the
    pieces tells where each word's ids end. Every other stretch takes the tokenizer's full path. Stretches are
    found and looked up for whole blocks of documents at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        ends = np.zeros(self.full.get_vocab_size(), bool)
        for piece, i in self.full.get_vocab().items():
            ends[i] = piece.endswith("</w>")
        self.ends = ends
        self.cache = StretchCache(self.learn, "<u4", CACHE_ENTRIES)

    def encode_full(self, stretches: list[str]) -> tuple[np.ndarray, list[int]]:
        got = [e.ids for e in self.full.encode_batch_fast(stretches, add_special_tokens=False)]
        return np.asarray([i for ids in got for i in ids], "<u4"), [len(ids) for ids in got]

    def encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        [got] = self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.asarray(got.ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("word ends do not match the words")
        return ids, np.diff(stops, prepend=0)

    def learn(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = [s.decode("utf-8", "replace") for s in stretches]
        plain = np.fromiter((t.isalpha() and max(t) <= "ÿ" for t in texts), bool, len(texts))
        order = np.argsort(~plain, kind="stable")
        texts = [texts[i] for i in order.tolist()]
        n = int(plain.sum())
        words, sizes = self.encode_plain([t.lower() for t in texts[:n]]) if n else (np.zeros(0, "<u4"), [])
        other, more = self.encode_full(texts[n:]) if n < len(texts) else (np.zeros(0, "<u4"), [])
        return order, np.concatenate([words, other]), np.concatenate([sizes, more]).astype(np.int64)

    def encode_step(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all documents in a row, where each document's begin)``.

        Documents are cut at blanks. In ordinary prose (one-byte letters, no symbol beside a full stop or comma)
        full stops and commas are cut off too, and upper case is folded in the cache key, so that far fewer
        different stretches remain; both change nothing in the ids.
        """
        docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(docs + 1, np.int64)
        kind = KIND[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge = edge[:-1]
        point, symbol = kind == 2, kind >= 2
        odd = kind == 4
        odd[1:] |= ((point[1:] & symbol[:-1]) | (symbol[1:] & point[:-1])) & ~edge[1:]
        odd |= data == ord("<")
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # times and division signs
        # a document is ordinary when none of its bytes is odd
        counted = np.concatenate([[0], np.cumsum(odd)])
        ordinary = np.repeat(counted[offsets[1:]] == counted[offsets[:-1]], np.diff(offsets))
        kind = np.where(kind == 0, 0, np.where(ordinary & point, 2, 1))
        start = edge.copy()
        start[0] = True
        start[1:] |= (kind[1:] != kind[:-1])
        starts = np.flatnonzero(start)
        hashes = hash_stretches(data, starts, FOLDED)
        ends = np.append(starts[1:], len(data))
        kept = kind[starts] != 0
        # without folding for other documents: a distinct key space, cased bytes
        cased = ~ordinary[starts] & kept
        if cased.any():
            hashes = np.where(cased, ~hash_stretches(data, starts, TABLE), hashes)
        hashes, starts, ends = hashes[kept], starts[kept], ends[kept]
        ids, sizes = self.cache.look_up(hashes, data, starts, ends, np.where(ordinary, LOWERED[data], data))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, upto[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: ids of each text and the end id; only longer ones are cut."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(tokenizer_path)
        ids, piece, start, length, crc = [], [], [], [], []
        tail = np.asarray([END_ID], "<u4").tobytes()
        for a, b, data, offsets in text_steps(batch.column(1)):
            got, begins = enc.encode_step(data, offsets)
            raw, begins = got.tobytes(), (4 * begins).tolist()
            for k, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                own = raw[begins[k]:begins[k + 1]] + tail
                for n, first in enumerate(range(0, len(own), 4 * limit)):
                    part = own[first:first + 4 * limit]
                    ids.append(doc)
                    piece.append(n)
                    start.append(first // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
        arrays = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, step, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan, on the histogram


def patterns(grid: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` positive coarse lengths that sum to ``grid``, largest part first."""
    out: list[tuple[int, ...]] = []

    def grow(parts: tuple[int, ...], left: int, top: int) -> None:
        if left == 0:
            out.append(parts)
        elif len(parts) < depth:
            for part in range(min(left, top), 0, -1):
                if part * (depth - len(parts)) < left:
                    break
                grow((*parts, part), left - part, part)

    grow((), grid, grid)
    return out


def nnls(matrix: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """``argmin |matrix x - target|`` over x >= 0 by accelerated projected gradients."""
    gram = matrix @ matrix.T  # rows are few, columns many: the step bound comes from the small side
    bound = float(np.linalg.eigvalsh(gram)[-1]) or 1.0
    x = np.zeros(matrix.shape[1])
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - matrix.T @ (matrix @ y - target) / bound)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x


def pattern_counts(histogram: np.ndarray, limit: int, grid: int = GRID, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with rounded-down repeat counts; coarse length c covers ((c-1)*w, c*w] with w = limit/grid."""
    width = -(-limit // grid)
    coarse = np.zeros(grid + 1)
    np.add.at(coarse, -(-np.arange(limit + 1) // width), histogram)
    shapes = patterns(grid, depth)
    matrix = np.zeros((grid, len(shapes)))
    for j, parts in enumerate(shapes):
        for part in parts:
            matrix[part - 1, j] += 1
    fitted = np.floor(nnls(matrix, coarse[1:]) + 1e-6).astype(np.int64)
    return [(shapes[j], int(fitted[j])) for j in np.argsort(-fitted, kind="stable") if fitted[j] > 0]


def pack_histogram(histogram: np.ndarray, limit: int = LIMIT, grid: int = GRID, depth: int = DEPTH) -> tuple[np.ndarray, int]:
    """Rank intervals ``(length, first rank, count, first sequence, offset)`` that place every piece; and the
    number of sequences. ``histogram[n]`` counts pieces of ``n`` tokens, 1 <= n <= limit."""
    left = np.asarray(histogram, np.int64).copy()
    used = np.zeros(limit + 1, np.int64)
    width = -(-limit // grid)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, count)]
    present = np.flatnonzero(left[1:]) + 1

    def longest_upto(top: int) -> int:
        """The longest length that is left and at most ``top`` (0: none)."""
        nonlocal present
        at = int(np.searchsorted(present, top, side="right")) - 1
        while at >= 0 and left[present[at]] == 0:
            at -= 1
        return int(present[at]) if at >= 0 else 0

    def place(length: int, count: int, first: int, offset: int) -> None:
        rows.append((length, int(used[length]), count, first, offset))
        used[length] += count
        left[length] -= count

    # full sequences by themselves
    if left[limit]:
        count = int(left[limit])
        place(limit, count, 0, 0)
        sequences = count
    # 1. patterns, in bulk: each part takes the longest real length in its coarse class, the last part whatever
    # fits best in the room that is left
    for parts, repeats in pattern_counts(left, limit, grid, depth):
        while repeats > 0:
            chosen: list[int] = []
            room = limit
            for k, part in enumerate(parts):
                top = room if k == len(parts) - 1 else min(room, part * width)
                need = lambda n: left[n] - chosen.count(n) > 0
                n = longest_upto(top)
                while n and not need(n):
                    n = longest_upto(n - 1)
                if not n or n <= (part - 1) * width - width:
                    chosen = []
                    break
                chosen.append(n)
                room -= n
            if not chosen:
                break
            times = min(repeats, *(int(left[n]) // chosen.count(n) for n in set(chosen)))
            offset = 0
            for n in chosen:
                place(n, times, sequences, offset)
                offset += n
            if room:
                open_runs.setdefault(room, []).append((sequences, times))
            sequences += times
            repeats -= times
    # 2. residuals: longest first, each into the fullest sequence that has room
    rooms = np.zeros(limit + 1, bool)
    rooms[list(open_runs)] = True
    length = longest_upto(limit)
    while length:
        count = int(left[length])
        fit = np.flatnonzero(rooms[length:])
        if len(fit):
            room = length + int(fit[0])
            first, have = open_runs[room].pop()
            take = min(have, count)
            if take < have:
                open_runs[room].append((first + take, have - take))
            if not open_runs[room]:
                del open_runs[room]
                rooms[room] = False
        else:
            room, first = limit, sequences
            per = limit // length
            take = count // per or 1
            if count >= per and per > 1:
                # as many equal ones side by side as fit
                for k in range(per):
                    place(length, take, first, k * length)
                sequences += take
                rest = limit - per * length
                if rest:
                    open_runs.setdefault(rest, []).append((first, take))
                    rooms[rest] = True
                length = longest_upto(length)
                continue
            take = count if per == 1 else 1
            sequences += take
        place(length, take, first, limit - room)
        rest = room - length
        if rest:
            open_runs.setdefault(rest, []).append((first, take))
            rooms[rest] = True
        length = longest_upto(length)
    table = np.asarray(rows, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))], sequences


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``limit``.

    Sequences hold ``limit`` tokens at most and are filled from offset 0 without gaps.
    """
    spark = pieces.sparkSession
    cols = pieces.columns
    salt = F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece") if c in cols]), F.lit(PARTS)).cast("int")
    rows = settled(pieces.withColumn("__part", salt), "pieces")
    parts = settled(rows.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most limit * PARTS rows, and limit of them reach the driver
    histogram = np.zeros(limit + 1, np.int64)
    for length, n in parts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    plan, _ = pack_histogram(histogram, limit)
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select(
        F.col("length").alias("__l"), F.col("__part").alias("__p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"),
    )
    inside = Window.partitionBy("length", "__part").orderBy(*[c for c in ("doc_id", "piece", "start") if c in cols])
    ranked = rows.withColumn("__rank", F.row_number().over(inside) - 1).join(
        firsts, (F.col("length") == F.col("__l")) & (F.col("__part") == F.col("__p"))
    ).select(*cols, (F.col("__first") + F.col("__rank")).alias("__rank"))
    keys = (plan[:, 0] << 40) | plan[:, 1]
    shared = spark.sparkContext.broadcast((keys, plan))  # bounded by limit and the patterns, not by the rows

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, plan = shared.value
        length = batch.column(cols.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column(len(cols)).to_numpy(zero_copy_only=False).astype(np.int64)
        row = plan[np.searchsorted(keys, (length << 40) | rank, side="right") - 1]
        arrays = [batch.column(i) for i in range(len(cols))]
        arrays += [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])]
        return pa.RecordBatch.from_arrays(arrays, [*cols, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_batches(ranked, look_up, f"{schema}, sequence_id long, offset long")
