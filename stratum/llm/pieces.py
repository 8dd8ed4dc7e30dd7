"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair again and again. A token sequence is that result exactly
when every token is what its own text merges to and every two neighbours stay apart when their joint text is
merged again. So the encoder takes the longest piece at each position (all matches come from one Aho-Corasick
pass), falls back to the next shorter piece while the neighbour check fails, and gives up a position when no
piece fits; a bitfield remembers positions that failed, so none is tried twice and the work stays linear.

No piece of such a model runs from a non-space into a space, nor across a character that is no piece, so those
are borders: the text is cut there and a short stretch is encoded once per task (bounded cache). Characters
that are no piece become byte pieces, or ``<unk>`` where the model has none.

The vocabulary is read from the model file with the sentencepiece library; the encoding itself is not its.
The model must be BPE with identity normalisation, a dummy prefix and escaped white space (checked).

Defined results: null and empty texts give no ids and an empty decoded text.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .words import StretchCache, hash_stretches, text_steps

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
#: Different stretches, and pairs of pieces, that a task remembers.
CACHE_ENTRIES, PAIR_ENTRIES = 1_500_000, 600_000
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


class PieceModel:
    """Pieces and scores of one model file, with encode and decode."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.unk = lib.unk_id()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        self.byte_id, self.byte_of, self.ids, self.score = {}, {}, {}, {}
        for i, piece in enumerate(self.pieces):
            if lib.is_byte(i):
                value = int(BYTE_PIECE.match(piece)[1], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece], self.score[piece] = i, lib.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece runs from a non-space into a space: the model cannot be cut at spaces")
        probe = " Ab  Ａé "
        if lib.decode(lib.encode(probe)) != probe or lib.encode("a") == lib.encode(" a"):
            raise ValueError("the model needs identity normalisation, a dummy prefix and kept white space")
        self.chars = {p for p in self.ids if len(p) == 1}
        self.length = [len(p) for p in self.pieces]
        self.found = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.found.add_word(piece, (i, len(piece)))
        self.found.make_automaton()
        # for each piece, the longest piece that is a proper prefix of it (-1: none)
        self.shorter = [-1] * size
        for piece, i in self.ids.items():
            self.shorter[i] = next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), -1)
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        self.cache = StretchCache(self.learn, np.uint8, CACHE_ENTRIES)
        self.decimal = [f"{i}," for i in range(size)]
        self.lossless = len(self.byte_id) == 256
        self.inside = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.plain_bytes = [
            bytes((self.byte_of[i],)) if i in self.byte_of else " ⁇ ".encode() if i == self.unk else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        # line feeds are the commonest border; any other character that is no piece is found inside a stretch
        self.line_border = "\n" not in "".join(self.ids)
        self.stretch = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+" if self.line_border else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    # merging, used only on the texts of one or two pieces

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first among equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def is_sound(self, token: int) -> bool:
        """Whether a piece is what its own text merges to."""
        known = self.sound[token] = self.merged(self.pieces[token]) == [self.pieces[token]]
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart when their joint text is merged again."""
        if len(self.pairs) > PAIR_ENTRIES:
            self.pairs.clear()
        texts = [self.pieces[left], self.pieces[right]]
        known = self.pairs[left << 32 | right] = self.merged("".join(texts)) == texts
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a stretch whose every character is a piece."""
        size = len(text)
        longest = [0] * size
        reach = [0] * size
        for end, (i, n) in self.found.iter(text):
            start = end - n + 1
            if n > reach[start]:
                reach[start], longest[start] = n, i
        alive = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        sound, pairs, length, shorter = self.sound.get, self.pairs.get, self.length, self.shorter
        at, token, last = 0, longest[0], -1
        while True:
            while token >= 0:
                end = at + length[token]
                if alive[end]:
                    good = sound(token)
                    if good is None:
                        good = self.is_sound(token)
                    if good and last >= 0:
                        good = pairs(last << 32 | token)
                        if good is None:
                            good = self.apart(last, token)
                    if good:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == size:
                    return tokens
                at, token, last = end, longest[end], token
            else:
                if not tokens:
                    raise ValueError("no sequence of pieces merges to this text")
                alive[at] = 0
                token = tokens.pop()
                at -= length[token]  # its end is dead now, so the next shorter piece is tried
                last = tokens[-1] if tokens else -1

    def runs(self, stretch: str) -> list[int]:
        """Ids of a stretch; characters that are no piece are borders."""
        if self.chars.issuperset(stretch):
            return self.backtrack(stretch)
        ids, run = [], []
        for ch in stretch:
            if ch in self.chars:
                run.append(ch)
                continue
            if run:
                ids += self.backtrack("".join(run))
                run = []
            ids += [self.byte_id[b] for b in ch.encode("utf-8", "surrogatepass")] if self.byte_id else [self.unk]
        if run:
            ids += self.backtrack("".join(run))
        return ids

    def surface(self, ids: list[int]) -> bytes:
        """UTF-8 of a stretch's pieces, before the leading space goes."""
        return b"".join([self.plain_bytes[i] for i in ids])

    def stretches(self, text: str) -> list[str]:
        return self.stretch.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def stretch_ids(self, stretch: str) -> list[int]:
        if len(stretch) > 1 and stretch[-1] in ",." and stretch[-2:] not in self.inside:
            # no piece holds these two characters side by side: a border
            return self.runs(stretch[:-1]) + self.runs(stretch[-1])
        return self.runs(stretch)

    def learn(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Decimal ids, each followed by a comma, of stretches in UTF-8; checks that decoding gives each back."""
        out = []
        for raw in stretches:
            ids = self.stretch_ids(raw.decode().replace(" ", SPACE))
            if self.lossless and self.surface(ids) != raw.replace(SPACE_BYTES, b" "):
                raise ValueError("a stretch does not decode to itself")
            out.append("".join([self.decimal[i] for i in ids]))
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.arange(len(out)), np.frombuffer("".join(out).encode(), np.uint8), sizes

    def encode_step(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(decimal ids with commas of all documents in a row, where each document's begin)``; every document
        of ``data`` that is not empty starts with the dummy space."""
        if not len(data):
            return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
        blank, line = data == 32, data == 10
        start = np.zeros(len(data) + 1, bool)
        start[offsets] = True
        start = start[:-1]
        start[1:] |= blank[1:] & ~blank[:-1]
        if self.line_border:
            start |= line
            start[1:] |= line[:-1]
        starts = np.flatnonzero(start)
        out, sizes = self.cache.look_up(hash_stretches(data, starts), data, starts, np.append(starts[1:], len(data)))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return out, upto[np.searchsorted(starts, offsets)]

    def encode(self, text: str) -> list[int]:
        return [i for s in self.stretches(text) for i in self.stretch_ids(s)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces joined to characters, one leading space (the dummy prefix) removed."""
        return plain(self.surface(ids))


def plain(surface: bytes) -> str:
    return surface.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One model per Python worker."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every document, begin and end ids not included."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model(model_path)
        ids = [m.encode(x.as_py() or "") for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), step, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model(model_path)
        text = [m.decode(x.as_py() or []) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), step, "doc_id long, text string")


def digest_column(m: PieceModel, texts: pa.Array) -> list[pa.Array]:
    """Number of ids, SHA-256 of the ids and of the decoded text, for every row."""
    counts, ids_sha, text_sha = [], [], []
    for _, _, data, offsets in text_steps(texts):
        sizes = np.diff(offsets)
        prefixed = np.insert(data, offsets[:-1][sizes > 0], 32)
        out, begins = m.encode_step(prefixed, offsets + np.concatenate([[0], np.cumsum(sizes > 0)]))
        joined, raw = out.tobytes(), data.tobytes()
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            text, ids = raw[a:b], joined[begins[k]:begins[k + 1]]
            decoded = text  # every stretch was checked to decode to itself
            if not m.lossless or SPACE_BYTES in text:
                plain_ids = m.encode(text.decode())
                ids, decoded = "".join([m.decimal[i] for i in plain_ids]).encode(), m.decode(plain_ids).encode()
            counts.append(ids.count(b","))
            ids_sha.append(hashlib.sha256(ids[:-1]).hexdigest())
            text_sha.append(hashlib.sha256(decoded).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


def encode_decode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text; nothing is shuffled."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        arrays = [batch.column(0), *digest_column(model(model_path), batch.column(1))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
