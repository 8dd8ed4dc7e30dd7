"""Different stretches never stand for each other: strings that cancel out in polynomial hashes, and forced collisions."""

import hashlib
import zlib
from collections import Counter
from math import sqrt

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from stratum.llm.minmax import near_duplicates
from stratum.llm.multiset import compare_with_edits, edited_text, fingerprint, unpacked
from stratum.llm.packing import token_pieces
from stratum.llm.pieces import encode_decode_digests
from stratum.llm.words import StretchCache

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def twins(length):
    """Two complementary Thue-Morse strings: in any polynomial over an odd base modulo 2**64 they collide from 1,024 on."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(scope="module")
def twin_rows():
    rows = []
    for n in (512, 1024, 2048):
        one, two = twins(n)
        rows += [(n, one), (n + 1, two), (n + 2, f"{one} q {two} q"), (n + 3, f"x {two} {one}. {two}")]
    return rows


def test_token_ids_of_twins(make_docs, twin_rows):
    tok = Tokenizer.from_file(WORDS)
    want = {i: zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t in twin_rows}
    assert {r.doc_id: r.ids_crc32 for r in token_pieces(make_docs(twin_rows).coalesce(1), WORDS).collect()} == want


def test_piece_ids_of_twins(make_docs, twin_rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = {}
    for i, t in twin_rows:
        ids = sp.encode(t)
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    got = encode_decode_digests(make_docs(twin_rows).coalesce(1), PIECES).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_shingles_and_fingerprints_of_twins(make_docs, twin_rows):
    got = {r.doc_id: r for r in near_duplicates(make_docs(twin_rows), words=2, percent=80).collect()}
    assert all(got[i].n_shingles == len({tuple(p) for p in zip(t.split(), t.split()[1:])} or [t]) for i, t in twin_rows)
    assert len({fingerprint(t) for _, t in twin_rows}) == len(twin_rows)
    assert got[2049].component_id == 2049 and got[2048].component_id == 2048 and got[1027].n_shingles == 3


def lengths_of(stretches):
    return np.arange(len(stretches)), np.frombuffer(b"".join(stretches), np.uint8), np.array([len(s) for s in stretches], np.int64)


@pytest.mark.parametrize("hashes", ["one", "length", "own"])
@pytest.mark.parametrize("limit", [3, 1000])
def test_cache_compares_bytes(hashes, limit):
    """The identity as value: whatever collides, each stretch gets its own bytes."""
    cache = StretchCache(lengths_of, np.uint8, limit)
    rng = np.random.default_rng(3)
    for _ in range(6):
        words = ["".join(rng.choice(list("abC"), rng.integers(1, 4))) for _ in range(50)]
        data = np.frombuffer("".join(words).encode(), np.uint8)
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        keys = {"one": [7] * 50, "length": sizes, "own": [zlib.crc32(w.encode()) for w in words]}[hashes]
        values, counts = cache.look_up(np.array(keys, np.uint64), data, ends - sizes, ends)
        assert values.tobytes() == data.tobytes() and counts.tolist() == sizes.tolist()


# fingerprints, computed independently


def paragraphs_sum(text):
    lanes = [0] * 8
    for part in text.split("\n"):
        if part:
            raw = hashlib.blake2b(part.encode()).digest()
            lanes = [(x + int.from_bytes(raw[8 * k:8 * k + 8], "little")) % 2 ** 64 for k, x in enumerate(lanes)]
    return lanes


def runs_of(text):
    runs = Counter()
    for part in text.split("\n"):
        words = part.lower().split()
        runs.update(tuple(words[k:k + 3]) for k in range(max(1, len(words) - 2)) if words)
    return runs


def cosine(a, b):
    a, b = runs_of(a), runs_of(b)
    if not a or not b:
        return float(not a and not b)
    return sum(n * b[r] for r, n in a.items()) / sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


def test_likeness_equals_shared_runs(make_docs, prose):
    rows = [(1, "word " * 40_000), (2, "word " * 65_538), (3, "tail " * 200_000), (4, "a b c d"), (5, ""), (6, "\n".join(["same line here"] * 70_000))]
    rows += [(10 + i, "\n".join([prose(i, 200), prose(i // 2, 300)])) for i in range(12)]
    got = {r.doc_id: r for r in compare_with_edits(make_docs(rows)).collect()}
    ordered = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        edited = edited_text(text, following)
        assert [int(x) for x in unpacked(got[i].fingerprint)[0]] == paragraphs_sum(text)
        assert [int(x) for x in unpacked(got[i].edited_fingerprint)[0]] == paragraphs_sum(edited)
        assert got[i].near_edited == pytest.approx(cosine(text, edited), abs=0.2)
        assert got[i].near_next == pytest.approx(cosine(text, following), abs=0.2)


def test_null_ids_only(make_docs, prose):
    rows = [(None, prose(k, 20)) for k in range(60)] + [(None, "copy")] * 30 + [(3, "three"), (9, "nine")]
    got = compare_with_edits(make_docs(rows)).collect()
    assert Counter(r.fingerprint for r in got) == Counter(fingerprint(t) for _, t in rows)
    # every text is the next one of exactly one row
    assert len(got) == len(rows)
    [nine] = [r for r in got if r.doc_id == 9]
    assert nine.edited_sha256 == hashlib.sha256(edited_text("nine", "three").encode()).hexdigest()
    only = compare_with_edits(make_docs([(None, "x y"), (None, None)])).collect()
    assert sorted(r.n_chars for r in only) == [0, 3]
