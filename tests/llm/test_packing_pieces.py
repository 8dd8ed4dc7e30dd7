import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from stratum.llm.packing import nnls, pack, pack_histogram, patterns, token_pieces
from stratum.llm.pieces import PieceModel, decode_documents, encode_decode_digests, encode_documents

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "it's I'M don't. x'", "A<|endoftext|>b", "é é É", "İstanbul ΣΑΣ", "a b\x1cc\x85d", "12345 a1b2 3.14, 5", "...,,, ,.", "日本語 😀", " \n\t ",
    "ª º µ ß × ÷ .×", "x" * 300, "<|startoftext|>", "a.,", ".", "l'été d'or.", "a\xa0b  c", "Ünï. cödé,", "no–dash.", "(a). b",
]


@pytest.fixture(scope="module")
def texts(awkward_rows):
    return [(r[0], r[1]) for r in awkward_rows] + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]


def test_pieces_carry_the_tokenizers_ids(make_docs, texts):
    tok = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter(tuple(r) for r in token_pieces(make_docs(texts), WORDS).collect()) == want


def check_packed(rows, limit):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_packing_is_gapless_and_tight(make_docs, prose):
    texts = [(i, prose(i, 3 + (i * 37) % 400)) for i in range(400)]
    rows = pack(token_pieces(make_docs(texts), WORDS, 256), 256).collect()
    assert len(rows) == token_pieces(make_docs(texts), WORDS, 256).count()
    total = sum(r.length for r in rows)
    assert check_packed(rows, 256) <= -(-total // 256) * 1.02 + 1


def test_packing_awkward_rows(awkward, nothing):
    rows = pack(token_pieces(awkward, WORDS)).collect()
    check_packed(rows, 4096)
    assert pack(token_pieces(nothing, WORDS)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_histogram_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4 + seed % 3, 1, 3000).astype(int) + 1, 1, 512)
    histogram = np.bincount(lengths, minlength=513)
    plan, sequences = pack_histogram(histogram, 512, 32, 4)
    fill, seen = np.zeros(sequences, int), np.zeros(513, int)
    spans = defaultdict(list)
    for length, rank, count, first, offset in plan.tolist():
        assert rank == seen[length]
        seen[length] += count
        fill[first:first + count] += length
        for s in range(first, first + count):
            spans[s].append((offset, offset + length))
    assert (seen == histogram).all() and fill.max() <= 512
    assert all(a[1] == b[0] for s in spans.values() for a, b in zip(sorted(s), sorted(s)[1:])) and all(min(s)[0] == 0 for s in spans.values())
    assert sequences <= -(-lengths.sum() // 512) * 1.03 + 1


def test_plan_size_depends_on_lengths_not_on_rows():
    rng = np.random.default_rng(0)
    histogram = np.bincount(np.clip(rng.lognormal(5, 1, 5000).astype(int), 1, 512), minlength=513)
    assert len(pack_histogram(histogram * 1000, 512)[0]) < 20 * 512


def test_nnls_and_patterns():
    assert set(patterns(4, 3)) == {(4,), (3, 1), (2, 2), (2, 1, 1)}
    a = np.array([[1.0, 0, 1], [0, 1, 1]])
    x = nnls(a, np.array([3.0, 1.0]))
    assert (x >= 0).all() and np.allclose(a @ x, [3, 1], atol=1e-3)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def hard_texts(model):
    rng = random.Random(1)
    alphabet = "ab  \n,.Ttheéß▁1$"
    pieces = list(model.ids)
    return [
        "  two  spaces ", "a\n\nb", "\t tab", "x​y", "ﬁ ｆｕｌｌ", "", "   ", "a▁b", "日本 😀 é é", "<s>hi</s>", "<0x41> <unk>", "a\x00b",
        "a" * 63, "▁", " " * 40 + "x", "b" * 300, "\n", "\n a", "é" * 50, "ab" * 500, "� x",
        *("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)),
        *("".join(rng.choice(pieces) for _ in range(rng.randrange(1, 8))) for _ in range(3000)),
    ]


def test_backtracking_equals_the_library(library):
    model = PieceModel(PIECES)
    for text in hard_texts(model):
        ids = library.encode(text)
        assert model.encode(text) == ids, text
        assert model.decode(ids) == library.decode(ids), text


def test_digests_equal_the_library(make_docs, awkward_rows, library):
    model = PieceModel(PIECES)
    texts = [(r[0], r[1]) for r in awkward_rows] + [(1000 + i, t) for i, t in enumerate(hard_texts(model)[:800])]
    want = Counter()
    for i, t in texts:
        ids = library.encode(t or "")
        shas = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want[(i, len(ids), *shas)] += 1
    assert Counter(tuple(r) for r in encode_decode_digests(make_docs(texts), PIECES).collect()) == want


def test_round_trip(awkward, awkward_rows, nothing):
    back = decode_documents(encode_documents(awkward, PIECES), PIECES).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in awkward_rows)
    assert encode_decode_digests(nothing, PIECES).count() == 0
