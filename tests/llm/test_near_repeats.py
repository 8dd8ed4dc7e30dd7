import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stratum.llm import compact_windows as compact
from stratum.llm import minmax
from stratum.llm.compact_windows import cartesian_spans, chains, compact_windows, shared_passages, similar_passages, window_minima
from stratum.llm.components import components
from stratum.llm.minmax import MinMax, keep_one, near_duplicates, shingle_sets
from stratum.llm.previous_factor import anchors, joined_runs, later_copies, remove_repeats, repeated_starts, sliding_min
from stratum.session import CLEANUP_CONF


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n):
    w = words_of(text)
    return frozenset(zip(*(w[k:] for k in range(n)))) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return find


def brute_components(rows, n, percent=80):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None and shingles(t, n):
            sets[i].append(shingles(t, n))
    links = []
    for a in sets:
        for b in sets:
            if a < b and any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                links.append((a, b))
    return roots(links)


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else w + rng.choice("xyz") for w in text.split())


@pytest.fixture(scope="module")
def family(prose):
    """Groups of near copies around the threshold, equal sets in different order of copies, unrelated texts."""
    out, n = [], 0
    for base in range(6):
        text = prose(base, 60 + 20 * base)
        for k in range(25):
            out.append((n, edited(text, n, 0.01 * (k % 12))))
            n += 1
    return out + [(n + i, prose(900 + i, 40)) for i in range(40)] + [(5000 + i, out[3][1].upper()) for i in range(10)]


@pytest.mark.parametrize("n", [2, 5])
def test_components_equal_brute_force(make_docs, family, n):
    find = brute_components(family, n)
    got = {r.doc_id: r for r in near_duplicates(make_docs(family), n).collect()}
    assert {i: r.component_id for i, r in got.items()} == {i: find(i) for i, _ in family}
    assert all(got[i].n_shingles == len(shingles(t, n)) and got[i].kept == (find(i) == i) for i, t in family)


def test_blocks_of_mixed_buckets(make_docs, family, monkeypatch):
    monkeypatch.setattr(minmax, "BLOCK", 500)
    find = brute_components(family, 2)
    assert {r.doc_id: r.component_id for r in near_duplicates(make_docs(family), 2).collect()} == {i: find(i) for i, _ in family}


def test_near_duplicates_of_awkward_rows(awkward, awkward_rows, nothing):
    find = brute_components([r[:2] for r in awkward_rows], 2)
    got = near_duplicates(awkward, 2).collect()
    assert len(got) == len(awkward_rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else find(r.doc_id))
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert near_duplicates(nothing, 2).count() == 0
    assert keep_one(awkward).columns == awkward.columns and keep_one(nothing).count() == 0


def test_minmax_values_estimate_similarity(prose):
    a, b = shingle_sets(pa.array([prose(1, 400), edited(prose(1, 400), 5, 0.08)]), 2)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    hasher = MinMax(100, 6)
    assert abs((hasher.signature(a) == hasher.signature(b)).mean() - true) < 0.08


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 150: 100}


# --- longest previous factor


def brute_removal(rows, length):
    seen, out = set(), []
    for i, t in rows:
        raw, gone = (t or "").encode(), np.zeros(len((t or "").encode()), bool)
        for p in range(len(raw) - length + 1):
            if raw[p:p + length] in seen:
                gone[p:p + length] = True
            else:
                seen.add(raw[p:p + length])
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.fixture(scope="module")
def patchwork():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(5)]
    rows = []
    for i in range(80):
        at = rng.randrange(150)
        rows.append((3 * i, "".join(rng.choice("xyz") for _ in range(rng.randrange(40))) + rng.choice(base)[at:at + rng.randrange(20, 300)] + "".join(rng.choice("uvw") for _ in range(rng.randrange(40)))))
    return rows + [(1000, "a" * 350), (1001, "ab" * 200), (1002, ""), (1003, None), (1004, "é" * 120), (1005, "a" * 99), (1006, "a" * 101)]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_removal_equals_brute_force(make_docs, patchwork, hot):
    got = remove_repeats(make_docs(patchwork), chunk=50, hot=hot)
    assert sorted(map(tuple, got.collect())) == sorted(brute_removal(patchwork, 100))


def test_removal_with_another_length(make_docs, patchwork):
    got = remove_repeats(make_docs(patchwork), length=40, gram=16)
    assert sorted(map(tuple, got.collect())) == sorted(brute_removal(patchwork, 40))


def test_removal_of_awkward_rows(awkward, awkward_rows, nothing):
    got = {}
    for r in remove_repeats(awkward, with_bytes=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(awkward_rows)
    assert got[1][0].n_removed == 0 and got[2][0].n_removed == got[2][0].n_bytes and got[2][0].n_spans == 1
    assert len({tuple(r) for r in got[10]}) == 1 and got[10][0].n_removed == 0  # a repeated row is one document
    assert remove_repeats(nothing).count() == 0


def test_previous_factors_of_units():
    text = b"abracadabra" * 3
    unit, at = repeated_starts([text, text[5:]], np.array([0, 1]), np.array([0, 5]), 8)
    seen, want = set(), []
    for u, (raw, base) in enumerate([(text, 0), (text[5:], 5)]):
        for p in range(len(raw) - 7):
            want += [(u, base + p)] if raw[p:p + 8] in seen else []
            seen.add(raw[p:p + 8])
    assert sorted(zip(unit.tolist(), at.tolist())) == want


def test_anchors_own_every_window():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 700).astype(np.uint8)
    doc, at, before, after, _, _ = anchors(data, np.array([0, 300, 350, 700]))
    for first, last, d in ((0, 300, 0), (350, 700, 2)):
        for p in range(last - first - 99):
            assert any(d == k and a - x <= p and p + 100 <= a + y for k, a, x, y in zip(doc, at, before, after))
    assert 1 not in doc
    values = rng.integers(0, 50, 101).astype(np.uint64)
    assert (sliding_min(values, 7) == [values[i:i + 7].min() for i in range(95)]).all()
    assert [x.tolist() for x in joined_runs(np.array([5, 0, 3]), np.array([9, 3, 4]))] == [[0, 5], [4, 9]]


# --- compact windows


def test_compact_windows_cover_every_subsequence_once():
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 40, 60).astype(np.uint64)
    factors = np.array([7], np.uint64)
    span = 6
    _, value, place, first, last = compact_windows(tokens, factors, span)
    from stratum.llm.words import mix
    hashed = mix(tokens * factors[0])
    for i in range(60):
        for j in range(i + span - 1, 60):
            hit = [(v, c) for v, c, a, b in zip(value, place, first, last) if a <= i <= c <= j <= b]
            c = i + int(np.argmin(hashed[i:j + 1]))
            assert hit == [(hashed[c], c)]
    assert (np.diff(window_minima(hashed, span)) > 0).all()
    assert cartesian_spans(hashed, np.arange(60), 60)[0][int(np.argmin(hashed))] == 0


@pytest.fixture(scope="module")
def quoting(prose):
    """Texts that quote passages of 50 to 90 words, exactly or nearly, and others that quote too little."""
    passages = [prose(7000 + k, 50 + 10 * k) for k in range(5)]
    rows = []
    for i in range(60):
        quoted = passages[i % 5] if i % 3 else edited(passages[i % 5], i, 0.02)
        rows.append((i, " ".join([prose(8000 + i, 10 + i), quoted, prose(9000 + i, 30)])))
    return rows + [(100 + i, " ".join([prose(100 + i, 30), " ".join(passages[0].split()[:30]), prose(200 + i, 30)])) for i in range(10)]


def test_every_shared_run_of_fifty_words_is_found(make_docs, quoting):
    rows = quoting + [(500 + i, quoting[3][1]) for i in range(5)]
    got = similar_passages(make_docs(rows)).collect()
    find = roots([(r.doc_id, r.other_id) for r in got])
    shared = defaultdict(set)
    words = {i: words_of(t) for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - 49):
            shared[tuple(w[k:k + 50])].add(i)
    assert all(len({find(i) for i in ids}) == 1 for ids in shared.values())
    for r in got:
        a, b = words[r.doc_id][r.first_word:r.last_word + 1], words[r.other_id][r.other_first:r.other_last + 1]
        x, y = shingles(" ".join(a), 5), shingles(" ".join(b), 5)
        assert len(a) >= 50 and len(b) >= 50 and r.other_id < r.doc_id
        assert r.similarity == 100 * len(x & y) // len(x | y) >= 80
    assert not {r.doc_id for r in got} & set(range(100, 110)), "texts that share less stay alone"


@pytest.mark.parametrize("words", range(50, 55))
def test_short_passages_with_one_changed_word(words):
    """Brute force over all aligned passages of that many words: every place of the changed word."""
    rng = np.random.default_rng(words)
    base, sides = rng.integers(0, 1 << 60, words), rng.integers(0, 1 << 60, (4, 60))

    def tokens(w):
        return np.array([hash(tuple(w[i:i + 5].tolist())) for i in range(len(w) - 4)]).view(np.uint64)

    for at in range(words):
        changed = base.copy()
        changed[at] += 1
        a, b = (tokens(np.concatenate([sides[2 * k], w, sides[2 * k + 1]])) for k, w in enumerate((base, changed)))
        one, two = (set(x[60:60 + words - 4].tolist()) for x in (a, b))
        got = shared_passages(a, b, 80, 46)
        # a change so near the border that the rest has 50 words is found as that rest
        assert bool(got) == (100 * len(one & two) >= 80 * len(one | two)), at
        for fa, la, fb, lb, s in got:
            x, y = set(a[fa:la + 1].tolist()), set(b[fb:lb + 1].tolist())
            assert min(la - fa, lb - fb) + 1 >= 46 and s == 100 * len(x & y) // len(x | y) >= 80


def test_links_of_other_diagonals_close_no_chain():
    links = [(f, 100 + 5 * f, 100 + 5 * f + far, 40, 40) for f in range(4) for far in (50, 600)]
    assert chains(links, 2) == [(60, 155, 110, 205, 4), (60, 155, 660, 755, 4)]
    assert chains(links[:1] + [(1, 105, 400, 9, 9)] + links[2:3], 2) == [(60, 145, 110, 195, 2)]


def test_passage_repeated_in_the_later_document(make_docs, prose):
    passage = prose(7100, 60)
    second = [passage, prose(7101, 500), passage, prose(7102, 500), edited(passage, 3, 0.02)]
    got = similar_passages(make_docs([(1, " ".join([prose(7103, 40), passage, prose(7104, 40)])), (2, " ".join(second))])).collect()
    assert all((r.doc_id, r.other_id) == (2, 1) for r in got)
    covered = {w for r in got for w in range(r.first_word, r.last_word + 1)}
    assert set(range(60)) | set(range(560, 620)) <= covered


def near_pairs(prose, count):
    """Pairs of texts ``2 i, 2 i + 1`` whose only common passage has 50 to 70 words and similarity 0.8 to 0.9 by brute force."""
    rows, seed = [], 0
    while len(rows) < 2 * count:
        seed += 1
        rng = random.Random(seed)
        words = prose(20_000 + seed, rng.randrange(50, 71)).split()
        changed = list(words)
        for at in rng.sample(range(len(words)), rng.randrange(1, 3)):
            changed[at] += "q"
        x, y = shingles(" ".join(words), 5), shingles(" ".join(changed), 5)
        if 80 * len(x | y) <= 100 * len(x & y) < 90 * len(x | y):
            for one in (words, changed):
                rows.append((len(rows), " ".join([prose(50_000 + len(rows), 60), *one, prose(90_000 + len(rows), 60)])))
    return rows


def test_recall_of_near_passages(make_docs, prose):
    rows = near_pairs(prose, 500)
    got = {(r.other_id, r.doc_id) for r in similar_passages(make_docs(rows)).collect()}
    want = {(i, i + 1) for i in range(0, len(rows), 2)}
    assert got == want, f"recall {len(got & want) / len(want):.4f}"


@pytest.mark.parametrize("block", [4096, 3])
def test_partial_quotes_before_and_between_full_ones(make_docs, prose, monkeypatch, block):
    """Quotes of 30 and 44 words, with ids before and between those of the full ones, hide no full one."""
    monkeypatch.setattr(compact, "BLOCK", block)
    rows, full, n = [], defaultdict(list), 0
    for k in range(6):
        words = prose(7200 + k, 50).split()
        for part in (words[:30], words[20:], words[:44], words, words[3:47], words[:30], words[20:], words, words[6:]):
            rows.append((n, " ".join([prose(7300 + n, 60), *part, prose(7400 + n, 60)])))
            if len(part) == 50:
                full[k].append(n)
            n += 1
    got = {(r.other_id, r.doc_id) for r in similar_passages(make_docs(rows)).collect()}
    find = roots(got)
    assert all(find(a) == find(b) for a, b in full.values())
    assert all({a % 9, b % 9} <= {3, 7, 2, 4, 8} for a, b in got)


def test_repetitive_texts_make_few_windows_and_stay_covered(make_docs, prose):
    unit = prose(7500, 30)
    rows = [(1, " ".join([prose(7501, 80), *[unit] * 10])), (2, " ".join([*[unit] * 100, prose(7502, 80)])), (3, " ".join(["same"] * 400)), (4, " ".join(["same"] * 300))]
    docs = make_docs(rows).selectExpr("doc_id AS doc", "text")
    assert compact.windows_of(docs, 4, 46, 5).count() < 200
    got = similar_passages(make_docs(rows)).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(2, 1), (4, 3)}
    assert set(range(2990)) <= {w for r in got if r.doc_id == 2 for w in range(r.first_word, r.last_word + 1)}
    assert set(range(300)) == {w for r in got if r.doc_id == 4 for w in range(r.first_word, r.last_word + 1)}
    words = {i: words_of(t) for i, t in rows}
    for r in got:
        x, y = (shingles(" ".join(w), 5) for w in (words[r.doc_id][r.first_word:r.last_word + 1], words[r.other_id][r.other_first:r.other_last + 1]))
        assert r.similarity == 100 * len(x & y) // len(x | y) >= 80


def test_windows_of_documents_in_a_row():
    """Windows of several documents in one step equal those of each for itself."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 30, n).astype(np.uint64) for n in (6, 40, 7, 200)]
    factors, edges = np.array([7, 11], np.uint64), np.cumsum([0, 6, 40, 7, 200])
    together = set(zip(*(c.tolist() for c in compact_windows(np.concatenate(texts), factors, 6, edges))))
    alone = {(f, v, c + e, x + e, y + e) for t, e in zip(texts, edges.tolist()) for f, v, c, x, y in zip(*(k.tolist() for k in compact_windows(t, factors, 6)))}
    assert together == alone


def test_different_values_of_places_in_a_row():
    values = np.random.default_rng(9).integers(0, 6, 50).astype(np.uint64)
    before = compact.earlier(values)[0]
    assert compact.different(before, 7).tolist() == [len(set(values[i:i + 7].tolist())) for i in range(44)]


def test_steps_of_passages_leave_no_shuffle_files(make_docs, quoting):
    """Files of shuffles go with their step; they stayed until the driver's garbage was collected."""
    docs = make_docs(quoting)
    files = docs.sparkSession.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = files.getAllBlocks()
        return {str(found.apply(k)) for k in range(found.size()) if "shuffle" in str(found.apply(k))}

    before = shuffled()
    got = similar_passages(docs)
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    left = shuffled() - before
    assert got.count() and not left
    assert docs.sparkSession.conf.get(CLEANUP_CONF, None) != "true", "only within the operator"


def test_short_tokens_refuse_phrases_and_no_passage():
    rng = np.random.default_rng(11)
    ranges, phrases = [], []
    for k in range(400):
        text = rng.integers(0, 1 << 63, 90).astype(np.uint64) * np.uint64(2)
        if k % 3 == 0:
            text[rng.integers(0, 90, 30)] = text[0]
        other = rng.integers(0, 1 << 63, 120).astype(np.uint64) * np.uint64(2)
        size = (60, 20)[k % 2]
        other[10:10 + size] = text[15:15 + size]
        other[rng.integers(0, 120, k % 7)] += np.uint64(1 << 50)
        ranges += [text, other]
        phrases.append(size == 20 and k % 3 > 0)
    found = {"tokens": (np.concatenate(ranges) >> np.uint64(48)).astype(np.uint16), "ends": np.cumsum([0, *map(len, ranges)])}
    left = np.arange(0, 800, 2)
    alike = compact.can_share(found, left, left + 1, 80, 46)
    want = np.array([bool(shared_passages(ranges[k + 1], ranges[k], 80, 46, 5)) for k in left])
    assert alike[want].all() and want.sum() > 100
    assert not alike[np.array(phrases)].any() and sum(phrases) > 100
    # nor does the test on places, of ranges without repeats
    for k in (k for k in left[want].tolist() if len(set(ranges[k].tolist())) == 90):
        a, b = ranges[k], ranges[k + 1]
        fa, la, fb, lb, _ = shared_passages(a, b, 80, 46, -5)[0]
        place = next(x for x in range(fa, la + 1) if a[x] in b[fb:lb + 1])
        places = np.flatnonzero(np.isin(a, b))
        assert compact.dense_around(np.zeros(len(places), int), places, np.array([place]), 121, 80, 46)[0]


def test_passages_of_documents_in_parts(make_docs, quoting, monkeypatch):
    """A document of very many spots brings its text to several rows."""
    whole = {tuple(r)[:7] for r in similar_passages(make_docs(quoting)).collect()}
    monkeypatch.setattr(compact, "PARTS", 3)
    assert {tuple(r)[:7] for r in similar_passages(make_docs(quoting)).collect()} == whole


def test_islands_are_ranges_that_touch():
    rng = np.random.default_rng(12)
    home, first = rng.integers(0, 5, 300), rng.integers(0, 4000, 300)
    last = first + rng.integers(0, 60, 300)
    got = compact.islands(home, first, last, 20)
    for doc in range(5):
        mine = sorted(zip(first[home == doc].tolist(), last[home == doc].tolist(), got[home == doc].tolist()))
        name, end = None, None
        for x, y, island in mine:
            if end is None or x - 20 > end + 21:
                name, end = x, y
            end = max(end, y)
            assert island == name


def test_passages_of_awkward_rows(awkward, nothing):
    got = {(r.doc_id, r.other_id) for r in similar_passages(awkward).collect()}
    assert (2, 1) in got and (11, 10) in got and not any(None in p for p in got)
    assert similar_passages(nothing).count() == 0


def test_sure_repeats_leave_the_hot_anchor():
    anchor, unit = np.array([7, 7, 7, 7, 8]), np.array([1, 1, 1, 2, 1])
    doc, slot = np.array([5, 3, 5, 9, 3]), np.array([0, 4, 0, 1, 4])
    assert later_copies(anchor, unit, doc, slot).tolist() == [True, False, True, False, False]
    # the same row twice is one document
    assert later_copies(anchor[:1].repeat(2), unit[:1].repeat(2), doc[:1].repeat(2), slot[:1].repeat(2)).tolist() == [False, False]
