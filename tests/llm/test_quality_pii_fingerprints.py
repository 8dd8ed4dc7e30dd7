import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import multiset, pii
from stratum.llm.multiset import changed, compare_with_edits, edited_text, fingerprint, fingerprints, likeness, unpacked
from stratum.llm.pii import pii_digests, redact
from stratum.llm.quality import GOOD, STATISTICS, Rule, RuleModel, keep_good, score_documents, step_statistics, tree_paths
from stratum.llm.words import cut_words, text_steps

# --- personal data


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        good = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0
        out += [("card", *m.span())] if 13 <= len(d) <= 19 and good else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] if 9 <= sum(c.isdigit() for c in m[0]) <= 15 else []
    return out


def personal_texts():
    rng = random.Random(5)
    parts = ["a.b@c.d", "x@y", "@", "a@b.c.", "a@b..c", "q_w@e-r.t.y@u.i", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.00255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "1 2", "+1 (375) 555-4393", "+49.", "+1-2", "😀", "é", " ", "-", ".", "12", "+", "word ", "a@b.c_d@e.f"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(700)]
    return out + ["a" * 40_000 + "@", "1" * 40_000, "a." * 20_000 + "@b" + ".c" * 20_000, "1.1.1.1." * 3000, "+1" + " " * 20_000, "-".join("1" * 9000), "@" * 5000]


def test_base_spans_equal_brute_force(make_docs, awkward_rows):
    texts = list(enumerate(personal_texts())) + [(10_000 + i, r[1]) for i, r in enumerate(awkward_rows)]
    got = {r.doc_id: r for r in pii_digests(make_docs(texts)).collect()}
    for i, t in texts:
        want = base_spans(t or "")
        shown = ",".join("%s:%d:%d" % s for s in want)
        assert got[i].base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
        assert got[i].spans.startswith(shown)


def test_added_kinds_need_checksum_or_context(make_docs):
    rows = [(1, "pay to DE89 3704 0044 0532 0130 00 now"), (2, "pay to DE89 3704 0044 0532 0130 01 now"), (3, "my social security 123-45-6789"), (4, "part 123-45-6789")]
    got = {r.doc_id: r for r in pii_digests(make_docs(rows)).collect()}
    assert got[1].spans == "iban:7:34" and got[2].spans == "" and got[3].spans == "ssn:19:30" and got[4].spans == ""
    near = {r.doc_id: r.scores for r in pii_digests(make_docs([(1, "card 4111111111111111"), (2, "sample 4111111111111111"), (3, "4111111111111111")])).collect()}
    assert float(near[2]) < float(near[3]) < float(near[1])


def test_redaction(make_docs, awkward, awkward_rows, nothing):
    out = {r.doc_id: r for r in redact(make_docs([(1, "é a.b@c.de, +1 (375) 555-4393!"), (2, "none"), (3, None)]), count_col="n_chars").collect()}
    assert out[1].text == "é [EMAIL], [PHONE]!" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "none" and out[3].text is None and out[3].n_chars is None
    assert redact(awkward).columns == awkward.columns and redact(nothing).count() == 0
    assert Counter(r.text for r in redact(awkward).collect()) == Counter(r[1] for r in awkward_rows)


def test_no_python_in_the_plan(awkward):
    for df in (pii_digests(awkward), redact(awkward)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# --- quality


@pytest.fixture(scope="module")
def labelled(spark, prose):
    texts, marks = [], []
    for i in range(240):
        good = prose(i, 40)
        texts.append((i, good if i % 3 else (good.upper().replace(" ", "!! ") if i % 2 else "spam " * 40)))
        marks.append((i, int(i % 3 > 0), 0))
    return texts, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(make_docs, labelled):
    texts, labels = labelled
    scored, model = score_documents(make_docs(texts), labels)
    rows = scored.collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.predicted == int(r.score >= GOOD) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    assert 0 < len(model.rules) < 120 and all(r.weight for r in model.rules)


def test_keep_good(make_docs, labelled, awkward, nothing):
    texts, labels = labelled
    kept = keep_good(make_docs(texts), labels)
    assert kept.columns == make_docs(texts).columns
    assert np.mean([r.doc_id % 3 > 0 for r in kept.collect()]) > 0.97
    assert keep_good(awkward, labels.limit(0)).count() == awkward.count(), "without labels nothing is rejected"
    assert keep_good(nothing, labels).count() == 0


def test_scores_of_awkward_rows(awkward, labelled, nothing):
    scored, _ = score_documents(awkward, labelled[1].unionByName(labelled[1]))
    assert all(r.score is not None for r in scored.collect()) and scored.count() == awkward.count()
    assert score_documents(nothing, labelled[1])[0].count() == 0


def test_statistics_and_rules(spark):
    column = pa.array(["AB cd cd!", "", None, "x|y\n"])
    [(_, _, data, offsets)] = list(text_steps(column))
    table = dict(zip(STATISTICS, step_statistics(data, offsets).T))
    assert table["upper"].tolist() == pytest.approx([2 / 9, 0, 0, 0]) and table["loud"].tolist() == pytest.approx([1 / 3, 0, 0, 0])
    assert table["distinct"].tolist() == pytest.approx([1, 0, 0, 1]) and table["bars"].tolist() == pytest.approx([0, 0, 0, 0.25])
    printed = "x\n  If (feature 0 <= 1.5)\n   If (feature 2 <= 3.0)\n    Predict: 0.0\n   Else (feature 2 > 3.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    assert tree_paths(printed) == [
        (("chars", "<=", 1.5),), (("chars", "<=", 1.5), ("word_bytes", "<=", 3.0)), (("chars", "<=", 1.5), ("word_bytes", ">", 3.0)), (("chars", ">", 1.5),),
    ]
    rule = Rule((("chars", ">", 1.0),), 2.0)
    got = spark.createDataFrame([(0.0,), (2.0,)], "chars double").select(RuleModel((rule,), -1.0).score().alias("s")).collect()
    assert [r.s for r in got] == pytest.approx([1 / (1 + np.e), 1 / (1 + np.exp(-1))]) and str(rule) == "chars > 1"


def test_words_are_cut_at_blanks():
    texts = ["A a\tb", "", "é\x0b x", " "]
    [(_, _, data, offsets)] = list(text_steps(pa.array(texts)))
    hashes, counts, first, after = cut_words(data, offsets)
    assert counts.tolist() == [3, 0, 2, 0] and hashes[0] == hashes[1]
    assert [bytes(data[a:b]).decode() for a, b in zip(first, after)] == ["A", "a", "b", "é", "x"]


# --- fingerprints


def test_edits_and_neighbours_equal_brute_force(make_docs, awkward_rows, prose):
    rows = [r[:2] for r in awkward_rows if r[0] is not None] + [(50 + i, prose(i, 30 + i)) for i in range(60)]
    rows = list(dict(rows).items())
    got = {r.doc_id: r for r in compare_with_edits(make_docs(rows)).collect()}
    ordered = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(ordered):
        text, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = edited_text(text, following)
        r = got[i]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == fingerprint(text) and r.edited_fingerprint == fingerprint(edited)
        for shown, other in ((r.near_edited, edited), (r.near_next, following)):
            assert shown == pytest.approx(float(likeness(*(unpacked(fingerprint(x))[1][None] for x in (text, other)))[0]))


def test_likeness_follows_shared_words(make_docs, prose):
    rows = compare_with_edits(make_docs([(i, prose(i, 300)) for i in range(40)])).collect()
    assert 0.4 < np.mean([r.near_edited for r in rows]) < 0.6 and np.mean([r.near_next for r in rows]) < 0.1


def test_awkward_fingerprints(awkward, awkward_rows, nothing, make_docs):
    got = compare_with_edits(awkward).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward_rows)
    assert len({r.fingerprint for r in got if r.doc_id in (3, 4)}) == 1
    assert compare_with_edits(nothing).count() == 0
    [alone] = compare_with_edits(make_docs([(1, "abcd")])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == pytest.approx(1)


def test_multiset_laws(make_docs):
    one, two = "first paragraph here\nsecond one", "second one\nfirst paragraph here"
    assert fingerprint(one) == fingerprint(two) != fingerprint("first paragraph here")
    assert changed(fingerprint(one), inserted="third", removed="second one") == fingerprint("third\nfirst paragraph here")
    assert fingerprint(one + "\nsecond one") != fingerprint(one)
    rows = fingerprints(make_docs([(1, one), (2, two), (3, None)])).collect()
    assert len({r.fingerprint for r in rows if r.doc_id < 3}) == 1 and fingerprint(None) == fingerprint("")
    assert len(unpacked(fingerprint(one))[1]) == multiset.LANES


def test_next_rows_need_no_global_window(awkward):
    plan = compare_with_edits(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
