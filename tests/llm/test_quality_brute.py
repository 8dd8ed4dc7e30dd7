"""Every statistic and every score of the classifier recomputed in plain Python; exact dedup in batches and by rows."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm.exact_dedup import DigestIndex, exact_dedup, keep_largest
from stratum.llm.quality import GOOD, STATISTICS, keep_good, score_documents, statistics

BLANKS, MARKS = b" \t\n\x0b\x0c\r", b".,;:"


def plain_statistics(text):
    raw = (text or "").encode()
    words = [w for w in "".join(" " if chr(c) in " \t\n\x0b\x0c\r" else chr(c) for c in raw).encode("latin-1").split(b" ") if w]
    folded = [w.lower() for w in words]
    n, size = max(len(words), 1), max(len(raw), 1)
    letter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    digit = lambda c: 48 <= c <= 57
    symbol = lambda c: not letter(c) and not digit(c) and c not in MARKS and c not in BLANKS
    share = lambda test: sum(map(test, raw)) / size
    return dict(zip(STATISTICS, [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / n, math.log1p(max(map(len, words), default=0)),
        share(lambda c: 65 <= c <= 90), share(digit), share(symbol), share(lambda c: c in MARKS), share(lambda c: c == 124),
        share(lambda c: c == 10), share(lambda c: c >= 128),
        sum(a == b for a, b in zip(folded, folded[1:])) / n, len(set(folded)) / n,
        sum(65 <= w[0] <= 90 for w in words) / n, sum(symbol(w[-1]) for w in words) / n,
    ]))


@pytest.fixture(scope="module")
def odd_texts(awkward_rows, prose):
    texts = [r[1] for r in awkward_rows] + ["A a A\tb!\x0b\x0cc|", "||| 12 3.4,5;6:7", "é É ß\r\nÜ! x", "\x00\x1f \x7f", "Same same SAME same", "x" * 5000]
    return [(k, t) for k, t in enumerate(texts)] + [(1000 + k, prose(k, 1 + 7 * k)) for k in range(60)] + [(2000, "long word " * 300_000)]


def test_statistics_of_whole_texts(make_docs, odd_texts):
    got = {r.doc_id: r for r in statistics(make_docs(odd_texts)).collect()}
    for i, text in odd_texts:
        want = plain_statistics(text)
        assert [got[i][s] for s in STATISTICS] == pytest.approx([want[s] for s in STATISTICS], rel=1e-12, abs=1e-12), (i, (text or "")[:40])


def test_scores_are_the_rules(spark, make_docs, odd_texts, prose):
    rows = odd_texts + [(5000 + k, prose(k, 50) if k % 2 else (prose(k, 50).upper() + "!! ") * 2) for k in range(200)]
    labels = spark.createDataFrame([(5000 + k, k % 2, 0) for k in range(200)] + [(5001, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    scored, model = score_documents(make_docs(rows), labels)
    assert model.rules
    texts = dict(rows)
    for r in scored.collect():
        stats, total = plain_statistics(texts[r.doc_id]), model.intercept
        for rule in model.rules:
            if all(stats[s] <= v if op == "<=" else stats[s] > v for s, op, v in rule.terms):
                total += rule.weight
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9) and r.predicted == int(r.score >= GOOD)
    # the filter keeps what the score keeps, though it is fitted on the sample alone
    good = {r.doc_id for r in scored.collect() if r.predicted}
    assert {r.doc_id for r in keep_good(make_docs(rows), labels).collect()} == good


@pytest.mark.parametrize("batches", [2, 5])
def test_batches_give_the_rows_of_one(spark, awkward, nothing, batches):
    one, several = exact_dedup(awkward), exact_dedup(awkward, batches=batches)
    assert Counter(tuple(r) for r in one.collect()) == Counter(tuple(r) for r in several.collect())
    assert exact_dedup(nothing, batches=batches).count() == 0


def test_later_batches_meet_the_index(spark, make_docs, monkeypatch):
    met = []
    real = DigestIndex.unseen
    monkeypatch.setattr(DigestIndex, "unseen", lambda self, rows: (met.append((self.table().count(), rows.count())), real(self, rows))[1])
    got = exact_dedup(make_docs([(k, f"t{k % 5}") for k in range(40)]), batches=2)
    assert len(met) == 2 and met[0][0] == 0 and met[1][0] == 5 and met[1][1] == 5
    assert {(r.keep_id, r.group_size) for r in got.collect()} == {(35 + k, 8) for k in range(5)}


def test_nothing_is_left_in_the_catalog(spark, awkward):
    before = {t.name for t in spark.catalog.listTables()}
    exact_dedup(awkward, batches=2).count()
    keep_largest(awkward).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_one_row_of_each_group_stays(make_docs):
    rows = [(1, "a"), (1, "A"), (1, "b"), (2, "b"), (None, "c"), (None, "C"), (None, "b"), (None, None), (3, ""), (4, "solo"), (4, "solo")]
    out = keep_largest(make_docs(rows))
    got = Counter((r.doc_id, (r.text or "").lower()) for r in out.collect())
    assert got == {(1, "a"): 1, (2, "b"): 1, (None, "c"): 1, (3, ""): 1, (4, "solo"): 1}
    again = keep_largest(out)
    assert again.count() == 5 and again.columns == out.columns


def test_extra_columns_travel(spark, awkward):
    assert set(keep_largest(awkward).columns) == set(awkward.columns) and keep_largest(awkward.withColumn("keep_digest", F.lit(1))).columns[-1] == "keep_digest"
