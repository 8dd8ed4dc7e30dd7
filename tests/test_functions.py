import re

from pyspark.sql import functions as F

from stratum.functions import bands, calendar, casting, keys, masking, text
from stratum.plans.entities import engagement, lending, people


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


def col(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_typed_never_fails(spark):
    assert col(spark, ["1", " 2 ", "3.7", "x", None], "string", lambda c: casting.typed(c, "int")) == [1, 2, 3, None, None]
    assert col(spark, ["1.5", "abc"], "string", lambda c: casting.typed(c, "double")) == [1.5, None]
    assert [str(d) for d in col(spark, ["2020-02-30", "2020-02-29"], "string", lambda c: casting.typed(c, "date"))] == ["None", "2020-02-29"]
    assert col(spark, [" Ab "], "string", lambda c: casting.typed(c, "string lower trim")) == ["ab"]
    assert col(spark, ["true", "no", "maybe"], "string", lambda c: casting.typed(c, "boolean")) == [True, False, None]


def test_project_pads_and_keeps(spark):
    df = spark.createDataFrame([("1", "m")], "a string, meta string")
    out = casting.project(df, {"a": "int", "gone": "double"}, keep=("meta", "absent"))
    assert out.dtypes == [("a", "int"), ("gone", "double"), ("meta", "string")]


def test_cast_failures(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert [tuple(r) for r in casting.cast_failures(df, {"a": "int"}).collect()] == [("a", 1)]


def test_first_date_format_wins(spark):
    got = col(spark, ["2024-01-02", "03/04/2024", "12/31/2024", "31/12/2024", "nope", None], "string",
              lambda c: casting.parse_date(c, ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")))
    assert [str(d) for d in got] == ["2024-01-02", "2024-04-03", "2024-12-31", "2024-12-31", "None", "None"]


def test_complaint_formats(spark):
    got = col(spark, ["2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05", "02/01/2024 03:04", "2024/01/02 03:04:05", "02-Jan-2024 03:04", "x"],
              "string", lambda c: casting.parse_timestamp(c, engagement.COMPLAINT_FORMATS))
    assert [str(t) for t in got] == ["2024-01-02 01:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:00", "2024-01-02 03:04:05", "2024-01-02 03:04:00", "None"]


def test_band_edges(spark):
    assert col(spark, [49999.99, 50000.0, 199999.0, 200000.0, 1e6, None], "double", people.income_band) == [
        "Low (<50k)", "Lower-Middle (50k-200k)", "Lower-Middle (50k-200k)", "Middle (200k-500k)", "High (1M+)", "Unknown"]
    assert col(spark, [-5, 0, 30, 31, 60, 61, 90, 91, None], "int", lending.dpd_bucket) == [
        "1-30", "1-30", "1-30", "31-60", "31-60", "61-90", "61-90", "90+", "90+"]
    assert col(spark, [0.29, 0.3, 0.6, 0.8, None], "double", people.risk_tier) == ["Low", "Medium", "High", "Critical", "Unscored"]
    assert col(spark, [4, 5, 8, None], "int", engagement.risk_band) == ["LOW", "MEDIUM", "HIGH", "LOW"]
    assert col(spark, [-1, 24, 25, 64, 65, None], "int", people.age_band) == ["18-24", "18-24", "25-34", "55-64", "65+", "Unknown"]
    assert col(spark, [None, 1.0], "double", lending.arrears_bucket) == ["10k+", "<1k"]


def test_lookup_score_fill(spark):
    assert col(spark, ["a", "z", None], "string", lambda c: bands.map_lookup(c, {"a": "A"}, "other")) == ["A", "other", "other"]
    df = spark.createDataFrame([(True, None), (False, True)], "a boolean, b boolean")
    assert [r[0] for r in df.select(bands.score([F.col("a"), F.col("b")])).collect()] == [1, 1]


def test_masks(spark):
    assert one(spark, masking.hashed(F.lit("x"), "s")) != one(spark, masking.hashed(F.lit("x"), "s", order="prefix"))
    assert one(spark, masking.hashed(F.lit(None), "s")) is None
    assert one(spark, masking.email(F.lit("no-at"), "s")) is None
    assert re.fullmatch(r"[0-9a-f]{64}@b\.c", one(spark, masking.email(F.lit("a@b.c"), "s")))
    assert one(spark, masking.phone(F.lit("+27821234567"))) == "+278***567"
    assert one(spark, masking.last_four(F.lit("12"))) == "****12"
    assert one(spark, masking.last_four(F.lit("123456"))) == "****3456"


def test_no_pii_guard(spark):
    import pytest

    with pytest.raises(ValueError):
        masking.assert_no_pii(spark.createDataFrame([(1,)], "email int"), ["email"])


def test_keys_do_not_collide_across_types(spark):
    assert one(spark, keys.surrogate(F.lit("a"), F.lit(None).cast("date"))) == one(spark, keys.surrogate(F.lit("a")))
    assert one(spark, keys.surrogate(F.lit("a"), record_type="deposit")) != one(spark, keys.surrogate(F.lit("a"), record_type="tx"))


def test_monday_week_like_strftime(spark):
    import datetime as dt

    days = [dt.date(2016, 12, 25) + dt.timedelta(days=i) for i in range(1200)]
    got = col(spark, days, "date", calendar.monday_week)
    assert got == [int(d.strftime("%W")) for d in days]


# ---- text: brute force with Python's own regular expressions

MARKERS = [r"\nOn .{0,120}? wrote:", r"\n-{2,}\s*Original Message\s*-{2,}", r"\nFrom:\s.*?\nSent:\s.*?\nTo:\s", r"\n_{5,}", r"\nSent from my \w+"]


def brute_clean(s):
    ends = [m.start() for m in (re.search(p, s) for p in MARKERS) if m]
    s = s[: min(ends)] if ends else s
    s = "\n".join(x for x in s.splitlines() if not x.lstrip().startswith(">"))
    for p in (r"This (e-?mail|message) and any attachments.*", r"CONFIDENTIALITY NOTICE.*"):
        s = re.sub(p, "", s, flags=re.I | re.S)
    m = re.search(r"\n\s*(kind regards|best regards|regards|thanks|thank you|cheers|sincerely)[,.]?\s*\n", s, re.I)
    s = s[: m.start()] if m else s
    s = re.sub(r"\S+@\S+", " ", s)
    return re.sub(r"\s+", " ", re.sub(r"http\S+", " ", s)).strip()


MESSAGES = [
    "", "plain", "a\nOn Mon, Bob wrote:\nold", "x\n-- Original Message --\ny", "q\nFrom: a\nSent: b\nTo: c\nz", "q\n_____\nz",
    "hi\nSent from my phone", "> all\n> quoted", "> first\nkept\n  > second\nlast", "text\r\n> q\r\nmore\r\n", "tail\n", "tail\n\n",
    "body\nthanks\n> quoted", "body\nthanks\n", "body\nThanks,\nBob", "body\nKind regards.\n\nAnn", "> q\nthanks\nBob", "\n", "\n\n",
    "this EMAIL and any attachments are secret\nmore", "before confidentiality notice after", "mail a@b.c now, @x y@ z@@w @q@r",
    "see http://x.y/z and https://q", "mid > not quoted", "one\x0btwo\n\t> tabbed\nthree", "a" * 5000 + "@" + "b", "no at " + "c" * 5000,
]


def test_clean_message_like_brute_force(spark):
    assert col(spark, MESSAGES, "string", text.clean_message) == [brute_clean(m) for m in MESSAGES]
    assert col(spark, [None], "string", text.clean_message) == [""]


def test_templates(spark):
    subjects = ["RE: Fwd: re: Order 12/3 for a@b.c!", "Plain", None, "  aw : x 1,000.50-2", "reply: re"]
    assert col(spark, subjects, "string", text.subject_template) == ["order <num> for", "plain", "", "x <num>", "reply re"]
    assert col(spark, ["Pay 100 by 2024-01-02.\nThanks\nBob"], "string", text.body_template) == ["pay <num> by <num>"]


def test_tokens_and_noise(spark):
    assert col(spark, ["", " a  b ", "one"], "string", text.token_count) == [0, 2, 1]
    assert col(spark, ["Out of Office until May", "delivery has failed", "about offices", "Unsubscribe here"], "string", text.is_noise) == [True, True, False, True]


def test_compose(spark):
    df = spark.createDataFrame([("S", "body"), (None, "body"), ("", "b")], "s string, b string")
    assert [r[0] for r in df.select(text.compose("s", "b")).collect()] == ["S. body", "body", ". b"]


def brute_trim(t, n):
    if len(t) <= n:
        return t
    cut = t[:n]
    dot = cut.rfind(". ")
    return (cut[: dot + 1] if dot > 40 else cut).strip()


def test_trim_summary(spark):
    texts = ["short", "x" * 300, "First sentence is quite long, longer than forty. " + "y" * 300, "Short. " + "z" * 300, "w" * 60 + ". " + "v" * 50 + ". " + "u" * 200]
    assert col(spark, texts, "string", lambda c: text.trim_summary(c, 200)) == [brute_trim(t, 200) for t in texts]
