"""Personal data in whole texts, with DataFrame functions only.

A regular expression proposes spans, a checksum confirms them (Luhn for cards, mod 97 for account numbers, number
ranges for addresses), and words nearby raise or lower the score. Positions come from the text between matches:
the pieces that ``split`` leaves and the matches that ``regexp_extract_all`` finds alternate, so their lengths add
up to code-point offsets.

The expressions are written so that no starting point inside a run is tried twice and no group repeats without
bound: a text that is one run of letters, digits or dots takes linear time and a flat stack.

Base kinds (email, ip, card, phone) always stay, whatever their score; added kinds (iban, ssn) need ``THRESHOLD``.
Defined results: a null text counts as empty and has no spans; spans of different kinds may overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

LOCAL, DOMAIN = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
#: kind -> (expression, cheap test that must hold for any match)
PATTERNS = {
    # a run of local characters is entered at its first character or where the last match ended; the domain goes on
    # to the first dot that no domain character follows
    "email": (
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++@(?={DOMAIN}++\.{DOMAIN})[A-Za-z0-9.-]+?(?=\.(?!{DOMAIN})|[^A-Za-z0-9.-]|\z)",
        "@",
    ),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    # a chain of digits with single blanks or hyphens is taken whole; only 13 to 19 digits can pass
    "card": (r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])", r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-"),
}
BASE, ADDED = ("email", "ip", "card", "phone"), ("iban", "ssn")
#: score of a span that its checksum or range test confirmed, and the words nearby that raise or lower it
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": r"e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|adresse|direcci",
    "card": r"card|visa|credit|debit|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|telefon|t.l.phone",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social|security",
}
AGAINST = r"example|sample|version|isbn|serial|order|invoice"
RAISE, LOWER, WINDOW, THRESHOLD = 0.2, 0.2, 40, 0.5
SPAN = "struct<start:int,end:int,match:string>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with code-point start and end (exclusive)."""
    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), match.alias("match")),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + piece["gap"]
        end = start + piece["size"]
        span = F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match"))
        return F.when(piece["size"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))
        )

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Doubling every second digit from the right, the digit sum is a multiple of ten."""
    doubled = F.transform(
        F.split(F.reverse(digits_of(match)), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(match: Column) -> Column:
    """The account number with its first four characters moved to the end, letters as 10 to 35, leaves 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, ch: Column) -> Column:
        digit = ch.between("0", "9")
        value = F.ascii(ch) - F.when(digit, 48).otherwise(55)
        return (rest * F.when(digit, 10).otherwise(100) + value) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def small_number(part: Column) -> Column:
    """At most 255, whatever the number of digits."""
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), small_number)
    if kind == "card":
        return luhn(match)
    if kind == "phone":
        return F.length(digits_of(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def scored(kind: str, span: Column, text: Column) -> Column:
    near = F.lower(F.concat_ws(" ",
        F.substr(text, F.greatest(span["start"] - WINDOW, F.lit(0)) + 1, F.least(span["start"], F.lit(WINDOW))),
        F.substr(text, span["end"] + 1, F.lit(WINDOW)),
    ))
    score = F.lit(SCORES[kind])
    score = score + F.when(near.rlike(CONTEXT[kind]), RAISE).otherwise(0.0) - F.when(near.rlike(AGAINST), LOWER).otherwise(0.0)
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3)


def no_spans() -> Column:
    return F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")


def spans_of(kind: str, pattern: str, text: Column) -> Column:
    spans = F.filter(located(text, pattern), lambda s: confirmed(kind, s["match"]))
    spans = F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), scored(kind, s, text).alias("score"),
    ))
    return F.filter(spans, lambda s: s["score"] >= THRESHOLD) if kind in ADDED else spans


def kind_count(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, score), kinds in the order of ``PATTERNS``, then start.

    Texts without digits and ``@`` are not looked at further.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = text.rlike("[0-9@]")
    arrays = [F.when(some & text.rlike(test), spans_of(kind, pattern, text)).otherwise(no_spans()) for kind, (pattern, test) in PATTERNS.items()]
    return docs.withColumn(out, F.concat(*arrays))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, all spans and the scores, one row per document."""
    found = find_pii(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "pii")
    counts = [kind_count(k).alias(f"n_{k}") for k in BASE]
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), scores.alias("scores"))


def redact(docs: DataFrame, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are replaced together.

    ``count_col`` (if there) takes the new number of characters of changed rows. Texts without spans stay as they
    are, null texts stay null.
    """
    name = unused(docs, "pii_spans")
    marked = find_pii(docs, text_col, name)
    text = F.col(text_col)

    def step(acc: Column, span: Column) -> Column:
        text_between = F.substr(acc["text"], acc["at"] + 1, span["start"] - acc["at"])
        fresh = span["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], text_between, F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out"),
            acc["text"].alias("text"),
        )

    ordered = F.array_sort(F.transform(name, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), text.alias("text"))
    whole = F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substr(a["text"], a["at"] + 1, F.length(a["text"]))))
    changed = F.size(name) > 0
    out = marked.withColumn(text_col, F.when(changed, whole).otherwise(text))
    if count_col and count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        out = out.withColumn(count_col, F.when(changed, F.length(text_col).cast(kind)).otherwise(F.col(count_col)))
    return out.drop(name)
