"""Message text queries on documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..plans import topics
from .registry import documents, query, table

BLANK = r"[\t\n\f\r\x0B ]"


def clean_sql(column: str) -> str:
    """The cleaning rules as SQL."""
    replies = (
        r"\nOn [^\n]{0,120}? wrote:|\n-{2,}\s*Original Message\s*-{2,}|\nFrom:\s[^\n]*?\nSent:\s[^\n]*?\nTo:\s|\n_{5,}|\nSent from my \w+"
    )
    cut = rf"regexp_replace({column}, '(?:{replies})(?s:.*)', '')"
    lines = rf"regexp_replace(regexp_replace({cut}, '\r\n|[\r\x0B\x0C]', chr(10), 'g'), '\n\z', '')"
    unquoted = rf"array_to_string(list_filter(string_split({lines}, chr(10)), lambda l: NOT regexp_matches(l, '^\s*>')), chr(10))"
    legal = rf"regexp_replace({unquoted}, '(?i)(?:This (?:e-?mail|message) and any attachments|CONFIDENTIALITY NOTICE)(?s:.*)', '')"
    signed = rf"regexp_replace({legal}, '(?i)\n\s*(?:kind regards|best regards|regards|thanks|thank you|cheers|sincerely)[,.]?\s*\n(?s:.*)', '')"
    bare = rf"regexp_replace(regexp_replace({signed}, '\S+@\S+', ' ', 'g'), 'http\S+', ' ', 'g')"
    return rf"trim(regexp_replace({bare}, '{BLANK}+', ' ', 'g'))"


def slots_sql(expr: str) -> str:
    numbered = rf"regexp_replace({expr}, '\p{{Nd}}[\p{{Nd}},./:\-]*', ' <num> ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({numbered}, '[^a-z<>\t\n\f\r\x0B ]', ' ', 'g'), '{BLANK}+', ' ', 'g'))"


SUBJECT_SQL = "concat('RE: Fwd: case ', doc_id, '/', lang, ' (', source, ')')"
CLEAN = clean_sql("text")
BODY = slots_sql(f"lower({CLEAN})")
SUBJECT_NORM = slots_sql(rf"regexp_replace(lower(trim({SUBJECT_SQL})), '^(?:\s*(?:re|fwd|fw|aw)\s*:\s*)+', '')")


def messages(spark, sf):
    """Documents as messages with a subject line made of their keys."""
    return documents(spark, sf).select(
        F.col("doc_id").alias("message_id"),
        F.concat(F.lit("RE: Fwd: case "), F.col("doc_id"), F.lit("/"), "lang", F.lit(" ("), "source", F.lit(")")).alias("subject"),
        F.col("text").alias("body"),
    )


@query("clean_text", f"SELECT doc_id, {CLEAN} AS clean FROM documents")
def _(spark, sf):
    # the table is one row group: deal the texts out before the rules, which cost more
    return documents(spark, sf).select("doc_id", "text").repartition("doc_id").select("doc_id", text.clean_message("text").alias("clean"))


def mail_sql() -> str:
    """Conversations dressed as mail threads: every cleaning rule has something to remove."""
    return r"""(SELECT conv_id, turn, concat(text, chr(10), 'see http://x.example/', conv_id, ' or ask a.b@c.example', chr(10), '> earlier line', chr(10),
CASE role WHEN 'user' THEN concat('Kind regards,', chr(10), 'Someone') WHEN 'assistant' THEN concat('On Monday the team wrote:', chr(10), 'old text')
ELSE 'CONFIDENTIALITY NOTICE for the reader' END, chr(10), 'tail') AS body FROM conversations)"""


def mails(spark, sf):
    role, nl = F.col("role"), F.lit("\n")
    end = (
        F.when(role == "user", "Kind regards,\nSomeone").when(role == "assistant", "On Monday the team wrote:\nold text")
        .otherwise("CONFIDENTIALITY NOTICE for the reader")
    )
    body = F.concat(
        "text", nl, F.lit("see http://x.example/"), F.col("conv_id"), F.lit(" or ask a.b@c.example"), nl, F.lit("> earlier line"), nl,
        end, nl, F.lit("tail"),
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", body.alias("body"))


@query("clean_threads", f"SELECT conv_id, turn, {clean_sql('body')} AS clean FROM {mail_sql()}")
def _(spark, sf):
    return mails(spark, sf).select("conv_id", "turn", text.clean_message("body").alias("clean"))


@query("norm_template", f"SELECT doc_id AS message_id, {SUBJECT_NORM} AS subject_norm, {BODY} AS body_norm FROM documents")
def _(spark, sf):
    return topics.prepare(messages(spark, sf)).select("message_id", "subject_norm", "body_norm")


@query("template_freq", f"""WITH d AS (SELECT doc_id, {BODY} AS body_norm, {SUBJECT_NORM} AS subject_norm FROM documents)
SELECT doc_id AS message_id, count(*) OVER (PARTITION BY subject_norm) AS subject_count, count(*) OVER (PARTITION BY subject_norm) >= 5 AS subject_is_common,
count(*) OVER (PARTITION BY body_norm) AS body_template_count, count(*) OVER (PARTITION BY body_norm) >= 5 AS body_is_common FROM d""")
def _(spark, sf):
    rows = topics.template_frequencies(topics.prepare(messages(spark, sf)), "message_id")
    return rows.select("message_id", "subject_count", "subject_is_common", "body_template_count", "body_is_common")


@query("template_report", f"""WITH d AS (SELECT doc_id, {SUBJECT_SQL} AS subject, {SUBJECT_NORM} AS subject_norm FROM documents)
SELECT subject_norm, count(*) AS messages, arg_min(subject, doc_id) AS example, count(*) >= 5 AS is_common FROM d GROUP BY 1 ORDER BY messages DESC, subject_norm LIMIT 15""")
def _(spark, sf):
    rows = messages(spark, sf).withColumn("subject_norm", text.subject_template("subject"))
    return topics.template_report(rows, "subject_norm", "subject", "message_id", top_n=15)


@query("noise_filter", rf"""WITH d AS (SELECT conv_id, turn, {clean_sql('text')} AS clean FROM conversations),
n AS (SELECT *, CASE WHEN clean = '' THEN 0 ELSE len(string_split(clean, ' ')) END AS n_tokens FROM d)
SELECT conv_id, turn, CAST(n_tokens AS INTEGER) AS n_tokens FROM n WHERE n_tokens >= 5
AND NOT regexp_matches(clean, '(?i)\b(?:out of office|automatic reply|auto-reply|do not reply|delivery (?:has )?failed|undeliverable|read receipt|unsubscribe)\b')""")
def _(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", text.clean_message("text").alias("clean_text"))
    kept = topics.drop_noise(rows.withColumn("n_tokens", text.token_count("clean_text")))
    return kept.select("conv_id", "turn", "n_tokens")


@query("compose_text", rf"""SELECT doc_id AS message_id, trim(concat({SUBJECT_SQL}, '. ', {CLEAN})) AS clean_text FROM documents""")
def _(spark, sf):
    return messages(spark, sf).select("message_id", text.compose("subject", "body").alias("clean_text"))


@query("complaint_risk", """SELECT conv_id, turn, CASE WHEN n >= 8 THEN 'HIGH' WHEN n >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_band,
CASE WHEN n >= 8 THEN 'HIGH' WHEN n >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS profile_risk_band FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)""")
def _(spark, sf):
    from ..operators.groups import with_group_count
    from ..plans.entities.engagement import PROFILE_RISK_MEDIUM, risk_band

    rows = with_group_count(table(spark, sf, "conversations"), ["conv_id"], "n")
    return rows.select(
        "conv_id", "turn", risk_band("n").alias("customer_risk_band"), risk_band("n", PROFILE_RISK_MEDIUM).alias("profile_risk_band")
    )
