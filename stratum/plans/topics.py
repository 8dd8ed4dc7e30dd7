"""Message topics: templates, vectors, spherical clusters, scoring and summaries.

Sentence vectors enter as a column (any encoder can fill it); :func:`hashed_vectors` is a JVM-side stand-in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators.dedup import latest_by
from ..operators.groups import with_group_count
from ..session import durable
from . import clustering

# fixed values: thresholds and sizes of the topic report
COMMON_MIN = 5
K_MIN, K_MAX = 4, 20
CONFIDENCE_MIN, MARGIN_MIN = 0.35, 0.02
TEST_SHARE, SEED, INVERSE_PENALTY, STARTS = 0.25, 42, 10.0, 10
TOP_SUBJECTS, EXAMPLE_CHARS, SUMMARY_CHARS, SUBJECT_CHARS = 3, 280, 200, 70
#: Centroids multiplied at once in a task
CENTROID_BLOCK = 1024


def prepare(messages: DataFrame) -> DataFrame:
    """Clean text, templates and token counts of (message_id, subject, body) rows.

    The rules cost far more than moving a message, and files can be few and large: messages are dealt out by their id
    first. Each body is cleaned once.
    """
    cleaned = messages.repartition("message_id").withColumn("cleaned", text.clean_message("body"))
    return cleaned.withColumns({
        "clean_text": text.compose_cleaned("subject", "cleaned"),
        "subject_norm": text.subject_template("subject"), "body_norm": text.template_of_cleaned("cleaned"),
    }).withColumn("n_tokens", text.token_count("clean_text")).drop("cleaned")


def drop_noise(prepared: DataFrame) -> DataFrame:
    return prepared.filter((F.col("n_tokens") >= text.MIN_TOKENS) & ~text.is_noise("clean_text"))


def with_frequency(prepared: DataFrame, column: str, count: str, common: str, minimum: int = COMMON_MIN) -> DataFrame:
    """Attach the template's frequency. A template shared by a third of all messages is counted map-side."""
    return with_group_count(prepared, [column], count).withColumn(common, F.col(count) >= minimum)


def template_frequencies(prepared: DataFrame, id_col: str, minimum: int = COMMON_MIN) -> DataFrame:
    """(id, template digests, counts, common flags) for subjects and bodies.

    Counting needs the templates twice, so they are cleaned once and kept as digests in the shared folder.
    """
    keys = durable(prepared.select(
        id_col, F.sha2("subject_norm", 256).alias("subject_digest"), F.sha2("body_norm", 256).alias("body_digest")
    ), "templates")
    keys = with_frequency(keys, "subject_digest", "subject_count", "subject_is_common", minimum)
    return with_frequency(keys, "body_digest", "body_template_count", "body_is_common", minimum)


def template_report(prepared: DataFrame, column: str, verbatim: str, tie: str, top_n: int | None = None) -> DataFrame:
    """Templates by frequency with one verbatim example, the one with the smallest ``tie``."""
    out = prepared.groupBy(column).agg(
        F.count(F.lit(1)).alias("messages"), F.min_by(verbatim, tie).alias("example")
    ).withColumn("is_common", F.col("messages") >= COMMON_MIN)
    return out if top_n is None else out.orderBy(F.desc("messages"), column).limit(top_n)


def hashed_vectors(df: DataFrame, column: str, output: str = "features", size: int = 512) -> DataFrame:
    """TF-IDF vectors of hashed tokens. The weights need a pass of their own, so the input is written once."""
    df = durable(df, "tokens")
    stages = [
        RegexTokenizer(inputCol=column, outputCol="__tokens", pattern=r"\s+"),
        HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=size),
        IDF(inputCol="__tf", outputCol=output),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("__tokens", "__tf")


def unit_vectors(df: DataFrame, column: str, output: str = "unit") -> DataFrame:
    """L2-normalised ML vectors from an array column."""
    vectors = df.withColumn("__v", array_to_vector(F.col(column).cast("array<double>")))
    return Normalizer(inputCol="__v", outputCol=output, p=2.0).transform(vectors).drop("__v")


def choose_k(vectors: DataFrame, features: str = "unit", k_min: int = K_MIN, k_max: int = K_MAX, seed: int = SEED, starts: int = STARTS):
    """(model, silhouette scores): spherical K-Means with the best cosine silhouette, for each K the cheapest of several
    starts. K stays below the number of rows.

    The vectors are written once; every round of all models together reads that copy once, see :mod:`clustering`.
    """
    data = durable(vectors.select(vector_to_array(features).alias("v")), "vectors")
    ks = range(k_min, min(k_max, data.count() - 1) + 1)
    fitted = clustering.fit_all(data, ks, starts, seed)
    best = {k: min((fitted[k, s] for s in range(starts)), key=lambda m: m.cost) for k in ks}
    scores = clustering.silhouettes(data, {k: m.centres for k, m in best.items()})
    return best[max(ks, key=lambda k: (scores[k], -k))], scores


def classify(
    new: DataFrame, column: str, centroids: Sequence[tuple[int, Sequence[float]]], summary: DataFrame, confidence_min: float = CONFIDENCE_MIN,
) -> DataFrame:
    """New messages with ``topic``, its ``topic_label`` and ``request_summary`` (empty where the topic has none), ``confidence``
    and ``needs_review``, which looks at the confidence alone.

    ``summary`` is :func:`topic_summary` of the messages the topics were found in: a row per topic, joined by its size.
    """
    known = durable(summary.select(F.col("topic").alias("__t"), "topic_label", "request_summary"), "topic-names")
    scored = score_centroids(new, column, centroids, confidence_min, margin_min=None).drop("margin")
    named = scored.join(known, F.col("topic") == F.col("__t"), "left").drop("__t")
    return named.withColumns({c: F.coalesce(c, F.lit("")) for c in ("topic_label", "request_summary")})


def model_centroids(model) -> list[tuple[int, list[float]]]:
    return [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]


def mean_centroids(df: DataFrame, label: str, column: str) -> DataFrame:
    """Mean vector per label, combined map-side."""
    vectors = df.select(F.col(label).alias("topic"), array_to_vector(F.col(column).cast("array<double>")).alias("v"))
    means = vectors.groupBy("topic").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select("topic", vector_to_array("m").alias("centroid"))


def collect_centroids(centroids: DataFrame) -> list[tuple[int, list[float]]]:
    """Centroids as a list: one row per topic, as a fitted clustering model holds them too."""
    rows = centroids.orderBy("topic").collect()
    return [(int(r["topic"]), [float(x) for x in r["centroid"]]) for r in rows]


def score_centroids(
    df: DataFrame,
    column: str,
    centroids: Sequence[tuple[int, Sequence[float]]],
    confidence_min: float = CONFIDENCE_MIN,
    margin_min: float | None = MARGIN_MIN,
) -> DataFrame:
    """Nearest centroid by cosine: ``topic``, ``confidence``, ``margin`` to the runner-up, ``needs_review``.

    One matrix product per Arrow batch and block of centroids, of which only the best two are kept.
    ``margin_min=None`` reviews on confidence alone, as for new messages.
    """
    topics = np.array([t for t, _ in centroids], dtype="int64")
    matrix = np.array([c for _, c in centroids], dtype="float64")
    matrix = matrix / (np.linalg.norm(matrix, axis=1, keepdims=True) + 1e-9)

    @F.pandas_udf("struct<topic: bigint, confidence: double, margin: double>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            x = np.stack(vectors.to_numpy()).astype("float64")
            x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
            rows = np.arange(len(x))
            first, top, second = np.zeros(len(x), int), np.full(len(x), -np.inf), np.full(len(x), -np.inf)
            for start in range(0, len(matrix), CENTROID_BLOCK):
                sims = x @ matrix[start:start + CENTROID_BLOCK].T
                here = sims.argmax(axis=1)
                best = sims[rows, here]
                sims[rows, here] = -np.inf
                second = np.maximum(np.minimum(top, best), np.maximum(second, sims.max(axis=1)))
                first, top = np.where(best > top, start + here, first), np.maximum(top, best)
            margin = top - second if len(matrix) > 1 else np.full(len(x), np.nan)
            yield pd.DataFrame({"topic": topics[first], "confidence": top, "margin": margin})

    scored = df.withColumn("__s", nearest(F.col(column))).select("*", "__s.*").drop("__s")
    review = F.col("confidence") < confidence_min
    if margin_min is not None:
        review = review | (F.col("margin") < margin_min)
    return scored.withColumn("needs_review", review)


def medoids(scored: DataFrame, id_col: str) -> DataFrame:
    """The most typical row of each topic: highest confidence, smallest id on ties."""
    sizes = scored.groupBy("topic").agg(F.max("confidence").alias("medoid_confidence"), F.count(F.lit(1)).alias("members"))
    first = most_typical(scored, id_col).select(F.col("topic").alias("__t"), F.col(id_col).alias("medoid"))
    return first.join(sizes, F.col("__t") == F.col("topic")).select("topic", "medoid", "medoid_confidence", "members")


def most_typical(scored: DataFrame, id_col: str) -> DataFrame:
    """One row per topic, limited on both sides of the shuffle; ``min_by`` on texts would sort all rows first."""
    return latest_by(scored, ["topic"], [F.desc("confidence"), F.asc(id_col)], tie=())


def stratified(df: DataFrame, label: str, id_col: str, share: float, bits: int = 10) -> DataFrame:
    """``df`` with ``held_out``: per label the ``round(share * n)`` rows with the smallest (hash, id).

    A label is counted in hash buckets; buckets below the border are held out whole, and only the rows of the one bucket
    in which the border falls are ranked. No task ranks a whole label.
    """
    turn = F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED))
    bucket = F.shiftrightunsigned(turn, 64 - bits)
    rows = df.withColumns({"__turn": turn, "__bucket": bucket})
    counts = rows.groupBy(F.col(label).alias("__l"), F.col("__bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy("__l")
    upto = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"__before": F.coalesce(F.sum("__n").over(upto), F.lit(0)), "__wanted": F.round(F.sum("__n").over(whole) * F.lit(share)).cast("bigint")})
    counts = durable(counts, "strata")
    joined = rows.join(counts, F.col(label).eqNullSafe(F.col("__l")) & (F.col("__bucket") == F.col("__b")))
    # a null key keeps settled rows out of the ranking
    border = (F.col("__before") < F.col("__wanted")) & (F.col("__before") + F.col("__n") > F.col("__wanted"))
    place = F.row_number().over(Window.partitionBy("__l", "__b").orderBy("__turn", id_col))
    ranked = joined.filter(border).withColumn("held_out", F.col("__before") + place <= F.col("__wanted"))
    settled = joined.filter(~border).withColumn("held_out", F.col("__before") < F.col("__wanted"))
    return settled.unionByName(ranked).select(*df.columns, "held_out")


def separability(df: DataFrame, features: str, label: str, id_col: str, share: float = TEST_SHARE) -> DataFrame:
    """Accuracy and macro F1 of a linear classifier on a held-out part; one result row.

    Of every label the given share (rounded) with the smallest id hashes is held out; see :func:`stratified`. The penalty
    is stated for the summed loss, Spark averages it over the rows.
    """
    data = durable(stratified(df, label, id_col, share).select(F.col(features), F.col(label).cast("double").alias("label"), "held_out"), "split")
    train = data.filter(~F.col("held_out"))
    penalty = 1.0 / (INVERSE_PENALTY * max(1, train.count()))
    model = LogisticRegression(featuresCol=features, labelCol="label", regParam=penalty, maxIter=200).fit(train)
    predicted = model.transform(data.filter("held_out")).select("label", "prediction")
    cells = predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    # macro F1 from the confusion counts: a few rows per pair of labels
    actual = cells.groupBy(F.col("label").alias("c")).agg(
        F.sum("n").alias("actual"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hit")
    )
    guessed = cells.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("guessed"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("actual") + F.coalesce("guessed", F.lit(0))), F.lit(0.0))
    return actual.join(guessed, "c", "left").agg(
        F.sum("actual").alias("held_out"), (F.sum("hit") / F.sum("actual")).alias("accuracy"), F.avg(f1).alias("macro_f1")
    )


def topic_summary(scored: DataFrame, subject: str, body: str, id_col: str, common: str | None = None) -> DataFrame:
    """One row per topic: size, label, top subjects, dominant share, mean confidence, summary and example.

    ``scored`` carries topic, confidence, the subject and body columns and ``body_norm``. Ties go to the
    smaller text or id. All counting is map-side; windows run over distinct subjects with a group limit.
    """
    size = scored.groupBy("topic").agg(
        F.count(F.lit(1)).alias("email_count"), F.avg("confidence").alias("avg_confidence"),
        (F.count_if(F.col(common)) if common else F.lit(0).cast("bigint")).alias("common_subject_emails"),
    )
    typical = most_typical(scored.select("topic", "confidence", id_col, body), id_col)
    typical = typical.select(F.col("topic").alias("__t4"), F.col(body).alias("__medoid"))
    counts = scored.groupBy("topic", F.col(subject).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    dominant = counts.groupBy(F.col("topic").alias("__t1")).agg(F.max("n").alias("__dominant"))
    named = counts.filter(F.trim("s") != "")
    ranked = named.withColumn(
        "r", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("n"), "s"))
    ).filter(F.col("r") <= TOP_SUBJECTS)
    line = F.concat(F.col("n"), F.lit("x "), F.substring("s", 1, SUBJECT_CHARS))
    tops = ranked.groupBy(F.col("topic").alias("__t2")).agg(
        F.sort_array(F.collect_list(F.struct("r", line.alias("line"), "s"))).alias("__top")
    )
    # the commonest body of each topic, then its verbatim form with the smallest id
    templates = scored.groupBy("topic", "body_norm").agg(F.count(F.lit(1)).alias("n"))
    commonest = latest_by(templates, ["topic"], [F.desc("n"), F.asc("body_norm")], tie=())
    commonest = commonest.select(F.col("topic").alias("__t3"), F.col("body_norm").alias("__b3"))
    texts = scored.select("topic", "body_norm", id_col, body).join(
        commonest, F.col("topic").eqNullSafe(F.col("__t3")) & F.col("body_norm").eqNullSafe(F.col("__b3"))
    )
    examples = latest_by(texts, ["__t3"], [F.asc(id_col)], tie=()).select("__t3", F.col(body).alias("__example"))
    joined = (
        size.join(dominant, F.col("topic") == F.col("__t1"), "left")
        .join(tops, F.col("topic") == F.col("__t2"), "left")
        .join(examples, F.col("topic") == F.col("__t3"), "left")
        .join(typical, F.col("topic") == F.col("__t4"), "left")
    )
    return joined.select(
        "topic", "email_count",
        F.coalesce(F.get("__top.s", F.lit(0)), F.concat(F.lit("requirement "), F.col("topic"))).alias("topic_label"),
        text.trim_summary(text.clean_message("__medoid"), SUMMARY_CHARS).alias("request_summary"),
        F.coalesce(F.array_join("__top.line", " | "), F.lit("")).alias("top_subjects"),
        (F.col("__dominant") / F.col("email_count")).alias("dominant_subject_share"),
        "common_subject_emails", "avg_confidence",
        F.substring(text.clean_message("__example"), 1, EXAMPLE_CHARS).alias("example_message"),
    )


# fixed values: published columns of the assignments
ASSIGNMENT_COLUMNS = [
    "message_id", "subject", "body", "subject_norm", "subject_count", "subject_is_common", "body_template_count", "body_is_common",
    "topic", "topic_label", "confidence", "needs_review",
]


def assignments(scored: DataFrame, summary: DataFrame) -> DataFrame:
    """The 12-column assignment table; texts that are null become empty."""
    labels = summary.select(F.col("topic").alias("__t"), "topic_label")
    rows = scored.join(labels, F.col("topic") == F.col("__t"), "left")
    blanks = {c: F.coalesce(F.col(c), F.lit("")) for c in ("subject", "body", "subject_norm", "topic_label")}
    return rows.withColumns(blanks).select(*ASSIGNMENT_COLUMNS)
