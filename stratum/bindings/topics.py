"""Vector and topic queries on the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import vectors
from ..plans import clustering, topics
from ..session import durable
from .registry import query, table
from .text import messages

CENTROIDS_SQL = """(SELECT label AS topic, list(m ORDER BY i) AS centroid FROM (SELECT label, i, avg(x) AS m FROM
(SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)"""
SIMS_SQL = f"""(SELECT vec_id, label, c.topic, list_dot_product(v, c.centroid) / ((sqrt(list_dot_product(v, v)) + 1e-9) * (sqrt(list_dot_product(c.centroid, c.centroid)) + 1e-9)) AS s
FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), {CENTROIDS_SQL} c)"""
SCORED_SQL = f"""(SELECT vec_id, label, arg_max(topic, s) AS topic, max(s) AS confidence, max(s) - list_sort(list(s), 'DESC')[2] AS margin FROM {SIMS_SQL} GROUP BY ALL)"""


def scored(spark, sf):
    rows = table(spark, sf, "embeddings")
    centroids = topics.collect_centroids(topics.mean_centroids(rows, "label", "embedding"))
    return topics.score_centroids(rows, "embedding", centroids)


@query("mean_centroids", f"""SELECT topic, CAST(i AS INTEGER) AS i, round(x, 6) AS x FROM (SELECT topic, unnest(centroid) AS x, unnest(range(len(centroid))) AS i FROM {CENTROIDS_SQL})""")
def _(spark, sf):
    means = topics.mean_centroids(table(spark, sf, "embeddings"), "label", "embedding")
    return means.select("topic", F.posexplode("centroid").alias("i", "x")).select("topic", "i", F.round("x", 6).alias("x"))


@query("unit_vectors", """SELECT vec_id, round(sqrt(list_dot_product(v, v)), 6) AS norm, round(v[1] / (sqrt(list_dot_product(v, v)) + 1e-9), 6) AS first
FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    return rows.select(
        "vec_id", F.round(vectors.norm("embedding"), 6).alias("norm"), F.round(F.get(vectors.unit("embedding"), F.lit(0)), 6).alias("first")
    )


@query("centroid_score", f"""SELECT vec_id, CAST(topic AS BIGINT) AS topic, round(confidence, 6) AS confidence, round(margin, 6) AS margin,
confidence < 0.35 OR margin < 0.02 AS needs_review FROM {SCORED_SQL}""")
def _(spark, sf):
    return scored(spark, sf).select(
        "vec_id", "topic", F.round("confidence", 6).alias("confidence"), F.round("margin", 6).alias("margin"), "needs_review"
    )


@query("medoid", f"""SELECT CAST(topic AS BIGINT) AS topic, arg_min(vec_id, (-confidence, vec_id)) AS medoid, round(max(confidence), 6) AS medoid_confidence, count(*) AS members FROM {SCORED_SQL} GROUP BY 1""")
def _(spark, sf):
    return topics.medoids(scored(spark, sf), "vec_id").withColumn("medoid_confidence", F.round("medoid_confidence", 6))


def as_messages(spark, sf):
    """Scored vectors as messages: the label gives subjects and bodies with repeats."""
    group = F.col("label") % 4
    return scored(spark, sf).withColumns({
        "message_id": F.col("vec_id"),
        "subject": F.when(F.col("label") == 3, " ").otherwise(F.concat(F.lit("subject "), F.col("label"))),
        "body": F.concat(F.lit("Body of group "), group, F.lit(".\nPlease see line "), F.length(F.col("vec_id").cast("string"))),
        "body_norm": F.concat(F.lit("body of group "), group),
    }).withColumn("subject_norm", F.col("subject"))


TOPIC_ROWS_SQL = f"""(SELECT vec_id AS message_id, topic, confidence, CASE WHEN label = 3 THEN ' ' ELSE concat('subject ', label) END AS subject,
concat('Body of group ', label % 4, '. Please see line ', length(vec_id::VARCHAR)) AS body, concat('body of group ', label % 4) AS body_norm, label, margin FROM {SCORED_SQL})"""


@query("cluster_summary", f"""WITH r AS {TOPIC_ROWS_SQL},
k AS (SELECT topic, subject, count(*) AS n FROM r GROUP BY ALL),
nm AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY n DESC, subject) AS rk FROM k WHERE trim(subject) <> ''),
tp AS (SELECT topic, arg_min(subject, rk) AS label, string_agg(concat(n, 'x ', subject), ' | ' ORDER BY rk) AS tops FROM nm WHERE rk <= 3 GROUP BY 1),
bd AS (SELECT topic, body_norm, count(*) AS n, arg_min(body, message_id) AS raw FROM r GROUP BY ALL),
ex AS (SELECT topic, arg_min(raw, (-n, body_norm)) AS raw FROM bd GROUP BY 1)
SELECT CAST(r.topic AS BIGINT) AS topic, count(*) AS email_count, coalesce(any_value(tp.label), concat('requirement ', r.topic)) AS topic_label, arg_min(body, (-confidence, message_id)) AS request_summary,
coalesce(any_value(tp.tops), '') AS top_subjects, any_value(mx.n) / count(*) AS dominant_subject_share, CAST(0 AS BIGINT) AS common_subject_emails, round(avg(confidence), 6) AS avg_confidence, any_value(ex.raw) AS example_message
FROM r LEFT JOIN tp USING (topic) LEFT JOIN ex USING (topic) LEFT JOIN (SELECT topic, max(n) AS n FROM k GROUP BY 1) mx USING (topic) GROUP BY r.topic""")
def _(spark, sf):
    full = as_messages(spark, sf)
    return topics.topic_summary(full, "subject", "body", "message_id").withColumn("avg_confidence", F.round("avg_confidence", 6))


@query("classify_new", f"""WITH r AS {TOPIC_ROWS_SQL}, k AS (SELECT topic, subject, count(*) AS n FROM r WHERE trim(subject) <> '' GROUP BY ALL),
tp AS (SELECT topic, arg_min(subject, (-n, subject)) AS label FROM k GROUP BY 1), sm AS (SELECT topic, arg_min(body, (-confidence, message_id)) AS summary FROM r GROUP BY 1)
SELECT message_id, CAST(topic AS BIGINT) AS topic, coalesce(tp.label, concat('requirement ', topic)) AS topic_label, summary AS request_summary,
round(confidence, 6) AS confidence, confidence < 0.5 AS needs_review FROM r LEFT JOIN tp USING (topic) LEFT JOIN sm USING (topic)""")
def _(spark, sf):
    """Every message once more as a new one, against the topics and their summary."""
    rows = table(spark, sf, "embeddings")
    centroids = topics.collect_centroids(topics.mean_centroids(rows, "label", "embedding"))
    summary = topics.topic_summary(as_messages(spark, sf), "subject", "body", "message_id")
    out = topics.classify(rows.withColumnRenamed("vec_id", "message_id"), "embedding", centroids, summary, 0.5)
    return out.select("message_id", "topic", "topic_label", "request_summary", F.round("confidence", 6).alias("confidence"), "needs_review")


@query("topic_assignments", f"""WITH r AS {TOPIC_ROWS_SQL}, k AS (SELECT topic, subject, count(*) AS n FROM r WHERE trim(subject) <> '' GROUP BY ALL),
tp AS (SELECT topic, arg_min(subject, (-n, subject)) AS label FROM k GROUP BY 1)
SELECT message_id, subject, concat('Body of group ', r.label % 4, '.', chr(10), 'Please see line ', length(message_id::VARCHAR)) AS body, subject AS subject_norm, CAST(r.topic AS BIGINT) AS topic, coalesce(tp.label, concat('requirement ', r.topic)) AS topic_label,
count(*) OVER (PARTITION BY subject) AS subject_count, count(*) OVER (PARTITION BY subject) >= 5 AS subject_is_common, count(*) OVER (PARTITION BY body_norm) AS body_template_count, count(*) OVER (PARTITION BY body_norm) >= 5 AS body_is_common,
round(confidence, 6) AS confidence, confidence < 0.35 OR margin < 0.02 AS needs_review FROM r LEFT JOIN tp USING (topic)""")
def _(spark, sf):
    full = as_messages(spark, sf)
    full = topics.with_frequency(full, "subject_norm", "subject_count", "subject_is_common")
    full = topics.with_frequency(full, "body_norm", "body_template_count", "body_is_common")
    summary = topics.topic_summary(full, "subject", "body", "message_id", common="subject_is_common")
    return topics.assignments(full, summary).withColumn("confidence", F.round("confidence", 6))


UNITS_SQL = """(SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v
FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings))"""


@query("silhouette", f"""WITH c AS {CENTROIDS_SQL},
a AS (SELECT vec_id, v, arg_max(topic, list_dot_product(v, centroid) / sqrt(list_dot_product(centroid, centroid))) AS own FROM {UNITS_SQL} CROSS JOIN c GROUP BY vec_id, v),
s AS (SELECT own AS topic, max(n) AS n, list(x ORDER BY i) AS total FROM (SELECT own, i, sum(x) AS x, count(*) AS n FROM
  (SELECT own, unnest(v) AS x, unnest(range(len(v))) AS i FROM a) GROUP BY ALL) GROUP BY 1),
d AS (SELECT vec_id, own, topic, n, 1 - list_dot_product(v, total) / n AS away FROM a CROSS JOIN s),
p AS (SELECT vec_id, max(CASE WHEN own = topic THEN n END) AS n, max(CASE WHEN own = topic THEN away * n / greatest(n - 1, 1) END) AS mine, min(CASE WHEN own <> topic THEN away END) AS other FROM d GROUP BY 1)
SELECT count(*) AS row_count, (SELECT count(*) FROM s) AS topics, round(avg(CASE WHEN n > 1 THEN (other - mine) / greatest(other, mine) ELSE 0 END), 6) AS silhouette FROM p""")
def _(spark, sf):
    """The silhouette of fixed centroids, by the scan that judges all models."""
    rows = table(spark, sf, "embeddings")
    centroids = topics.collect_centroids(topics.mean_centroids(rows, "label", "embedding"))
    data = durable(topics.unit_vectors(rows, "embedding").select(vector_to_array("unit").alias("v")), "vectors")
    matrix = clustering.unit(np.array([c for _, c in centroids]))
    score = clustering.silhouettes(data, {0: matrix})[0]
    members = clustering.centroid_sums(data, matrix, [len(matrix)])
    return spark.range(1).select(
        F.lit(sum(m[1] for m in members.values())).cast("bigint").alias("row_count"), F.lit(len(members)).cast("bigint").alias("topics"),
        F.lit(round(score, 6)).alias("silhouette"),
    )


@query("kmeans_members", """SELECT count(*) AS row_count, 17::BIGINT AS models, 10::BIGINT AS starts FROM embeddings""")
def _(spark, sf):
    """Every model of the search assigns every vector to one centroid."""
    data = durable(topics.unit_vectors(table(spark, sf, "embeddings"), "embedding").select(vector_to_array("unit").alias("v")), "vectors")
    ks = range(topics.K_MIN, topics.K_MAX + 1)
    fitted = clustering.fit_all(data, ks, topics.STARTS, topics.SEED, rounds=2)
    best = [min((fitted[k, s] for s in range(topics.STARTS)), key=lambda m: m.cost) for k in ks]
    ends = np.cumsum([len(m.centres) for m in best]).tolist()
    sums = clustering.centroid_sums(data, np.concatenate([m.centres for m in best]), ends)
    sizes = {sum(sums[c][1] for c in range(a, b) if c in sums) for a, b in zip([0, *ends[:-1]], ends)}
    rows = spark.createDataFrame([(int(n),) for n in sizes], "row_count bigint")
    return rows.select("row_count", F.lit(len(best)).cast("bigint").alias("models"), F.lit(len(fitted) // len(ks)).cast("bigint").alias("starts"))


@query("kmeans_silhouette")
def _(spark, sf):
    """Iterative and seeded: no SQL equivalent."""
    data = topics.unit_vectors(table(spark, sf, "embeddings"), "embedding")
    model, scores = topics.choose_k(data)
    clustered = topics.score_centroids(table(spark, sf, "embeddings"), "embedding", topics.model_centroids(model))
    per_topic = clustered.groupBy("topic").agg(F.count(F.lit(1)).alias("members"), F.round(F.avg("confidence"), 4).alias("avg_confidence"))
    return per_topic.withColumns({"k": F.lit(len(model.clusterCenters())), "silhouette": F.lit(round(max(scores.values()), 6))})


@query("stratified_split", """SELECT CAST(label AS BIGINT) AS label, CAST(round(count(*) * 0.25) AS BIGINT) AS held_out, count(*) AS row_count FROM embeddings GROUP BY 1""")
def _(spark, sf):
    split = topics.stratified(table(spark, sf, "embeddings").select("vec_id", "label"), "label", "vec_id", topics.TEST_SHARE)
    return split.groupBy(F.col("label").cast("bigint").alias("label")).agg(F.count_if("held_out").alias("held_out"), F.count(F.lit(1)).alias("row_count"))


@query("separability")
def _(spark, sf):
    """A fitted classifier: no SQL equivalent."""
    data = topics.unit_vectors(table(spark, sf, "embeddings"), "embedding", "features")
    return topics.separability(data, "features", "label", "vec_id")


@query("hashed_vectors")
def _(spark, sf):
    """Term weights over hashed tokens: no SQL equivalent."""
    rows = topics.prepare(messages(spark, sf)).select("message_id", "clean_text")
    weighted = topics.hashed_vectors(rows, "clean_text")
    return weighted.select("message_id", F.round(vectors.norm(vector_to_array("features")), 4).alias("length"))
