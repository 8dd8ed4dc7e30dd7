"""Spherical K-Means of all K at once, and its silhouette, against plain numpy."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stratum.plans import clustering, topics


def unit_rows(n=400, dims=6, groups=5, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return clustering.unit(centres[rng.integers(groups, size=n)] + rng.normal(scale=0.35, size=(n, dims)))


@pytest.fixture(scope="module")
def rows():
    return unit_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(r.tolist(),) for r in rows], "v array<double>").repartition(5)


def lloyd(rows, centres, rounds=clustering.ROUNDS):
    """One model on its own."""
    for turn in range(rounds + 1):
        cosines = rows @ centres.T
        own = cosines.argmax(1)
        cost = (1 - cosines[np.arange(len(rows)), own]).sum()
        new = np.array([clustering.unit(rows[own == c].sum(0)) if (own == c).any() else centres[c] for c in range(len(centres))])
        if turn == rounds or np.abs(new - centres).max() < clustering.TOLERANCE:
            return centres, cost, own
        centres = new


def test_all_models_equal_single_fits(spark, frame, rows, monkeypatch):
    scans = []
    real = clustering.centroid_sums
    monkeypatch.setattr(clustering, "centroid_sums", lambda *a: (scans.append(1), real(*a))[1])
    fitted = clustering.fit_all(frame, range(2, 8), 3, 7)
    assert len(fitted) == 18 and len(scans) <= clustering.ROUNDS + 1
    sample = np.array([r[0] for r in frame.orderBy(F.xxhash64("v"), "v").limit(clustering.INIT_ROWS).collect()])
    for (k, s), model in fitted.items():
        centres, cost, own = lloyd(rows, clustering.first_centroids(sample, k, np.random.default_rng([7, k, s])))
        assert model.cost == pytest.approx(cost, rel=1e-9)
        assert ((rows @ model.centres.T).argmax(1) == own).all()


def test_silhouette_equals_sparks_and_brute_force(spark, frame, rows):
    models = {k: m.centres for (k, _), m in clustering.fit_all(frame, [2, 5, 9], 1, 3).items()}
    got = clustering.silhouettes(frame, models)
    for k, centres in models.items():
        own = (rows @ centres.T).argmax(1)
        labelled = spark.createDataFrame([(r.tolist(), int(o)) for r, o in zip(rows, own)], "v array<double>, topic int")
        judge = ClusteringEvaluator(featuresCol="f", predictionCol="topic", distanceMeasure="cosine")
        assert got[k] == pytest.approx(judge.evaluate(labelled.select(array_to_vector("v").alias("f"), "topic")), abs=1e-9)
        away = 1 - rows @ rows.T
        values = []
        for i in range(len(rows)):
            mine = (own == own[i]) & (np.arange(len(rows)) != i)
            others = [away[i, own == c].mean() for c in set(own) - {own[i]}]
            values.append(0 if not mine.any() else (min(others) - away[i, mine].mean()) / max(min(others), away[i, mine].mean()))
        assert got[k] == pytest.approx(np.mean(values), abs=1e-9)


def test_awkward_inputs(spark):
    same = spark.createDataFrame([([1.0, 0.0],)] * 6 + [([0.0, 1.0],)], "v array<double>")
    fitted = clustering.fit_all(same, [2, 4], 2, 1)
    assert all(np.isfinite(m.centres).all() for m in fitted.values()) and fitted[2, 0].cost == pytest.approx(0, abs=1e-9)
    score = clustering.silhouettes(same, {2: fitted[2, 0].centres})[2]
    assert score == pytest.approx(6 / 7)  # the row alone in its cluster counts 0


def test_choose_k_finds_the_groups(spark):
    rows = unit_rows(300, 12, 5, 3)
    df = topics.unit_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, e array<double>"), "e")
    model, scores = topics.choose_k(df, k_min=2, k_max=8, starts=4)
    assert len(model.clusterCenters()) == 5 == max(scores, key=scores.get) and set(scores) == set(range(2, 9))
    few = topics.unit_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows[:5])], "id long, e array<double>"), "e")
    assert max(topics.choose_k(few, starts=2)[1]) == 4


def test_classify_names_topics(spark, rows):
    centroids = [(0, [1.0, 0.0]), (3, [0.0, 1.0])]
    summary = spark.createDataFrame([(0, "cards", "card lost")], "topic long, topic_label string, request_summary string")
    new = spark.createDataFrame([("a", [2.0, 0.1]), ("b", [0.0, 5.0]), ("c", [1.0, 1.0])], "id string, e array<double>")
    got = {r["id"]: r for r in topics.classify(new, "e", centroids, summary, 0.9).collect()}
    assert (got["a"]["topic_label"], got["a"]["request_summary"], got["a"]["needs_review"]) == ("cards", "card lost", False)
    assert (got["b"]["topic"], got["b"]["topic_label"], got["b"]["request_summary"]) == (3, "", "") and got["c"]["needs_review"]
