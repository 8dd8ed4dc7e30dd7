"""Quality classifier as a sparse rule ensemble.

Statistics of each whole text are computed in one vectorised pass. A random forest over them gives tree paths; each
path is a conjunctive rule. A lasso logistic regression over the rule indicators keeps few of them, and what remains
is compiled into one Spark column expression over the statistics, so scoring needs no model object.

Inputs of a score are statistics of the text alone. Fitting uses at most ``SAMPLE`` labelled rows (the first by a hash
of the id), the rest is over all rows. Defined results: null counts as empty, an empty text has all statistics 0 and is
scored like any other; without usable labels every score is 1, with labels of one class it is that class.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import released
from .common import map_batches, settled, unused
from .words import BLANK, cut_words, text_steps

#: Labelled rows used for fitting, trees and their depth, lasso strength, and the score from which a text is good.
SAMPLE, TREES, DEPTH, LASSO, GOOD = 20_000, 24, 3, 0.0005, 0.3
STATISTICS = (
    "chars", "words", "word_bytes", "longest", "upper", "digits", "symbols", "marks", "bars", "lines", "beyond_ascii",
    "repeated", "distinct", "capital", "loud",
)
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[0x80:] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in ".,;:"]] = True
SYMBOL = ~(LETTER | DIGIT | MARK | BLANK)


def step_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per document; shares and means, and logarithms of sizes."""
    docs = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    safe = np.maximum(size, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        counted = np.concatenate([[0], np.cumsum(flags)])
        return (counted[offsets[1:]] - counted[offsets[:-1]]) / safe

    hashes, counts, first, after = cut_words(data, offsets)
    doc = np.repeat(np.arange(docs), counts)
    words = np.maximum(counts, 1)
    length = after - first
    longest = np.zeros(docs)
    if len(first):
        begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
        longest[counts > 0] = np.maximum.reduceat(length, begins[counts > 0])
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    # distinct words per document: sort by document and hash at once
    keyed = np.lexsort((hashes, doc))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[keyed][1:] != hashes[keyed][:-1]) | (doc[keyed][1:] != doc[keyed][:-1])
    distinct = np.bincount(doc[keyed][new], minlength=docs)
    starts_upper = UPPER[data[first]] if len(first) else np.zeros(0, bool)
    ends_symbol = SYMBOL[data[after - 1]] if len(first) else np.zeros(0, bool)
    return np.column_stack([
        np.log1p(size), np.log1p(counts), np.bincount(doc, length, docs) / words, np.log1p(longest),
        share(UPPER[data]), share(DIGIT[data]), share(SYMBOL[data]), share(MARK[data]), share(data == ord("|")),
        share(data == 10), share(data >= 0x80),
        np.bincount(doc, same, docs) / words, distinct / words,
        np.bincount(doc, starts_upper, docs) / words, np.bincount(doc, ends_symbol, docs) / words,
    ])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every whole text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [step_statistics(data, offsets) for _, _, data, offsets in text_steps(batch.column(1))]
        table = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in table.T)], ["doc_id", *STATISTICS])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, step, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction ``statistic <= value`` / ``statistic > value`` with its weight."""

    terms: tuple[tuple[str, str, float], ...]
    weight: float = 0.0

    def condition(self) -> Column:
        tests = [F.col(s) <= v if op == "<=" else F.col(s) > v for s, op, v in self.terms]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def __str__(self) -> str:
        return " and ".join(f"{s} {op} {v:.6g}" for s, op, v in self.terms)


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self) -> Column:
        """The logistic of the weights of the rules that hold."""
        total = F.lit(float(self.intercept))
        for rule in self.rules:
            total = total + F.when(rule.condition(), float(rule.weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_paths(text: str, names: tuple[str, ...] = STATISTICS) -> list[tuple[tuple[str, str, float], ...]]:
    """Paths from the root to every inner and leaf node of a printed tree."""
    found, path = [], []
    for line in text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [(d, t) for d, t in path if d < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
        found.append(tuple(t for _, t in path))
    return found


def fit_rules(sample: DataFrame, seed: int = 17) -> RuleModel:
    """Fit on rows with the statistics and ``label`` (0/1); the caller bounds the sample."""
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(classes) < 2:
        return RuleModel((), 30.0 if not classes or 1.0 in classes else -30.0)
    rows = sample.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("label").cast("double").alias("label")).coalesce(4)
    rows = settled(rows.select("features", "label"), "quality-sample")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(rows)
    paths = list(dict.fromkeys(p for tree in forest.trees for p in tree_paths(tree.toDebugString)))
    if not paths:
        return RuleModel((), float(np.log(classes[1.0] / classes[0.0])))
    indicators = F.array(*[F.when(Rule(p).condition(), 1.0).otherwise(0.0) for p in paths])
    tested = settled(sample.select(*STATISTICS, "label"), "quality-rules").select(array_to_vector(indicators).alias("features"), F.col("label").cast("double").alias("label"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(tested)
    weights = lasso.coefficients.toArray()
    return RuleModel(tuple(Rule(p, float(w)) for p, w in zip(paths, weights) if w), float(lasso.intercept))


def labelled_ids(labels: DataFrame, held_out: Column, limit: int = SAMPLE) -> DataFrame:
    """``labelled, label``: one label per id (the lower of several), not held out, at most ``limit`` ids by a hash."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min("quality").alias("label"))
    return settled(marks.filter(~held_out).orderBy(F.xxhash64("labelled"), "labelled").limit(limit), "quality-labels")


def training_sample(stats: DataFrame, marks: DataFrame) -> DataFrame:
    """Statistics with ``label`` of the rows that ``labelled_ids`` chose."""
    joined = stats.join(marks, F.col("doc_id") == F.col("labelled")).select(*STATISTICS, F.col("label").cast("double").alias("label"))
    return settled(joined, "quality-labelled")


def is_held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, RuleModel]:
    """``doc_id, held_out, score, predicted`` of every document, and the model fitted on ``labels``."""
    stats = settled(statistics(docs, id_col, text_col), "statistics")
    model = fit_rules(training_sample(stats, labelled_ids(labels, is_held_out("labelled"))))
    score = model.score()
    out = stats.select("doc_id", F.coalesce(is_held_out("doc_id"), F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int")), model


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier does not reject, with all their columns, null and repeated rows like any other.

    Fitting takes statistics of the labelled sample only; all other texts are looked at once, in the pass that filters.
    """
    with released(docs.sparkSession):
        marks = labelled_ids(labels, is_held_out("labelled"))
        sample = docs.join(marks, F.col("doc_id").cast("long") == F.col("labelled"), "left_semi")
        model = fit_rules(training_sample(statistics(sample), marks))
    named = {s: unused(docs, f"statistic_{s}") for s in STATISTICS}
    step_names = list(named.values())
    columns = docs.columns

    def with_statistics(batches):
        for batch in batches:
            texts = batch.column(columns.index("text"))
            rows = [step_statistics(data, offsets) for _, _, data, offsets in text_steps(texts)]
            table = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in table.T)], [*columns, *step_names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    wide = docs.mapInArrow(with_statistics, schema + ", " + ", ".join(f"`{n}` double" for n in step_names))
    renamed = RuleModel(tuple(Rule(tuple((named[s], op, v) for s, op, v in r.terms), r.weight) for r in model.rules), model.intercept)
    return wide.filter(renamed.score() >= GOOD).select(*columns)
