"""Merkle manifest, centroid clustering and source mixing against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm.clusters import cluster_vectors, nearest
from stratum.llm.lines import in_line
from stratum.llm.merkle import dataset_manifest, merkle_proofs
from stratum.llm.mixing import mixed_documents, mixture, reversed_bits


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# places


def test_places_and_sums_in_a_hot_group(spark):
    data = [("hot" if i % 3 else None if i % 2 else "cold", (i * 7919) % 1000, i % 5) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, o long, w long").withColumn("id", F.monotonically_increasing_id())
    got = in_line(df, ["g"], ["o", "id"], "test", weight="w").collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.g].append(r)
    assert {k: len(v) for k, v in groups.items()} == Counter(x[0] for x in data)
    for rows in groups.values():
        rows.sort(key=lambda r: (r.o, r.id))
        assert [r.place for r in rows] == list(range(len(rows)))
        assert {r.members for r in rows} == {len(rows)} and {r.total for r in rows} == {sum(r.w for r in rows)}
        assert [r.before for r in rows] == [sum(r.w for r in rows[:k]) for k in range(len(rows))]


# Merkle manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root and, per leaf, the list of (left, right) up to it."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for k, place in enumerate(at):
            run, slot = runs[place // 8], place % 8
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = place // 8
        level = [sha("".join(run)) for run in runs]
    return (level[0] if level else None), paths


def manifest_of(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r[0], r[1], r[2], r[3], r[4]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops, paths = [], []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        top, path = tree([x[2] for x in by_lang[lang]])
        tops.append(top)
        paths.append(path)
    root, upper = tree(tops)
    out = Counter()
    for lang, top, path, up in zip(langs, tops, paths, upper):
        for (_, _, leaf, r), own in zip(by_lang[lang], path):
            changed = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low = None if r[1] is None else r[1].encode().lower().decode()
                changed = leaf_of(r[0], low, r[2], r[3], r[4])
            for left, right in own + up:
                changed = sha(left + changed + right)
            proof = sha("".join(a + b for a, b in own + up))
            out[(r[0], leaf, top, root, proof, changed, changed == root)] += 1
    return out


@pytest.mark.parametrize("copies", [1, 40])
def test_manifest_equals_plain_trees(spark, awkward_rows, copies):
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in awkward_rows]
    rows += [(100 + i, f"Text {i}", [None, "de", "en", "é"][i % 4], None if i % 5 else "s", i) for i in range(copies * 10)]
    rows += [(900, "Lone", "zz", "s", 4), (901, None, "", None, None), (901, "same Id", "en", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("tree", F.lit(1))
    got = dataset_manifest(df.withColumn("place", F.lit("x")).repartition(5)).collect()
    want = manifest_of(rows)
    assert Counter(tuple(r) for r in got) == want
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_nothing_and_of_one(nothing, make_docs):
    assert dataset_manifest(nothing).count() == 0
    one = dataset_manifest(make_docs([(4, "only")])).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == sha("")


def test_path_lists_siblings(spark):
    leaves = spark.createDataFrame([(k, "t", sha(str(k))) for k in range(20)], "rank long, tree string, leaf string")
    got = {r["rank"]: r for r in merkle_proofs(leaves, ["rank"], fanout=4).collect()}
    assert [len(got[k].path) for k in (0, 19)] == [3, 3] and got[19].place == 19
    assert len(got[0].path[0].right) == 3 * 64 and len(got[17].path[0].left) == 64


# centroid clustering


def brute_clusters(rows, clusters=8, rounds=10, dims=64):
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    start = sorted(kept, key=lambda r: (sha("3:" + ("" if r[0] is None else str(r[0]))), r[1]))[:clusters]
    centroids = [list(v) for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    inertia = Counter()
    for d, k in found:
        inertia[k] += d
    return Counter(
        (i, k, d, inertia[k], sum(inertia.values()), sha(",".join(map(str, centroids[k])))) for (i, _), (d, k) in zip(kept, found)
    )


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, vector string")


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(i % 5, 1, 64).tolist()) for i in range(300)]
    rows += [(i, [0.25] * 64) for i in range(300, 340)] + [(7, rows[7][1]), (None, [0.5] * 64)]
    rows += [(400, None), (401, [1.0] * 63), (402, []), (403, [1.0] * 65), (404, [None] + [1.0] * 63), (405, [float("nan")] * 64)]
    rows += [(406, [float("inf")] + [0.0] * 63), (407, [-float("inf")] + [0.0] * 63), (408, [-0.0004] * 64), (409, [1e6] + [-1e6] * 3 + [0.0] * 60)]
    got = Counter(tuple(r) for r in cluster_vectors(vectors(spark, rows).repartition(4)).collect())
    assert got == brute_clusters(rows)


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0] * 64), (2, [1.0] * 64), (3, [2.0] * 64)]
    assert Counter(tuple(r) for r in cluster_vectors(vectors(spark, rows)).collect()) == brute_clusters(rows)
    none = cluster_vectors(vectors(spark, [(1, None)]))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_vectors_beyond_a_long(spark):
    rows = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)] + [(k, [float(k)] * 64) for k in range(4, 14)]
    got = cluster_vectors(vectors(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.distance <= r.inertia for r in got)


@pytest.mark.parametrize("large", [1, 1 << 20])
def test_threshold_walk_finds_the_nearest(large):
    rng = np.random.default_rng(11)
    points, centres = rng.integers(-40, 40, (400, 6)) * large * 64, rng.integers(-40, 40, (17, 6)) * large * 64
    centres[5] = centres[3]
    number, distance = nearest(points, centres)
    exact = ((points[:, None, :].astype(object) - centres[None].astype(object)) ** 2).sum(2)
    assert [int(x) for x in distance] == exact.min(1).tolist()
    assert number.tolist() == [row.tolist().index(min(row)) for row in exact]


# mixing


def word_count(text):
    return len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])


def targets_of(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, target = sum(sizes.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            free.remove(s)
            left -= 3 * sizes[s]


@pytest.fixture(scope="module")
def mixed_rows(awkward_rows, prose):
    rows = [(r[0], r[1], r[3]) for r in awkward_rows]
    rows += [(1000 + k, prose(k, 5 + k % 90), ["a", "b", None, "é", "tiny", "big"][min(k % 7, 5)]) for k in range(400) if k % 7 != 4]
    rows += [(5000, "just three words", "tiny"), (5001, "x", ""), (5002, " ", "blank")]
    return rows


def test_mix_meets_its_targets(spark, mixed_rows):
    df = spark.createDataFrame(mixed_rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("slot", F.lit(1))
    got = mixed_documents(df.repartition(6)).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, word_count(t)) for i, t, _ in mixed_rows)
    sizes, taken = Counter(), Counter()
    source = {i: s for i, _, s in mixed_rows}
    for r in got:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    want = targets_of(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12, abs_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    again = mixed_documents(df.repartition(2, "source")).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


def test_mix_blocks_cover_the_repeated_line(spark, mixed_rows):
    df = spark.createDataFrame(mixed_rows, "doc_id long, text string, source string")
    rows, targets, mix = mixture(df, block_words=16)
    size = {r.row: r["size"] for r in rows.collect()}
    pieces = mix.collect()
    assert all(p.words > 0 and p.first_word >= 0 and p.first_word + p.words <= size[p.row] for p in pieces)
    covered = Counter()
    for p in pieces:
        covered.update((p.row, p.epoch, w) for w in range(p.first_word, p.first_word + p.words))
    assert set(covered.values()) == {1}
    goals = {r.source_key: r.goal for r in targets.collect()}
    # stretches of the schedule hold the sources in proportion
    slots = sorted({(p.slot, p.source_key) for p in pieces})
    half = Counter(s for _, s in slots[:len(slots) // 2])
    for s, goal in goals.items():
        if goal > 200:
            assert abs(half[s] / (len(slots) // 2) - goal / sum(goals.values())) < 0.03
    words = Counter()
    for p in pieces:
        words[(p.source_key, p.rank)] += p.words
    for s in goals:
        lengths = {n for (key, _), n in words.items() if key == s}
        assert not lengths or max(lengths) - min(lengths) <= 1


def test_mix_of_nothing(nothing, make_docs):
    assert mixed_documents(nothing).count() == 0
    got = mixed_documents(make_docs([(1, None), (2, " ")])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_mix_runs_no_python(spark, make_docs):
    plan = mixed_documents(make_docs([(1, "a b"), (2, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_reversed_bits(spark):
    got = spark.range(1 << 10).select("id", reversed_bits(F.col("id"), 10).alias("r"), reversed_bits(F.col("id") * 12345678901, 62).alias("w")).collect()
    assert all(r.r == int(f"{r.id:010b}"[::-1], 2) and r.w == int(f"{r.id * 12345678901:062b}"[::-1], 2) for r in got)
