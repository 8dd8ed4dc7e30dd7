import hashlib
import zlib
from collections import Counter, defaultdict

from stratum.llm.exact_dedup import DigestIndex, digests, exact_dedup, keep_largest
from stratum.llm.sharding import lpt, lpt_shards


def lower(text):
    return (text or "").encode().lower()


def test_exact_dedup_equals_grouping(awkward, awkward_rows):
    groups = defaultdict(list)
    for r in awkward_rows:
        groups[hashlib.sha256(lower(r[1])).hexdigest()].append(r[0])
    want = Counter()
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, digest) for i in ids)
    assert Counter(tuple(r) for r in exact_dedup(awkward).collect()) == want


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup(nothing).count() == 0
    assert keep_largest(nothing).columns == nothing.columns


def test_keep_largest_keeps_columns_and_rows(awkward):
    out = keep_largest(awkward)
    assert out.columns == awkward.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert 2 in ids and 1 not in ids and 7 in ids and 6 not in ids


def test_index_remembers_earlier_batches(spark, make_docs):
    index = DigestIndex(spark, buckets=4)
    first = exact_dedup(make_docs([(1, "a b"), (2, "A B"), (3, "c")]), index)
    assert {(r.doc_id, r.kept) for r in first.collect()} == {(1, False), (2, True), (3, True)}
    second = exact_dedup(make_docs([(9, "C"), (10, "d")]), index)
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(9, 3, False), (10, 10, True)}
    assert index.table().count() == 3
    again = DigestIndex(spark, index.name, index.path, 4)
    assert again.unseen(digests(make_docs([(11, "a B"), (12, "new")]))).count() == 1


def test_index_side_of_the_anti_join_is_not_shuffled(spark, make_docs):
    index = DigestIndex(spark, buckets=4)
    index.ingest(digests(make_docs([(1, "a")])))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        groups = digests(make_docs([(2, "b")])).groupBy("digest").count()
        plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") <= 1


def test_lpt_is_greedy_by_size():
    assert lpt([(1, 7), (2, 6), (3, 5), (4, 4), (5, 3)], 2) == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}
    loads = defaultdict(int)
    sizes = {i: s for i, s in enumerate([9, 8, 7, 6, 5, 4, 3, 2, 1])}
    for item, shard in lpt(list(sizes.items()), 3).items():
        loads[shard] += sizes[item]
    assert max(loads.values()) - min(loads.values()) <= 2


def check_shards(rows, source, shards):
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[r.group_key].add(r.shard)
        assert 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in source)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_shards_hold_groups_and_number_slots(awkward, awkward_rows):
    check_shards(lpt_shards(awkward, 5).collect(), [r[:2] for r in awkward_rows], 5)


def test_shards_are_even_and_split_hot_numbering(make_docs, prose):
    texts = [(i, prose(i, 20 + i % 30)) for i in range(400)] + [(1000 + i, "copy " * 3) for i in range(200)]
    rows = lpt_shards(make_docs(texts), 4, fineness=20).collect()
    check_shards(rows, texts, 4)
    loads = defaultdict(int)
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.1 * min(loads.values())


def test_shards_of_nothing(nothing):
    assert lpt_shards(nothing, 3).count() == 0
