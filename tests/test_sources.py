import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratum.session import work_root
from stratum.sources import files, mail, reconciled, tables


def put(root, path, content):
    p = root / path
    p.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, pa.Table):
        pq.write_table(content, p)
    else:
        p.write_bytes(content)
    return str(p)


@pytest.fixture()
def tree(tmp_path):
    """A landing tree with every kind of bad file."""
    put(tmp_path, "2023/01/loans_2023_01.parquet", pa.table({"id": [1, 2], "amt": pa.array([1, 2], pa.int64())}))
    put(tmp_path, "2023/02/loans_2023_02.parquet", pa.table({"id": [3], "amt": ["9.5"], "extra": [True]}))
    put(tmp_path, "2023/03/loans_2023_03.parquet", pa.table({}))
    good = put(tmp_path, "2023/04/loans_2023_04.parquet", pa.table({"id": [4]}))
    put(tmp_path, "2023/05/loans_2023_05.parquet", open(good, "rb").read()[:40])
    put(tmp_path, "2023/06/loans_2023_06.parquet", b"version https://example\noid sha256:0\n")
    put(tmp_path, "2023/07/cards_2023_07.parquet", pa.table({"id": pa.array([], pa.int64())}))
    put(tmp_path, "2023/01/emails/a.eml", b"Subject: Hi\nContent-Type: text/plain; charset=utf-8\n\nbody \xc3\xa9\n")
    put(tmp_path, "2023/01/emails/b.eml", b"Subject: H\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary=x\n\n--x\nContent-Type: text/html\n\n<p>h</p>\n--x\nContent-Type: text/plain\n\nplain\n--x--\n")
    put(tmp_path, "2023/01/emails/c.eml", b"\n")
    put(tmp_path, "2023/01/emails/a.pdf", b"%PDF")
    return tmp_path


def test_reconciled_read(spark, tree, rows):
    listing = files.list_files(spark, str(tree), "loans*.parquet")
    df, conflicts, skipped = reconciled.read_reconciled(spark, listing, "loans*.parquet")
    assert conflicts == ["amt"]
    assert sorted((r["path"][-10:-8], r["verdict"].split(":")[0]) for r in skipped.collect()) == [("03", "empty_shell"), ("05", "unreadable"), ("06", "pointer")]
    got = rows(reconciled.with_period(df).select("id", "amt", "extra", "year", "month"))
    assert got == [(1, "1", None, "2023", "01"), (2, "2", None, "2023", "01"), (3, "9.5", True, "2023", "02"), (4, None, None, "2023", "04")]


def test_reconciled_read_needs_one_file(spark, tree):
    listing = files.list_files(spark, str(tree), "loans_2023_03.parquet")
    with pytest.raises(ValueError):
        reconciled.read_reconciled(spark, listing)


def test_probe_and_gaps(spark, tree):
    probed = reconciled.probe_files(files.list_files(spark, str(tree), "*.parquet"))
    verdicts = {r["path"][-15:-8]: r["verdict"] for r in probed.collect()}
    assert verdicts["2023_01"] == "ok" and verdicts["2023_03"] == "empty_shell" and verdicts["2023_06"] == "pointer"
    assert verdicts["2023_05"].startswith("unreadable")
    grid = reconciled.expected_grid(spark, ["loans", "cards"], "2023-01-01", "2023-08-01")
    gaps = {(r["entity"], r["month"]): (r["finding"].split(":")[0], r["resolution"]) for r in reconciled.gap_manifest(grid, probed).collect()}
    assert len(gaps) == 16
    assert gaps["loans", "01"] == ("present", "none") and gaps["loans", "08"] == ("missing", "request_from_source")
    assert gaps["loans", "05"] == ("unreadable", "fetch_again") and gaps["cards", "07"] == ("no_rows", "request_from_source")


def test_discovery(spark, tree, rows):
    assert rows(files.discover_entities(files.list_files(spark, str(tree)))) == [("cards", 1), ("loans", 6)]


def test_manifest_reads_no_bytes(spark, tree):
    df = files.build_manifest(spark, str(tree), "*.pdf", "pdf", "b1")
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()
    r = df.first()
    assert (r["file_name"], r["year"], r["month"], r["file_type"], r["length"]) == ("a.pdf", "2023", "01", "pdf", 4)


def test_changed_files(spark, tree):
    first = files.list_files(spark, str(tree), "*.eml").collect()
    last = spark.createDataFrame(first)
    assert files.changed_files(files.list_files(spark, str(tree), "*.eml"), last).isEmpty()
    put(tree, "2023/02/emails/new.eml", b"Subject: n\n\nx")
    (tree / "2023/01/emails/b.eml").unlink()
    put(tree, "2023/01/emails/c.eml", b"longer now")
    now = files.list_files(spark, str(tree), "*.eml")
    assert files.changed_files(now, last).count() == 2
    got = {r["path"].rsplit("/", 1)[1]: r["change"] for r in files.changed_files(now, last, deletions=True).collect()}
    assert got == {"new.eml": "added", "c.eml": "modified", "b.eml": "deleted"}
    assert files.changed_files(now, now, deletions=True).isEmpty()


def test_listing_in_rounds(spark, tmp_path, rows):
    """Few entries per task: the folders that are left go to the next round; zero bytes and hidden names are there."""
    want = set()
    for y in range(3):
        for m in range(4):
            for k in range(3):
                want.add(put(tmp_path, f"{y}/{m}/deep/{k}.bin", b"x" * k))
    want.add(put(tmp_path, "_odd/.hidden.bin", b""))
    put(tmp_path, "0/_SUCCESS", b"")
    put(tmp_path, "0/.x.bin.crc", b"1")
    for most in (1, 5, 1000):
        got = {r["path"].removeprefix("file:"): r["length"] for r in files.list_files(spark, str(tmp_path), "*", most).collect()}
        assert set(got) == want and sorted(got.values()) == sorted(len(open(w, "rb").read()) for w in want)
    single = next(iter(want))
    assert files.list_files(spark, [single], "*.bin").count() == 1
    with pytest.raises(Exception, match="FileNotFound"):
        files.list_files(spark, str(tmp_path / "none"))


def test_no_file_reaches_the_driver(spark, tree, monkeypatch):
    """The driver fetches one sample per schema and whole folders; listings and skipped files stay in tables."""
    for k in range(40):
        put(tree, f"2024/01/loans_2024_01.parquet/part-{k:03d}.parquet", pa.table({"id": [k]}))
    fetched = []
    frame = type(spark.range(1))
    for name in ("collect", "toLocalIterator", "toPandas"):
        real = getattr(frame, name)

        def spy(self, *args, real=real, **kwargs):
            out = list(real(self, *args, **kwargs))
            fetched.append(len(out))
            return iter(out) if real.__name__ == "toLocalIterator" else out

        monkeypatch.setattr(frame, name, spy)
    df, _, skipped = reconciled.read_reconciled(spark, files.list_files(spark, str(tree / "2024"), "*.parquet"), "*.parquet")
    assert sum(fetched) == 2 and df.count() == 40 and skipped.isEmpty()


def test_folders_of_one_schema_are_read_whole(spark, tree):
    probed = reconciled.probe_files(files.list_files(spark, str(tree), "*.parquet"))
    places = {r["place"].split("/2023/")[1] for r in reconciled.schema_groups(probed).collect()}
    assert places == {"01", "02", "04", "07"}
    put(tree, "2023/04/loans_b_2023_04.parquet", b"")
    probed = reconciled.probe_files(files.list_files(spark, str(tree), "*.parquet"))
    assert {r["place"].split("/2023/")[1] for r in reconciled.schema_groups(probed).collect()} == {"01", "02", "04/loans_2023_04.parquet", "07"}


def test_mail(spark, tree):
    got = {r["message_id"]: r for r in mail.read_messages(spark, str(tree)).collect()}
    assert set(got) == {"a.eml", "b.eml", "c.eml"}
    assert got["a.eml"]["body"].strip() == "body é" and got["b.eml"]["body"].strip() == "plain"
    assert got["c.eml"]["subject"] == "" and all(r["parse_error"] is None for r in got.values())


def test_jsonl_csv_control(spark, tmp_path):
    put(tmp_path, "2023/01/transactions.jsonl", b'{"a": 1, "s": {"x": "q"}}\nnot json\n{"a": 2}\n')
    df = files.read_jsonl(spark, str(tmp_path), "a int, s struct<x: string>").cache()
    assert sorted((r["a"] or 0, r["_corrupt_record"] or "") for r in df.collect()) == [(0, "not json"), (1, ""), (2, "")]
    flat = files.read_flat_jsonl(spark, str(tmp_path), "a int, s struct<x: string>", {"a": "a", "x": "s.x"}, {"t": "D"})
    assert flat.columns == ["a", "x", "t", "_source_file"] and flat.filter("x = 'q' AND t = 'D'").count() == 1
    put(tmp_path, "csv/2023/01/mkt/campaigns.csv", b"id,d\n1,2020-01-01\nx,\n")
    assert files.read_csv(spark, str(tmp_path / "csv"), "id int, d date").filter("id IS NULL").count() == 1
    groups = files.discover_groups(files.list_files(spark, str(tmp_path / "csv"), "*.csv"))
    assert groups.first()["table_name"] == "mkt_campaigns"
    put(tmp_path, "control.json", b'{\n "next": 5\n}')
    assert files.read_control_json(spark, str(tmp_path / "control.json")).first()["next"] == 5


def test_bronze_meta(spark, tmp_path):
    put(tmp_path, "2023/04/a.parquet", pa.table({"id": [1]}))
    put(tmp_path, "other/b.parquet", pa.table({"id": [2]}))
    df = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path))
    got = {r["id"]: r for r in files.with_bronze_meta(df, "b1", "sha").collect()}
    assert (got[1]["year"], got[1]["month"], got[1]["_batch_id"], got[1]["_commit_sha"]) == ("2023", "04", "b1", "sha")
    assert (got[2]["year"], got[2]["month"]) == ("", "")


def test_merge_table(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, created int")
    b = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, created int")
    assert tables.merge_table(a, root, ["k"], "b1")["inserted"] == 2
    assert tables.merge_table(b, root, ["k"], "b2", preserve=["created"]) == {"inserted": 1, "updated": 1, "untouched": 1}
    assert rows(tables.current_snapshot(spark, root).select("k", "v", "created")) == [(1, "a", 1), (2, "c", 1), (3, "d", 2)]
    assert tables.merge_table(b, root, ["k"], "b3", preserve=["created"]) == {"inserted": 0, "updated": 2, "untouched": 1}
    with pytest.raises(ValueError):
        tables.publish(a, root, "b3")
    with pytest.raises(ValueError):
        tables.merge_table(a.unionByName(a), root, ["k"], "b4")
    # a snapshot without a log row (a job that died) is not visible and its batch can run again
    a.write.parquet(f"{root}/batch=b5")
    assert tables.current_path(spark, root).endswith("b3")
    tables.publish(a, root, "b5")
    assert tables.current_path(spark, root).endswith("b5")


def test_create_once(spark, tmp_path):
    df = spark.range(3)
    tables.create_once(df, str(tmp_path / "x"))
    with pytest.raises(Exception):
        tables.create_once(df, str(tmp_path / "x"))


def test_work_root_follows_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") == work_root(spark) if spark.conf.get("spark.checkpoint.dir", None) else work_root(spark)


def test_write_bronze_partitions(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("2023").alias("year"), F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0").alias("month"))
    tables.write_bronze(df, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == 100 and back.select("month").distinct().count() == 3
