import pytest

from stratum.streaming.ingest import RESCUED, ingest_rescued, ingest_stream, open_stream


def run(spark, fmt, src, dst, marks, schema=None, **kw):
    ingest_stream(spark, fmt, src, dst, marks, "b1", schema, **kw).awaitTermination()
    return spark.read.parquet(dst)


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, rows):
    src, dst, marks = (str(tmp_path / n) for n in ("src", "dst", "marks"))
    spark.range(10).write.parquet(f"{src}/2023/01/a.parquet")
    first = run(spark, "parquet", src, dst, marks, "id bigint")
    assert rows(first.select("id")) == rows(spark.range(10))
    assert run(spark, "parquet", src, dst, marks, "id bigint").count() == 10
    spark.range(10, 15).write.parquet(f"{src}/2023/02/a.parquet")
    third = run(spark, "parquet", src, dst, marks, "id bigint", options={"maxFilesPerTrigger": 1})
    assert third.count() == 15 and third.filter("month = 2").count() == 5


def test_json_stream_keeps_corrupt_lines(spark, tmp_path):
    folder = tmp_path / "src" / "2023" / "01"
    folder.mkdir(parents=True)
    (folder / "t.jsonl").write_text('{"a": 1}\nbroken\n')
    out = run(spark, "json", str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "m"), "a int")
    assert sorted((r["a"] or 0, r["_corrupt_record"] or "") for r in out.collect()) == [(0, "broken"), (1, "")]


def test_csv_and_manifest_streams(spark, tmp_path):
    folder = tmp_path / "src" / "2023" / "01"
    folder.mkdir(parents=True)
    (folder / "c.csv").write_text("id,v\n1,x\n2,y\n")
    out = run(spark, "csv", str(tmp_path / "src"), str(tmp_path / "d1"), str(tmp_path / "m1"), "id int, v string")
    assert out.count() == 2 and out.filter("_batch_id = 'b1'").count() == 2
    man = run(spark, "binaryFile", str(tmp_path / "src"), str(tmp_path / "d2"), str(tmp_path / "m2"), partition=False)
    assert man.select("file_name", "length").first() == ("c.csv", 13) and "content" not in man.columns


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        open_stream(spark, "orcish", str(tmp_path))


def test_drifting_columns_are_rescued(spark, tmp_path):
    src, dst, marks = (str(tmp_path / n) for n in ("src", "dst", "marks"))
    spark.sql("SELECT 1L AS id, '7' AS v, 'x' AS only").write.parquet(f"{src}/2023/01/a.parquet")
    spark.sql("SELECT 2L AS id, 8L AS v UNION ALL SELECT 3L, NULL").write.parquet(f"{src}/2023/02/a.parquet")
    spark.sql("SELECT 4L AS id, 8.5D AS v UNION ALL SELECT 5L, 9D").write.parquet(f"{src}/2023/03/a.parquet")
    spark.sql("SELECT 6L AS id, named_struct('k', 1) AS v").write.parquet(f"{src}/2023/04/a.parquet")
    spark.sql("SELECT 'seven' AS id").write.parquet(f"{src}/2023/05/a.parquet")
    for _ in range(2):
        ingest_rescued(spark, src, dst, marks, "b1", "id bigint, v bigint", {"maxFilesPerTrigger": 1}).awaitTermination()
    got = {(r.id, r.v, r[RESCUED]) for r in spark.read.parquet(dst).collect()}
    assert got == {
        (1, 7, '{"only":"x"}'), (2, 8, None), (3, None, None), (4, None, '{"v":8.5}'), (5, 9, None), (6, None, '{"v":{"k":1}}'), (None, None, '{"id":"seven"}'),
    }
    assert spark.read.parquet(dst).count() == 7


def test_unreadable_file_fails_the_batch(spark, tmp_path):
    folder = tmp_path / "src" / "2023" / "01"
    folder.mkdir(parents=True)
    (folder / "a.parquet").write_bytes(b"PAR1 cut off")
    spark.range(3).write.parquet(str(folder / "b.parquet"))
    with pytest.raises(Exception, match="not readable"):
        ingest_rescued(spark, str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "m"), "b1", "id bigint").awaitTermination()
