"""File sources, sinks and streams on files that Spark writes from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import durable, fresh_path
from ..sources import files, mail, reconciled, tables
from ..streaming.ingest import RESCUED, ingest_rescued, ingest_stream
from .registry import ORACLES, documents, query, table

def landing(spark, sf, kind: str) -> str:
    """Orders as a landing tree ``<root>/<yyyy>/01/<name>/``, one folder of several files per year that the orders have, with
    schema drift for Parquet: until 1997 ``o_custkey`` is text, from 2000 on ``o_orderpriority`` is missing.

    Each kind of rows is written once, partitioned by year; the year folders then get their landing names.
    """
    root, orders = fresh_path(spark, "landing"), table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    if kind == "parquet":
        early = orders.filter("y <= 1997").withColumn("o_custkey", F.col("o_custkey").cast("string"))
        drifts = [early, orders.filter("y BETWEEN 1998 AND 1999"), orders.filter("y >= 2000").drop("o_orderpriority")]
        name, save = "orders_{}_01.parquet", "parquet"
    elif kind == "json":
        meta = F.struct("o_orderstatus", "o_orderpriority").alias("meta")
        good = orders.select(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", meta)).alias("value"), "y", "o_orderkey")
        broken = orders.filter("o_orderstatus = 'P'").select(F.lit("{broken").alias("value"), "y", "o_orderkey")
        drifts, name, save = [good.unionByName(broken)], "transactions.jsonl", "text"
    elif kind == "text":
        drifts, name, save = [orders.select(F.col("o_orderkey").cast("string").alias("value"), "y", "o_orderkey")], "keys", "text"
    else:
        drifts = [orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "y")]
        name, save = "complaints/complaints.csv", "csv"
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    for n, rows in enumerate(drifts):
        stage = f"{root}-stage-{n}"
        dealt = rows.repartition("y", F.pmod("o_orderkey", F.lit(4)))
        if save == "text":
            dealt = dealt.drop("o_orderkey")
        dealt.write.partitionBy("y").option("header", True).format(save).save(stage)
        fs = hadoop.Path(stage).getFileSystem(conf)
        for status in fs.globStatus(hadoop.Path(f"{stage}/y=*")):
            year = status.getPath().getName().removeprefix("y=")
            place = hadoop.Path(f"{root}/{year}/01/{name.format(year)}")
            fs.mkdirs(place.getParent())
            fs.rename(status.getPath(), place)
        fs.delete(hadoop.Path(stage), True)
    return root


def folder():
    return F.regexp_replace("path", "/[^/]*$", "")


def folders_of(listing):
    """The listing with one row per folder: how many files a year has depends on the cluster."""
    return listing.select(folder().alias("path")).distinct()


@query("reconciled_read", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, CASE WHEN year(o_orderdate) < 2000 THEN o_orderpriority END AS o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS year, '01' AS month FROM orders""")
def _(spark, sf):
    root = landing(spark, sf, "parquet")
    rows, conflicts, _ = reconciled.read_reconciled(spark, files.list_files(spark, root, "*.parquet"), "*.parquet")
    assert conflicts == ["o_custkey"], conflicts
    return reconciled.with_period(rows).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "year", "month")


@query("discover_entities", "SELECT 'orders' AS entity, count(DISTINCT year(o_orderdate)) AS files FROM orders")
def _(spark, sf):
    return files.discover_entities(folders_of(files.list_files(spark, landing(spark, sf, "parquet"), "*.parquet")))


@query("discover_groups", "SELECT 'complaints' AS subfolder, 'complaints_complaints' AS table_name, count(DISTINCT year(o_orderdate)) AS files FROM orders")
def _(spark, sf):
    listing = files.list_files(spark, landing(spark, sf, "csv"), "*.csv")
    return files.discover_groups(folders_of(listing)).select("subfolder", "table_name", "files")


BYTES_SQL = "count(DISTINCT year(o_orderdate)) AS folders, CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes"


@query("manifest", f"""SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, '01' AS month, 'keys' AS file_type, {BYTES_SQL} FROM orders GROUP BY ALL""")
def _(spark, sf):
    rows = files.build_manifest(spark, landing(spark, sf, "text"), "*.txt", "keys", "b1")
    return rows.groupBy("year", "month", "file_type").agg(F.count_distinct(folder()).alias("folders"), F.sum("length").alias("bytes"))


@query("changed_files", """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, 'added' AS change FROM orders WHERE year(o_orderdate) >= 2000 GROUP BY ALL
UNION ALL SELECT CAST(min(year(o_orderdate)) AS VARCHAR), 'deleted' FROM orders UNION ALL SELECT CAST(min(year(o_orderdate)) + 1 AS VARCHAR), 'modified' FROM orders""")
def _(spark, sf):
    """The last manifest lacks the years from 2000; since then the first year was deleted and the second one written anew."""
    root = landing(spark, sf, "parquet")
    known = ["path", "length", "modificationTime"]
    then = durable(files.build_manifest(spark, root, "*.parquet", "orders", "b1").filter("year < '2000'").select(*known), "manifest")
    first = table(spark, sf, "orders").agg(F.min(F.year("o_orderdate"))).first()[0]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = hadoop.Path(f"{root}/{first}")
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    now = files.list_files(spark, root, "*.parquet").select(
        "path", F.when(F.col("path").contains(f"/{first + 1}/"), F.col("length") + 1).otherwise(F.col("length")).alias("length"), "modificationTime",
    )
    changes = files.changed_files(now, then, deletions=True)
    return changes.select(files.period("path")["year"].alias("year"), "change").distinct()


@query("probe_files", """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, 'ok' AS verdict, count(*) AS row_count FROM orders GROUP BY ALL""")
def _(spark, sf):
    probed = reconciled.probe_files(files.list_files(spark, landing(spark, sf, "parquet"), "*.parquet"))
    return reconciled.with_period(probed, "path").groupBy("year", "verdict").agg(F.sum("rows").alias("row_count"))


def damaged(spark, sf) -> str:
    """The landing tree with four damaged files of ``loans`` beside it: no bytes, no columns, a pointer, cut off."""
    import base64
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    root = landing(spark, sf, "parquet")
    whole, bare = io.BytesIO(), io.BytesIO()
    pq.write_table(pa.table({"id": list(range(100))}), whole)
    pq.write_table(pa.table({}), bare)
    contents = {"1995": b"", "1996": bare.getvalue(), "1997": b"version https://pointer", "1998": whole.getvalue()[:40]}
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for year, content in contents.items():
        path = fs.Path(f"{root}/{year}/01/loans_{year}_01.parquet")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(content))
        out.close()
    return root


DAMAGE_SQL = "(VALUES (1995, 'zero_bytes'), (1996, 'empty_shell'), (1997, 'pointer'), (1998, 'unreadable: ArrowInvalid')) b(y, verdict)"
#: The grid runs from the first to the last month of the orders' years (and over those with damaged files).
YEARS_SQL = "(SELECT unnest(range(least(1995, min(year(o_orderdate))), greatest(1998, max(year(o_orderdate))) + 1)) AS y FROM orders)"
GRID_SQL = f"""(SELECT t.y, m, e, CASE WHEN m = '01' AND e = 'orders' AND o.y IS NOT NULL THEN 'present' WHEN m = '01' AND e = 'loans' THEN coalesce(b.verdict, 'missing') ELSE 'missing' END AS finding
FROM YEARS t, (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS m FROM range(1, 13)), (VALUES ('orders'), ('loans')) w(e))"""
GRID_SQL = GRID_SQL.replace("FROM YEARS t,", f"FROM {YEARS_SQL} t LEFT JOIN {DAMAGE_SQL} ON b.y = t.y LEFT JOIN (SELECT DISTINCT year(o_orderdate) AS y FROM orders) o ON o.y = t.y,")


@query("probe_verdicts", f"""SELECT CAST(y AS VARCHAR) AS year, verdict, CASE WHEN verdict = 'empty_shell' THEN 0 END AS row_count FROM {DAMAGE_SQL}
UNION ALL SELECT CAST(year(o_orderdate) AS VARCHAR), 'ok', count(*) FROM orders GROUP BY ALL""")
def _(spark, sf):
    probed = reconciled.probe_files(files.list_files(spark, damaged(spark, sf), "*.parquet"))
    return reconciled.with_period(probed, "path").groupBy("year", "verdict").agg(F.sum("rows").alias("row_count"))


@query("gap_manifest", f"""SELECT concat_ws('-', e, y, m, finding) AS finding_id, concat_ws('_', e, y, m) || '.parquet' AS file_name,
CAST(CASE finding WHEN 'zero_bytes' THEN 0 WHEN 'pointer' THEN 23 WHEN 'unreadable: ArrowInvalid' THEN 40 END AS BIGINT) AS size, CAST(y AS VARCHAR) AS year, m AS month, e AS entity, finding <> 'missing' AS on_disk, finding,
CASE WHEN finding = 'present' THEN 'none' WHEN finding = 'missing' THEN 'absent_file' WHEN finding IN ('zero_bytes', 'empty_shell') THEN 'empty_file' ELSE 'broken_file' END AS gap_type,
CASE WHEN finding = 'present' THEN 'none' WHEN finding IN ('missing', 'zero_bytes', 'empty_shell') THEN 'request_from_source' ELSE 'fetch_again' END AS resolution FROM {GRID_SQL}""")
def _(spark, sf):
    probed = reconciled.probe_files(files.list_files(spark, damaged(spark, sf), "*.parquet"))
    day = F.col("o_orderdate")
    first, last = table(spark, sf, "orders").agg(F.least(F.lit(1995), F.min(F.year(day))), F.greatest(F.lit(1998), F.max(F.year(day)))).first()
    grid = reconciled.expected_grid(spark, ["orders", "loans"], f"{first}-01-01", f"{last}-12-01")
    known = F.col("finding").isin("zero_bytes", "pointer", "unreadable: ArrowInvalid")  # sizes that do not depend on a writer
    return reconciled.gap_manifest(grid, probed).withColumn("size", F.when(known, F.col("size")))


JSON_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, meta struct<o_orderstatus: string, o_orderpriority: string>"


@query("read_jsonl", """SELECT o_orderkey, o_totalprice, o_orderstatus AS status, FALSE AS is_corrupt FROM orders UNION ALL SELECT NULL, NULL, NULL, TRUE FROM orders WHERE o_orderstatus = 'P'""")
def _(spark, sf):
    rows = files.read_jsonl(spark, landing(spark, sf, "json"), JSON_SCHEMA)
    return rows.select("o_orderkey", "o_totalprice", F.col("meta.o_orderstatus").alias("status"), F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


@query("read_flat_jsonl", """SELECT o_orderkey AS account_id, o_totalprice AS amount, o_orderstatus AS branch_code, 'INITIAL_DEPOSIT' AS transaction_type FROM orders
UNION ALL SELECT NULL, NULL, NULL, 'INITIAL_DEPOSIT' FROM orders WHERE o_orderstatus = 'P'""")
def _(spark, sf):
    rows = files.read_flat_jsonl(
        spark, landing(spark, sf, "json"), JSON_SCHEMA,
        {"account_id": "o_orderkey", "amount": "o_totalprice", "branch_code": "meta.o_orderstatus"}, {"transaction_type": "INITIAL_DEPOSIT"},
    )
    return rows.drop("_source_file")


@query("read_csv", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def _(spark, sf):
    return files.read_csv(spark, landing(spark, sf, "csv"), "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")


@query("read_csv_inferred", """SELECT count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders""")
def _(spark, sf):
    rows = files.read_csv(spark, landing(spark, sf, "csv"))
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("keys"))


@query("control_json", """SELECT count(*) AS next_account FROM orders""")
def _(spark, sf):
    path = fresh_path(spark, "control")
    counter = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"))
    counter.select(F.concat(F.lit('{\n  "next_account": '), "n", F.lit("\n}"))).coalesce(1).write.text(path)
    return files.read_control_json(spark, path)


@query("bronze_table", """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS row_count, 1::BIGINT AS batches FROM orders GROUP BY ALL""")
def _(spark, sf):
    """Read the landing tree with audit columns, write it partitioned by period, read it back."""
    source = spark.read.schema("o_orderkey bigint, o_totalprice double").option("recursiveFileLookup", True).parquet(landing(spark, sf, "parquet"))
    path = fresh_path(spark, "bronze")
    tables.write_bronze(files.with_bronze_meta(source, "b1", "c0ffee"), path)
    back = tables.read_table(spark, path)
    return back.groupBy(F.col("year").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("_batch_id").alias("batches"))


@query("table_checklist", """SELECT 'orders' AS table_name, TRUE AS present, count(*) AS row_count, 'ok' AS status FROM orders UNION ALL SELECT 'ghost', FALSE, 0, 'missing' UNION ALL SELECT 'hollow', TRUE, 0, 'empty'""")
def _(spark, sf):
    hollow = fresh_path(spark, "hollow")
    tables.create_once(table(spark, sf, "orders").filter("o_orderkey < 0"), hollow)
    return tables.checklist(spark, {"orders": f"{sf}/orders.parquet", "ghost": f"{hollow}-none", "hollow": hollow})


@query("replace_table", """SELECT r_regionkey, r_name, count(*) AS nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY ALL""")
def _(spark, sf):
    """Two full replaces with different columns; the second one is what remains."""
    path = fresh_path(spark, "replaced")
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tables.replace_table(places.select("n_name", "r_name"), path)
    tables.replace_table(places.groupBy("r_regionkey", "r_name").agg(F.count(F.lit(1)).alias("nations")), path)
    return tables.read_table(spark, path)


@query("append_control", """SELECT CAST(ts AS DATE) AS day, max(ts) AS watermark_value FROM events GROUP BY 1""")
def _(spark, sf):
    path = fresh_path(spark, "log")
    marks = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.max("ts").alias("watermark_value"))
    for batch in (F.dayofmonth("day") <= 10, F.dayofmonth("day") > 10):
        tables.append(marks.filter(batch), path)
    return tables.read_table(spark, path)


@query("parse_messages", """SELECT concat(doc_id, '.eml') AS message_id, concat('Case ', doc_id) AS subject, sha256(rtrim(text, chr(10))) AS body_hash, FALSE AS failed FROM documents""")
def _(spark, sf):
    head = F.concat(
        F.lit("Subject: Case "), F.col("doc_id"),
        F.lit('\nMIME-Version: 1.0\nContent-Type: text/plain; charset="utf-8"\nContent-Transfer-Encoding: base64\n\n'),
    )
    rows = documents(spark, sf).select(
        F.concat(F.lit("/mail/"), F.col("doc_id"), F.lit(".eml")).alias("path"),
        F.encode(F.concat(head, F.base64(F.encode("text", "utf-8"))), "utf-8").alias("content"),
    )
    parsed = mail.parse_messages(rows)
    body = F.sha2(F.regexp_replace("body", r"\n+\z", ""), 256)
    return parsed.select("message_id", "subject", body.alias("body_hash"), F.col("parse_error").isNotNull().alias("failed"))


# ---- streams: two runs on one checkpoint, the second finds nothing new

def _ingest(spark, root, fmt, schema=None, options=None):
    dst, marks = fresh_path(spark, "stream"), fresh_path(spark, "marks")
    for _ in range(2):
        run = ingest_stream(spark, fmt, root, dst, marks, "b1", schema, options)
        run.awaitTermination()
    return spark.read.option("mergeSchema", False).parquet(dst)


PER_YEAR = """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL"""


def _per_year(rows):
    return rows.groupBy(F.col("year").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("keys"))


ORDER_SCHEMA = "o_orderkey bigint, o_custkey string, o_totalprice double, o_orderpriority string"


def _rescued(spark, sf):
    """All columns of the drifting orders, in two runs on one checkpoint; what the schema does not name is rescued."""
    root, dst, marks = landing(spark, sf, "parquet"), fresh_path(spark, "stream"), fresh_path(spark, "marks")
    for _ in range(2):
        ingest_rescued(spark, root, dst, marks, "b1", ORDER_SCHEMA, {"maxFilesPerTrigger": 4}).awaitTermination()
    return spark.read.parquet(dst)


@query("stream_parquet", PER_YEAR)
def _(spark, sf):
    return _per_year(_rescued(spark, sf))


@query("stream_rescue", f"""SELECT *, TRUE AS rescued FROM ({ORACLES["reconciled_read"]})""")
def _(spark, sf):
    """The rows of ``reconciled_read`` by the stream, and whether the status and date of each order are in the rescue column."""
    kept = F.get_json_object(RESCUED, "$.o_orderstatus").isNotNull() & F.get_json_object(RESCUED, "$.o_orderdate").isNotNull()
    return _rescued(spark, sf).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.col("year").cast("string").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"), kept.alias("rescued"),
    )


@query("stream_evolve", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE WHEN year(o_orderdate) < 2000 THEN o_orderpriority END AS o_orderpriority,
CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders""")
def _(spark, sf):
    """Two runs: first the years without a priority, by a schema of two columns; the others bring the column, which the log
    adds, and keys as text, which keep the log's type."""
    from ..streaming import schema_log

    root, src = landing(spark, sf, "parquet"), fresh_path(spark, "arrivals")
    dst, marks, log = (fresh_path(spark, n) for n in ("stream", "marks", "schema-log"))
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.Path(root).getFileSystem(conf)
    fs.mkdirs(hadoop.Path(src))
    for arrive in (lambda y: y >= 2000, lambda y: y < 2000):
        for status in fs.listStatus(hadoop.Path(root)):
            if arrive(int(status.getPath().getName())):
                fs.rename(status.getPath(), hadoop.Path(f"{src}/{status.getPath().getName()}"))
        schema_log.ingest_evolving(spark, src, dst, marks, log, "b1", "o_orderkey bigint, o_custkey bigint").awaitTermination()
    rows = schema_log.read_evolved(spark, dst, log)
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "year")


@query("stream_json", """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) + count(*) FILTER (WHERE o_orderstatus = 'P') AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys,
count(*) FILTER (WHERE o_orderstatus = 'P') AS corrupt FROM orders GROUP BY ALL""")
def _(spark, sf):
    rows = _ingest(spark, landing(spark, sf, "json"), "json", JSON_SCHEMA)
    return rows.groupBy(F.col("year").cast("string").alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("keys"), F.count(files.CORRUPT).alias("corrupt")
    )


@query("stream_csv", PER_YEAR)
def _(spark, sf):
    return _per_year(_ingest(spark, landing(spark, sf, "csv"), "csv", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"))


@query("stream_manifest", f"""SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, {BYTES_SQL} FROM orders GROUP BY ALL""")
def _(spark, sf):
    rows = _ingest(spark, landing(spark, sf, "text"), "binaryFile", options={"pathGlobFilter": "*.txt"})
    return rows.groupBy(F.col("year").cast("string").alias("year")).agg(F.count_distinct(folder()).alias("folders"), F.sum("length").alias("bytes"))
