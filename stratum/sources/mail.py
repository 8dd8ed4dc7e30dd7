"""E-mail files: MIME parsing runs inside the scan tasks, nothing is gathered on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import file_name

MESSAGE_SCHEMA = "path string, subject string, body string, parse_error string"


def _parse(batches):
    from email import message_from_bytes, policy
    from email.errors import MessageError

    def one(path: str, content: bytes) -> tuple:
        try:
            message = message_from_bytes(content, policy=policy.default)
            part = message.get_body(preferencelist=("plain", "html"))
            return path, str(message["subject"] or ""), part.get_content() if part else "", None
        except (ValueError, LookupError, TypeError, AttributeError, MessageError) as error:
            # what a broken message makes the parser raise: the row is kept and reported, other errors fail the task
            return path, None, None, type(error).__name__

    for batch in batches:
        rows = [one(p, c) for p, c in zip(batch["path"], batch["content"])]
        yield pd.DataFrame(rows, columns=["path", "subject", "body", "parse_error"])


def parse_messages(files: DataFrame) -> DataFrame:
    """message_id, subject and body (plain text first, then HTML) of ``path``/``content`` rows."""
    parsed = files.select("path", "content").mapInPandas(_parse, MESSAGE_SCHEMA)
    return parsed.select(file_name("path").alias("message_id"), "subject", "body", "parse_error")


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    """All ``*.eml`` files below ``root``; twins in other formats are left out by the glob filter."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", True).load(root)
    )
    return parse_messages(files.select("path", F.col("content")))
