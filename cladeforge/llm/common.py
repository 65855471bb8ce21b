"""What the operators of this package share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeforge.sources.scratch import fresh_path, kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder that the cluster names."""
    return kept(df)


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a compressed table in that folder, for what is large."""
    path = fresh_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """rid, doc_id, text of each row, null texts as empty ones.

    rid names a row by its content, so that null or repeated doc_ids join rightly; equal rows share it.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col("doc_id"), text).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def id_part(parts: int) -> Column:
    """crc32 of the doc_id's decimal text, modulo parts."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values on end, and the n + 1 places where values begin."""
    column = column.cast(pa.large_binary())
    begins = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[begins[0] : begins[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, begins - begins[0] if len(column) else np.zeros(1, np.int64)


def as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()
