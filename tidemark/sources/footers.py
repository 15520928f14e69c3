"""Maxima and row counts from Parquet footers: no column of the files is read.

Spark's V2 Parquet reader answers MAX, MIN and COUNT of whole-number columns
from file footers when the aggregate is pushed down. Both are session settings,
so the frames here belong to a session of their own (same application, same
catalog-free paths), and the caller's session keeps its readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import apply_required_conf

FOOTER_CONF = {
    "spark.sql.sources.useV1SourceList": "",  # Parquet through the V2 reader
    "spark.sql.parquet.aggregatePushdown": "true",
}
FROM_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    apply_required_conf(session)
    for key, value in FOOTER_CONF.items():
        session.conf.set(key, value)
    return session


def footer_watermark(spark: SparkSession, path: str, cursor: str, schema: T.StructType | None = None, by: str | None = None) -> DataFrame:
    """``watermark`` (MAX of the cursor) and ``n_rows``, from footers; one row, or one per value of the partition column ``by``.

    ``schema`` declares the files' columns where there may be no file yet (the
    watermark is then null): in the files' order, as Spark finds a column's
    statistics by its position. So nested columns must come after the cursor.
    Text and timestamps have no footer maxima that Spark pushes; such a cursor
    is refused, as it would be a scan.
    """
    reader = footer_session(spark).read
    files = (reader.schema(schema) if schema is not None else reader).parquet(path)
    before = files.schema.fields[: files.schema.fieldNames().index(cursor)]
    if any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) for f in before):
        raise ValueError(f"a nested column stands before {cursor}: its footer statistics cannot be found by position")
    if not isinstance(files.schema[cursor].dataType, FROM_FOOTERS):
        raise ValueError(f"{cursor} is {files.schema[cursor].dataType.simpleString()}: its maximum is not in the footers")
    asked = [F.max(cursor).alias("watermark"), F.count(F.lit(1)).alias("n_rows")]
    return files.groupBy(by).agg(*asked) if by else files.agg(*asked)
