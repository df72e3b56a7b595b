"""Readers for the star-schema parquet tables and generic file scans."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.operators.schema import quoted


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan (SRC-2); Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(table_path(sf_dir, name))


def as_utc_timestamps(df: DataFrame) -> DataFrame:
    """Turn ``timestamp_ntz`` columns into session-zone ``timestamp``.

    The driver tables store wall-clock times without zone; watermarks and the
    stored aggregates need ``timestamp`` (session zone is UTC).
    """
    cols = [
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    **options,
) -> DataFrame:
    """CSV scan with a header (SRC-1).

    An explicit schema is the default path; inference costs an extra full pass
    over the input and is only done when asked for.
    """
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_tagged(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, corrupt: str = CORRUPT, **options
) -> DataFrame:
    """CSV scan with every line kept: its fields, ``status`` (``ok`` or ``quarantine``) and ``raw`` for a bad line.

    A line is bad if it has fewer or more fields than ``schema``, or one that
    doesn't read as its type (SRC-1, SRC-7).  Good and bad lines add up to the
    lines that aren't blank.  ``corrupt`` must not be a column of the file.
    """
    if corrupt in schema.fieldNames():
        raise ValueError(f"{corrupt} is a column of the file; name another")
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    reader = reader.option("columnPruning", False)
    rows = reader.options(**options).schema(wide).csv(path)
    bad = F.col(quoted(corrupt))
    # not a plain null test: pushed down to the parser, it would lose bad lines
    good = F.coalesce(F.length(bad), F.lit(-1)) < 0
    fields = [F.when(good, F.col(quoted(f.name))).alias(f.name) for f in schema.fields]
    # the parser only checks columns that are asked for, so the status asks for all of them (and adds nothing)
    all_fields = F.xxhash64(*[F.col(quoted(f.name)) for f in schema.fields]).cast("string")
    status = F.concat(F.when(good, "ok").otherwise("quarantine"), F.substring(all_fields, 1, 0))
    return rows.select(*fields, status.alias("status"), F.when(status != "ok", bad).alias("raw"))
