"""Where queries publish what their SQL reads: the node tables of trained forests.

A trained forest is data, so no fixed SQL text can state its scores.  The
model queries store the forest's node table here, and their SQL scores the rows
again by walking the stored nodes.  The folder lies in the shared checkpoint folder
under a fixed name, is rewritten by each run, and outlives the session.
"""

from __future__ import annotations

import os
import re

import pyspark
from pyspark.sql import DataFrame, SparkSession

# Used only if neither a session nor the Spark defaults name a checkpoint folder.
FALLBACK = "/tmp/checkpoints"


def _shared_folder() -> str:
    spark = SparkSession.getActiveSession()
    found = spark.conf.get("spark.checkpoint.dir", None) if spark else None
    if not found:
        conf = os.path.join(os.environ.get("SPARK_CONF_DIR") or os.path.join(os.path.dirname(pyspark.__file__), "conf"), "spark-defaults.conf")
        text = open(conf).read() if os.path.exists(conf) else ""
        named = re.search(r"^\s*spark\.checkpoint\.dir[\s=]+(\S+)", text, re.M)
        found = named.group(1) if named else FALLBACK
    return found.rstrip("/")


def folder(name: str) -> str:
    return f"{_shared_folder()}/shiplens-published/{name}"


def publish(df: DataFrame, name: str) -> None:
    """Replace the published table ``name``; it is as small as a model."""
    df.coalesce(1).write.mode("overwrite").parquet(folder(name))


def sql_source(name: str) -> str:
    """The published table ``name`` as a table function call of another engine."""
    return f"read_parquet('{re.sub('^file:/*', '/', folder(name))}/*.parquet')"
