"""Connected components of a link table, by alternating star contractions.

Each round runs two grouped minima over the links (large star, small star)
and stages the contracted links as Parquet in the shared folder, so the plan
does not grow and a lost executor re-reads files.  Nothing of the graph comes
to the driver but a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hops = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hops.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(links: DataFrame, name: str = "links") -> DataFrame:
    """``links(u, v)`` of longs -> ``(node, root)`` for every linked node that isn't a root.

    The root is the smallest node of the component.  Rounds go on until the
    links no longer change (about the logarithm of the longest chain).
    """
    now = staged(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = _state(now)
    while before[0]:
        large = _large_star(now).where("u <> v").distinct()
        now = staged(_small_star(large).distinct(), name)
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
