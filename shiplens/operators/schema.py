"""Plan-time schema and projection operators (SCH-1..8, PRJ-1, PRJ-4).

These only look at ``df.columns`` / ``df.schema`` and emit one projection,
so they cost nothing at run time and Catalyst collapses them into the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.session import stage_table


# The naming rule: any white space inside a name is an underscore, and
# parentheses disappear.
_NAME_RULE = {ord(c): "_" for c in " \t\n\r\f\v\u00a0"} | {ord(c): None for c in "()"}


def normalize_name(name: str) -> str:
    """A column name in lower case, without outer white space, by the naming rule."""
    return name.strip().translate(_NAME_RULE).lower()


def quoted(name: str) -> str:
    """A column name that may hold dots, quotes or backticks, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name` in one projection.

    Raises when two source columns map to the same name, which a rename loop
    would silently turn into an ambiguous frame.
    """
    names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for src, dst in zip(df.columns, names):
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} both normalise to {dst!r}")
        seen[dst] = src
    return df.toDF(*names)


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The names from ``cols`` that exist in ``df``, in the given order, once each."""
    have = set(df.columns)
    out: list[str] = []
    for c in cols:
        if c in have and c not in out:
            out.append(c)
    return out


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project only the requested columns that exist (SCH-2)."""
    return df.select(*[F.col(quoted(c)) for c in present(df, cols)])


def resolve(df: DataFrame, aliases: Sequence[str]) -> str | None:
    """First of ``aliases`` that is a column of ``df`` (SCH-4)."""
    for a in aliases:
        if a in df.columns:
            return a
    return None


def ensure_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``name`` computed by ``expr`` only when the column is absent (SCH-5)."""
    if name in df.columns:
        return df
    return df.withColumn(name, expr)


def ensure_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """:func:`ensure_column` for several columns in a single projection."""
    missing = [(n, e) for n, e in defaults.items() if n not in df.columns]
    if not missing:
        return df
    return df.select("*", *[e.alias(n) for n, e in missing])


def flatten_struct(df: DataFrame, struct_col: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by its fields (SCH-6)."""
    field_names = df.schema[struct_col].dataType.fieldNames()
    others = [F.col(quoted(c)) for c in df.columns if c != struct_col]
    fields = [F.col(quoted(struct_col))[f].alias(f"{prefix}{f}") for f in field_names]
    return df.select(*others, *fields)


def split_by_type(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, other) column names by data type (SCH-8)."""
    cols = list(cols) if cols is not None else df.columns
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    other = [c for c in cols if c not in numeric]
    return numeric, other


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast named columns (PRJ-1); ``lenient`` turns bad values into null."""
    def conv(c: str) -> Column:
        col = F.col(quoted(c))
        if c not in types:
            return col
        return (col.try_cast(types[c]) if lenient else col.cast(types[c])).alias(c)

    return df.select(*[conv(c) for c in df.columns])


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Deterministic key of a row's content from business columns (PRJ-4).

    A random ``uuid()`` changes whenever the plan is re-executed (retries,
    several sinks), so two writers would disagree; an md5 of the columns does
    not.  Each value is written with its length in front, and a null as
    ``-``, so different rows never hash the same text: not null and empty,
    nor values that only differ in where a separator falls.
    """
    values = [(F.col(quoted(c)) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]))


def with_row_key(df: DataFrame, name: str, copies_per_task: int = 1_000_000) -> DataFrame:
    """``df`` with a key in front that is unique to each row (PRJ-4).

    Equal rows share their content key, so an occurrence number follows it.
    Equal rows are interchangeable: they are counted (copies collapse before
    the shuffle) and written out again with numbers 0, 1, ..., so the keyed
    rows are the same on every run.  A row with more copies than
    ``copies_per_task`` is written out in pieces by several tasks.
    """
    cols = [F.col(quoted(c)) for c in df.columns]
    counted, _ = stage_table(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")), "row-key")
    few = counted.where(F.col("__n") <= copies_per_task).select("*", F.lit(0).cast("long").alias("__piece"))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / copies_per_task))
    many = counted.where(F.col("__n") > copies_per_task).select("*", F.explode(pieces).alias("__piece"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("__piece") * copies_per_task
    last = F.least(F.col("__n"), first + copies_per_task) - 1
    rows = few.unionByName(many.repartition(n, *cols, "__piece")).withColumn("__copy", F.explode(F.sequence(first, last)))
    return rows.select(F.concat_ws("-", surrogate_key(cols), F.col("__copy").cast("string")).alias(name), *cols)
