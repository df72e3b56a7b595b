"""Date and time column functions (FN-2, FN-3, FN-4, FN-5, FN-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts the order records arrive in, tried in this order.
DEFAULT_LAYOUTS = ("M/d/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, layouts: Sequence[str] = DEFAULT_LAYOUTS) -> Column:
    """Parse text with several layouts; the first layout that matches wins.

    ``try_to_timestamp`` returns null on a miss instead of failing the task
    under ANSI mode, so a row that matches a later layout is still parsed.
    Surrounding blanks are trimmed first.
    """
    text = F.trim(_col(c))
    return F.coalesce(*[F.when(_looks_like(text, fmt), F.try_to_timestamp(text, F.lit(fmt))) for fmt in layouts])


def _looks_like(text: Column, layout: str) -> Column:
    """Cheap guard: every separator of the layout occurs in the text.

    A failed parse costs an exception inside the JVM; skipping layouts that
    cannot match keeps the common path exception-free.  The guard only ever
    skips texts the layout would reject anyway.
    """
    seps = sorted({ch for ch in layout if not ch.isalnum() and ch not in " '"})
    cond = F.lit(True)
    for ch in seps:
        cond = cond & (F.instr(text, ch) > 0)
    return cond


def to_day(c: str | Column) -> Column:
    """Timestamp to calendar date (session zone)."""
    return F.to_date(_col(c))


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (date parts only)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def ingest_time() -> Column:
    """Processing time of the micro-batch that reads the row."""
    return F.current_timestamp()


def epoch_or_iso_to_ts(c: str | Column) -> Column:
    """Epoch seconds (number or numeric text) or ISO-8601 text to a UTC timestamp."""
    col = _col(c)
    as_num = F.trim(col.cast("string")).try_cast("double")
    return F.coalesce(
        F.timestamp_micros((as_num * F.lit(1_000_000)).cast("long")),
        F.try_to_timestamp(F.trim(col.cast("string"))),
    )


def day_bounds(date_from: str, date_to: str) -> tuple[Column, Column]:
    """Half-open bounds [from 00:00, to+1 day 00:00) covering whole UTC days.

    Equal at microsecond precision to an inclusive ``<= to 23:59:59.999999``.
    """
    lo = F.to_timestamp(F.lit(date_from))
    hi = F.to_timestamp(F.date_add(F.to_date(F.lit(date_to)), 1))
    return lo, hi
