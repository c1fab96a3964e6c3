"""Column expressions shared by the operators (all built-in, JVM-side, codegen-friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the temporal contract.
EPOCH = "1970-01-01 00:00:00"          # high-water mark of an empty table
FAR_FUTURE = "9999-12-31 00:00:00"     # stand-in for an open valid_to in overlap tests


def ts_literal(text: str) -> Column:
    """A zone-less timestamp literal (never shifts with the session time zone)."""
    return F.lit(text).cast("timestamp_ntz")


def received_id(change_id: str, entity: str, ingest_ts: str, source_ts: str) -> Column:
    """Delivery surrogate key: md5 over ``change_id|entity|ingest|source`` as text (NULL parts skipped)."""
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in (change_id, entity, ingest_ts, source_ts))))


def version_key(entity: str, change_id: str) -> Column:
    """``entity || '-' || change_id`` (NULL-propagating like SQL ``||``)."""
    return F.concat(F.col(entity).cast("string"), F.lit("-"), F.col(change_id))


def hour_floor_ntz(col: str | Column) -> Column:
    """Truncate a timestamp_ntz to the hour without a detour through the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """OR-fold of ``a <> b`` with SQL three-valued logic (NULL vs value is not a difference)."""
    return reduce(lambda acc, c: acc | c, [a != b for a, b in pairs])


def asc_last(*cols: str) -> list[Column]:
    """Ascending, NULLs last: the ordering a SQL engine like DuckDB uses by default."""
    return [F.col(c).asc_nulls_last() for c in cols]


def entity_bucket(entity: str, n_buckets: int) -> Column:
    """Stable storage bucket of an entity key."""
    return F.pmod(F.xxhash64(F.col(entity)), F.lit(n_buckets)).cast("int")
