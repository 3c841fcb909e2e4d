"""What changed between consecutive full deliveries of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical(*columns: str | Column) -> Column:
    """One string per row in which null, empty text and column limits stay distinct.

    Each value is written as its length and its text, null as ``~``. Floating
    point values are folded first (``-0.0`` to ``0.0``; NaN is one value).
    """
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        text = F.when(text == "-0.0", F.lit("0.0")).otherwise(text)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts)


def row_hash(*columns: str | Column) -> Column:
    """64-bit hash of the canonical form; only rows of one key are ever compared."""
    return F.xxhash64(canonical(*columns))


def delivery_calendar(df: DataFrame, snapshot: str) -> DataFrame:
    """(snapshot, _ord, _next): the deliveries in order, the next one's date beside each.

    One row per distinct delivery day, so its size is bounded by the calendar and
    not by the rows; the unpartitioned window runs over these few rows only.
    """
    days = df.where(F.col(snapshot).isNotNull()).select(snapshot).distinct()
    w = Window.orderBy(snapshot)
    return days.select(snapshot, (F.row_number().over(w) - 1).cast("int").alias("_ord"), F.lead(snapshot).over(w).alias("_next"))


def last_loaded(df: DataFrame, keys: Sequence[str], values: Sequence[str], loaded: str) -> DataFrame:
    """Of several rows of one key the last loaded, with map-side combination.

    Ties on ``loaded`` fall to the largest value tuple (null smallest), so the
    result does not depend on the order of rows. A null load time counts as oldest.
    """
    best = F.max(F.struct(F.col(loaded).alias("_loaded"), *[F.col(v) for v in values])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def snapshot_changes(
    df: DataFrame,
    snapshot: str,
    keys: Sequence[str],
    compared: Sequence[str],
    loaded: str,
    change: str = "mudanca",
    deliveries: DataFrame | None = None,
) -> DataFrame:
    """Rows added, removed or changed between every two consecutive deliveries.

    Full outer join of each delivery with the one before it on the primary key;
    a missing side is an addition or removal, unequal canonical row hashes are a
    change. Returns (snapshot of the later delivery, *keys, change). The days of
    delivery come from ``deliveries`` (a table with the snapshot column), by
    default from ``df`` itself; pass it when ``df`` is already filtered.

    Edge cases: rows whose snapshot or any key is null belong to no delivery or
    no record and are left out; of repeated rows of a key the last loaded counts
    (``last_loaded``); null in a compared column is a value; an empty table or
    a single delivery gives no rows; further columns are never read.
    """
    present = df.where(F.col(snapshot).isNotNull())
    calendar = F.broadcast(delivery_calendar(present if deliveries is None else deliveries, snapshot))
    valid = present
    for k in keys:
        valid = valid.where(F.col(k).isNotNull())
    rows = last_loaded(valid.select(snapshot, *keys, *compared, loaded), [snapshot, *keys], list(compared), loaded)
    hashed = rows.select(snapshot, *keys, row_hash(*compared).alias("_hash")).join(calendar, snapshot)
    later = hashed.select(F.col(snapshot).alias("_day"), *keys, F.col("_hash").alias("_new"), F.col("_ord").alias("_has_new"))
    earlier = hashed.where(F.col("_next").isNotNull()).select(
        F.col("_next").alias("_day"), *keys, F.col("_hash").alias("_old"), F.lit(1).alias("_has_old")
    )
    both = later.join(earlier, ["_day", *keys], "full_outer")
    kind = (
        F.when(F.col("_has_old").isNull(), "added")
        .when(F.col("_has_new").isNull(), "removed")
        .when(F.col("_new") != F.col("_old"), "changed")
    )
    not_first = F.col("_has_old").isNotNull() | (F.col("_has_new") > 0)
    return both.where(not_first).withColumn(change, kind).where(F.col(change).isNotNull()).select(
        F.col("_day").alias(snapshot), *keys, change
    )
