"""References to records that are missing, deleted or arrive later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join


def parent_intervals(parents: DataFrame, key: str, valid_from: str | None, valid_to: str | None = None) -> DataFrame:
    """(_key, _from, _to): one row per parent key with the period it exists.

    A null bound is open. Of repeated keys the earliest start and latest end
    count, an open bound winning. Null keys are no parents.
    """
    start = F.col(valid_from) if valid_from else F.lit(None).cast("date")
    end = F.col(valid_to) if valid_to else F.lit(None).cast("date")
    return (
        parents.where(F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), start.alias("_s"), end.alias("_e"))
        .groupBy("_key")
        .agg(
            F.when(F.count("_s") == F.count(F.lit(1)), F.min("_s")).alias("_from"),
            F.when(F.count("_e") == F.count(F.lit(1)), F.max("_e")).alias("_to"),
            F.lit(1).alias("_there"),
        )
    )


def orphan_references(refs: DataFrame, key: str, at: str, intervals: DataFrame, status: str = "situacao") -> DataFrame:
    """The rows of ``refs`` whose ``key`` fails at time ``at``, with the reason.

    References and parents are hash-partitioned and sorted on the key and merged
    in one pass (sort-merge join); rows of hot keys meet their single parent row
    in a broadcast join bounded by the number of hot keys. ``missing``: no such
    parent; ``late``: the parent starts after ``at``; ``deleted``: it ended
    before ``at``. A null key is no reference; with a null ``at`` only
    ``missing`` is decided. Columns of ``refs`` pass through, and none of the
    parents' can clash with them.
    """
    asked = refs.where(F.col(key).isNotNull()).withColumn("_key", F.col(key))
    joined = lookup_join(asked, intervals, "_key", how="left", hint="merge")
    reason = (
        F.when(F.col("_there").isNull(), "missing")
        .when(F.col("_from") > F.col(at), "late")
        .when(F.col("_to") < F.col(at), "deleted")
    )
    return joined.withColumn(status, reason).where(F.col(status).isNotNull()).drop("_key", "_from", "_to", "_there")
