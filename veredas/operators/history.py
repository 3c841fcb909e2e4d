"""Attribute history from periodic deliveries, kept as checkpoints and patches.

The store has two kinds of rows. A *checkpoint* row gives the value of one
attribute of one entity at every ``every``-th delivery (a full version). A
*patch* row gives one change between two deliveries: ``add``, ``set`` or ``del``.
Any state is the nearest checkpoint at or before it with the patches after that
checkpoint folded forward; validity periods come from the same fold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .snapshots import delivery_calendar, last_loaded

CHECKPOINT, ADD, SET, DELETE = "checkpoint", "add", "set", "del"


def build_store(
    df: DataFrame,
    snapshot: str,
    keys: Sequence[str],
    attributes: Mapping[str, Column],
    loaded: str,
    every: int = 4,
    deliveries: DataFrame | None = None,
) -> DataFrame:
    """The checkpoint-and-patch store of ``df``.

    ``attributes`` maps names to expressions that give the value as it is to be
    compared. Returns (*keys, atributo, ord, dia, op, valor); ``valor`` is text.
    One row per key and delivery is left after ``last_loaded``, so the windows
    below see at most as many rows per key as there are deliveries.

    Edge cases: rows with null snapshot or key are left out; null is a value;
    of repeated rows the last loaded counts; an empty table gives an empty store.
    """
    present = df.where(F.col(snapshot).isNotNull())
    calendar = delivery_calendar(present if deliveries is None else deliveries, snapshot)
    valid = present
    for k in keys:
        valid = valid.where(F.col(k).isNotNull())
    names = list(attributes)
    fields = {n: f"_a{i}" for i, n in enumerate(names)}
    picked = valid.select(snapshot, *keys, F.col(loaded).alias("_at"), *[attributes[n].cast("string").alias(fields[n]) for n in names])
    rows = last_loaded(picked, [snapshot, *keys], list(fields.values()), "_at").join(F.broadcast(calendar), snapshot)
    w = Window.partitionBy(*keys).orderBy("_ord")
    lead_in = rows.withColumn("_before", F.lag("_ord").over(w)).withColumn("_after", F.lead("_ord").over(w))
    gap_before = F.col("_before").isNull() | (F.col("_before") != F.col("_ord") - 1)
    gap_after = F.col("_next").isNotNull() & (F.col("_after").isNull() | (F.col("_after") != F.col("_ord") + 1))
    for n in names:
        lead_in = lead_in.withColumn(f"_p{fields[n]}", F.lag(fields[n]).over(w))

    def event(when: Column, name: str, order: Column, day: Column, op: str, value: Column) -> Column:
        body = F.struct(F.lit(name).alias("atributo"), order.alias("ord"), day.alias("dia"), F.lit(op).alias("op"), value.alias("valor"))
        return F.when(when, body)

    events = []
    for n in names:
        value, previous = F.col(fields[n]), F.col(f"_p{fields[n]}")
        order, day = F.col("_ord"), F.col(snapshot)
        events += [
            event(order % every == 0, n, order, day, CHECKPOINT, value),
            event(gap_before, n, order, day, ADD, value),
            event(~gap_before & ~previous.eqNullSafe(value), n, order, day, SET, value),
            event(gap_after, n, order + 1, F.col("_next"), DELETE, F.lit(None).cast("string")),
        ]
    exploded = lead_in.select(*keys, F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("_e"))
    return exploded.select(*keys, "_e.*")


def validity(store: DataFrame, keys: Sequence[str], valid_from: str = "valido_de", valid_to: str = "valido_ate") -> DataFrame:
    """Versions with the period for which each held, folded from the store.

    Returns (*keys, atributo, valor, valid_from, valid_to); ``valid_to`` is null
    while the version still holds. A checkpoint restates the current value and
    opens a version only where the fold starts there; a ``del`` closes one.
    """
    w = Window.partitionBy(*keys, "atributo").orderBy("ord", F.when(F.col("op") == CHECKPOINT, 1).otherwise(0))
    alive = F.col("op") != DELETE
    folded = store.withColumn("_alive", alive)
    same = F.lag("_alive").over(w).eqNullSafe(F.col("_alive")) & F.lag("valor").over(w).eqNullSafe(F.col("valor"))
    # a patch right after a gap is a new version even if the value returns
    turning = folded.withColumn("_turn", ~same | (F.col("op") == ADD)).where("_turn")
    closed = turning.withColumn(valid_to, F.lead("dia").over(w))
    return closed.where("_alive").select(*keys, "atributo", "valor", F.col("dia").alias(valid_from), valid_to)


def state_as_of(store: DataFrame, keys: Sequence[str], day: str, snapshot_ord: int, every: int = 4) -> DataFrame:
    """The state at delivery ``snapshot_ord``: nearest checkpoint plus the patches after it.

    Only rows between that checkpoint and the asked delivery are read. Returns
    (*keys, atributo, valor, dia) where ``dia`` is ``day`` as text.
    """
    start = snapshot_ord - snapshot_ord % every
    near = store.where((F.col("ord") <= snapshot_ord) & ((F.col("ord") > start) | ((F.col("ord") == start) & (F.col("op") == CHECKPOINT))))
    last = F.max(F.struct("ord", F.col("op").alias("o"), F.col("valor").alias("v"))).alias("_l")
    return near.groupBy(*keys, "atributo").agg(last).where(F.col("_l.o") != DELETE).select(
        *keys, "atributo", F.col("_l.v").alias("valor"), F.lit(day).alias("dia")
    )
