"""Filling containers of several fixed capacities with whole texts."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Items packed together; a packing of this many leaves a few unfilled containers at its end.
ITEMS_PER_SHARD = 20_000


class _OpenBins:
    """Open containers by free space; the tightest that fits is found by one bit scan."""

    def __init__(self) -> None:
        self.bits = 0
        self.at: dict[int, list[int]] = {}

    def put(self, free: int, bin_: int) -> None:
        self.at.setdefault(free, []).append(bin_)
        self.bits |= 1 << free

    def take(self, need: int) -> tuple[int, int] | None:
        above = self.bits >> need
        if not above:
            return None
        free = need + (above & -above).bit_length() - 1
        bins = self.at[free]
        bin_ = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return free, bin_


def best_fit(sizes: Sequence[int], capacities: Sequence[int]) -> tuple[list[int], list[int]]:
    """(container of each item, capacity of each container); every item fits the largest capacity.

    Items go in decreasing order into the open container with the least room that
    holds them. Where none does, the capacity of least cost is opened: the room
    that the items still to come cannot fill, per token placed, ties to the
    smaller. Of the items to come those that the open containers can still take
    are not counted twice. At the end every container shrinks to the least capacity that holds
    its contents.
    """
    caps = sorted(set(capacities))
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    ascending = sorted(sizes)
    total = [0]
    for s in ascending:
        total.append(total[-1] + s)
    left, loose = len(sizes), 0
    bins, where, room, used = _OpenBins(), [0] * len(sizes), [], []
    for i in order:
        need = sizes[i]
        left -= 1
        got = bins.take(need)
        if got is None:
            options = []
            for c in caps[bisect_left(caps, need) :]:
                spare = c - need
                fill = min(spare, max(0, total[min(bisect_right(ascending, spare), left)] - loose))
                options.append(((spare - fill) / (need + fill or 1), c))
            c = min(options)[1]
            got = (c, len(room))
            room.append(c)
            used.append(0)
            loose += c
        free, b = got
        where[i] = b
        used[b] += need
        loose -= need
        bins.put(free - need, b)
    return where, [caps[bisect_left(caps, u)] for u in used]


_SCHEMA = "plano string, recipiente string, capacidade_tokens long, container long, doc_id long, pedaco int, inicio long, tokens long"


def packed(items: DataFrame, plans: Mapping[str, Mapping[str, int]], item_id: str = "doc_id", shard_items: int = ITEMS_PER_SHARD) -> DataFrame:
    """Assign every item to containers, once per plan.

    ``items`` has an id and ``tokens``; ``plans`` maps a plan to the capacities it
    permits, by name. Returns (plano, recipiente, capacidade_tokens, container,
    doc_id, pedaco, inicio, tokens): the piece of the item that starts at token
    ``inicio`` lies in that container. An item is cut only if it exceeds the
    largest capacity of the plan, into full pieces of that capacity and a rest.

    Rows are dealt to shards of about ``shard_items`` by a hash of their position,
    so repeated ids spread too; shards are packed side by side, and their number
    grows with the rows. Container ids hold the shard in the high bits.

    Edge cases: a null or empty text has no tokens and needs no container, it
    comes out with container and capacity null; repeated rows are items of their
    own; null ids are packed like others; an empty table gives no rows.
    """
    base = cut(items.select(F.col(item_id).cast("long").alias("doc_id"), F.coalesce("tokens", F.lit(0)).alias("tokens")))
    shards = max(1, -(-base.count() // shard_items))
    dealt = base.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("long"))
    names = {p: {c: n for n, c in sorted(caps.items(), reverse=True)} for p, caps in plans.items()}

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tokens", "doc_id"], ascending=[False, True], kind="stable", na_position="last")
        ids, sizes = rows["doc_id"].tolist(), rows["tokens"].tolist()
        frames = []
        for plan, named in names.items():
            most = max(named)
            pieces = []
            for d, n in zip(ids, sizes):
                pieces += [(d, k, k * most, min(most, n - k * most)) for k in range(-(-n // most))]
            where, capacity = best_fit([p[3] for p in pieces], list(named))
            out = pd.DataFrame(pieces, columns=["doc_id", "pedaco", "inicio", "tokens"])
            out["container"] = [(int(key[0]) << 32) + b for b in where]
            out["capacidade_tokens"] = [capacity[b] for b in where]
            out["recipiente"] = [named[capacity[b]] for b in where]
            out["plano"] = plan
            frames.append(out)
        columns = [c.split()[0] for c in _SCHEMA.split(", ")]
        return pd.concat(frames)[columns]

    placed = dealt.where("tokens > 0").groupBy("_shard").applyInPandas(fill, _SCHEMA)
    nothing = dealt.where("tokens = 0").select(
        F.explode(F.array(*[F.lit(p) for p in names])).alias("plano"), F.lit(None).cast("string").alias("recipiente"), F.lit(None).cast("long").alias("capacidade_tokens"),
        F.lit(None).cast("long").alias("container"), "doc_id", F.lit(0).alias("pedaco"), F.lit(0).cast("long").alias("inicio"), "tokens",
    )
    return placed.unionByName(nothing)


def usage(placed: DataFrame) -> DataFrame:
    """(plano, recipiente, containers, itens, capacidade, tokens, uso): how full the containers are."""
    each = placed.where(F.col("container").isNotNull()).groupBy("plano", "recipiente", "container").agg(
        F.max("capacidade_tokens").alias("c"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")
    )
    out = each.groupBy("plano", "recipiente").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("n").alias("itens"), F.sum("c").alias("capacidade"), F.sum("t").alias("tokens")
    )
    return out.withColumn("uso", F.col("tokens") / F.col("capacidade"))
