"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

LEVEL_BITS = 10
HASH_BITS = 60


@dataclass(frozen=True)
class Share:
    mix: str
    source: str
    weight: float
    most: int
    fraction: float


def source_name(source: str | Column) -> Column:
    """Source names without the differences of case, spacing and hyphens; null stays null."""
    c = F.col(source) if isinstance(source, str) else source
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_]+", "_")


def budgets(shares: list[Share], available: dict[str, int], corpus: int) -> dict[tuple[str, str], float]:
    """Tokens that each source gives to each mix.

    A mix of size ``fraction * corpus`` is split by weight. A source cannot give
    more than ``most`` times its tokens; what it lacks is spread over the others
    by weight, until all is placed or every source is at its limit.
    """
    out: dict[tuple[str, str], float] = {}
    for mix in sorted({s.mix for s in shares}):
        mine = [s for s in shares if s.mix == mix]
        rest, open_ = max(s.fraction for s in mine) * corpus, list(mine)
        while open_:
            weight = sum(s.weight for s in open_)
            full = [s for s in open_ if weight <= 0 or rest * s.weight / weight >= s.most * available.get(s.source, 0)]
            if not full:
                out |= {(mix, s.source): rest * s.weight / weight for s in open_}
                break
            for s in full:
                out[mix, s.source] = float(s.most * available.get(s.source, 0)) if s.weight > 0 else 0.0
                rest -= out[mix, s.source]
            open_ = [s for s in open_ if s not in full]
    return out


def thresholds(docs: DataFrame, wanted: dict[tuple[str, str], float], available: dict[str, int]) -> list[tuple[str, str, int, int]]:
    """(mix, source, whole copies, hash threshold): documents below the threshold come once more.

    Tokens are summed by source and hash bucket; the bucket in which a budget ends
    is the only one looked into again, with the next bits of the hash, until it
    cannot be split. Each round gathers at most one bucket's 2^10 sums per budget,
    so what reaches the driver is bounded by the number of budgets.
    """
    goal: dict[tuple[str, str], float] = {}
    copies: dict[tuple[str, str], int] = {}
    for (mix, source), tokens in wanted.items():
        have = available.get(source, 0)
        copies[mix, source] = int(tokens // have) if have else 0
        goal[mix, source] = tokens - copies[mix, source] * have if have else 0.0
    prefix = {k: 0 for k in goal}
    result: dict[tuple[str, str], int] = {k: 0 for k in goal if goal[k] <= 0}
    for depth in range(1, HASH_BITS // LEVEL_BITS + 1):
        asked = {(s, prefix[m, s]) for m, s in goal if (m, s) not in result}
        if not asked:
            break
        shift = HASH_BITS - depth * LEVEL_BITS
        inside = F.lit(False)
        for s, p in sorted(asked):
            inside = inside | ((F.col("source") == s) & (F.shiftright("h", shift + LEVEL_BITS) == p))
        sums = docs.where(inside).groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()
        by: dict[tuple[str, int], list] = defaultdict(list)
        for r in sums:
            by[r.source, r.b >> LEVEL_BITS].append((r.b, r.t, r.n))
        for k in [k for k in goal if k not in result]:
            for b, t, n in sorted(by[k[1], prefix[k]]):
                if goal[k] < t or (goal[k] == t and t > 0):
                    if n == 1 or shift == 0:  # one document, or equal hashes: in if that is nearer
                        result[k] = (b + (goal[k] * 2 >= t)) << shift
                    prefix[k] = b
                    break
                goal[k] -= t
            else:
                result[k] = (prefix[k] + 1) << (shift + LEVEL_BITS)
    return [(m, s, copies[m, s], result[m, s]) for m, s in sorted(goal)]


def mixed(documents: DataFrame, targets: DataFrame, item_id: str = "doc_id") -> tuple[DataFrame, list[tuple], dict[str, int], int]:
    """Documents of every mix with how often each comes, and what the report needs.

    ``documents``: id, source, tokens. ``targets``: mistura, fracao_corpus, source,
    peso_alvo, max_repeticoes, a small fixed table. Returns (rows (mistura, doc_id,
    source, repeticoes, tokens), thresholds, tokens by source, tokens of the corpus).

    A document's hash decides alone whether it is below a threshold, so nothing is
    sorted, a larger budget contains the documents of a smaller one, and one
    source with a third of all rows is spread like any other.

    Edge cases: documents with null source, or no tokens, are in no mix (they
    count to the corpus size); a named source without documents gives nothing and
    its weight goes to the others; repeated rows share their hash and go in or
    out together; weights of 0 give nothing; null weights and sources of targets
    are left out; empty tables give no rows.
    """
    name = source_name("source")
    h = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col(item_id)), 64 - HASH_BITS)
    docs = cut(documents.select(F.col(item_id).alias("doc_id"), name.alias("source"), F.coalesce("tokens", F.lit(0)).alias("tokens"), h.alias("h")))
    rows = targets.where("source is not null and peso_alvo is not null and mistura is not null").select(
        "mistura", source_name("source").alias("source"), "peso_alvo", "max_repeticoes", "fracao_corpus"
    ).collect()
    shares = [Share(r.mistura, r.source, r.peso_alvo, r.max_repeticoes or 0, r.fracao_corpus or 0.0) for r in rows]
    corpus = docs.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    named = docs.where(F.col("source").isin(sorted({s.source for s in shares})) & (F.col("tokens") > 0))
    available = {r.source: r.t for r in named.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    wanted = budgets(shares, available, corpus)
    limits = thresholds(named, wanted, available)
    spark = documents.sparkSession
    table = spark.createDataFrame(limits, "mistura string, source string, _copies long, _below long")
    taken = named.join(F.broadcast(table), "source").withColumn("repeticoes", F.col("_copies") + F.when(F.col("h") < F.col("_below"), 1).otherwise(0))
    out = taken.where("repeticoes > 0").select("mistura", "doc_id", "source", "repeticoes", "tokens")
    return out, [(s, wanted[s.mix, s.source]) for s in shares], available, corpus


def report(spark, rows: DataFrame, wanted: list[tuple], available: dict[str, int], corpus: int) -> DataFrame:
    """Shares asked and reached per mix and source."""
    asked = spark.createDataFrame(
        [(s.mix, s.source, s.weight, s.most, s.fraction * corpus, w, available.get(s.source, 0)) for s, w in wanted],
        "mistura string, source string, peso_alvo double, max_repeticoes long, tokens_mistura double, tokens_orcados double, tokens_fonte long",
    )
    got = rows.groupBy("mistura", "source").agg(
        F.sum(F.col("tokens") * F.col("repeticoes")).alias("tokens"), F.count(F.lit(1)).alias("documentos"), F.max("repeticoes").alias("mais_repetido")
    )
    size = got.groupBy("mistura").agg(F.sum("tokens").alias("_all"))
    return (
        asked.join(got, ["mistura", "source"], "left").join(size, "mistura", "left").fillna(0, ["tokens", "documentos", "mais_repetido"])
        .withColumn("peso_obtido", F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0))).drop("_all")
    )
