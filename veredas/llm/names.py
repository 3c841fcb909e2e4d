"""Linking the spellings of names typed by people (merge-and-rematch)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .spelling import LEAST_GIVEN, agreement, block_keys, merged_tokens, parse, share_trigrams, trigrams

#: The spellings of one document are gathered up to this number. Of a company with more each part of about so many
#: is merged, then the parts. The names of a masked document with more meet by joins, under the same rule.
MAX_SPELLINGS_OF_DOCUMENT = 200
#: Tokens that begin fewer than one in so many persons' names are not taken for given names.
GIVEN = 100_000

_STRINGS = T.ArrayType(T.StringType())
_PARSED = T.StructType().add("kind", "string").add("tokens", _STRINGS).add("legal", _STRINGS).add("gen", "string")
_BEARERS = T.StructType().add("part", T.ArrayType(T.IntegerType())).add("rich", T.ArrayType(_STRINGS))
_AGREED = T.StructType().add("level", "integer").add("share", "double")


@F.pandas_udf(_PARSED)
def parsed(name: pd.Series, hint: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(n, h or "") for n, h in zip(name, hint)], columns=["kind", "tokens", "legal", "gen"])


@F.pandas_udf(_BEARERS)
def bearers(names: pd.Series, hint: pd.Series, certain: pd.Series) -> pd.DataFrame:
    """Groups the spellings of one document by bearer; also each bearer's merged name."""
    parts, riches = [], []
    for group, h, sure in zip(names, hint, certain):
        seen = [parse(n, h or "") for n in group]
        order = sorted(range(len(seen)), key=lambda i: (-len("".join(seen[i][1])), group[i]))
        clusters: list[list[int]] = []
        part = [-1] * len(seen)
        near = {} if sure else {i: _nearness(seen[i][1]) for i in order if seen[i][0] != "x"}
        for i in order:
            if seen[i][0] == "x":
                continue
            met = [c for c in clusters if sure or any(_linked(seen[i], near[i], seen[j], near[j]) for j in c)]
            clusters = [c for c in clusters if not any(c is m for m in met)] + [[j for c in met for j in c] + [i]]
        clusters = [sorted(c, key=order.index) for c in clusters]
        for k, c in enumerate(clusters):
            for i in c:
                part[i] = k
        parts.append(part)
        riches.append([_filled(seen[c[0]][1], [seen[j][1] for j in c[1:]]) for c in clusters])
    return pd.DataFrame({"part": parts, "rich": riches})


def _grams(tokens: list[str]) -> list[int]:
    return sorted(xxhash.xxh64_intdigest("3:" + g) - (1 << 63) for g in trigrams(tokens))


def _nearness(tokens: list[str]) -> tuple[set[str], set[int], set[int]]:
    """Block keys, trigrams, and the third of them that meets the other name's: what ``_within_documents`` joins by."""
    grams = _grams(tokens)
    return set(block_keys("p", tokens)), set(grams), set(grams[: len(grams) - -(-len(grams) * 2 // 3) + 1])


def _filled(longest: list[str], others: list[list[str]]) -> list[str]:
    """The longest name, each initial of it filled in by the first other name that has a whole word there."""
    out = list(longest)
    for o in others:
        out = [r if x == t else x for x, t, r in zip(out, longest, merged_tokens(longest, [o]))]
    return out


def _linked(a: tuple, near_a: tuple, b: tuple, near_b: tuple) -> bool:
    """The rule of ``_within_documents`` for two names of one masked document."""
    met = near_a[0] & near_b[0] or near_a[2] & near_b[1] or near_b[2] & near_a[1]
    return bool(met) and (share_trigrams(a[1], b[1]) or agreement(a[0], a[1], b[1], (), (), a[3], b[3])[0] == 2)


@F.pandas_udf(T.ArrayType(T.LongType()))
def keys_of(kind: pd.Series, tokens: pd.Series) -> pd.Series:
    def signed(text: str) -> int:
        n = xxhash.xxh64_intdigest(text)
        return n - (1 << 64) if n >= 1 << 63 else n

    return pd.Series([[signed(k) for k in block_keys(k0, list(t))] for k0, t in zip(kind, tokens)])


def agreed(given: Broadcast | None = None):
    """Level and share of two names' features; ``given`` has the known given names with their counts."""

    @F.pandas_udf(_AGREED)
    def judge(kind: pd.Series, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        known = given.value if given is not None else None
        rows = zip(kind, a["tokens"], b["tokens"], a["legal"], b["legal"], a["gen"], b["gen"])
        return pd.DataFrame([agreement(k, list(x), list(y), list(lx), list(ly), gx, gy, known) for k, x, y, lx, ly, gx, gy in rows], columns=["level", "share"])

    return judge


def given_names(names: DataFrame) -> Broadcast:
    """How many persons' names begin with each token, for tokens that begin 1/``GIVEN`` of them or more, so at most ``GIVEN`` tokens."""
    first = names.where("kind = 'p'").select(F.get("tokens", F.lit(0)).alias("t")).where(F.length("t") > 1)
    least = max(LEAST_GIVEN, first.count() / GIVEN)
    usual = first.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect()
    return names.sparkSession.sparkContext.broadcast({r.t: r.n for r in usual})


@F.pandas_udf(_STRINGS)
def richer(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([merged_tokens(list(x), [list(y)]) if y is not None else list(x) for x, y in zip(a, b)])


@F.pandas_udf(T.ArrayType(T.LongType()))
def grams_of(tokens: pd.Series) -> pd.Series:
    return pd.Series([_grams(list(t)) for t in tokens])


@F.pandas_udf(T.BooleanType())
def one_bearer(kind: pd.Series, a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    rows = zip(kind, a["tokens"], b["tokens"], a["gen"], b["gen"])
    return pd.Series([agreement(k, list(x), list(y), (), (), gx, gy)[0] == 2 or share_trigrams(list(x), list(y)) for k, x, y, gx, gy in rows], dtype=bool)


def document_key(document: str) -> F.Column:
    """Root of a CNPJ, or the six middle digits that a masked and a full CPF share; null else."""
    digits = F.regexp_replace(document, r"[^0-9]", "")
    return (
        F.when(digits.rlike("^0*$"), None)
        .when(F.length(digits) == 14, F.concat(F.lit("c"), F.substring(digits, 1, 8)))
        .when(F.length(digits) == 11, F.concat(F.lit("m"), F.substring(digits, 4, 6)))
        .when(F.length(digits) == 6, F.concat(F.lit("m"), digits))
    )


_FEATURES = ("tokens", "legal", "gen")


def _features(prefix: str = "") -> F.Column:
    return F.struct(*[F.col(prefix + f).alias(f) for f in _FEATURES])


def link_spellings(records: DataFrame, name: str, document: str, hint: str) -> DataFrame:
    """(name, entity): each distinct name with every entity that it names.

    ``records`` has a name, an optional document and an optional hint (``p`` a
    person, ``o`` an organisation) per row. Merge and rematch: (1) spellings
    under one document are merged where the document is whole or the names agree
    in full or share their trigrams, and the merged profile keeps the union of spellings with its
    initials filled in; (2) names without any document enter blocking against
    the profiles; a name joins the one profile it agrees with in full; (3) the
    profiles grown in a round re-enter blocking with their merged names, until a
    round merges nothing; (4) names still alone are matched among themselves, and
    two that agree are merged into a name with the initials of both filled in;
    (5) merged names re-enter blocking, against each other, the names still alone
    and all profiles: a group joins the one profile that its merged names single
    out, which grows by it and goes back to (3); until nothing further merges.

    What a name met in an earlier round still counts in a later one, so a profile
    that has grown does not win over one that fitted as well before. Equal letters
    count for more than a misspelling, and two known given names one letter apart
    are no misspelling of each other.

    A name that agrees equally well with two profiles joins neither. Homonyms
    (one string under two documents) stand in both entities. Null and empty
    names, other holders, treasury shares and public bodies have no entity;
    repeated rows count once; an empty table gives no rows; further columns are
    never read. A company has its spellings however many they are. Under a masked
    document, which strangers may share, names are linked that agree in full or
    share their trigrams, however many spellings it has: documents of up to
    ``MAX_SPELLINGS_OF_DOCUMENT`` are judged in one place, larger ones by joins.
    """
    rows = records.where(F.col(name).isNotNull()).select(F.col(name).alias("nome"), document_key(document).alias("doc"), F.col(hint).alias("hint"))
    from_doc = F.when(F.col("doc").startswith("c"), "o").when(F.col("doc").startswith("m"), "p")
    seen = rows.groupBy("nome", "doc").agg(
        F.sum(F.when(F.coalesce(from_doc, "hint") == "p", 1).otherwise(0)).alias("_p"), F.sum(F.when(F.coalesce(from_doc, "hint") == "o", 1).otherwise(0)).alias("_o")
    )
    seen = cut(seen)
    kinds = seen.groupBy("nome").agg(F.sum("_p").alias("_p"), F.sum("_o").alias("_o"), F.max(F.col("doc").isNotNull()).alias("documented"))
    hinted = kinds.select("nome", "documented", F.when(F.col("_p") > F.col("_o"), "p").when(F.col("_o") > 0, "o").otherwise("").alias("hint"))
    names = hinted.select("nome", "documented", parsed("nome", "hint").alias("x")).select("nome", "documented", "x.*").where(F.col("kind") != "x")
    names = cut(names)

    borne = seen.where(F.col("doc").isNotNull()).groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    many = cut(borne.where(F.col("n") > MAX_SPELLINGS_OF_DOCUMENT))
    usable = seen.where(F.col("doc").isNotNull()).join(many, "doc", "left_anti")
    # a document with one spelling leaves nothing to judge
    single = usable.join(borne.where("n = 1"), "doc", "left_semi").join(names.select("nome"), "nome", "left_semi")
    several = usable.join(borne.where("n > 1"), "doc", "left_semi")
    grouped = several.groupBy("doc").agg(F.array_sort(F.collect_list("nome")).alias("nomes"))
    judged = grouped.select("doc", "nomes", bearers("nomes", F.when(F.col("doc").startswith("c"), "o").otherwise("p"), F.col("doc").startswith("c")).alias("b"))
    judged = cut(judged.select("doc", "nomes", "b.*"))
    members = judged.select("doc", F.explode(F.arrays_zip("nomes", "part")).alias("m")).where(F.col("m.part") >= 0)
    linked = members.select(F.col("m.nomes").alias("nome"), F.concat("doc", F.lit("#"), F.col("m.part").cast("string")).alias("entidade"))
    linked = linked.unionByName(single.select("nome", F.concat("doc", F.lit("#0")).alias("entidade")))

    riches = None
    vouched = usable.select("nome")
    if not many.isEmpty():
        hot = seen.join(many, "doc").select("doc", "n", "nome")
        companies = hot.where(F.col("doc").startswith("c"))
        named, riches = _companies_of_many_names(companies)
        placed, filled = _within_documents(hot.where(F.col("doc").startswith("m")))
        linked, vouched = linked.unionByName(named).unionByName(placed), vouched.unionByName(hot.select("nome"))
        riches = riches.unionByName(filled)

    # names that no document vouches for, one row per form
    alone = names.join(vouched.distinct(), "nome", "left_anti").drop("documented")
    alone = cut(alone.withColumn("form", _form_id()))
    forms = cut(alone.groupBy("form").agg(F.first("kind").alias("kind"), *[F.first(f).alias(f) for f in _FEATURES]).withColumn("keys", keys_of("kind", "tokens")))
    profile_kind = F.when(F.col("doc").startswith("c"), "o").otherwise("p")
    merged = judged.where(F.size("nomes") > 1).select("doc", F.posexplode("rich").alias("part", "tokens")).select(
        F.concat("doc", F.lit("#"), F.col("part").cast("string")).alias("entidade"), profile_kind.alias("kind"), "tokens",
        F.array().cast("array<string>").alias("legal"), F.lit("").alias("gen"),
    )
    if riches is not None:
        merged = merged.unionByName(riches)
    spelled = names.join(linked, "nome").select("entidade", "kind", *_FEATURES)
    entering = _distinct_profiles(spelled.unionByName(merged)).withColumn("keys", keys_of("kind", "tokens"))
    given = given_names(names.where("documented"))
    by_form = _rematched(forms, entering, given)
    given.unpersist()
    return cut(linked.unionByName(alone.select("nome", "form").join(by_form, "form").select("nome", "entidade")).distinct())


def _rematched(forms: DataFrame, profiles: DataFrame, given: Broadcast) -> DataFrame:
    """(form, entidade): every form with its profile or, if none takes it, with the forms it agrees with."""
    all_profiles, open_, entering = [profiles], forms, profiles
    joined: list[DataFrame] = []
    met = _met(_blocked(open_, entering, "form", "entidade", given))
    while True:
        while True:
            won, ties = _singled_out(met)
            if won.isEmpty():
                break
            joined.append(won)
            grown = open_.join(won, "form")
            open_ = open_.join(won.select("form"), "form", "left_anti")
            entering = _grown(grown, entering)
            all_profiles.append(entering)
            met = _met(_blocked(open_, entering, "form", "entidade", given)).unionByName(ties)
        open_ = cut(open_)
        nodes = open_.select("form", "kind", *_FEATURES, "keys")
        edges = cut(_blocked(open_, open_.withColumnRenamed("form", "form2"), "form", "form2", given).where("level = 2 and form != form2").select("form", "form2"))
        fresh = _merged_forms(nodes, edges)
        if fresh.isEmpty():
            return reduce(DataFrame.unionByName, joined, _own_groups(open_, _components(nodes.select("form"), edges)))
        # as many merged names as there are pairs with complementary initials, few beside the profiles
        known = reduce(DataFrame.unionByName, [p.select("entidade", "kind", *_FEATURES, "keys") for p in all_profiles])
        claims: list[DataFrame] = []
        while not fresh.isEmpty():
            more = fresh.select("form", "kind", *_FEATURES, "keys")
            claims.append(_singled_out(_met(_blocked(more, known, "form", "entidade", given)))[0])
            nodes = cut(nodes.unionByName(more))
            agreeing = _blocked(more, nodes.withColumnRenamed("form", "form2"), "form", "form2", given).where("level = 2 and form != form2").select("form", "form2")
            new = cut(agreeing.unionByName(fresh.select("form", F.col("source").alias("form2"))).distinct())
            edges = edges.unionByName(new)
            fresh = _merged_forms(nodes, new)
        labels = _components(nodes.select("form"), edges)
        one = reduce(DataFrame.unionByName, claims).join(labels, "form").groupBy("label").agg(F.min("entidade").alias("entidade"), F.max("entidade").alias("_other")).where("entidade = _other")
        taken = cut(open_.select("form").join(labels, "form").join(one, "label").select("form", "entidade"))
        if taken.isEmpty():
            return reduce(DataFrame.unionByName, joined, _own_groups(open_, labels))
        joined.append(taken)
        grown = open_.join(taken, "form")
        open_ = open_.join(taken.select("form"), "form", "left_anti")
        entering = _grown(grown, known)
        all_profiles.append(entering)
        met = _met(_blocked(open_, entering, "form", "entidade", given)).unionByName(ties.join(taken.select("form"), "form", "left_anti"))


def _own_groups(open_: DataFrame, labels: DataFrame) -> DataFrame:
    return open_.select("form").join(labels, "form").select("form", F.concat(F.lit("n#"), F.col("label").cast("string")).alias("entidade"))


def _met(pairs: DataFrame) -> DataFrame:
    return pairs.where("level = 2").select("form", "entidade", "share")


def _singled_out(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(form, entidade) where one profile agrees best; of forms where several do, two of these with their share.

    ``met`` has (form, entidade, share), of earlier rounds too. Two stand for all that
    tie: any of them wins later only by a larger share.
    """
    ends = cut(met.groupBy("form").agg(F.max(F.struct("share", "entidade")).alias("_a"), F.min(F.struct((-F.col("share")).alias("share"), "entidade")).alias("_b")))
    alike = F.col("_a.entidade") == F.col("_b.entidade")
    both = F.explode(F.array(F.col("_a.entidade"), F.col("_b.entidade"))).alias("entidade")
    return ends.where(alike).select("form", F.col("_a.entidade").alias("entidade")), ends.where(~alike).select("form", both, F.col("_a.share").alias("share"))


def _grown(grown: DataFrame, before: DataFrame) -> DataFrame:
    """The profiles that ``grown`` (forms with their entidade) joined: the new spellings, also with the profile's longest name filled in."""
    old = before.join(grown.select("entidade").distinct(), "entidade", "left_semi").groupBy("entidade").agg(F.max_by("tokens", F.struct(F.size("tokens"), F.array_join("tokens", " "))).alias("_t"))
    new = grown.join(old, "entidade").select("entidade", "kind", richer("tokens", "_t").alias("tokens"), "legal", "gen")
    return cut(_distinct_profiles(grown.select("entidade", "kind", *_FEATURES).unionByName(new)).withColumn("keys", keys_of("kind", "tokens")))


def _merged_forms(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(form, kind, tokens, legal, gen, keys, source): names that two agreeing ones make together and that neither is.

    Only a name with an initial gains anything, so no group is gathered: each pair gives at most one merged name.
    """
    initial = nodes.where(F.exists("tokens", lambda t: F.length(t) == 1))
    a = edges.join(initial.select("form", "kind", *_FEATURES), "form")
    both = a.join(nodes.select(F.col("form").alias("form2"), F.col("tokens").alias("_t")), "form2")
    rich = both.select(F.col("form").alias("source"), "kind", richer("tokens", "_t").alias("_rich"), "tokens", "legal", "gen").where("_rich != tokens")
    made = rich.select("source", "kind", F.col("_rich").alias("tokens"), "legal", "gen").withColumn("form", _form_id())
    new = made.join(nodes.select("form"), "form", "left_anti")
    return cut(new.groupBy("form").agg(F.first("kind").alias("kind"), *[F.first(f).alias(f) for f in _FEATURES], F.min("source").alias("source")).withColumn("keys", keys_of("kind", "tokens")))


def _form_id() -> F.Column:
    return F.xxhash64("kind", F.array_join("tokens", " "), F.array_join("legal", " "), "gen")


def _companies_of_many_names(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nome, entidade) of all names and the merged profiles of companies with too many spellings (doc, n, nome) to gather."""
    entity = F.concat("doc", F.lit("#0")).alias("entidade")
    named = rows.select("doc", "nome", parsed("nome", F.lit("o")).alias("x")).where("x.kind != 'x'").select("nome", entity)
    parts = rows.groupBy("doc", F.pmod(F.xxhash64("nome"), F.ceil(F.col("n") / MAX_SPELLINGS_OF_DOCUMENT)).alias("at")).agg(F.array_sort(F.collect_list("nome")).alias("nomes"))
    rich = parts.select("doc", "at", bearers("nomes", F.lit("o"), F.lit(True)).alias("b"))
    rich = cut(rich.select("doc", "at", F.get("b.rich", F.lit(0)).alias("tokens")).where("tokens is not null"))
    while not rich.where("at > 0").isEmpty():
        two = F.array_sort(F.collect_list(F.struct((-F.length(F.array_join("tokens", ""))).alias("_l"), "tokens")))
        pairs = rich.groupBy("doc", F.floor(F.col("at") / 2).alias("at")).agg(two.alias("t"))
        rich = cut(pairs.select("doc", "at", richer(F.get("t", F.lit(0))["tokens"], F.get("t", F.lit(1))["tokens"]).alias("tokens")))
    return named, rich.select(entity, F.lit("o").alias("kind"), "tokens", F.array().cast("array<string>").alias("legal"), F.lit("").alias("gen"))


def _within_documents(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nome, entidade) and merged profiles: names (doc, nome) under one masked document that agree in full or share their trigrams.

    Pairs meet by block keys, and by trigrams exactly: two thirds of the smaller
    set are shared, so one of any third of it and one more is.
    """
    read = rows.select("doc", "nome", parsed("nome", F.lit("p")).alias("x")).select("doc", "nome", "x.*").where("kind != 'x'")
    read = cut(read.withColumn("form", F.xxhash64("doc", F.array_join("tokens", " "), "gen")))
    nodes = read.dropDuplicates(["form"]).select("form", "doc", "kind", "tokens", "gen", keys_of("kind", "tokens").alias("keys"), grams_of("tokens").alias("grams"))
    nodes = cut(nodes)
    third = F.slice("grams", F.lit(1), F.size("grams") - F.ceil(F.size("grams") * 2 / 3).cast("int") + 1)
    a = nodes.select("doc", "form", F.explode(F.concat("keys", third)).alias("key"))
    b = nodes.select("doc", F.col("form").alias("form2"), F.explode(F.concat("keys", "grams")).alias("key"))
    met = a.join(b, ["doc", "key"]).where("form != form2").select("form", "form2").distinct()
    own = F.struct("tokens", "gen")
    both = met.join(nodes.select("form", "kind", own.alias("_a")), "form").join(nodes.select(F.col("form").alias("form2"), own.alias("_b")), "form2")
    labels = _components(nodes.select("form"), both.where(one_bearer("kind", "_a", "_b")).select("form", "form2"))
    placed = cut(read.join(labels, "form").select("nome", "tokens", F.concat("doc", F.lit("#="), F.col("label").cast("string")).alias("entidade")))
    # the longest name with its initials filled in by the first other one that has a whole word there
    first = F.struct((-F.length(F.array_join("tokens", ""))).alias("l"), "nome", "tokens")
    longest = placed.groupBy("entidade").agg(F.min(first)["tokens"].alias("_t"))
    fills = placed.join(longest, "entidade").select("entidade", "_t", first.alias("o"), richer("_t", "tokens").alias("_rich")).where("_rich != _t")
    each = fills.select("entidade", "o", F.posexplode(F.arrays_zip("_t", "_rich")).alias("at", "w")).where("w._t != w._rich")
    words = each.groupBy("entidade", "at").agg(F.min(F.struct("o", F.col("w._rich").alias("w")))["w"].alias("w"))
    words = words.groupBy("entidade").agg(F.map_from_entries(F.collect_list(F.struct("at", "w"))).alias("_w"))
    rich = longest.join(words, "entidade", "left").select(
        "entidade", F.lit("p").alias("kind"), F.transform("_t", lambda t, at: F.coalesce(F.get(F.array(F.col("_w")), F.lit(0))[at], t)).alias("tokens"),
        F.array().cast("array<string>").alias("legal"), F.lit("").alias("gen"),
    )
    return placed.select("nome", "entidade"), rich


def _distinct_profiles(df: DataFrame) -> DataFrame:
    return df.where(F.size("tokens") > 0).select("entidade", "kind", *_FEATURES).distinct()


def _blocked(left: DataFrame, right: DataFrame, a: str, b: str, given: Broadcast | None = None) -> DataFrame:
    """(a, b, level, share) for pairs that share a block key, each judged once.

    The left side is the smaller and brings its features along; of the right side only hashes are spread by key.
    """
    spelled = F.xxhash64(F.array_join("tokens", " "), F.array_join("legal", " "), "gen").alias("_form")
    x = left.select(a, "kind", _features().alias("_a"), F.explode("keys").alias("key"))
    y = right.select(b, F.col("kind").alias("_k"), F.explode("keys").alias("key"), spelled)
    met = x.join(y, "key").where(F.col("kind") == F.col("_k")).groupBy(a, b, "_form").agg(F.first("kind").alias("kind"), F.first("_a").alias("_a"))
    both = met.join(right.select(b, spelled, _features().alias("_b")).dropDuplicates([b, "_form"]), [b, "_form"])
    return both.select(a, b, agreed(given)("kind", "_a", "_b").alias("_s")).select(a, b, "_s.*")


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(form, label): smallest form of each connected group, by spreading minima."""
    both = cut(edges.select("form", "form2").unionByName(edges.select(F.col("form2").alias("form"), F.col("form").alias("form2"))).distinct())
    labels = cut(nodes.select("form", F.col("form").alias("label")))
    while True:
        near = both.join(labels.select(F.col("form").alias("form2"), F.col("label").alias("_l")), "form2").groupBy("form").agg(F.min("_l").alias("_l"))
        hop = labels.join(near, "form", "left").select("form", "label", F.least("label", F.coalesce("_l", "label")).alias("_new"))
        # shortcut: take the label of the form one points at
        ahead = hop.select(F.col("form").alias("_new"), F.col("_new").alias("_far"))
        new = cut(hop.join(ahead, "_new", "left").select("form", "label", F.least("_new", F.coalesce("_far", "_new")).alias("_new")))
        if new.where("label != _new").isEmpty():
            return labels
        labels = new.select("form", F.col("_new").alias("label"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """(nome_a, nome_b): different names of one entity, ``nome_a`` first by code points."""
    a = linked.select(F.col("nome").alias("nome_a"), "entidade")
    b = linked.select(F.col("nome").alias("nome_b"), "entidade")
    return a.join(b, "entidade").where(F.col("nome_a") < F.col("nome_b")).select("nome_a", "nome_b").distinct()
