"""Reading level of each document from vocabulary coverage and sentence complexity."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .spelling import repair

#: Shares of a text's words that the smallest vocabulary has to cover; the first is the one reported.
SHARES = (0.75, 0.5, 0.9)
#: A word is frequent from this share of the corpus on, so there are at most 1/share frequent words.
FREQUENT = 1e-5
#: A word belongs to the vocabulary of a level from this share of its labelled documents on.
USUAL = 2e-5
#: At most about this many labelled documents calibrate, drawn by hash; up to there all labels are used.
CALIBRATING = 200_000

#: Runs of lower-case letters: Latin with accents, the scripts up to U+1FFF and from U+2C00 on, not the marks between.
_WORD = re.compile("[a-zªµº\u00df-\u00f6\u00f8-\u02af\u0370-\u1fff\u2c00-\ud7ff]+")
_TAG = re.compile(r"<[^<>]{1,200}>|&[a-z]{2,8};|https?://\S+")
_FURNITURE = re.compile(r"(?im)^.*(?:p[áa]gina \d+ de \d+|page \d+ of \d+).*$")
_PAGE = re.compile(r"(?i)(?:gina|page) \d+ (?:de|of) \d+")
_BROKEN = re.compile(r"(?<=[^\W\d_])-\n(?=[^\W\d_])")
#: Starts with one class of letters, which the search skips to.
_STOP = re.compile(r"[.!?;:\n](?:(?<!\n)[.!?;:]*(?=[\sA-ZÁÀÂÃÉÊÍÓÔÕÚÇ]|$)|(?<=\n)(?=\n|\s*[-*•]\s|\d+[.)]\s))")
# fixed values: function words that tell the two languages apart
_ENGLISH = frozenset("the of and to that which with for by is was from".split())
_PORTUGUESE = frozenset("de que do da em um uma para com os as não no na por".split())


def clean(text: str) -> str:
    """The text without markup, page headers, line-end hyphens and wrong decoding."""
    text = repair(text)
    if "<" in text or "&" in text or "http" in text:
        text = _TAG.sub(" ", text)
    if ("gina " in text or "GINA " in text or "age " in text or "AGE " in text) and _PAGE.search(text):
        text = _FURNITURE.sub(" ", text)
    return _BROKEN.sub("", text) if "-\n" in text else text


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _quantile(ordered: Sequence[int], share: float) -> int:
    return ordered[min(len(ordered) - 1, int(len(ordered) * share))] if ordered else 0


def complexity(text: str, own: list[str], seen: Counter | None = None) -> tuple[float, float, float, float, float, int]:
    """(median, upper and mean words per sentence, letters per word, commas per word, English)."""
    n = len(own)
    if not n:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0
    lengths = sorted(k for s in _STOP.split(text) if (k := len(s.split())) > 2) or [n]
    seen = Counter(own) if seen is None else seen
    english = sum(seen[w] for w in _ENGLISH) > sum(seen[w] for w in _PORTUGUESE)
    return float(_quantile(lengths, 0.5)), float(_quantile(lengths, 0.8)), sum(lengths) / len(lengths), len("".join(own)) / n, text.count(",") / n, int(english)


_MEASURES = ("frase", "frase_longa", "frase_media", "letras", "virgulas")
_READ = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("parte", T.IntegerType()), T.StructField("palavras", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in _MEASURES]
    + [T.StructField("ingles", T.IntegerType()), T.StructField("termos", T.StringType()), T.StructField("vezes", T.BinaryType())]
    + [T.StructField("grupo", T.IntegerType()), T.StructField("palavra", T.StringType()), T.StructField("n", T.LongType())]
)


def read_once(documents: DataFrame, item_id: str, text: str) -> DataFrame:
    """Every whole text read a single time, as two kinds of rows.

    With ``grupo`` null: a document's measures and its different words (``termos``,
    with their counts in ``vezes``). With ``palavra``: how often documents of a
    group have the word, counted per batch. ``documents`` has ``_grupo`` (0
    without a label) and ``_parte`` beside id and text.
    """
    import numpy as np

    def counted(seen: dict[int, Counter]) -> pd.DataFrame:
        found = [(g, w, n) for g, c in seen.items() for w, n in c.items()]
        return _typed(pd.DataFrame(found, columns=["grupo", "palavra", "n"]))

    def _typed(out: pd.DataFrame) -> pd.DataFrame:
        out = out.reindex(columns=_READ.names)
        whole = {f.name: "Int64" if f.dataType == T.LongType() else "Int32" for f in _READ if f.dataType in (T.LongType(), T.IntegerType())}
        return out.astype(whole | {n: "float64" for n in _MEASURES} | {n: "object" for n in ("termos", "vezes", "palavra")})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {}
        for batch in batches:
            rows = []
            for d, part, group, t in zip(batch[item_id], batch["_parte"], batch["_grupo"], batch[text]):
                flat = clean(t) if t else ""
                own = words(flat)
                per = Counter(own)
                seen.setdefault(int(group), Counter()).update(own)
                times = np.fromiter(per.values(), np.uint32, len(per)).tobytes() if per else None
                rows.append((None if pd.isna(d) else int(d), None if pd.isna(part) else int(part), len(own), *complexity(flat, own, per), " ".join(per) if per else None, times))
            yield _typed(pd.DataFrame(rows, columns=_READ.names[: len(_READ) - 3]))
            if sum(map(len, seen.values())) > 200_000:
                yield counted(seen)
                seen = {}
        yield counted(seen)

    return documents.select(F.col(item_id).cast("long").alias(item_id), "_parte", "_grupo", text).mapInPandas(read, _READ)


def count_ranks(counts: DataFrame) -> DataFrame:
    """(n, posto): the rank of words that occur n times; words of one count share the best rank.

    One row per distinct count. There are at most sqrt(2 * corpus words) of them,
    so the unpartitioned window runs over a small table.
    """
    by = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    above = F.sum("k").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))
    return by.select("n", (F.coalesce(above, F.lit(0)) + 1).alias("posto"))


_COVERED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("palavras", T.LongType())]
    + [T.StructField(f"cobertura{i}", T.LongType()) for i in range(len(SHARES))]
    + [T.StructField(n, T.DoubleType()) for n in _MEASURES]
    + [T.StructField("ingles", T.IntegerType()), T.StructField("frequentes", T.LongType())]
    + [T.StructField("raras", T.ArrayType(T.StringType())), T.StructField("por_nivel", T.ArrayType(T.DoubleType()))]
)


def single_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, nivel) of documents with one label, at most about ``CALIBRATING`` of them.

    Two different labels of one document tell nothing certain.
    """
    votes = labels.where("nivel is not null and doc_id is not null").groupBy("doc_id").agg(F.min("nivel").alias("nivel"), F.max("nivel").alias("_other"))
    sure = votes.where("nivel = _other").select("doc_id", F.col("nivel").cast("int").alias("nivel"))
    share = min(1.0, CALIBRATING / max(1, sure.count()))
    return sure.where(F.pmod(F.xxhash64(F.lit("label"), "doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def _ranked(counts: DataFrame, share: float) -> DataFrame:
    """(palavra, posto): the ranks of the words that make up ``share`` of all, at most 1/share of them."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.where(F.col("n") >= max(1.0, share * total)).join(count_ranks(counts), "n").select("palavra", "posto")


def profile(documents: DataFrame, labels: DataFrame | None = None, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Coverage ranks and sentence complexity of every document.

    ``coberturaN`` is the size of the smallest frequency-ranked vocabulary of the
    corpus that covers share ``SHARES[N]`` of the document's words: exact, whatever
    the corpus. Ranks of frequent words (at most ``1/FREQUENT``) are sent to the
    executors; documents in which a share ends among rarer words are looked up by
    a join of their rare words with the whole ranked vocabulary.

    ``por_nivel`` has, in order of level, the logarithm of the same size for
    ``SHARES[0]`` in the vocabulary of the documents labelled with the level. That
    vocabulary is by definition the words that make up ``USUAL`` of these
    documents; all others stand behind its last. Labelled documents fall into two
    parts with a vocabulary each: a labelled document is measured by the part that
    it is not in, any other by the mean of both, so none meets itself.
    """
    import numpy as np

    spark = documents.sparkSession
    plain = documents.select(F.col(item_id).cast("long").alias(item_id), text)
    if labels is None:
        marked = plain.withColumn("_parte", F.lit(None).cast("int")).withColumn("_grupo", F.lit(0))
    else:
        # the bounded labels go to the documents, so no text is shuffled
        part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(2)).cast("int")
        known = single_labels(labels).select(F.col("doc_id").cast("long").alias(item_id), part.alias("_parte"), "nivel")
        joined = plain.join(F.broadcast(known), item_id, "left")
        marked = joined.withColumn("_grupo", F.coalesce(2 * F.col("nivel") + F.col("_parte") + 1, F.lit(0)).cast("int")).drop("nivel")
    read = cut(read_once(marked, item_id, text))
    by_group = cut(read.where("palavra is not null").groupBy("grupo", "palavra").agg(F.sum("n").alias("n")))
    counts = cut(by_group.groupBy("palavra").agg(F.sum("n").alias("n")))
    ranks = cut(count_ranks(counts))
    groups = sorted(r.grupo for r in by_group.where("grupo > 0").select("grupo").distinct().collect())
    levels = sorted({(g - 1) // 2 for g in groups})
    columns = [_ranked(counts, FREQUENT).collect()]
    size = {}
    for level in levels:
        for k in (0, 1):
            found = _ranked(by_group.where(F.col("grupo") == 2 * level + k + 1).select("palavra", "n"), USUAL).collect()
            size[level, k] = len(found)
            columns.append(found)
    place: dict[str, int] = {}
    for column in columns:
        for r in column:
            place.setdefault(r.palavra, len(place))
    far = np.iinfo(np.int32).max
    postos = np.empty((len(columns), len(place) + 1), dtype=np.int32)
    for k, column in enumerate(columns):
        postos[k] = far if k == 0 else len(column) + 1
        for r in column:
            postos[k, place[r.palavra]] = r.posto
    del columns
    # a level of which one part has no document is measured by the other one
    usable = [[k for k in (0, 1) if size[level, k]] for level in levels]
    shared = spark.sparkContext.broadcast((place, postos))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, table = shared.value
        other = len(where)
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                measures = [getattr(r, n) for n in (*_MEASURES, "ingles")]
                if not r.palavras:
                    rows.append((r.doc_id, 0, *[0] * len(SHARES), *measures, 0, None, [0.0] * len(levels)))
                    continue
                terms, times = r.termos.split(" "), np.frombuffer(r.vezes, np.uint32)
                places = np.fromiter((where.get(w, other) for w in terms), np.int64, len(terms))
                every = np.repeat(places, times)
                n = len(every)
                at = [min(n - 1, int(n * s)) for s in SHARES]
                ordered = np.partition(table[0, every], at)
                covered = [None if (v := int(ordered[k])) == far else v for k in at]
                frequent, rare = n, None
                if None in covered:
                    unknown = table[0, places] == far
                    frequent = n - int(times[unknown].sum())
                    rare = sorted(w for w, t, u in zip(terms, times, unknown) if u for _ in range(t))
                by_level = np.log1p(np.partition(table[1:, every], at[0], axis=1)[:, at[0]]).reshape(-1, 2) if levels else []
                own = None if pd.isna(r.parte) else int(r.parte)
                seen = [float(np.mean([v[k] for k in ([1 - own] if own is not None and 1 - own in use else use)])) for v, use in zip(by_level, usable)]
                rows.append((r.doc_id, n, *covered, *measures, frequent, rare, seen))
            out = pd.DataFrame(rows, columns=_COVERED.names)
            yield out.astype({f"cobertura{i}": "Int64" for i in range(len(SHARES))})

    described = cut(read.where("palavra is null").select("doc_id", "parte", "palavras", *_MEASURES, "ingles", "termos", "vezes").mapInPandas(describe, _COVERED))
    shared.destroy()
    rare = described.where("raras is not null").select(F.xxhash64("doc_id", "raras").alias("_k"), "doc_id", "palavras", "frequentes", "raras").dropDuplicates(["_k"])
    spelled = rare.select("_k", F.explode("raras").alias("palavra")).join(counts, "palavra").join(ranks, "n")
    ordered = spelled.groupBy("_k").agg(F.array_sort(F.collect_list("posto")).alias("_postos"))
    both = described.withColumn("_k", F.when(F.col("raras").isNotNull(), F.xxhash64("doc_id", "raras"))).join(ordered, "_k", "left")

    def covered(i: int, share: float):
        at = F.least(F.col("palavras") - 1, F.floor(F.col("palavras") * F.lit(share))) - F.col("frequentes")
        return F.coalesce(f"cobertura{i}", F.get("_postos", at.cast("int"))).alias(f"cobertura{i}")

    return both.select("doc_id", "palavras", *[covered(i, s) for i, s in enumerate(SHARES)], *_MEASURES, "ingles", "por_nivel")


_COVERAGE = ["ln(1 + cobertura0)"]
_LOGS = ["ln(1 + frase)", "ln(1 + frase_longa)", "ln(1 + frase_media)", "ln(1 + letras)", "ln(0.005 + virgulas)"]


def calibrated(
    profiles: DataFrame, labels: DataFrame, rounds: int = 3, doubt: float = 0.03, features: Sequence[str] = ("corpus", "levels", "sentences")
) -> DataFrame:
    """(doc_id, nivel, confianca): the most probable level of every profiled document.

    Features are the logs of the coverage rank in the corpus vocabulary, of that in
    every level's vocabulary and of the sentence measures. Per language and level, SQL sums over all labelled
    documents give their mean and covariance; a document's level maximises the normal
    density times the level's share. Labels to which the first fit gives less than
    ``doubt`` are taken for errors and left out of the next. What reaches the
    driver is one row of sums per language and level.
    """
    import numpy as np

    parts = {"corpus": F.array(*[F.expr(e) for e in _COVERAGE]), "levels": F.col("por_nivel"), "sentences": F.array(*[F.expr(e) for e in _LOGS])}
    logs = F.concat(*[parts[f] for f in features])
    x = profiles.where("palavras > 0").select("doc_id", "ingles", logs.alias("x"))
    marked = cut(x.join(single_labels(labels), "doc_id"))
    first = marked.first()
    d = len(first["x"]) if first else 0
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    model: list[tuple] = []
    for _ in range(max(1, rounds) if first else 0):
        kept = marked if not model else _scored(marked, model).where(F.element_at("p", F.col("nivel").cast("string")) > doubt)
        sums = kept.groupBy("ingles", "nivel").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)], *products).collect()
        model = _normal(sums, d, np)
    if not model:
        return x.select("doc_id", F.lit(None).cast("long").alias("nivel"), F.lit(None).cast("double").alias("confianca"))
    scored = _scored(x, model).withColumn("_best", F.array_max(F.transform(F.map_entries("p"), lambda e: F.struct(e["value"].alias("v"), (-e["key"].cast("int")).alias("l")))))
    return scored.select("doc_id", (-F.col("_best.l")).cast("long").alias("nivel"), F.col("_best.v").alias("confianca"))


def _normal(sums: list, d: int, np) -> list[tuple]:
    """(english, level, log weight, mean, inverse covariance, log determinant) from sums.

    Groups too small for a covariance of their own lean on the pooled one.
    """
    def moments(rows):
        n = sum(r["n"] for r in rows)
        s = np.array([sum(r[f"s{i}"] for r in rows) for i in range(d)])
        m = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                m[i, j] = m[j, i] = sum(r[f"p{i}_{j}"] for r in rows)
        return n, s / n, m / n - np.outer(s / n, s / n)

    if not sums:
        return []
    pooled = moments(sums)[2]
    out = []
    total = {e: sum(r["n"] for r in sums if r["ingles"] == e) for e in (0, 1)}
    everywhere = sum(total.values())
    for e in (0, 1):
        for level in sorted({r["nivel"] for r in sums}):
            own = [r for r in sums if r["ingles"] == e and r["nivel"] == level] or [r for r in sums if r["nivel"] == level]
            n, mean, cov = moments(own)
            lean = min(1.0, 0.05 + 2.0 * d / n)
            v = (1 - lean) * cov + lean * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
            weight = n / (total[e] if own[0]["ingles"] == e and total[e] else everywhere)
            out.append((e, level, float(np.log(weight)), mean.tolist(), np.linalg.inv(v).tolist(), float(np.linalg.slogdet(v)[1])))
    return out


def _scored(x: DataFrame, model: list[tuple]) -> DataFrame:
    """Adds ``p``, a map from level (text) to probability.

    Every log density is a quadratic form, so it is the inner product of fixed
    coefficients with the products of two features, evaluated in SQL.
    """
    d = len(model[0][3])
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    coefficients: dict[int, list[str]] = {0: [], 1: []}
    for e, _, weight, mean, inverse, det in model:
        slope = [sum(inverse[i][j] * mean[j] for j in range(d)) for i in range(d)]
        constant = weight - 0.5 * det - 0.5 * sum(slope[i] * mean[i] for i in range(d))
        squares = [-(0.5 if i == j else 1.0) * inverse[i][j] for i, j in pairs]
        coefficients[e].append("array(" + ", ".join(f"{c!r}D" for c in [constant, *slope, *squares]) + ")")
    levels = sorted({m[1] for m in model})
    products = F.array(F.lit(1.0), *[F.col("x")[i] for i in range(d)], *[F.col("x")[i] * F.col("x")[j] for i, j in pairs])
    chosen = f"case when ingles = 1 then array({', '.join(coefficients[1])}) else array({', '.join(coefficients[0])}) end"
    inner = "aggregate(zip_with(c, _q, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    raw = x.withColumn("_q", products).withColumn("_l", F.expr(f"transform({chosen}, c -> {inner})"))
    raw = raw.withColumn("_e", F.expr("transform(_l, v -> exp(v - array_max(_l)))"))
    share = F.expr("transform(_e, v -> v / aggregate(_e, 0D, (a, b) -> a + b))")
    return raw.withColumn("p", F.map_from_arrays(F.array(*[F.lit(str(n)) for n in levels]), share)).drop("_q", "_l", "_e")


def reading_levels(documents: DataFrame, labels: DataFrame, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, nivel, confianca, cobertura, palavras, frase) of every document with words.

    Edge cases: documents with null or empty text, or text without letters, have
    no level and do not come out; repeated rows come out as often as they go in;
    without labels the level is null; documents with two different labels do not
    calibrate; any length of text is read whole; further columns are never read.
    """
    profiles = cut(profile(documents, labels, item_id, text))
    levels = calibrated(profiles.dropDuplicates(["doc_id"]), labels)
    seen = profiles.where("palavras > 0").select("doc_id", F.col("cobertura0").alias("cobertura"), "palavras", "frase")
    return seen.join(levels, "doc_id")
