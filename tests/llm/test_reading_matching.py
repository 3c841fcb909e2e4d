import random
from collections import Counter

from pyspark.sql import functions as F

from veredas.llm import reading as rd
from veredas.llm.matching import BANDS, bands_of, candidates, company_name, match_companies, near_keys
from veredas.llm.reading import calibrated, clean, profile, reading_levels, words

DOCS = "doc_id long, text string, source string"


def test_cleaning():
    assert clean("<p>Olá</p>\nPágina 8 de 24 - documento\nfim com-\nposto").split() == ["Olá", "fim", "composto"]
    assert words("ÁGUA e 3 peixes_x") == ["água", "e", "peixes", "x"]


def test_coverage_is_exact_with_and_without_rare_words(spark, monkeypatch):
    rnd = random.Random(4)
    vocabulary = [chr(97 + i % 26) * (1 + i // 26) for i in range(120)]
    texts = [" ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(120)], k=rnd.randrange(0, 80))) for _ in range(60)] + [None, "", "123", "Z" * 70_000]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    count = Counter(w for t in texts if t for w in words(t))
    by = Counter(count.values())
    rank, at = {}, 1
    for n in sorted(by, reverse=True):
        rank[n], at = at, at + by[n]
    for share in (1e-5, 0.02, 0.9):
        monkeypatch.setattr(rd, "FREQUENT", share)
        got = {r.doc_id: (r.palavras, [r.cobertura0, r.cobertura1, r.cobertura2]) for r in profile(df).collect()}
        for i, t in enumerate(texts):
            ranks = sorted(rank[count[w]] for w in words(t or ""))
            want = [ranks[min(len(ranks) - 1, int(len(ranks) * s))] if ranks else 0 for s in rd.SHARES]
            assert got[i] == (len(ranks), want), (i, share)


def test_levels_on_held_out_documents(spark):
    rnd = random.Random(6)
    easy, hard = ["casa", "dono", "pão", "vila", "tem", "viu"], [f"palavra{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]

    def text(level):
        pool = easy if level < 3 else hard
        return " ".join(" ".join(rnd.choices(pool, k=rnd.randrange(3, 6) * (1 if level in (1, 3) else 4))).capitalize() + "." for _ in range(12))

    level = {i: 1 + i % 4 for i in range(400)}
    df = spark.createDataFrame([(i, text(n), "s") for i, n in level.items()], DOCS)
    labels = spark.createDataFrame([(i, n if i % 20 else 1 + n % 4, "a") for i, n in level.items() if i < 200], "doc_id long, nivel long, anotador string")
    got = {r.doc_id: r.nivel for r in reading_levels(df, labels).collect()}
    assert sum(got[i] == level[i] for i in range(200, 400)) >= 190


def test_levels_edge_cases(spark):
    df = spark.createDataFrame([(1, "um dois três. quatro", "s"), (1, "um dois três. quatro", "s"), (2, None, "s"), (3, "", "s"), (4, "12 34", "s")], DOCS)
    none = spark.createDataFrame([], "doc_id long, nivel long")
    assert sorted((r.doc_id, r.nivel) for r in reading_levels(df, none).collect()) == [(1, None), (1, None)]
    two = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (2, None)], "doc_id long, nivel long")
    assert {r.nivel for r in reading_levels(df, two).collect()} == {None}
    assert reading_levels(df.limit(0), two).count() == 0
    assert calibrated(profile(df), two).where(F.col("nivel").isNotNull()).count() == 0


BRANDS = "BELAMON CORATIX DUVELAN FANTARU GILOMEX HORUTAN JASPERO KALUMIN LAVERTO MONTARE NUVALIX OPERAN PILAREX QUIMERA RUBITAN SOLAREN TAVUNEX URBELAN VITOREX ZELARIN".split()
SECTORS = "ENERGIA ALIMENTOS MINERACAO SEGUROS".split()


def tables(spark):
    rf, cvm, rank = [], [], []
    n = 0
    for b in BRANDS:
        for s in SECTORS:
            for r in ("", " DO SUL"):
                n += 1
                rf.append((f"{n:08d}", f"{b} {s}{r} LTDA"))
                typed = f"{b[:4]}{b[5:]} {s.title()}{r.title()} Ltda."
                cvm.append((f"{n:06d}", f"{n:08d}000100" if n % 7 else None, typed, [f"{b.title()} {s[:5].title()}.", typed, None][n % 3], ["SP", "RJ", None][n % 3], s.title()))
                if n % 4 == 0:
                    rank.append((n, f"Grupo {b.title()}", f"{b.title()} {s.title()}{r.title()} Limitada" if n % 8 else f"{b.title()[:3]}{b.title()[4:]} {s.title()}{r.title()} Ltda", ["SP", "RJ", None][n % 3], s.title()))
    rank += [(9001, "Desconhecida", "DESCONHECIDA TOTAL SA", "SP", None), (9002, None, None, None, None), (9003, "Belamon", "Belamon Tecidos do Vale SA", "AC", None), (4, *rank[0][1:])]
    return (
        spark.createDataFrame([(*r, 1) for r in rank], "posicao long, nome string, razao_social string, sede_uf string, setor string, chave int"),
        spark.createDataFrame([*rf, *rf[:3], (None, "X"), ("99999999", None)], "cnpj_basico string, razao_social string"),
        spark.createDataFrame(cvm, "id_cvm string, id_cnpj string, razao_social string, nome_comercial string, sigla_uf string, setor_atividade string"),
    )


def test_matching_recovers_companies(spark):
    rank, rf, cvm = tables(spark)
    got = match_companies(rank, rf, cvm).where("confianca >= 0.5").toPandas()
    known = {p for p in range(4, 161, 4)}
    right = {int(r.posicao) for r in got.itertuples() if r.tabela == "stg_rf_empresa" and int(r.chave) == r.posicao}
    wrong = [r for r in got.itertuples() if r.tabela == "stg_rf_empresa" and int(r.chave) != r.posicao]
    assert len(right) >= 0.9 * len(known) and len(wrong) <= 2
    assert not set(got.posicao) & {9001, 9002}
    listed = {int(r.posicao) for r in got.itertuples() if r.tabela == "stg_cvm_cia_aberta" and int(r.chave) == r.posicao}
    assert len(listed) >= 0.85 * len(known)
    assert got.duplicated(["posicao", "tabela", "chave"]).sum() == 0


def test_reliability_counts_the_held_out_companies(spark):
    from veredas.llm.matching import reliability

    got = reliability(*tables(spark)).toPandas()
    assert len(got) and got.n.sum() > 0 and got.certos.between(0, 1).all() and got.confianca.between(0, 1).all()


def test_a_trade_name_of_its_own_is_an_alias(spark):
    rank, rf, cvm = tables(spark)
    more = spark.createDataFrame([("888888", "00000001000100", "BELAMON ENERGIA LTDA", "Marca Xilopan", None, None)], cvm.schema)
    asked = spark.createDataFrame([(8001, "Marca Xilopan", None, None, None, 1)], rank.schema)
    got = match_companies(rank.unionByName(asked), rf, cvm.unionByName(more)).where("posicao = 8001").collect()
    assert ("stg_rf_empresa", "00000001") in {(r.tabela, r.chave) for r in got}


def test_matching_with_long_names(spark):
    rank, rf, cvm = tables(spark)
    long_ = " ".join("".join(chr(65 + (i * k) % 26) for k in range(1, 8)) for i in range(2000))
    extra = spark.createDataFrame([(7001, long_, long_ + " SA", None, None, 1), (7002, "B" * 60_000, None, None, None, 1)], rank.schema)
    more = spark.createDataFrame([("77777777", long_ + " S.A."), ("77777778", "B" * 60_000)], rf.schema)
    got = match_companies(rank.unionByName(extra), rf.unionByName(more), cvm).toPandas()
    assert ((got.posicao == 7001) & (got.chave == "77777777")).any()


def test_matching_of_empty_tables(spark):
    rank, rf, cvm = tables(spark)
    assert match_companies(rank.limit(0), rf, cvm).count() == 0
    assert match_companies(rank, rf.limit(0), cvm.limit(0)).count() == 0


def test_bands_recall_of_near_brands(spark):
    from itertools import product

    near = [b[:i] + b[i + 1 :] for b, i in product(BRANDS, (2, 4))]
    rows = spark.createDataFrame([(x,) for x in [*BRANDS, *near]], "b string").select("b", bands_of("b").alias("k")).collect()
    keys = {r.b: set(r.k) for r in rows}
    assert all(len(k) <= BANDS for k in keys.values())
    met = [bool(keys[b] & keys[b[:i] + b[i + 1 :]]) for b, i in product(BRANDS, (2, 4))]
    assert sum(met) / len(met) >= 0.9


def met(spark, typed, registered):
    """The registered names that each typed name meets."""
    none = F.lit(None).cast("string")
    q = spark.createDataFrame([(i, n) for i, n in enumerate(typed)], "posicao long, _short_text string").withColumn("_long_text", none)
    q = q.withColumn("_short", company_name("_short_text")).withColumn("_long", company_name("_long_text"))
    r = spark.createDataFrame([(str(i), n) for i, n in enumerate(registered)], "ent string, _alias string").withColumn("_name", company_name("_alias"))
    got = candidates(q, "posicao", r, "ent").collect()
    return {n: {x._alias for x in got if x.posicao == i} for i, n in enumerate(typed)}


def test_brands_two_letters_off_or_swapped_are_candidates(spark):
    registered = ["NOFUZU ENERGIA SA", "DABEKON SA", "TIRVO LTDA", "BELAMON TEXTIL", "QUIMERA BANCO SA"]
    got = met(spark, ["Noufzu Energia", "DBAEKON", "Trivo", "Belomin", "Qumiear"], registered)
    assert [registered[i] in g for i, g in enumerate(got.values())] == [True] * 5


def test_near_keys_are_exact():
    from veredas.llm.spelling import apart

    rnd = random.Random(5)
    for n in range(2, 40):
        for _ in range(60):
            b = c = "".join(rnd.choices("ABCDEFG", k=n))
            for _ in range(2):
                i = rnd.randrange(len(c))
                c = rnd.choice([c[:i] + c[i + 1 :], c[:i] + rnd.choice("XYA") + c[i:], c[:i] + rnd.choice("XYA") + c[i + 1 :], c[:i] + c[i : i + 2][::-1] + c[i + 2 :]]) or "A"
            if len(c) > 1 and apart(b, c) <= (1 if n < 6 else 2):
                assert near_keys(b, True) & near_keys(c, False), (b, c)


def test_a_brand_of_many_aliases_is_met_without_a_shared_word(spark):
    registered = ["BELAMON ENERGIA SA", "BELAMON ALIMENTOS SA", "BELAMON SEGUROS LTDA", "BELAMON"]
    got = met(spark, ["Belamon", "Belamon Mineracao", "Belamon Energia"], registered)
    assert list(got.values()) == [set(registered)] * 3


def test_no_side_of_the_candidates_is_built_on_the_driver(spark):
    none = F.lit(None).cast("string")
    q = spark.createDataFrame([(1, "Noufzu Energia")], "posicao long, _short_text string").withColumn("_long_text", none)
    q = q.withColumn("_short", company_name("_short_text")).withColumn("_long", company_name("_long_text"))
    r = spark.createDataFrame([("1", "NOFUZU ENERGIA SA"), ("2", "NOFUZU ENERGIA SA")], "ent string, _alias string").withColumn("_name", company_name("_alias"))
    got = candidates(q, "posicao", r, "ent")
    assert {x.ent for x in got.collect()} == {"1", "2"}
    # brands look small until their keys are made of them
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
