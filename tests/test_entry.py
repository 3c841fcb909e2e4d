import __spark_entry__ as e


def test_entry_runs(spark):
    df = e.entry(spark)
    assert df.columns == ["cnpj", "raiz", "profundidade", "caminho", "ciclo", "no_ciclo"] and df.count() >= 0


def test_every_query_is_named_once_and_sql_belongs_to_one():
    names = e.queries()
    assert set(e.oracle_sql()) <= set(names)
    assert {"p2_found", "p4_found", "p5_found", "p7_found"} <= set(names)


def test_found_columns(spark, data):
    want = {
        "p2_found": ["data", "cnpj_basico", "documento", "mudanca"], "p4_found": ["cnpj", "raiz", "profundidade"],
        "p5_found": ["tabela", "cnpj_basico", "documento", "valido_de", "valido_ate"], "p7_found": ["campo", "id_vinculo", "periodo", "situacao"],
    }
    for name, columns in want.items():
        assert e.queries()[name](spark, data).columns == columns
