import __spark_entry__ as e


def test_found_columns(spark, data):
    want = {
        "p1_found": ["nome_a", "nome_b"], "p3_found": ["origem_id", "cnpj", "campo", "id_vinculo"], "p6_found": ["posicao", "tabela", "chave"], "p10_found": ["doc_id", "nivel"],
    }
    for name, columns in want.items():
        assert e.queries()[name](spark, data).columns == columns


def test_other_queries_run(spark, data):
    for name in ("p8_aproveitamento", "p9_participacoes"):
        assert e.queries()[name](spark, data).count() > 0


def test_p3_found_runs_no_stage_that_its_rows_do_not_need(spark, data):
    plan = e.queries()["p3_found"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
