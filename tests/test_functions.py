from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from veredas.functions import documents as d
from veredas.functions import graph as g
from veredas.functions import hygiene as h
from veredas.functions import names as n

NBSP, TAB = " ", "\t"


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f("x").alias("y")).first().y


@pytest.mark.parametrize("f, value, want", [
    (h.clean_string, " \n a b\t", "a b"), (h.clean_string, "   ", None), (h.clean_string, None, None),
    (h.to_int64, " 12 ", 12), (h.to_int64, "12.7", None), (h.to_int64, "x", None), (h.to_int64, "99999999999999999999", None), (h.to_int64, None, None),
    (h.to_float64, "5d", None), (h.to_float64, "1e3", 1000.0), (h.to_float64, "-.5", -0.5), (h.to_float64, "", None),
    (h.to_numeric, "12.345", Decimal("12.345000000")), (h.to_numeric, "abc", None),
    (h.parse_br_numeric, "1.234.567,89", Decimal("1234567.890000000")), (h.parse_br_numeric, "1234567.89", Decimal("1234567.890000000")), (h.parse_br_numeric, "", None),
    (h.to_date, "2025-01-31", date(2025, 1, 31)), (h.to_date, "31/01/2025", date(2025, 1, 31)), (h.to_date, "20250131", date(2025, 1, 31)), (h.to_date, "01-31-2025", date(2025, 1, 31)),
    (h.to_date, "2025", None), (h.to_date, "31/02/2025", None), (h.to_date, "2025-13-01", None), (h.to_date, "", None), (h.to_date_yyyymmdd, "2025-01-31", None),
    (lambda c: h.padded_code(c, 2), "5", "05"), (lambda c: h.padded_code(c, 2), "123", "12"), (lambda c: h.padded_code(c, 2), "-", None),
    (h.short_number, "36.7000", "36.7"), (h.short_number, "100", "100"), (h.short_number, "0.00001", "1e-05"), (h.short_number, "12345678", "1.23457e+07"), (h.short_number, None, None),
    (d.cnpj14, "12.345.678/0001-95", "12345678000195"), (d.cnpj14, "191", "00000000000191"), (d.cnpj14, "00000000000000", None), (d.cnpj14, "", None), (d.cnpj14, "123456789012345", None),
    (d.cnpj8, "00000000", "00000000"), (d.cnpj8, "1", "00000001"), (d.cnpj8, "123456789", None),
    (d.identifying_document, "***222333**", "***222333**"), (d.identifying_document, "111.222.333-44", "11122233344"), (d.identifying_document, "00000000000000", "00000000000000"), (d.identifying_document, " ", None),
    (d.is_cnpj14, None, False), (d.is_cnpj14, "00000000000000", False), (d.is_cnpj14, "00000000000191", True), (d.is_cpf11, "***222333**", False), (d.is_placeholder_cnpj, None, False),
    (d.cpf_mask6, "11122233344", "222333"), (d.cpf_mask6, "***222333**", "222333"), (d.cpf_mask6, "12", None), (d.prefix8_from_cnpj14, "123", None),
    (d.person_id_from_cpf, "11122233344", "p-ebdca308"), (d.person_id_from_cpf, "22233344455", "p-baf57df5"), (d.person_id_from_cpf, "33344455566", "p-466f22cf"),
    (n.company_key, "Cia. Água & Luz S/A", "COMPANHIAAGUAELUZSA"), (n.company_key, None, ""), (n.company_key, "CIA CIA X", "COMPANHIACIAX"),
    (n.person_key, " João  das-Dores ", "JOAO DAS DORES"), (n.person_key, None, ""), (n.fold_upper, "União", "UNIAO"),
    (n.strip_legal_suffix, "ALFALTDA", "ALFA"), (n.text_before_dash, "A - B - C", "A"), (n.first_parenthetical, "A (B) (C)", "B"), (n.first_parenthetical, "A", ""),
    (g.relation, "socio", "SOCIO"), (g.relation, "x", "VINCULO"), (g.node_label, "outros", "Parada"),
])
def test_value(spark, f, value, want):
    assert one(spark, f, value) == want


def test_company_key_takes_overlapping_spaces_once(spark):
    # two CIA in a row share a blank, so the second one stays, as in the SQL form
    assert one(spark, n.company_key, "X CIA CIA Y") == "XCOMPANHIACIAY"


def test_tokens_and_edits(spark):
    df = spark.createDataFrame([("ANA LIMA", "ANA B LIMA"), ("ANA LIMA", "ANA LIMO"), ("A", "B")], "a string, b string")
    got = df.select(n.tokens_contained("a", "b"), n.within_edits("a", "b", 2), n.token_count("b"), n.first_token("b"), n.last_token("b")).collect()
    assert [tuple(r) for r in got] == [(True, True, 3, "ANA", "LIMA"), (False, True, 2, "ANA", "LIMO"), (False, True, 1, "B", "B")]


def test_edge_names(spark):
    df = spark.createDataFrame([("socio", "qsa", None, None), ("acionista", "fre", 36.7, 1.0), ("acionista_controlador", "fre", None, 50.0), ("outro", "fre", None, None)], "p string, f string, o double, t double")
    assert [r[0] for r in df.select(g.edge_name("p", "f", "o", "t")).collect()] == ["sócio · QSA · sem %", "acionista · FRE · 36.7% ON", "controlador · FRE · 50% total", "outro · FRE"]


def test_origin_id(spark):
    df = spark.createDataFrame([("11122233344", "Ana", "1"), (None, "Ana Lima", "2")], "d string, n string, c string")
    assert [r[0] for r in df.select(n.person_origin_id("d", "n", "c")).collect()] == ["p-ebdca308", "nome:ANA LIMA@2"]
    assert df.select(F.count("d")).first()[0] == 1
