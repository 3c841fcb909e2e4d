import pytest

from veredas.llm import names as nm
from veredas.llm.names import link_spellings, name_pairs
from veredas.llm.spelling import agreement, apart, block_keys, initials_code, parse, sound


def test_edit_distance_matches_brute_force():
    import itertools

    def full(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    texts = ["".join(p) for n in range(5) for p in itertools.product("ab", repeat=n)]
    for a in texts:
        for b in texts:
            assert apart(a, b, 2) == min(full(a, b), 3)


def test_edit_distance_of_long_words_with_typos_at_both_ends():
    import random

    def full(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    def typo(w, i):
        return rnd.choice([w[:i] + w[i + 1 :], w[:i] + "X" + w[i:], w[:i] + "X" + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])

    assert apart("XBCDEFGHIY", "ABCDEFGHIZ") == 2
    rnd = random.Random(7)
    for n in range(10, 31):
        for _ in range(40):
            a = "".join(rnd.choices("ABCDEFGH", k=n))
            b = typo(typo(a, rnd.randrange(3)), n - 1 - rnd.randrange(2, 5))
            c = typo(b, rnd.randrange(n - 2))
            for most in (1, 2, 3):
                assert apart(a, b, most) == min(full(a, b), most + 1) and apart(a, c, most) == min(full(a, c), most + 1)


@pytest.mark.parametrize("name, hint, kind", [("Outros", "", "x"), ("OUTR0S", "", "x"), ("Ações em Tesouraria", "", "x"), ("Estado de Altavia", "", "x"), ("União Federal", "", "x"), ("", "", "x"), ("...", "", "x"), ("Ana Lima", "", "p"), ("Alfa Energia", "", "o"), ("Alfa S.A.", "", "o")])
def test_kinds(name, hint, kind):
    assert parse(name, hint)[0] == kind


@pytest.mark.parametrize("kind, a, b, level", [
    ("p", "SERGIO LEANDRO BRUNIQUAL BREPOQUEIRA", "Sérgio L. Bruniqual Brepokeira", 2), ("p", "JOSE VINICIUS CARUDAL", "JUCA VINICIUS CARUDAL", 2), ("p", "Brepoqueira, Simone Teresa", "SIMONE TERESA BREPOQUEIRA", 2),
    ("p", "VITÓRIA JULIANA BECUVOTE", "VitÃ³ria Juliana Becuvote", 2), ("p", "DIEGO BRADEVARESRUTUBANA", "DIEGO BRADEVARES RUTUBANA", 2), ("p", "ANA NULUZARES DUNUDOTE", "ANA DUNUDOTE", 1),
    ("p", "ANA LIMA FILHO", "ANA LIMA NETO", 0), ("p", "JOAO SILVA", "JOAO SOUZA", 0),
    ("o", "RIRALIS AGROPECUARIA SOCIEDADE ANONIMA", "Riralis Agrop. S.A.", 2), ("o", "COMPANHIA CIPIDU DE PARTICIPACOES", "CIPIDU PARTICIPACOES CIA", 2), ("o", "GRINEZEN SANEAMENTO INTERNACIONAL V SA", "Grinezen Saneamento Int'l V S.A.", 2),
    ("o", "GIFUSCIA SIDERURGIA VI LTDA", "GIFUSCIA SIDERURGIA V LTDA", 0), ("o", "DELALEN PARTNERS TRUST", "DELALEN PARTNERS B.V.", 1), ("o", "DIGAKAX QUIMICA LTDA", "RISETRA QUIMICA LTDA", 0),
])
def test_agreement(kind, a, b, level):
    x, y = parse(a, kind), parse(b, kind)
    got = agreement(kind, x[1], y[1], x[2], y[2], x[3], y[3])[0]
    assert got == level if level else got < 2


def test_full_agreement_up_to_one_letter_shares_a_block():
    for a, b in [("ANA DUNUDOTE", "ANA DUNUDOTEE"), ("ANA DUNUDOTE", "ANA DUNUDTE"), ("CARLA LUCIA TOGREMEIRA", "C. LUCIA TOGREMEIRA"), ("LUIZ LEPEMIQUE FAREZOTE", "LUIZ FAREZOTE LEPEMIQUE"), ("ANA BELA LIMAO", "ANABELA LIMAO")]:
        assert set(block_keys("p", parse(a, "p")[1])) & set(block_keys("p", parse(b, "p")[1])), (a, b)
    for a, b in [("RIRALIS AGROPECUARIA SA", "RIRALS AGROP. SA"), ("RIRALIS AGROPECUARIA SA", "RIRALIS AGROPECUARIA")]:
        assert set(block_keys("o", parse(a, "o")[1])) & set(block_keys("o", parse(b, "o")[1])), (a, b)


def test_sound_and_code():
    assert sound("PHELIPPE") == sound("FELIPE") and sound("BREPOKEIRA") == sound("BREPOQUEIRA")
    assert initials_code("Dávadex Farmacêutica do Vale S.A.") == "DFV DAV" and initials_code("Alfa") == ""


def linked(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "nome string, documento string, hint string, entidade int")
    out = link_spellings(df, "nome", "documento", "hint")
    return {tuple(sorted(g)) for g in out.toPandas().groupby("entidade")["nome"].agg(list)}


def test_merge_and_rematch(spark):
    rows = [
        ("F. OTAVIO TEDERTIQUE LACEBIM", "***331486**", "p"), ("FERNANDO TEDERTIQUE LACEBIM", "33333148600", "p"),
        ("Fernando Otávio Tedertique Lacebim", None, "p"),  # agrees with the merged profile only
        ("MARIA SOUZA PRATES", "***111111**", "p"), ("MARIA SOUZA PRATES", "***222222**", "p"), ("Maria Souza Prates", None, "p"),  # homonyms: fits two
        ("VIVO UM DOIS TRES", "***331486**", "p"),  # a stranger under the same digits
        ("LOSOLEN INVESTMENTS BV", None, ""), ("Losolen Investments B.V.", None, ""), ("LOSOLEN INVESTMENTS EUROPE BV", None, ""),
        ("ALFA ENERGIA SA", "11111111000191", "o"), ("NOVO NOME SA", "11111111000272", "o"), ("Outros", None, ""), (None, "***1**", "p"), ("", None, ""), ("ALFA ENERGIA SA", "11111111000191", "o"),
    ]
    assert linked(spark, rows) == {
        ("F. OTAVIO TEDERTIQUE LACEBIM", "FERNANDO TEDERTIQUE LACEBIM", "Fernando Otávio Tedertique Lacebim"), ("MARIA SOUZA PRATES",), ("Maria Souza Prates",), ("VIVO UM DOIS TRES",),
        ("LOSOLEN INVESTMENTS BV", "Losolen Investments B.V."), ("LOSOLEN INVESTMENTS EUROPE BV",), ("ALFA ENERGIA SA", "NOVO NOME SA"),
    }


def test_pairs_and_empty(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "1"), ("c", "1"), ("a", "2"), ("b", "2"), ("z", "3")], "nome string, entidade string")
    assert sorted(tuple(r) for r in name_pairs(df).collect()) == [("a", "b"), ("a", "c"), ("b", "c")]
    assert linked(spark, []) == set()


def test_a_document_of_too_many_names_identifies_nobody(spark, monkeypatch):
    monkeypatch.setattr(nm, "MAX_SPELLINGS_OF_DOCUMENT", 3)
    rows = [(f"PESSOA {w} LIMAO", "***000001**", "p") for w in ("ABELARDO", "BONIFACIO", "CLEMENTE", "DOROTEU")] + [("Pessoa Abelardo Limão", None, "p")]
    got = linked(spark, rows)
    assert ("PESSOA ABELARDO LIMAO", "Pessoa Abelardo Limão") in got and len(got) == 4


def test_long_names_do_not_break(spark):
    words = ["".join(chr(65 + (i * k) % 26) for k in range(1, 8)) for i in range(3000)]
    long_, other, compact = " ".join(words), " ".join(reversed(words)), "A" * 60_000
    rows = [(n, "***123456**", "p") for n in (long_, other, compact, "ANA LIMAO")] + [(long_.lower(), None, "p"), (long_ + " SA", None, ""), (other + " LTDA", None, "o"), (compact + " SA", None, "o")]
    groups = linked(spark, rows)
    assert {n for g in groups for n in g} == {r[0] for r in rows}
    assert any(long_ in g and long_.lower() in g for g in groups)


def test_documents_of_many_spellings_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(nm, "MAX_SPELLINGS_OF_DOCUMENT", 2)
    firm = ("ALFA ENERGIA SA", "NOVO NOME LTDA", "Belamon Tecidos", "R. Quimera Total", "CORATIX MINERACAO SA")
    person = ("FERNANDO OTAVIO TEDERTIQUE LACEBIM", "FERNANDO TEDERTIQUE LACEBIM")
    got = linked(spark, [(n, "11111111000191", "o") for n in firm] + [(n, "***331486**", "p") for n in (*person, "VIVO UM DOIS TRES")])
    assert tuple(sorted(firm)) in got and tuple(sorted(person)) in got
    assert ("VIVO UM DOIS TRES",) in got


def test_a_profile_that_has_grown_does_not_win_over_one_that_fitted_as_well(spark):
    rows = [("MARIA SOUZA PRATES", "***111111**", "p"), ("MARIA SOUZA PRATES", "***222222**", "p"), ("MARIQUINHA SOUZA PRATES", "***222222**", "p"), ("Maria Souza Prates", None, "p")]
    for more in ([], [("Mariquinha Souza Prates", None, "p")]):
        groups = linked(spark, rows + more)
        assert ("Maria Souza Prates",) in groups


def test_equal_letters_win_over_a_misspelling(spark):
    rows = [("ANA PAULA LIMAO", "***111111**", "p"), ("ANA PAULA LIMEO", "***222222**", "p"), ("Ana Paula Limão", None, "p")]
    assert ("ANA PAULA LIMAO", "Ana Paula Limão") in linked(spark, rows)


def test_two_given_names_are_no_misspelling(spark):
    known = [(f"{g} {w} BREPOQUE", f"***{n:06d}**", "p") for n, (g, w) in enumerate((g, w) for g in ("PAULO", "PAULA", "MARIO", "MARIA") for w in ("TULEM", "DACOR", "VIBES", "NOFUZ", "GERAM", "LAVIT"))]
    alone = [(n, None, "p") for n in ("PAULO SANTOS", "PAULA SANTOS", "Paulo Santoz", "MARIO ALVES COSTA", "MARIA ALVES COSTA", "MARIA ALVES KOSTA")]
    groups = linked(spark, known + alone)
    assert {("PAULO SANTOS", "Paulo Santoz"), ("PAULA SANTOS",), ("MARIO ALVES COSTA",), ("MARIA ALVES COSTA", "MARIA ALVES KOSTA")} <= groups
    # a misspelling that no one bears stays one
    assert ("PAULU SANTOS", "PAULO SANTOS") in groups or tuple(sorted(("PAULO SANTOS", "PAULU SANTOS"))) in linked(spark, known + [("PAULO SANTOS", None, "p"), ("PAULU SANTOS", None, "p")])


def test_names_without_document_merge_and_are_matched_again(spark):
    # two pairs of complementary initials make the same whole name, which alone links them
    one, two, three = "F. OTAVIO TEDERTIQUE LACEBIM", "FERNANDO O. TEDERTIQUE LACEBIM", "FERNANDO OTAVIO TEDERTIQUE LACEBIM"
    assert linked(spark, [(one, None, "p"), (two, None, "p")]) == {(one, two)}
    assert linked(spark, [(one, None, "p"), (two, None, "p"), (three, "***331486**", "p")]) == {tuple(sorted((one, two, three)))}
    # the merged name singles out a profile that neither spelling does
    rows = [("F. OTAVIO T. LACEBIM BRUNIQUAL", None, "p"), ("FERNANDO O. TEDERTIQUE LACEBIM BRUNIQUAL", None, "p")]
    profiles = [("FERNANDO OTAVIO TEDERTIQUE LACEBIM BRUNIQUAL", "***111111**", "p"), ("FABIO OTAVIO TUREM LACEBIM BRUNIQUAL", "***222222**", "p"), ("FERNANDO OSMAR TEDERTIQUE LACEBIM BRUNIQUAL", "***333333**", "p")]
    assert tuple(sorted((rows[0][0], rows[1][0], profiles[0][0]))) in linked(spark, rows + profiles)


def test_the_number_of_spellings_of_a_masked_document_changes_no_link(spark, monkeypatch):
    names = ["PESSOA ABELARDO LIMAO", "PESSOA BONIFACIO LIMAO", "P. ABELARDO LIMAO", "FERNANDO OTAVIO TEDERTIQUE LACEBIM", "F. OTAVIO TEDERTIQUE LACEBIM", "VIVO UM DOIS TRES"]
    rows = [(n, "***331486**", "p") for n in names] + [("Pessoa Abelardo Limão", None, "p"), ("VIVO UM DOIS TRES", "***222222**", "p")]
    few = linked(spark, rows)
    monkeypatch.setattr(nm, "MAX_SPELLINGS_OF_DOCUMENT", 2)
    assert linked(spark, rows) == few
    assert any("PESSOA ABELARDO LIMAO" in g and "PESSOA BONIFACIO LIMAO" in g for g in few) is False
