"""Plain-Python name handling shared by the linking operators; runs inside Arrow UDFs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import lru_cache
from itertools import combinations

# --- fixed values -----------------------------------------------------------
PARTICLES = frozenset("DE DA DO DOS DAS E DI DEL D".split())
GENERATION = {"JR": "JUNIOR", "JUNIOR": "JUNIOR", "FILHO": "FILHO", "FO": "FILHO", "NETO": "NETO", "NT": "NETO", "SOBRINHO": "SOBRINHO", "SOB": "SOBRINHO"}
#: Common Brazilian short forms and the given names they stand for.
NICKNAMES = {
    "ZE": "JOSE", "JUCA": "JOSE", "ZECA": "JOSE", "CHICO": "FRANCISCO", "KIKO": "FRANCISCO", "QUICO": "FRANCISCO", "CHICA": "FRANCISCA",
    "TONHO": "ANTONIO", "TONINHO": "ANTONIO", "TONICO": "ANTONIO", "TOTO": "ANTONIO", "TONINHA": "ANTONIA", "BETO": "ROBERTO", "BETINHO": "ROBERTO",
    "CADU": "RICARDO CARLOS", "CACA": "CARLOS", "CARLINHOS": "CARLOS", "CACAU": "CARLA CLAUDIA", "CLAUDINHO": "CLAUDIO", "CEICA": "CONCEICAO",
    "CIDA": "APARECIDA", "CIDINHA": "APARECIDA", "CRIS": "CRISTINA CRISTIANE", "DANI": "DANIEL DANIELA", "DADA": "ADRIANA", "DRI": "ADRIANA",
    "DUDA": "EDUARDO EDUARDA", "DUDU": "EDUARDO", "EDU": "EDUARDO", "FAFA": "FABIO RAFAELA", "FE": "FERNANDA FELIPE", "FER": "FERNANDO FERNANDA", "NANDO": "FERNANDO", "NANDA": "FERNANDA",
    "LIPE": "FELIPE", "GABI": "GABRIELA", "BIEL": "GABRIEL", "GERALDINHO": "GERALDO", "GUGA": "GUSTAVO", "GUTO": "AUGUSTO GUSTAVO", "GUI": "GUILHERME",
    "RIQUE": "HENRIQUE", "LENA": "HELENA", "BEL": "ISABEL", "BELINHA": "ISABEL", "JAO": "JOAO", "JOCA": "JOAO", "JOAOZINHO": "JOAO", "JONI": "JOAO",
    "QUINCAS": "JOAQUIM", "QUIM": "JOAQUIM", "ZEFA": "JOSEFA", "JU": "JULIA JULIANA", "LALA": "LARISSA", "LARI": "LARISSA", "LEO": "LEONARDO LEANDRO",
    "LULA": "LUIZ", "LUIZINHO": "LUIZ", "LU": "LUCIA LUCIANA LUANA", "LUCI": "LUCIA", "MANE": "MANOEL", "MANECO": "MANOEL", "MARIQUINHA": "MARIA", "MARIAZINHA": "MARIA",
    "MARI": "MARIANA", "MARCINHA": "MARCIA", "MARCELINHO": "MARCELO", "TETEU": "MATEUS", "MUNDICO": "RAIMUNDO", "MUNDINHO": "RAIMUNDO", "NINO": "ANTONIO", "PATI": "PATRICIA",
    "PAULINHO": "PAULO", "PEDRINHO": "PEDRO", "PEPE": "PEDRO", "RAFA": "RAFAEL", "RO": "ROSANGELA RODRIGO", "DIGO": "RODRIGO RODOLFO", "ROSINHA": "ROSA", "SERGINHO": "SERGIO",
    "TIAO": "SEBASTIAO", "TECA": "TERESA", "TETE": "TERESINHA TERESA", "TERE": "TERESA TERESINHA", "TATI": "TATIANA", "TITI": "TIAGO", "VAVA": "VALTER", "VINI": "VINICIUS", "VITINHO": "VITOR",
    "VIVI": "VITORIA VIVIANE", "BIA": "BEATRIZ", "CATA": "CATARINA", "ALE": "ALEXANDRE", "XANDE": "ALEXANDRE", "CAROL": "CAROLINA", "CAMI": "CAMILA", "NENE": "MANOEL", "NINA": "CATARINA",
    "NANA": "MARIANA", "NATI": "NATALIA", "TUCA": "ARTUR", "VERINHA": "VERA", "ZUZU": "ZULEICA", "WAL": "WALQUIRIA", "BENE": "BENEDITO", "DEDE": "ANDRE", "DECO": "ANDRE", "DINHO": "EDSON", "LELE": "LETICIA HELENA",
}
LEGAL = {
    "SA": "SA", "LTDA": "LTDA", "LIMITADA": "LTDA", "LTD": "LTD", "CIA": "SA", "COMPANHIA": "SA", "COMP": "SA", "EIRELI": "EIRELI", "ME": "ME", "EPP": "EPP",
    "LLC": "LLC", "BV": "BV", "LP": "LP", "FUND": "LP", "FD": "LP", "TRUST": "TRUST", "TR": "TRUST", "HOLDINGS": "LTD", "HLDGS": "LTD", "INC": "INC", "CORP": "INC", "SPE": "SPE", "LDA": "LTDA",
}
#: Activity and region words of company names; what is left over is the brand.
GENERAL = frozenset(
    """ADMINISTRADORA BENS AGROPECUARIA AGRO ALIMENTOS ATLANTIC CAPITAL CELULOSE COMERCIO CONCESSOES CONSTRUCOES EDUCACAO EMPREENDIMENTOS
    ENERGIA FARMACEUTICA GLOBAL IMOBILIARIOS INDUSTRIA INVESTMENTS LATICINIOS MEDICOS MINERACAO OVERSEAS PAPEL PARTICIPACOES PARTNERS QUIMICA
    RODOVIARIAS SANEAMENTO SEGUROS SERVICOS SIDERURGIA TECIDOS TECNOLOGIA TELECOMUNICACOES TRANSPORTES VEICULOS AMAZONIA BRASIL CENTRO OESTE
    INTERNACIONAL INTERNATIONAL LITORAL NORTE MINEIRA NORDESTE PAULISTA PLANALTO SUL VALE AMERICAS EUROPE GRUPO BANCO COOPERATIVA TEXTIL SAUDE
    LOGISTICA METALURGIA PETROLEO GAS HOTEIS TURISMO VAREJO MAQUINAS EQUIPAMENTOS INVESTIMENTOS GESTAO HOLDING SAO""".split()
)
REGIONS = frozenset("AMAZONIA BRASIL CENTRO OESTE INTERNACIONAL INTERNATIONAL LITORAL NORTE MINEIRA NORDESTE PAULISTA PLANALTO SUL VALE AMERICAS EUROPE".split())
SHORT = {"BR": "BRASIL", "BRAS": "BRASIL", "INTL": "INTERNACIONAL", "NE": "NORDESTE", "SP": "PAULISTA", "MG": "MINEIRA", "CO": "CENTRO", "TELECOM": "TELECOMUNICACOES"}
ROMAN = {"I": "1", "II": "2", "III": "3", "IV": "4", "V": "5", "VI": "6", "VII": "7", "VIII": "8", "IX": "9", "X": "10"}
OTHER_HOLDERS = ("OUTROS", "OUTROSACIONISTAS", "DEMAISACIONISTAS", "OUTROSSOCIOS", "TESOURARIA", "ACOESEMTESOURARIA", "ACOESTESOURARIA", "ACOESEMCIRCULACAO")
PUBLIC_BODIES = re.compile(r"^(ESTADO D[EOA]S? |MUNICIPIO |PREFEITURA |GOVERNO |MINISTERIO |REPUBLICA |UNIAO$|UNIAO FEDERAL|TESOURO NACIONAL|FAZENDA NACIONAL|SECRETARIA D|DISTRITO FEDERAL)")
NOTES = re.compile(r"\(.*?\)|\s-\s*(?:EM (?:LIQUIDACAO|RECUPERACAO).*|MATRIZ|FILIAL.*|ME|EPP)\s*$|\bEM (?:LIQUIDACAO|RECUPERACAO JUDICIAL)\b.*$")
FULL_FORMS = (
    (re.compile(r"\bSOCIEDADE ANONIMA\b"), " SA "), (re.compile(r"\bS\s?[./]?\s?A\b\.?"), " SA "), (re.compile(r"\bB\.?\s?V\b\.?"), " BV "),
    (re.compile(r"\bL\.?\s?P\b\.?"), " LP "), (re.compile(r"\bL\.?L\.?C\b\.?"), " LLC "), (re.compile(r"\bLIMITED LIABILITY (?:COMPANY|CO)\b"), " LLC "),
    (re.compile(r"\bLIMITED PARTNERSHIP\b"), " LP "), (re.compile(r"\bHOLDINGS LIMITED\b"), " HOLDINGS LTD "), (re.compile(r"\bC[I1]A\b"), " CIA "), (re.compile(r"\bINT'?L\b"), " INTL "), (re.compile(r"&"), " E "),
)
_SOUNDS = (("PH", "F"), ("TH", "T"), ("QU", "K"), ("CK", "K"), ("Y", "I"), ("W", "V"), ("C", "K"), ("Q", "K"), ("Z", "S"), ("RN", "M"), ("X", "S"))
_JOINABLE = sorted([*(w for w in GENERAL if len(w) >= 6), "COMPANHIA", "LTDA", "EIRELI"], key=lambda w: (-len(w), w))
_OCR = str.maketrans("015834", "OISBEA")
# -----------------------------------------------------------------------------


def repair(text: str) -> str:
    """Undo UTF-8 read as Latin-1 where that gives valid text."""
    if "Ã" in text or "Â" in text:
        for wrong in ("latin-1", "cp1252"):
            try:
                return text.encode(wrong).decode("utf-8")
            except UnicodeError:
                continue
    return text


def fold(text: str) -> str:
    flat = unicodedata.normalize("NFKD", repair(text))
    return "".join(c for c in flat if not unicodedata.combining(c)).upper()


@lru_cache(maxsize=200_000)
def sound(token: str) -> str:
    """A key under which usual respellings of one word fall together."""
    for a, b in _SOUNDS:
        token = token.replace(a, b)
    out = []
    for c in token:
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


@lru_cache(maxsize=400_000)
def apart(a: str, b: str, most: int = 2) -> int:
    """Edit distance with transpositions, or ``most + 1`` where it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return min(max(len(a), len(b)), most + 1)
    # cells further than ``most`` from the diagonal are larger than it
    far, n = most + 1, len(b)
    before, row = None, [min(y, far) for y in range(n + 1)]
    older = [far] * (n + 1)
    for x in range(1, len(a) + 1):
        low, high = max(1, x - most), min(n, x + most)
        new, older = older, before or [far] * (n + 1)
        new[low - 1] = x if low == 1 and x <= most else far
        least = new[low - 1]
        for y in range(low, high + 1):
            d = min(row[y] + 1, new[y - 1] + 1, row[y - 1] + (a[x - 1] != b[y - 1]), far)
            if before is not None and y > 1 and a[x - 1] == b[y - 2] and a[x - 2] == b[y - 1]:
                d = min(d, before[y - 2] + 1)
            new[y] = d
            least = min(least, d)
        if high < n:
            new[high + 1] = far
        if least > most:
            return far
        before, row = row, new
    return min(row[-1], far)


def tolerance(n: int) -> int:
    return 0 if n < 4 else 1 if n < 8 else 2


@lru_cache(maxsize=100_000)
def _lost_space(word: str) -> tuple[str, ...]:
    """A word that runs into a general or legal word is taken apart."""
    if len(word) < 8 or word in GENERAL or not word.isalpha():
        return (word,)
    for known in _JOINABLE:
        if word.endswith(known) and len(word) - len(known) >= 2:
            return (*_lost_space(word[: -len(known)]), known)
        if word.startswith(known) and len(word) - len(known) >= 4:
            return (known, *_lost_space(word[len(known) :]))
    return (word,)


def parse(name: str, hint: str = "") -> tuple[str, list[str], list[str], str]:
    """(kind, tokens, legal forms, generation) of a typed name.

    kind: ``p`` person, ``o`` organisation, ``x`` no entity (other holders,
    treasury shares, public bodies, empty). ``hint`` is ``p``, ``o`` or empty.
    """
    flat = re.sub(r"\s+", " ", fold(name)).strip()
    if not flat:
        return "x", [], [], ""
    compact = re.sub(r"[^A-Z]", "", flat.translate(_OCR))
    if PUBLIC_BODIES.match(flat) or any(apart(compact, o) <= tolerance(len(o)) for o in OTHER_HOLDERS):
        return "x", [], [], ""
    reordered = flat
    if hint != "o" and flat.count(",") == 1:
        last, first = flat.split(",")
        reordered = f"{first.strip()} {last.strip()}"
    text = NOTES.sub(" ", reordered)
    if hint != "p":
        for pattern, full in FULL_FORMS:
            text = pattern.sub(full, text)
    words = []
    for w in re.findall(r"[A-Z0-9]+", text.replace("'", "")):
        if any(c.isalpha() for c in w) and any(c.isdigit() for c in w):
            w = w.translate(_OCR)
        words.append(w)
    if hint != "p" and len(words) > 1 and words[-1] not in LEGAL:
        near = [k for k in ("LTDA", "LIMITADA", "EIRELI", "TRUST", "HOLDINGS") if apart(words[-1], k) <= 1]
        words[-1:] = near[:1] or words[-1:]
    if hint != "p" and len(words) > 1 and len(words[0]) > 6 and apart(words[0], "COMPANHIA") <= 2:
        words[0] = "COMPANHIA"
    if hint != "p":
        words = [part for w in words for part in _lost_space(w)]
    legal = [LEGAL[w] for w in words if w in LEGAL]
    kind = hint or ("o" if legal or any(w in GENERAL for w in words) else "p")
    if kind == "p":
        generation = next((GENERATION[w] for w in words[1:] if w in GENERATION), "")
        tokens = [sound(w) for i, w in enumerate(words) if w not in PARTICLES and not (i and (w in GENERATION or _like_particle(w)))]
        return ("p", tokens, [], generation) if tokens else ("x", [], [], "")
    tokens = []
    for i, w in enumerate(words):
        w = SHORT.get(w, w)
        if w in LEGAL or w in PARTICLES:
            continue
        tokens.append(ROMAN[w] if i and w in ROMAN else sound(w) if w.isalpha() else w)
    return ("o", tokens, sorted(set(legal)), "") if tokens else ("x", [], [], "")


def _like_particle(word: str) -> bool:
    """A particle with a letter too many or out of place, such as DSO or DOPS."""
    return 2 < len(word) < 5 and word[0] == "D" and any(apart(word, p, 1) <= 1 for p in ("DO", "DA", "DE", "DOS", "DAS"))


_NICK = {sound(k): {sound(x) for x in v.split()} for k, v in NICKNAMES.items()}
_GENERAL = frozenset(sound(w) for w in GENERAL)
_REGIONS = frozenset(sound(w) for w in REGIONS)

#: Names of more tokens than this, and pairs of names with more pairs of tokens, are handled as long texts.
LONG_NAME, LONG_PAIRS = 12, 4_000
#: A given name is known from this many names on; two are told apart if neither is this many times commoner.
LEAST_GIVEN, COMMONER = 5, 50
#: strength of one aligned token
EQUAL, TYPO, NICK, CUT, INITIAL = 4, 3, 3, 2, 1


@lru_cache(maxsize=400_000)
def alike(a: str, b: str, abbreviations: bool) -> int:
    """How strongly two tokens agree; 0 if not."""
    if a == b:
        return EQUAL if len(a) > 1 else INITIAL
    if a.isdigit() or b.isdigit():
        return 0
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) == 1:
        return INITIAL if long_[0] == short else 0
    if long_ in _NICK.get(short, ()) or short in _NICK.get(long_, ()):
        return NICK
    if apart(a, b) <= tolerance(min(len(a), len(b))) and (len(short) > 4 or a[0] == b[0]):
        return TYPO
    if len(long_) >= len(short) + 2 and long_.startswith(short) and len(short) >= (2 if abbreviations else 4):
        return CUT
    if abbreviations and len(short) >= 3 and long_[0] == short[0] and long_ in _GENERAL and _subsequence(short, long_):
        return CUT
    return 0


def _subsequence(short: str, long_: str) -> bool:
    it = iter(long_)
    return all(c in it for c in short)


def align(a: list[str], b: list[str], abbreviations: bool = False) -> tuple[list[tuple[int, int, int]], int, int]:
    """Greedy best pairing of tokens: [(i, j, strength)], unpaired of a, unpaired of b.

    Texts far longer than names (over ``LONG_PAIRS`` pairs of tokens) are paired by equal tokens only.
    """
    if len(a) * len(b) > LONG_PAIRS:
        places: dict[str, list[int]] = {}
        for j, y in enumerate(b):
            places.setdefault(y, []).append(j)
        equal = [(i, places[x].pop(0), EQUAL) for i, x in enumerate(a) if places.get(x)]
        return equal, len(a) - len(equal), len(b) - len(equal)
    pairs = sorted(((s, -abs(i - j), i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (s := alike(x, y, abbreviations))), reverse=True)
    left, right, out = set(range(len(a))), set(range(len(b))), []
    for s, _, i, j in pairs:
        if i in left and j in right:
            left.discard(i)
            right.discard(j)
            out.append((i, j, s))
    return out, len(left), len(right)


def _compact_distance(a: list[str], b: list[str]) -> int:
    """Letters between two names written without spaces, in the order typed or with their words sorted; 3 stands for more than two."""
    x, y = "".join(a), "".join(b)
    if min(len(x), len(y)) < 8:
        return 0 if x == y else 3
    far = apart(x, y)
    return far if not far else min(far, apart("".join(sorted(a)), "".join(sorted(b))))


def brand_first(tokens: list[str]) -> list[str]:
    own = [t for t in tokens if t not in _GENERAL and not t.isdigit() and len(t) > 2]
    return own or tokens[:1]


def two_given_names(a: list[str], b: list[str], given: Mapping[str, int]) -> bool:
    """Whether tokens that pass for misspellings of each other are two given names in their own right.

    ``given`` has how many names begin with a token. A misspelling is far rarer
    than the name it stands for, so both must be usual.
    """
    for i, j, s in align(a, b)[0]:
        if s == TYPO and a[i] != b[j]:
            rare, usual = sorted((given.get(a[i], 0), given.get(b[j], 0)))
            if rare >= LEAST_GIVEN and rare * COMMONER >= usual:
                return True
    return False


def agreement(
    kind: str, a: list[str], b: list[str], legal_a: list[str] = (), legal_b: list[str] = (), gen_a: str = "", gen_b: str = "", given: Mapping[str, int] | None = None
) -> tuple[int, float]:
    """(level, share): level 2 the names agree in full, 1 they are compatible, 0 they are not.

    The same letters in the same order have share 1. Persons of whom one given name
    is turned into another one by a letter (``given``) never agree in full.
    """
    if not a or not b:
        return 0, 0.0
    if kind == "o":
        pairs, ua, ub = align(a, b, True)
        strong = [(i, j) for i, j, s in pairs if s >= TYPO]
        brands_a, brands_b = brand_first(a), brand_first(b)
        brand = any(a[i] in brands_a and b[j] in brands_b for i, j in strong)
        weight = sum(s for *_, s in pairs) / (EQUAL * max(len(a), len(b)))
        digits = {t for t in a if t.isdigit()} == {t for t in b if t.isdigit()}
        if digits and (far := _compact_distance(a, b)) <= 2:
            return (2 if _legal_fits(legal_a, legal_b) else 1), max(weight, 0.9 if far else 1.0)
        if not brand:
            return 0, weight
        if not ua and not ub and _legal_fits(legal_a, legal_b):
            return 2, weight
        return (1 if min(ua, ub) <= 1 and len(pairs) > ua + ub - 1 else 0), weight
    if (far := _compact_distance(a, b)) <= 2:
        full = gen_a == gen_b and not (far and given and two_given_names(a, b, given))
        return (2 if full else 1), (1.0 if a == b or "".join(a) == "".join(b) else 0.97 - 0.01 * far)
    pairs, ua, ub = align(a, b)
    full = [p for p in pairs if p[2] >= TYPO]
    weight = sum(s for *_, s in pairs) / (EQUAL * max(len(a), len(b)))
    if gen_a and gen_b and gen_a != gen_b:
        return 0, weight
    if not ua and not ub and len(full) >= 2 and gen_a == gen_b:
        return (1 if given and two_given_names(a, b, given) else 2), weight
    least = min(ua, ub)
    if least == 0 and full and (len(full) >= 2 or any(len(a[i]) > 4 and len(b[j]) > 4 for i, j, _ in full) and len(pairs) >= 2):
        return 1, weight
    if least <= 1 and len(full) >= 2:
        return 1, weight
    return 0, weight


def trigrams(tokens: list[str]) -> set[str]:
    text = "".join(tokens)
    return {text[i : i + 3] for i in range(max(1, len(text) - 2))}


def same_bearer(kind: str, a: list[str], b: list[str], *more) -> bool:
    """Whether two names seen with one masked document are one bearer's.

    Half a document leaves room for strangers, so the names must be compatible or
    share half their letter trigrams.
    """
    return bool(agreement(kind, a, b, *more)[0]) or share_trigrams(a, b)


def share_trigrams(a: list[str], b: list[str]) -> bool:
    """Half of all trigrams, or 0.7 of the shorter name's; so two thirds of the smaller set are shared at least."""
    x, y = trigrams(a), trigrams(b)
    return 2 * len(x & y) >= len(x) + len(y) - len(x & y) or len(x & y) >= 0.7 * min(len(x), len(y))


def _legal_fits(a: list[str], b: list[str]) -> bool:
    return not a or not b or bool(set(a) & set(b))


def _shorter(token: str) -> list[str]:
    """The token and, from five letters on (up to 40), every form with one letter left out."""
    return [token] if not 5 <= len(token) <= 40 else [token, *{token[:i] + token[i + 1 :] for i in range(len(token))}]


def _rest(tokens: list[str], used: tuple[int, ...]) -> list[str]:
    """Sorted initials of the tokens not used, and the same with one of them left out."""
    letters = sorted(t[0] for i, t in enumerate(tokens) if i not in used)
    return ["".join(letters), *{"".join(letters[:i] + letters[i + 1 :]) for i in range(len(letters))}]


def block_keys(kind: str, tokens: list[str]) -> list[str]:
    """Keys that two names share if they agree in full up to a typo or a lost token.

    Organisations: a brand token with at most one letter out, and the initials of
    the rest with at most one out. Persons: two tokens and the rest's initials;
    with two or three tokens also one whole token and the other with a letter out.
    Every name also has all its letters, against lost spaces. Names of over
    ``LONG_NAME`` tokens go by their longest ones, without the rest.
    """
    keys = {f"{kind}:=" + "".join(tokens)}
    if len(tokens) > LONG_NAME:
        longest = sorted(set(tokens), key=lambda t: (-len(t), t))[:LONG_NAME]
        if kind == "o":
            keys.update(f"o:{v}/#" for t in longest for v in _shorter(t))
        else:
            keys.update(f"p:{a}+{b}/#" for a, b in combinations(sorted(longest), 2))
        return list(keys)
    if kind == "o":
        for i, t in enumerate(tokens):
            if t in brand_first(tokens):
                rests = _rest(tokens, (i,))
                for v in _shorter(t):
                    keys.update(f"o:{v}/{r}" for r in rests)
        return list(keys)
    known = [min(_NICK[t]) if t in _NICK and len(_NICK[t]) == 1 else t for t in tokens]
    whole = [i for i, t in enumerate(known) if len(t) > 1]
    for x in range(len(whole)):
        for y in range(x + 1, len(whole)):
            i, j = whole[x], whole[y]
            rests = _rest(known, (i, j))
            a, b = sorted((known[i], known[j]))
            keys.update(f"p:{a}+{b}/{r}" for r in rests)
            if len(known) <= 3:
                for v in _shorter(a)[1:]:
                    keys.update(f"p:{v}-{b}/{r}" for r in rests[:1])
                    keys.add(f"p:{v}+{b}/{rests[0]}")
                for v in _shorter(b)[1:]:
                    keys.update((f"p:{a}+{v}/{rests[0]}",))
    return list(keys)


def merged_tokens(rich: list[str], others: list[list[str]]) -> list[str]:
    """``rich`` with its initials replaced by the whole tokens that other spellings have there."""
    out = list(rich)
    for o in others:
        for i, j, _ in align(out, o)[0]:
            if len(out[i]) == 1 and len(o[j]) > 1:
                out[i] = o[j]
    return out


Meanings = frozenset[str]


def company_parts(tokens: list[str]) -> tuple[list[str], set[Meanings], set[Meanings], set[str]]:
    """(brand, activities, regions, numbers) of an organisation's tokens.

    Besides the brand every token that abbreviates or misspells general words
    counts as those words; an abbreviation of several words keeps them all.
    """
    brand, activity, region, numbers = [], set(), set(), set()
    for i, t in enumerate(tokens):
        if t.isdigit():
            numbers.add(t)
            continue
        known = general_forms(t) if i or len(tokens) > 1 else frozenset()
        if not known:
            brand.append(t)
        elif known & _REGIONS:
            region.add(known & _REGIONS)
            if known - _REGIONS:
                activity.add(known - _REGIONS)
        elif "GRUPO" not in known:
            activity.add(known)
    return brand or tokens[:1], activity, region, numbers


def unmatched(a: set[Meanings], b: set[Meanings]) -> int:
    """How many words of ``a`` no word of ``b`` can mean."""
    return sum(not any(x & y for y in b) for x in a)


@lru_cache(maxsize=100_000)
def general_forms(token: str) -> Meanings:
    """The general words that a token is, shortens or misspells."""
    if token in _GENERAL:
        return frozenset((token,))
    if len(token) >= 5:
        near = frozenset(g for g in _GENERAL if len(g) >= 5 and g[0] == token[0] and apart(token, g) <= (1 if len(g) < 9 else 2))
        if near:
            return near
    if 2 <= len(token) <= 7:
        return frozenset(g for g in _GENERAL if len(g) >= len(token) + 2 and g.startswith(token))
    return frozenset()


def initials_code(name: str) -> str:
    """The form ``ABC DEF`` by which firms are listed: initials of the words, then the brand's first letters."""
    flat = [w for w in re.findall(r"[A-Z][A-Z'-]*", NOTES.sub(" ", fold(name)).replace(".", " ")) if w not in PARTICLES and w not in LEGAL and w not in ("S", "A")]
    own = [w for w in flat if w not in ROMAN or w == flat[0]]
    if len(own) < 2:
        return ""
    brand = next((w for w in own if w not in GENERAL), own[0])
    return "".join(w[0] for w in own) + " " + brand[:3]
