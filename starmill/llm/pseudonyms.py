"""Format-preserving pseudonyms for personal data, in SQL expressions alone.

Candidates are found by one pattern and validated: card numbers by their check digit, IBANs by
theirs, addresses of machines by range, social security numbers and dates by what exists, phone
numbers by length, mail addresses by form.  A valid value is taken apart into symbols (digits,
letters, octets, or the parts of a day's number), which a keyed Feistel network permutes: one half
of the symbols is shifted, symbol by symbol, by a hash of the key, the round and the other half, in
turns.  Each shift can be undone, so distinct values stay distinct, equal values get equal
pseudonyms in all documents, and the result has the same format; check digits are computed anew.

What is not valid stays as it is.  Documents without a digit or an at sign are not searched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import text_of

KINDS = ("mail", "iban", "ip", "date", "ssn", "phone", "card")
ROUNDS = 10
#: Days repeat after 400 years; 189 * 773 = 146097 days, so day numbers are pairs of symbols.
CYCLE, DAY_RADIX = 146097, (189, 773)
#: A date stays within its cycle; one begins on the first day of 1800, this many days before 1970.
BEFORE_1970 = 62091

#: Lengths of IBANs by country, those in use without being registered included.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    """An IBAN of a known length, in groups of four or in one."""
    whole, rest = divmod(length - 4, 4)
    last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{whole}}}{last}"


_IBANS = "|".join(_iban(*known) for known in IBAN_LENGTHS.items())
_COUNTRIES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")

PATTERN = "|".join(
    (
        # Possessive groups repeat without recursion.  A mail name has at most 64 characters.
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        rf"(?<![A-Za-z0-9])(?:{_IBANS})(?![A-Za-z0-9])",
        # Other countries and lengths; what follows may be an IBAN of a known length.
        rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?: ?(?!(?<= )(?:{_COUNTRIES})[0-9]{{2}})[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])",
        r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
        r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9]|[./-][0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
        r"(?<![0-9+])(?:\+1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        r"(?<![0-9+])\+[0-9](?:[ .-]?\(?[0-9]\)?){7,14}(?![0-9])",
        r"(?<![0-9(])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])",
        r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])",
    )
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _chars(value: str) -> str:
    return f"transform(sequence(1, greatest(length({value}), 1)), i -> substr({value}, i, 1))"


# --- validation ----------------------------------------------------------------------------


def _luhn_sum(digits: str, doubled: int) -> str:
    """Sum for the check digit, the last digit doubled or not; digits of doubled digits are added."""
    n = f"length({digits})"
    return (
        f"aggregate(sequence(1, {n}), 0, (s, i) -> s + CASE WHEN ({n} - i) % 2 = {doubled} "
        f"THEN int(substr({digits}, i, 1)) * 2 - IF(int(substr({digits}, i, 1)) > 4, 9, 0) ELSE int(substr({digits}, i, 1)) END)"
    )


def _mod97(value: str) -> str:
    """Remainder by 97 of letters and digits read as one number, A as 10."""
    return (
        f"aggregate({_chars(value)}, 0, (s, c) -> IF(c >= 'A', (s * 100 + ascii(c) - 55) % 97, (s * 10 + int(c)) % 97))"
    )


_DATE = (
    "CASE WHEN substr(m, 5, 1) = '-' THEN try_to_timestamp(m, 'yyyy-MM-dd') "
    "WHEN substr(m, 3, 1) = '/' AND substr(m, 6, 1) = '/' THEN coalesce(try_to_timestamp(m, 'MM/dd/yyyy'), try_to_timestamp(m, 'dd/MM/yyyy')) "
    "WHEN substr(m, 3, 1) = '.' AND substr(m, 6, 1) = '.' THEN try_to_timestamp(m, 'dd.MM.yyyy') END"
)
_LAYOUT = (
    "CASE WHEN substr(m, 5, 1) = '-' THEN 'yyyy-MM-dd' WHEN substr(m, 3, 1) = '.' THEN 'dd.MM.yyyy' "
    "WHEN try_to_timestamp(m, 'MM/dd/yyyy') IS NOT NULL THEN 'MM/dd/yyyy' ELSE 'dd/MM/yyyy' END"
)


def _kind() -> str:
    """The kind of match ``m`` when it is valid, else null."""
    plain, d = "regexp_replace(m, ' ', '')", _digits("m")
    iban = _mod97(f"concat(substr({plain}, 5), substr({plain}, 1, 4))")
    return f"""CASE
        WHEN instr(m, '@') > 0 THEN 'mail'
        WHEN m RLIKE '^[A-Z]' THEN CASE WHEN length({plain}) BETWEEN 15 AND 34 AND {iban} = 1 THEN 'iban' END
        WHEN m RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' THEN CASE WHEN forall(split(m, '[.]'), o -> int(o) < 256) THEN 'ip' END
        WHEN m RLIKE '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}[/.][0-9]{{2}}[/.][0-9]{{4}})$' THEN CASE WHEN {_DATE} IS NOT NULL THEN 'date' END
        WHEN m RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN CASE WHEN NOT m RLIKE '^(000|666|9)|-00-|0000$' THEN 'ssn' END
        WHEN m RLIKE '^[+(]' OR m RLIKE '^[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}$' THEN CASE WHEN length({d}) BETWEEN 8 AND 15 THEN 'phone' END
        WHEN {_luhn_sum(d, 1)} % 10 = 0 AND NOT {d} RLIKE '^([0-9])\\\\1*$' THEN 'card'
    END"""


# --- permutation ---------------------------------------------------------------------------


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` under a name, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _shifted(part: str, radix: str, other: str, key: str) -> str:
    """The symbols of ``part``, each shifted by hashed bits of the other half, modulo its radix."""
    digest = f"sha2(concat_ws('|', {key}, r, i div 8, array_join(transform({other}, y -> string(y)), ',')), 256)"
    number = f"bigint(conv(substr({digest}, 8 * (i % 8) + 1, 8), 16, 10))"
    return f"transform({part}, (x, i) -> int(pmod(x + {number}, element_at({radix}, i + 1))))"


def feistel(symbols: str, radix: str, key: str) -> str:
    """SQL for the permuted symbols; both arguments are arrays of ints of one length."""
    def parts(array: str) -> tuple[str, str]:
        return f"slice({array}, 1, size({array}) div 2)", f"slice({array}, size({array}) div 2 + 1, size({array}) - size({array}) div 2)"

    (left, right), (left_radix, right_radix) = parts("f"), parts("q")
    rounds = (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('a', {left}, 'b', {right}), (s, r) -> IF(r % 2 = 1, "
        f"named_struct('a', {_shifted('s.a', left_radix, 's.b', key)}, 'b', s.b), "
        f"named_struct('a', s.a, 'b', {_shifted('s.b', right_radix, 's.a', key)})), s -> concat(s.a, s.b))"
    )
    return _let("f", symbols, _let("q", radix, rounds))


def _permuted_text(value: str, letters: bool, key: str) -> str:
    """``value`` with its digits, and its letters where asked, permuted; other characters keep their places."""
    wanted = "[0-9A-Za-z]" if letters else "[0-9]"
    held = f"filter({_chars(value)}, c -> c RLIKE '{wanted}')"
    symbols = f"transform({held}, c -> CASE WHEN c <= '9' THEN int(c) WHEN c <= 'Z' THEN ascii(c) - 65 ELSE ascii(c) - 97 END)"
    radix = f"transform({held}, c -> IF(c <= '9', 10, 26))"
    written = "CASE WHEN c <= '9' THEN string(element_at(p, s.k)) WHEN c <= 'Z' THEN char(65 + element_at(p, s.k)) ELSE char(97 + element_at(p, s.k)) END"
    filled = (
        f"aggregate({_chars(value)}, named_struct('t', '', 'k', 1), (s, c) -> IF(c RLIKE '{wanted}', "
        f"named_struct('t', concat(s.t, {written}), 'k', s.k + 1), named_struct('t', concat(s.t, c), 'k', s.k)), s -> s.t)"
    )
    return _let("p", feistel(symbols, radix, key), filled)


def _pseudonym(key: str) -> str:
    """The pseudonym of match ``m`` of kind ``k``."""
    d = _digits("m")

    def of(kind: str) -> str:
        return _quoted(f"{key}|{kind}")

    card = _let(
        "w",
        _permuted_text(f"substr({d}, 1, length({d}) - 1)", False, of("card")),
        _let("w", f"concat(w, string(pmod(-({_luhn_sum('w', 0)}), 10)))", _fill("m", "w")),
    )
    bare = "regexp_replace(m, ' ', '')"
    iban = _let(
        "w",
        _permuted_text(f"substr({bare}, 5)", True, _quoted(f"{key}|iban")),
        _let("w", f"concat(substr(m, 1, 2), lpad(string(98 - {_mod97('concat(w, substr(m, 1, 2), chr(48), chr(48))')}), 2, '0'), w)", _fill("m", "w", "[A-Z0-9]")),
    )
    ip = f"array_join(transform({feistel('transform(split(m, chr(92) || chr(46)), o -> int(o))', 'array(256, 256, 256, 256)', of('ip'))}, o -> string(o)), '.')"
    parts = "array(int(substr(m, 1, 3)), int(substr(m, 5, 2)) - 1, int(substr(m, 8, 4)) - 1)"
    # Areas are numbered without 000 and 666: 1 to 899 but one.
    ssn_symbols = _let("p", parts, "array(IF(element_at(p, 1) > 666, element_at(p, 1) - 2, element_at(p, 1) - 1), element_at(p, 2), element_at(p, 3))")
    ssn = _let(
        "p",
        feistel(ssn_symbols, "array(898, 99, 9999)", of("ssn")),
        "concat(lpad(string(IF(element_at(p, 1) >= 665, element_at(p, 1) + 2, element_at(p, 1) + 1)), 3, '0'), '-', "
        "lpad(string(element_at(p, 2) + 1), 2, '0'), '-', lpad(string(element_at(p, 3) + 1), 4, '0'))",
    )
    day = f"(unix_date(date({_DATE})) + {BEFORE_1970})"
    symbols = _let("n", f"pmod({day}, {CYCLE})", f"array(int(n div {DAY_RADIX[1]}), int(n % {DAY_RADIX[1]}))")
    date = _let(
        "p",
        feistel(symbols, f"array({DAY_RADIX[0]}, {DAY_RADIX[1]})", of("date")),
        f"date_format(date_from_unix_date(int({day} - pmod({day}, {CYCLE}) + element_at(p, 1) * {DAY_RADIX[1]} + element_at(p, 2) - {BEFORE_1970})), {_LAYOUT})",
    )
    # The country of a phone number stays, so that the rest stays a number of that country.
    country = "regexp_extract(m, '^[+][0-9]{1,3}', 0)"
    phone = f"concat({country}, {_permuted_text(f'substr(m, length({country}) + 1)', False, of('phone'))})"
    mail = f"concat({_permuted_text('substring_index(m, chr(64), 1)', True, of('mail'))}, substr(m, instr(m, '@')))"
    made = {"mail": mail, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}
    return "CASE k " + " ".join(f"WHEN '{kind}' THEN {sql}" for kind, sql in made.items()) + " END"


def _fill(shape: str, value: str, wanted: str = "[0-9]") -> str:
    """The characters of ``value`` put in the places that ``wanted`` characters have in ``shape``."""
    return (
        f"aggregate({_chars(shape)}, named_struct('t', '', 'k', 1), (s, c) -> IF(c RLIKE '{wanted}', "
        f"named_struct('t', concat(s.t, substr({value}, s.k, 1)), 'k', s.k + 1), named_struct('t', concat(s.t, c), 'k', s.k)), s -> s.t)"
    )


# --- over all documents ------------------------------------------------------------------


def pseudonymise(docs: DataFrame, key: str = "starmill") -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms, and how many of each kind, for every row of ``docs``.

    ``key`` is the secret: the same key gives the same pseudonyms in every run.  A null text
    stays null and holds nothing; a null doc_id stays null, repeated rows are treated alike, an
    empty table gives no rows.  The whole text is searched.
    """
    rows = docs.select("doc_id", "text", text_of().alias("__text"))
    searched = F.expr(f"IF(__text RLIKE '[0-9@]', regexp_extract_all(__text, {_quoted(PATTERN)}, 0), array())")
    rows = rows.withColumn("__matches", searched)
    # Lambda arguments: m is the match, k its kind.
    with_kind = f"transform(__matches, m -> named_struct('m', m, 'k', {_kind()}))"
    rows = rows.withColumn("__kinds", F.expr(with_kind))
    made = f"transform(__kinds, e -> IF(e.k IS NULL, e.m, {_let('m', 'e.m', _let('k', 'e.k', _pseudonym(key)))}))"
    rows = rows.withColumn("__out", F.expr(f"IF(exists(__kinds, e -> e.k IS NOT NULL), {made}, NULL)"))
    joined = (
        f"IF(__out IS NULL, text, concat(array_join(zip_with(slice(split(__text, {_quoted(PATTERN)}, -1), 1, size(__out)), __out, "
        f"(g, o) -> concat(g, o)), ''), element_at(split(__text, {_quoted(PATTERN)}, -1), -1)))"
    )
    counts = [F.expr(f"bigint(size(filter(__kinds, e -> e.k = '{kind}')))").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", F.expr(joined).alias("text"), *counts)
