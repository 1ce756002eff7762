"""Format-preserving pseudonyms for personal data in texts.

Texts are cut into stretches that no candidate crosses. In a stretch every place is tried for every shape, and each
candidate is validated by its kind: check digits of card and bank account numbers, ranges of addresses and social
security numbers, real days of dates. Of valid candidates that overlap, those before phone numbers, then the first in
the text, so a candidate that fails hides nothing inside it. A validated value is permuted within its format by a keyed
Feistel network, so that equal values get equal pseudonyms in every document, different values different ones, and
whoever has the key can undo it. Numbers and dates are permuted as whole numbers of the format's range (two parts of a
times b, each moved by a keyed hash of the other); e-mail names, phone numbers, account numbers and secrets as character
strings whose halves shift each other within digits, small and capital letters.

A pseudonym depends on nothing but its value, and yet the way back finds the same values, because no permutation can
make or unmake another candidate: characters keep their class, groups of four digits in cards and phone numbers keep
their part of the check sum, so that every row of four such groups is as valid as before, and no phone number reaches
into the shape of another kind. There is one exception. What lies in an account number that fails its check may make it
valid, one time in 97; only there the stretch is permuted again.

Everything is a column expression. Texts without a candidate pass through as they are.

Defined results: a null text stays null, an empty one empty. Values that fail validation stay as they are. Repeated
rows and a null id keep their rows; an empty table gives no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Lengths of account numbers by country.
IBANS = """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18
FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21
LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19
SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30""".split()


def _ibans() -> str:
    """Account numbers of the right length for their country, unbroken or in groups of four."""
    shapes = []
    for size in sorted({x[2:] for x in IBANS}):
        groups, rest = divmod(int(size) - 4, 4)
        apart = f"(?: [0-9A-Z]{{4}}){{{groups}}}" + (f" [0-9A-Z]{{{rest}}}" if rest else "")
        shapes.append(f"(?:{'|'.join(x[:2] for x in IBANS if x[2:] == size)})[0-9]{{2}}(?:[0-9A-Z]{{{int(size) - 4}}}|{apart})")
    return f"(?<![0-9A-Za-z])(?:{'|'.join(shapes)})(?![0-9A-Za-z]|[.][0-9]){NO_NAME}"


#: What follows isn't the rest of the name of a mail address.
NO_NAME = "(?![A-Za-z0-9._%+-]{0,64}@)"
_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_SIX = r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?![0-9])"
_IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"

#: The kinds and their shapes, in order of precedence. Phone numbers have no check and come last.
EXACT = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"),
    ("date", rf"(?<![0-9+./-]){_DATE}{NO_NAME}"),
    ("iban", _ibans()),
    ("ssn", rf"(?<![0-9+-]){_SSN}"),
    ("ip", rf"(?<![0-9+.]){_IP}"),
    ("card", rf"(?<![0-9+])(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}})(?![0-9]|-[0-9]{{2}}-[0-9]{{2}}(?![0-9])){NO_NAME}"),
]
#: What parts the groups of a phone number, if no other shape starts behind it.
_NEXT = rf"[ ./-](?!{_DATE}|{_SSN}|{_IP}|{_SIX})"
LOOSE = [
    # Ten digits parted by blanks between other numbers are in a table of numbers.
    ("phone", rf"(?<![0-9+])(?!(?<=[0-9] )[0-9]{{3}} [0-9]{{3}} [0-9]{{4}} [0-9])(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[ .-])[0-9]{{3}}[ .-](?!{_SIX})[0-9]{{4}}(?![0-9]|[.-][0-9]){NO_NAME}"),
    # A sign, a country code and up to six groups: the longest that no exact shape lies across.
    *[("phone", rf"(?<![0-9A-Za-z+])\+[1-9][0-9]{{0,2}}(?:[ .-]?\([0-9]{{1,4}}\))?(?:{_NEXT})?[0-9]++(?:{_NEXT}[0-9]{{2,}}+){{{n}}}{NO_NAME}") for n in range(5, -1, -1)],
]
KINDS = ["email", "secret", "date", "iban", "phone", "ssn", "ip", "card"]
ANY = "|".join(shape for _, shape in EXACT + LOOSE)
#: Characters of candidates. A space beside a small letter is in none. What ends a stretch is in no look around a shape.
PART = r"(?:[A-Za-z0-9@._%+/()-]|(?<![a-z]) (?![a-z]))"
STRETCH = rf"(?<![A-Za-z0-9@._%+/()-])(?<!(?<![a-z]) (?![a-z]))(?:(?!{ANY}){PART})*+(?={ANY}){PART}++"
#: How often a stretch is permuted again at most. One time in 97 an account number around a value is valid by chance.
TRIES = 32
#: A group of four digits, without its last one.
FOURTH = "(?<![0-9])([0-9]{3})[0-9](?![0-9])"
CHOSEN = "array<struct<at: int, rank: int, kind: string, value: string>>"
PAIRS = "array<struct<kind: string, value: string, pseudonym: string>>"

#: Days of 400 years, and two factors of their number.
FIRST_DAY, DAYS, DAYS_A, DAYS_B = "DATE'1700-01-01'", 146_097, 189, 773
#: Social security numbers: areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
SSN_A, SSN_B = 898 * 99, 9_999


def _text(x: str) -> str:
    """An SQL literal."""
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _hashed(key: str, kind: str, step: str, x: str) -> str:
    """A keyed number of 60 bits."""
    return f"CAST(conv(substr(sha2(concat_ws('|', {_text(key)}, '{kind}', {step}, {x}), 256), 1, 15), 16, 10) AS BIGINT)"


def feistel(x: str, a: str, b: str, key: str, kind: str, back: bool = False) -> str:
    """SQL: a keyed permutation of the numbers from 0 to below a * b, or its inverse."""
    left = f"pmod(s.l {'-' if back else '+'} {_hashed(key, kind, 'CAST(i AS STRING)', 'CAST(s.r AS STRING)')} % ({a}), {a})"
    right = f"pmod(s.r {'-' if back else '+'} {_hashed(key, kind, 'CAST(i AS STRING)', 'CAST(s.l AS STRING)')} % ({b}), {b})"
    steps = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    return f"""aggregate({steps}, named_struct('l', ({x}) div ({b}), 'r', ({x}) % ({b})),
        (s, i) -> IF(i % 2 = 0, named_struct('l', {left}, 'r', s.r), named_struct('l', s.l, 'r', {right})),
        s -> s.l * ({b}) + s.r)"""


def _shifted(half: str, other: str, key: str, kind: str, alphabets: tuple[str, ...], back: bool) -> str:
    """SQL: each character of ``half`` moved on within its alphabet by a keyed hash of ``other``."""
    char = f"substr({half}, j, 1)"
    by = f"CAST(conv(substr(sha2(concat_ws('|', {_text(key)}, '{kind}', CAST(i AS STRING), CAST(j div 16 AS STRING), {other}), 256), 1 + (j % 16) * 4, 4), 16, 10) AS INT)"
    cases = " ".join(
        f"WHEN instr('{x}', {char}) > 0 THEN substr('{x}', 1 + pmod(instr('{x}', {char}) - 1 {'-' if back else '+'} {by}, {len(x)}), 1)"
        for x in alphabets
    )
    return f"IF({half} = '', '', array_join(transform(sequence(1, length({half})), j -> CASE {cases} ELSE {char} END), ''))"


DIGITS, SMALL, CAPITALS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def feistel_text(x: str, key: str, kind: str, alphabets: tuple[str, ...] = (DIGITS, SMALL, CAPITALS), back: bool = False) -> str:
    """SQL: a keyed permutation of the texts of one format: each character stays in its alphabet, others stay."""
    steps = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    left = _shifted("s.l", "s.r", key, kind, alphabets, back)
    right = _shifted("s.r", "s.l", key, kind, alphabets, back)
    return f"""aggregate({steps},
        named_struct('l', substr({x}, 1, length({x}) div 2), 'r', substr({x}, 1 + length({x}) div 2)),
        (s, i) -> IF(i % 2 = 0, named_struct('l', {left}, 'r', s.r), named_struct('l', s.l, 'r', {right})),
        s -> concat(s.l, s.r))"""


def refilled(shape: str, digits: str) -> str:
    """SQL: ``shape`` with its letters and digits replaced, in order, by the characters of ``digits``."""
    return f"""array_join(transform(sequence(1, length({shape})), p -> IF(substr({shape}, p, 1) rlike '[0-9A-Za-z]',
        substr({digits}, length(regexp_replace(substr({shape}, 1, p), '[^0-9A-Za-z]', '')), 1), substr({shape}, p, 1))), '')"""


def luhn(digits: str) -> str:
    """SQL: the check sum of card numbers; 0 modulo 10 if the last digit is right."""
    own = f"CAST(substr({digits}, length({digits}) - q, 1) AS INT)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (n, q) -> n + IF(q % 2 = 0, {own}, 2 * {own} - IF({own} > 4, 9, 0))) % 10"


def mod97(text: str) -> str:
    """SQL: digits and capital letters (A is 10) read as one number, modulo 97."""
    char = f"substr({text}, q, 1)"
    return f"""aggregate(sequence(1, length({text})), 0L, (n, q) -> IF({char} rlike '[0-9]', (n * 10 + CAST({char} AS INT)) % 97,
        (n * 100 + ascii({char}) - 55) % 97))"""


def _valid(kind: str, m: str) -> str:
    """SQL: whether a candidate is one. Validity that needs no arithmetic is in the format."""
    if kind == "date":
        return f"coalesce({_day(m)} BETWEEN 0 AND {DAYS - 1}, false)"
    if kind == "iban":
        bare = f"replace({m}, ' ', '')"
        return f"({mod97(f'concat(substr({bare}, 5), substr({bare}, 1, 4))')}) = 1"
    if kind == "ssn":
        return f"{m} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}$'"
    if kind == "ip":
        return f"forall(split({m}, '[.]'), o -> CAST(o AS INT) < 256)"
    if kind == "card":
        return f"({luhn(_digits(m))}) = 0"
    if kind == "phone":
        return f"length({_digits(m)}) BETWEEN 8 AND 15"
    return "true"


def _month_first(m: str) -> str:
    """SQL: the day of a slashed date that reads as month, day, year; NULL if that is no day."""
    return f"try_to_date(concat(substr({m}, 7, 4), '-', substr({m}, 1, 2), '-', substr({m}, 4, 2)), 'yyyy-MM-dd')"


def _day(m: str) -> str:
    """SQL: days since the first one of a date in one of the formats; NULL for a day that does not exist.

    A slashed date whose day can't be read in the second place has it in the first.
    """
    turned = f"try_to_date(concat(substr({m}, 7, 4), '-', substr({m}, 4, 2), '-', substr({m}, 1, 2)), 'yyyy-MM-dd')"
    slashed = f"WHEN substr({m}, 3, 1) = '/' THEN coalesce({_month_first(m)}, {turned})"
    return f"datediff(CASE WHEN substr({m}, 5, 1) = '-' THEN try_to_date({m}, 'yyyy-MM-dd') {slashed} ELSE {turned} END, {FIRST_DAY})"


def _moved(kind: str, m: str, key: str, back: bool) -> str:
    """SQL: the pseudonym of a valid value."""
    if kind == "email":
        return f"concat({feistel_text(f"substring_index({m}, '@', 1)", key, kind, back=back)}, '@', substring_index({m}, '@', -1))"
    if kind == "secret":
        return feistel_text(m, key, kind, (DIGITS, "abcdef", "ABCDEF"), back)
    if kind == "date":
        once = feistel(f"CAST({_day(m)} AS BIGINT)", f"{DAYS_A}L", f"{DAYS_B}L", key, kind, back)
        day_first = f"substr({m}, 3, 1) = '/' AND {_month_first(m)} IS NULL"
        # Permuted among the days after the 12th, so that the pseudonym is read the same way: six of ten days are such.
        late = f"dayofmonth(date_add({FIRST_DAY}, CAST(u AS INT))) > 12"
        again = feistel("u", f"{DAYS_A}L", f"{DAYS_B}L", key, kind, back)
        number = f"IF({day_first}, aggregate(sequence(1, 64), {once}, (u, r) -> IF({late}, u, {again})), {once})"
        day = f"date_add({FIRST_DAY}, CAST({number} AS INT))"
        slashed = f"WHEN {day_first} THEN 'dd/MM/yyyy' WHEN substr({m}, 3, 1) = '/' THEN 'MM/dd/yyyy'"
        shape = f"CASE WHEN substr({m}, 5, 1) = '-' THEN 'yyyy-MM-dd' {slashed} ELSE 'dd.MM.yyyy' END"
        return f"date_format({day}, {shape})"
    if kind == "iban":
        bare = f"replace({m}, ' ', '')"
        body = feistel_text(f"substr({bare}, 5)", key, kind, (DIGITS, CAPITALS), back)
        # The body is made once: it is named by a transform over an array of one.
        check = f"lpad(CAST(98 - {mod97(f'concat(y, substr({bare}, 1, 2), {_text("00")})')} AS STRING), 2, '0')"
        whole = f"concat(substr({bare}, 1, 2), {check}, y)"
        return f"element_at(transform(array({body}), y -> {refilled(m, whole)}), 1)"
    if kind == "phone":
        code = f"regexp_extract({m}, '^([+][0-9]{{1,3}}[ .-]?)?', 0)"
        rest = f"substr({m}, 1 + length({code}))"
        body = feistel_text(f"regexp_replace({rest}, {_text(FOURTH)}, '$1')", key, kind, (DIGITS,), back)
        pieces = "regexp_extract_all({}, '[0-9]+|[^0-9]+', 0)"
        # The fourth digit of a group of four is the one that leaves its part of a check sum as it is.
        four = f"IF(a rlike '^[0-9]{{4}}$', {_checked('b', 'a')}, b)"
        return f"concat({code}, array_join(zip_with({pieces.format(rest)}, {pieces.format(body)}, (a, b) -> {four}), ''))"
    if kind == "ssn":
        area = f"(CAST(substr({m}, 1, 3) AS BIGINT) - 1 - IF(substr({m}, 1, 3) > '666', 1, 0))"
        number = f"(({area} * 99 + CAST(substr({m}, 5, 2) AS BIGINT) - 1) * {SSN_B} + CAST(substr({m}, 8, 4) AS BIGINT) - 1)"
        y = f"(y div ({SSN_B} * 99) + 1)"
        whole = f"""concat(lpad(CAST({y} + IF({y} > 665, 1, 0) AS STRING), 3, '0'), '-',
            lpad(CAST(y div {SSN_B} % 99 + 1 AS STRING), 2, '0'), '-', lpad(CAST(y % {SSN_B} + 1 AS STRING), 4, '0'))"""
        return f"element_at(transform(array({feistel(number, f'{SSN_A}L', f'{SSN_B}L', key, kind, back)}), y -> {whole}), 1)"
    if kind == "ip":
        number = f"aggregate(split({m}, '[.]'), 0L, (n, o) -> n * 256 + CAST(o AS INT))"
        whole = "concat_ws('.', CAST(y div 16777216 AS STRING), CAST(y div 65536 % 256 AS STRING), CAST(y div 256 % 256 AS STRING), CAST(y % 256 AS STRING))"
        return f"element_at(transform(array({feistel(number, '65536L', '65536L', key, kind, back)}), y -> {whole}), 1)"
    return _named(_digits(m), "d", _named(_moved_card("d", key, back), "y", refilled(m, "y")))


def _checked(body: str, like: str) -> str:
    """SQL: ``body`` and the last digit that gives it the check sum of ``like``."""
    rest = f"concat({body}, '0')"
    return f"concat({body}, CAST(pmod({luhn(like)} - {luhn(rest)}, 10) AS STRING))"


def _number(x: str, size: int, key: str, back: bool) -> str:
    """SQL: digits permuted among all texts of ``size`` digits."""
    high, low = 10 ** (size // 2), 10 ** (size - size // 2)
    return f"lpad(CAST({feistel(f'CAST({x} AS BIGINT)', f'{high}L', f'{low}L', key, f'card{size}', back)} AS STRING), {size}, '0')"


def _moved_card(d: str, key: str, back: bool) -> str:
    """SQL: the digits of a card number permuted.

    Numbers that are written in groups of four or six keep the check sum of each group, those of 15 digits the first
    group; so a group counts the same in all cards that it may be read as a part of.
    """
    cases = []
    for groups in ([4, 4, 4, 4], [4, 6, 4]):
        at, taken, bodies, parts = 1, 1, [], []
        for size in groups:
            bodies.append(f"substr({d}, {at}, {size - 1})")
            parts.append(_checked(f"substr(u, {taken}, {size - 1})", f"substr({d}, {at}, {size})"))
            at, taken = at + size, taken + size - 1
        made = _number(f"concat({', '.join(bodies)})", taken - 1, key, back)
        cases.append(f"WHEN {sum(groups)} THEN {_named(made, 'u', f'concat({", ".join(parts)})')}")
    made = _number(f"substr({d}, 5, 10)", 10, key, back)
    cases.append(f"WHEN 15 THEN {_named(made, 'u', _checked(f'concat(substr({d}, 1, 4), u)', d))}")
    for size in (13, 17, 18, 19):
        made = _number(f"substr({d}, 1, {size - 1})", size - 1, key, back)
        cases.append(f"WHEN {size} THEN {_named(made, 'u', _checked('u', d))}")
    return f"CASE length({d}) {' '.join(cases)} END"


def _named(value: str, name: str, body: str) -> str:
    """SQL: ``body`` in which ``name`` stands for a value that is made once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _candidates(c: str, shapes: list[tuple[str, str]]) -> str:
    """SQL: the valid candidates of a stretch, also those that overlap, in the order of the text and of ``shapes``."""
    found = []
    for rank, (kind, shape) in enumerate(shapes):
        # A match is what lies before the next candidate and its first character, so the next may start inside it.
        each = _text(rf"(?s)(.*?)(?:(?=({shape})).|\z)")
        one = f"named_struct('at', s.at + z.n, 'rank', {rank}, 'kind', '{kind}', 'value', z.v)"
        found.append(f"""IF({c} rlike {_text(shape)}, aggregate(
            zip_with(regexp_extract_all({c}, {each}, 1), regexp_extract_all({c}, {each}, 2), (a, b) -> named_struct('n', length(a), 'v', b)),
            named_struct('at', 1, 'found', CAST(array() AS {CHOSEN})),
            (s, z) -> named_struct('at', s.at + z.n + 1, 'found',
                IF(z.v <> '' AND {_valid(kind, "z.v")}, concat(s.found, array({one})), s.found)),
            s -> s.found), CAST(array() AS {CHOSEN}))""")
    return f"array_sort(concat({', '.join(found)}))"


def _apart(candidates: str) -> str:
    """SQL: each candidate that starts after the end of the one chosen before it."""
    return f"""aggregate({candidates}, named_struct('end', 1, 'found', CAST(array() AS {CHOSEN})),
        (s, z) -> IF(z.at >= s.end, named_struct('end', z.at + length(z.value), 'found', concat(s.found, array(z))), s), s -> s.found)"""


def _chosen(c: str) -> str:
    """SQL: the values of a stretch, in the order of the text."""
    free = f"filter({_candidates(c, LOOSE)}, z -> NOT exists(e, u -> u.at < z.at + length(z.value) AND z.at < u.at + length(u.value)))"
    return _named(_apart(_candidates(c, EXACT)), "e", f"array_sort(concat(e, {_apart(free)}))")


def _permuted(chosen: str, values: str, key: str, back: bool) -> str:
    """SQL: ``values``, which are of the kinds of ``chosen``, permuted once."""
    kinds = " ".join(f"WHEN '{k}' THEN {_moved(k, 'v', key, back)}" for k in KINDS)
    return f"zip_with({chosen}, {values}, (x, v) -> CASE x.kind {kinds} END)"


def _with(c: str, chosen: str, values: str) -> str:
    """SQL: a stretch with ``values`` in the places of ``chosen``."""
    end = f"({chosen}[k - 1].at + length({chosen}[k - 1].value))"
    before = f"IF(k = 0, substr({c}, 1, x.at - 1), substr({c}, {end}, x.at - {end}))"
    last = f"element_at({chosen}, -1)"
    return f"""concat(array_join(transform({chosen}, (x, k) -> concat({before}, {values}[k])), ''),
        substr({c}, {last}.at + length({last}.value)))"""


def _hidden(c: str, key: str, back: bool) -> str:
    """SQL: (text, found) of a stretch: with pseudonyms, and what was replaced."""
    expected = "zip_with(f, w.made, (d, v) -> named_struct('kind', d.kind, 'value', v))"
    seen = f"transform({_chosen('g')}, d -> named_struct('kind', d.kind, 'value', d.value))"
    again = f"IF({_named(_with(c, 'f', 'w.made'), 'g', seen)} = {expected}, named_struct('made', w.made, 'done', true), named_struct('made', {_permuted('f', 'w.made', key, back)}, 'done', false))"
    # Only an account number that fails its check can become valid by what is in it; other candidates stay as they are.
    start = f"named_struct('made', {_permuted('f', 'f.value', key, back)}, 'done', NOT {c} rlike {_text(_ibans())})"
    walked = f"aggregate(sequence(1, {TRIES}), {start}, (w, t) -> IF(w.done, w, {again}), w -> w.made)"
    pairs = "zip_with(f, h, (d, v) -> named_struct('kind', d.kind, 'value', d.value, 'pseudonym', v))"
    nothing = f"named_struct('text', {c}, 'found', CAST(array() AS {PAIRS}))"
    some = _named(walked, "h", f"named_struct('text', {_with(c, 'f', 'h')}, 'found', {pairs})")
    return _named(_chosen(c), "f", f"IF(size(f) = 0, {nothing}, {some})")


def pseudonymised(
    docs: DataFrame, key: str, text_col: str = "text", back: bool = False, found_col: str | None = None
) -> DataFrame:
    """``docs`` with validated values of ``text_col`` replaced by their pseudonyms, or pseudonyms by values.

    found_col: a column to add, an array of (kind, value, pseudonym) in the order of the text.
    """
    text = F.col(text_col)
    # A cheap look first: every format has an at sign, two digits in a row or near, or a long run of letters a to f.
    some = text.rlike(r"@|[0-9][ ./()-]{0,2}[0-9]|[0-9A-Fa-f]{32}")
    rows = docs.withColumn("__pii_matches", F.when(some, F.regexp_extract_all(text, F.lit(STRETCH), F.lit(0))))
    any_found = "coalesce(size(__pii_matches), 0) > 0"
    rows = rows.withColumn("__pii_hidden", F.expr(f"IF({any_found}, transform(__pii_matches, c -> {_hidden('c', key, back)}), NULL)"))
    between = f"split({_quoted(text_col)}, {_text(STRETCH)}, -1)"
    joined = f"IF({any_found}, array_join(flatten(zip_with({between}, __pii_hidden, (a, b) -> array(a, coalesce(b.text, '')))), ''), {_quoted(text_col)})"
    rows = rows.withColumn("__pii_text", F.expr(joined))
    if found_col:
        rows = rows.withColumn(found_col, F.expr(f"coalesce(IF({any_found}, flatten(__pii_hidden.found), NULL), CAST(array() AS {PAIRS}))"))
    return rows.withColumn(text_col, F.col("__pii_text")).drop("__pii_matches", "__pii_hidden", "__pii_text")


def _quoted(name: str) -> str:
    return f"`{name}`"


def counts_by_kind(found_col: str) -> dict[str, Column]:
    """How many values of each kind there are in a column that ``pseudonymised`` added."""
    return {f"n_{k}": F.expr(f"CAST(size(filter({found_col}, x -> x.kind = '{k}')) AS BIGINT)") for k in KINDS}
