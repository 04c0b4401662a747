"""Personal data under format-preserving Feistel pseudonyms, in Spark SQL expressions only.

A text is searched, from every place on, for things that look like personal data; the first from the left that
prove valid (checksum, calendar, number range) are replaced by values of the same format, which are valid again.
What fails its check hides nothing that starts inside it:

- card numbers keep length, separators and a right Luhn digit, IBANs their country and check digits
- dates stay dates of 1900-2099 in their own layout, US social security numbers stay assignable
- IP addresses stay addresses, phone numbers keep their country code and layout
- e-mail addresses and keys keep length, case, digits, punctuation, the last domain label and a key's prefix;
  a letter beyond ASCII stays one of its kind and of its row of 64 code points

One day has one pseudonym in all layouts, but for month-first dates. Only a day over 12 shows that the month is
first, and the pseudonym must show it too, so these are permuted among themselves, and their 29ths of February apart.

A value is read as an array of small numbers, each below its own modulus. Eight rounds of a Feistel
network add to one half the keyed hash of the other, position by position, so the map is a permutation
within the format: equal values get equal pseudonyms in every document, different ones different ones,
and nobody without the key can go back.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import apart, column

ROUNDS = 8

# The lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# Groups of four, or no blanks; what fits no length above may have any.
_IBANS = "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
# Four groups of a card number: a phone number before them ends there.
_CARD = r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d"

# How keys of services begin.
TOKEN_PREFIXES = "AKIA|ASIA|[spr]k_(?:live|test)_|gh[pousr]_|github_pat_|glpat-|hf_|npm_"
# The forms of personal data, as Java patterns.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}\p{M}._%+-])[\p{L}\p{N}\p{M}._%+-]++@[\p{L}\p{N}\p{M}-]+(?:\.[\p{L}\p{N}\p{M}-]+){0,8}\.(?:[A-Za-z]{2,}|(?![A-Za-z])\p{L}[\p{L}\p{M}]+)",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBANS}|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "token": rf"(?<![A-Za-z0-9_-])(?:{TOKEN_PREFIXES})[0-9A-Za-z]{{16,}}+(?![A-Za-z0-9_-])",
    "phone": r"(?:(?<![\d+])\+?\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<![\d+])\+\d{8,15}(?!\d)"
             rf"|(?<![\d+])\+\d{{1,3}}(?=[ .-])(?:(?:[ .-](?!{_CARD}))?\d){{7,12}}(?!\d)"
             rf"|(?<![\d+])\+\d{{1,3}}[ -]\d{{2,4}}[ -]\d{{3,8}}(?:[ -](?!{_CARD})\d{{2,4}})?(?!\d)"
             r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
             rf"|(?<![\d.-])[2-9]\d{{2}} (?!{_CARD})[2-9]\d{{2}}[ -](?!{_CARD})\d{{4}}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])(?!\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![\w:])(?!\.\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d)(?!\.\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?<sep>[ -])\d{4}\k<sep>\d{4}\k<sep>\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Days from 1900-01-01 to the end of 2099: 17 * 4297.
FIRST_DAY, DAYS = "date'1900-01-01'", (17, 4297)
# Days over 12 before each month of a common year, and of the year: month-first dates are 200 years of these, and 7 * 7
# leap days from 1904 on.
_BEFORE = "array(0, 19, 35, 54, 72, 91, 109, 128, 147, 165, 184, 202)"
LATE_DAYS, LEAP_DAYS = (200, 221), (7, 7)


def _text(value: str) -> str:
    """A SQL string literal of any text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), ch -> ch <> '')"


def _digits(text: str) -> str:
    return f"transform(filter(split({text}, ''), ch -> ch between '0' and '9'), ch -> ascii(ch) - 48)"


def _feistel(values: str, moduli: str, key: str) -> str:
    """``values`` permuted within ``moduli``; both are SQL for arrays of int of the same length. The
    variable ``k`` in scope names the kind, so that kinds differ."""
    left = "(i < size(acc) div 2)"
    other = f"array_join(transform(filter(acc, (x, i) -> {left} = (r % 2 = 1)), x -> string(x)), ',')"
    step = "cast(conv(substring(sha2(concat(mac, ':', i), 256), 1, 12), 16, 10) as bigint)"
    changed = f"int(pmod(x + {step}, mods[i]))"
    rounds = f"""aggregate(sequence(0, {ROUNDS - 1}), transform({values}, x -> int(x)), (acc, r) -> {_let(
        'mac', f"sha2(concat_ws('|', {key}, k, size(acc), r, {other}), 256)",
        f"transform(acc, (x, i) -> case when {left} = (r % 2 = 0) and mods[i] > 1 then {changed} else x end)")})"""
    return _let("mods", moduli, rounds)


_KINDS = (r"\p{Ll}", r"\p{Lu}", r"\p{L}", r"\p{N}", r"\p{M}")


def _alphabet() -> str:
    """What a character c beyond ASCII may become: all of its kind in its row of 64 code points, c among them."""
    row = "transform(sequence(ascii(c) div 64 * 64, ascii(c) div 64 * 64 + 63), x -> decode(unhex(lpad(hex(x), 8, '0')), 'UTF-32'))"
    cases = " ".join(f"when c rlike {_text(f'^{kind}$')} then filter({row}, y -> y rlike {_text(f'^{kind}$')}{besides})"
                     for kind, besides in zip(_KINDS, ["", "", r" and not y rlike '^[\\p{Ll}\\p{Lu}]$'", "", ""]))
    return f"case {cases} else array(c) end"


_MODULUS = ("case when c between '0' and '9' then 10 when c between 'a' and 'z' or c between 'A' and 'Z' then 26 "
            f"when ascii(c) > 127 then size({_alphabet()}) else 1 end")
_VALUE = ("case when c between '0' and '9' then ascii(c) - 48 when c between 'a' and 'z' then ascii(c) - 97 "
          f"when c between 'A' and 'Z' then ascii(c) - 65 when ascii(c) > 127 then int(array_position({_alphabet()}, c)) - 1 else 0 end")
# A character of the class of c with the value v.
_SPELLED = ("case when c between '0' and '9' then char(48 + v) when c between 'a' and 'z' then char(97 + v) "
            f"when c between 'A' and 'Z' then char(65 + v) when ascii(c) > 127 then {_alphabet()}[v] else c end")
_HEX = "'0123456789abcdef'"


def _luhn(digits: str) -> str:
    doubled = "case when i % 2 = 1 then x * 2 - case when x > 4 then 9 else 0 end else x end"
    return f"aggregate(transform(reverse({digits}), (x, i) -> {doubled}), 0, (a, x) -> a + x) % 10"


def _remainder97(text: str) -> str:
    """The remainder by 97 of an IBAN whose first four characters have been moved to its end."""
    number = "case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end"
    return f"aggregate({_chars(text)}, 0, (a, c) -> (a * case when c between '0' and '9' then 10 else 100 end + {number}) % 97)"


# The steps below share these variables: m the candidate, k its kind, cs its characters, ds the digits of a
# card, p the parts of a date, number or address, lay the layout of a date, n its year, month and day or
# the numbers of the parts, flat an IBAN without blanks, body the characters that are permuted, q the
# permuted values. A kind's values are an array of small numbers, each with its own modulus.

_LEAP = "n[1] = 2 and n[2] = 29"


def _kind() -> str:
    cases = [f"when m rlike {_text('^(?:' + PATTERNS[k] + ')$')} then '{k}'" for k in PATTERNS]
    return f"case {' '.join(cases)} end"


def _numbers() -> str:
    """Dates year first, or day first; month first where the middle part can only be a day."""
    order = "case lay when 'ymd' then array(p[0], p[1], p[2]) when 'mdy' then array(p[2], p[0], p[1]) when 'dmy' then array(p[2], p[1], p[0]) else p end"
    return f"transform({order}, x -> int(x))"


def _valid() -> str:
    date = ("case when n[0] between 1900 and 2099 and n[1] between 1 and 12 and n[2] between 1 and 31 "
            "then n[2] <= day(last_day(make_date(n[0], n[1], 1))) else false end")
    moved = "concat(substring(flat, 5), substring(flat, 1, 4))"
    return (f"case k when 'card' then {_luhn('ds')} = 0 when 'iban' then {_remainder97(moved)} = 1 when 'date' then {date} "
            "when 'ip6' then size(filter(split(m, ':'), g -> g <> '')) < 8 or not contains(m, '::') "
            "when 'ssn' then n[0] between 1 and 899 and n[0] <> 666 and n[1] > 0 and n[2] > 0 when 'ip' then forall(n, o -> o < 256) else true end")


def _values() -> str:
    day = f"datediff(make_date(n[0], n[1], n[2]), {FIRST_DAY})"
    area = "case when n[0] > 666 then n[0] - 2 else n[0] - 1 end"
    return (f"case k when 'card' then slice(ds, 1, size(ds) - 1) when 'ip' then n when 'ssn' then array({area}, n[1] - 1, n[2] - 1) "
            f"when 'date' then case when lay <> 'mdy' then array(int({day} div {DAYS[1]}), {day} % {DAYS[1]}) "
            f"when {_LEAP} then array(int((n[0] - 1904) div 4 div {LEAP_DAYS[1]}), (n[0] - 1904) div 4 % {LEAP_DAYS[1]}) "
            f"else array(n[0] - 1900, {_BEFORE}[n[1] - 1] + n[2] - 13) end "
            f"when 'ip6' then transform(cs, c -> greatest(instr({_HEX}, lower(c)) - 1, 0)) when 'key' then transform(cs, c -> instr({_HEX}, lower(c)) - 1) else transform(body, c -> {_VALUE}) end")


def _moduli() -> str:
    """The country code of a phone number, the last label of an address and a key's prefix stay."""
    first = r"case k when 'phone' then length(regexp_extract(m, '^\\+\\d{1,3}(?=[ .(-])|^\\+\\d{2}', 0)) when 'token' then length(regexp_extract(m, '^(?:" + TOKEN_PREFIXES + r")', 0)) else 0 end"
    last = r"case when k = 'email' then size(body) - length(regexp_extract(m, '\\.[^.@]+$', 0)) else size(body) end"
    return (f"case k when 'card' then array_repeat(10, size(ds) - 1) when 'ip' then array(256, 256, 256, 256) when 'ssn' then array(898, 99, 9999) "
            f"when 'date' then case when lay <> 'mdy' then array({DAYS[0]}, {DAYS[1]}) when {_LEAP} then array({LEAP_DAYS[0]}, {LEAP_DAYS[1]}) "
            f"else array({LATE_DAYS[0]}, {LATE_DAYS[1]}) end when 'ip6' then transform(cs, c -> case when c = ':' then 1 else 16 end) when 'key' then array_repeat(16, size(cs)) "
            f"else transform(body, (c, i) -> case when i < {first} or i >= {last} then 1 else {_MODULUS} end) end")


def _spelling() -> str:
    card = _let("made", f"concat(q, array((10 - {_luhn('concat(q, array(0))')}) % 10))",
                "array_join(transform(cs, (c, at) -> case when c between '0' and '9' "
                "then string(made[size(filter(slice(cs, 1, at + 1), ch -> ch between '0' and '9')) - 1]) else c end), '')")
    ssn = "concat_ws('-', lpad(case when q[0] >= 665 then q[0] + 2 else q[0] + 1 end, 3, '0'), lpad(q[1] + 1, 2, '0'), lpad(q[2] + 1, 4, '0'))"
    hexes = f"array_join(transform(q, v -> substring({_HEX}, v + 1, 1)), '')"
    part = lambda value, i: f"lpad(string({value}), greatest(length(p[{i}]), length(string({value}))), '0')"
    sep = "regexp_extract(m, '[-/.]', 0)"
    month = f"size(filter({_BEFORE}, b -> b <= q[1]))"
    late = f"make_date(1900 + q[0], {month}, q[1] - {_BEFORE}[{month} - 1] + 13)"
    leap = f"make_date(1904 + 4 * (q[0] * {LEAP_DAYS[1]} + q[1]), 2, 29)"
    hex6 = f"array_join(zip_with(cs, q, (c, v) -> case when c = ':' then c when c between 'A' and 'F' then upper(substring({_HEX}, v + 1, 1)) else substring({_HEX}, v + 1, 1) end), '')"
    date = _let("made", f"case when lay <> 'mdy' then date_add({FIRST_DAY}, q[0] * {DAYS[1]} + q[1]) when {_LEAP} then {leap} else {late} end",
                f"case lay when 'ymd' then date_format(made, 'yyyy-MM-dd') "
                f"when 'mdy' then concat_ws({sep}, {part('month(made)', 0)}, {part('day(made)', 1)}, string(year(made))) "
                f"else concat_ws({sep}, {part('day(made)', 0)}, {part('month(made)', 1)}, string(year(made))) end")
    plain = f"array_join(zip_with(body, q, (c, v) -> {_SPELLED}), '')"
    check = f"lpad(string(98 - {_remainder97('concat(plain, substring(flat, 1, 2), ' + _text('00') + ')')}), 2, '0')"
    iban = _let("made", f"concat(substring(flat, 1, 2), {check}, plain)",
                "array_join(transform(cs, (c, at) -> case when c = ' ' then c else substring(made, size(filter(slice(cs, 1, at + 1), ch -> ch <> ' ')), 1) end), '')")
    other = f"case when k = 'iban' then {iban} else plain end"
    return (f"case k when 'card' then {card} when 'ip' then array_join(transform(q, o -> string(o)), '.') when 'ssn' then {ssn} when 'ip6' then {hex6} "
            f"when 'date' then {date} when 'key' then case when m = upper(m) then upper({hexes}) else {hexes} end else {_let('plain', plain, other)} end")


def _facts(key: str) -> list[dict[str, str]]:
    """What is found about a candidate, step by step: SQL by variable, over the variables of earlier steps. The last
    one, s, is its pseudonym, null where it fails its check."""
    layout = "case when k = 'date' then case when m like '____-%' then 'ymd' when int(p[1]) > 12 then 'mdy' else 'dmy' end end"
    return [
        {"cs": _chars("m"), "ds": f"case when k = 'card' then {_digits('m')} end", "p": "case when k in ('date', 'ssn', 'ip') then split(m, '[-/.]') end",
         "flat": "case when k = 'iban' then replace(m, ' ', '') end"},
        {"lay": layout, "body": "case when k = 'iban' then slice(filter(cs, ch -> ch <> ' '), 5, size(cs)) else cs end"},
        {"n": _numbers()},
        {"valid": _valid()},
        {"vs": f"case when valid then {_values()} end", "ns": f"case when valid then {_moduli()} end"},
        {"q": f"case when valid then {_feistel('vs', 'ns', key)} end"},
        {"s": f"case when valid then {_spelling()} end"},
    ]


def _of_candidate(sql: str, variables: list[str]) -> str:
    """``sql`` with the variables as fields of the struct j; string literals stay."""
    words = rf"'(?:[^'\\]|\\.)*'|\b(?:{'|'.join(variables)})\b"
    return re.sub(words, lambda found: found[0] if found[0].startswith("'") else f"j.{found[0]}", sql)


def _steps(text: str, secret: str, ms: str, ps: str, js: str, r: str) -> list[tuple[str, str]]:
    """Columns that lead from a text to its new one, each with its SQL over those before it; names come quoted.

    ``ms`` are the candidates, ``ps`` the pieces of the text, ``js`` has a struct for each candidate m: its piece and
    what is found about it, and ``r`` is null where there is no candidate. As one nested expression they would cost the driver
    1.5 GB to parse, and 90 MB for as long as it lives, since the parser keeps what it learned about each nesting.
    """
    # Candidates start where the pieces do, and may overlap.
    some = f"size({ms}) > 0"
    steps = [(js, f"case when {some} then zip_with({ms}, slice({ps}, size({ps}) - size({ms}) + 1, size({ms})), (m, piece) -> "
                  f"named_struct('m', m, 'piece', piece, 'k', {_kind()})) end")]
    known = ["m", "piece", "k"]
    for facts in _facts(_text(secret)):
        pairs = [f"'{name}', j.{name}" for name in known] + [f"'{name}', {_of_candidate(value, known)}" for name, value in facts.items()]
        steps.append((js, f"transform({js}, j -> named_struct({', '.join(pairs)}))"))
        known += facts
    rest = "substring(j.piece, length(j.m) + 1)"
    # Where no valid value reaches into the next piece, each stands alone; else the first from the left cover what they reach.
    alone = (f"named_struct('out', transform({js}, j -> case when j.s is null then j.piece else concat(j.s, {rest}) end), "
             f"'found', size(filter({js}, j -> coalesce(j.s <> j.m, false))), 'skip', 0)")
    step = ("case when a.skip > 0 then named_struct('out', concat(a.out, array(substring(j.piece, a.skip + 1))), 'found', a.found, 'skip', greatest(a.skip - length(j.piece), 0)) "
            "when j.s is null then named_struct('out', concat(a.out, array(j.piece)), 'found', a.found, 'skip', 0) "
            f"else named_struct('out', concat(a.out, array(concat(j.s, {rest}))), 'found', a.found + int(j.s <> j.m), 'skip', greatest(length(j.m) - length(j.piece), 0)) end")
    chained = f"aggregate({js}, named_struct('out', cast(array() as array<string>), 'found', 0, 'skip', 0), (a, j) -> {step})"
    resolved = f"case when exists({js}, j -> j.s is not null and length(j.m) > length(j.piece)) then {chained} else {alone} end"
    return [
        # All forms have a digit or an at sign: most texts end here.
        (ms, f"case when {text} rlike '[0-9@]' then regexp_extract_all({text}, {_text(f'(?=({ANY}))')}, 1) else cast(array() as array<string>) end"),
        (ps, f"case when {some} then split({text}, {_text(f'(?={ANY})')}, -1) end"),
        *steps,
        (r, f"case when {some} then {resolved} end"),
        (text, f"case when {some} then concat(case when size({ps}) > size({ms}) then {ps}[0] else '' end, array_join({r}.out, '')) else {text} end"),
    ]


def pseudonymise(docs: DataFrame, secret: str, text_column: str = "text", found_column: str = "n_found") -> DataFrame:
    """``docs`` with personal data in its text replaced and a count of replaced values, row by row.

    ``secret`` keys the permutation. All other columns stay, also where their names clash with ours; an empty
    table gives an empty one. Null texts stay null with a count of 0. Values that fail their check stay as they are.
    """
    names = [c for c in docs.columns if c != found_column]
    text, *others = (apart(docs, f"__{n}") for n in ("text", "ms", "ps", "js", "r"))
    made = docs.withColumn(text, column(text_column))
    for name, value in _steps(f"`{text}`", secret, *[f"`{n}`" for n in others]):
        made = made.withColumn(name.strip("`"), F.expr(value))
    return made.select(
        *[column(text).alias(c) if c == text_column else column(c) for c in names],
        F.coalesce(f"{others[-1]}.found", F.lit(0)).cast("long").alias(found_column),
    )
