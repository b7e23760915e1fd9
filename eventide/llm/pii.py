"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Found values are validated (check sums, ranges, real dates) and replaced by a
keyed permutation of their own format: an unbalanced Feistel network over the
value's positions, each with its own radix, so digits stay digits, a date
stays a date of the same layout, and check digits are computed anew. The
permutation depends on the key, the kind and the value only: equal values get
equal pseudonyms in every document, different values of one format different
ones, and ``reveal`` undoes it with the key.

Kinds: payment cards (13-19 digits, Luhn), IBANs (mod 97), social security
numbers (ranges), dates (ISO, d/m/y and d.m.y with a four-digit year), phone
numbers (international or with an area code in brackets), IPv4 addresses,
e-mail addresses (the part before the @).

Every value is handled where it stands, so no shuffle is needed. Defined
results: null texts stay null with zero counts; a number that fails its check
stays as it is; cards, IBANs and phone numbers are looked for at every
admissible length and at every group of a run of digits; where two readings of
adjoining numbers overlap, ``reveal`` may read the pseudonyms otherwise;
overlapping finds go to the earlier, then to the kind listed
first; repeated rows give repeated results; other columns are kept.
"""

from __future__ import annotations

import calendar
import datetime
import functools
import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 8
# Fixed value: the key of the registered query. Production jobs pass their own.
QUERY_KEY = b"eventide pseudonyms of the registered query"
KINDS = ("email", "iban", "card", "ssn", "date", "phone", "ip")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_FIND = re.compile(r"""
  (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-]))
 |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)
 |(?P<phone>(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\w])
   |(?<![\w)])\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}(?!\w))
 |(?P<date>(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\w-]|\.[0-9]))
 |(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
 |(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9]))
 |(?P<card>(?:(?<![\w.-])|(?<=[0-9]-))[0-9](?:[ -]?[0-9]){12})
""", re.X | re.A)
# Lengths of IBANs by country; of other countries any length that holds its check.
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
# Digits after the country code, where a plan fixes them.
PHONE_DIGITS = {"1": 10, "7": 10, "33": 9, "34": 9, "41": 9, "45": 8, "47": 8, "48": 9, "61": 9, "91": 10}
# Groups of digits in which cards are printed; a single group may have 13 to 19.
CARD_GROUPS = frozenset([(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), *((n,) for n in range(13, 20))])
_GROUP = re.compile(r"[0-9]+")
_MAY = re.compile(r"[0-9@]")  # every kind holds one of these


def _word(key: bytes, tweak: str, n: int, half: int) -> int:
    data = f"{tweak}|{n}|{half}".encode()
    return int.from_bytes(hmac.new(key, data, hashlib.blake2b).digest(), "big")


def _product(radices) -> int:
    out = 1
    for r in radices:
        out *= r
    return out


def _number(values, radices) -> int:
    out = 0
    for v, r in zip(values, radices, strict=True):
        out = out * r + v
    return out


def _places(number: int, radices) -> list[int]:
    out = []
    for r in reversed(radices):
        number, v = divmod(number, r)
        out.append(v)
    return out[::-1]


def permute(values: list[int], radices: list[int], key: bytes, tweak: str, back: bool = False) -> list[int]:
    """Keyed permutation of the sequences with the given radices."""
    if len(values) < 2:
        # one position: split it in two halves of its own range, walk out-of-range values on
        if not values or radices[0] < 2:
            return list(values)
        side = 1
        while side * side < radices[0]:
            side += 1
        v = values[0]
        while True:
            v = _number(permute(list(divmod(v, side)), [side, side], key, tweak, back), [side, side])
            if v < radices[0]:
                return [v]
    cut = len(values) // 2
    ra, rb = radices[:cut], radices[cut:]
    na, nb = _product(ra), _product(rb)
    a, b = _number(values[:cut], ra), _number(values[cut:], rb)
    sign = -1 if back else 1
    for n in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        if n % 2 == 0:
            a = (a + sign * _word(key, tweak, n, b)) % na
        else:
            b = (b + sign * _word(key, tweak, n, a)) % nb
    return _places(a, ra) + _places(b, rb)


def _walk(values, radices, key, tweak, back, valid):
    """Permutes until the value is valid again: a permutation of the valid."""
    while True:
        values = permute(values, radices, key, tweak, back)
        if valid(values):
            return values


def luhn_digit(digits: list[int]) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 == 0 else d
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _fill(shape: str, symbols: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def _classes(text: str) -> tuple[list[int], list[int]]:
    value, radix = [], []
    for c in text:
        if c.isdigit():
            value.append(int(c))
            radix.append(10)
        elif c.isalpha():
            value.append((ord(c) | 32) - 97)
            radix.append(26)
    return value, radix


def _spell(like: str, values: list[int]) -> str:
    it = iter(values)
    out = []
    for c in like:
        if c.isdigit():
            out.append(str(next(it)))
        elif c.isalpha():
            out.append(chr((97 if c.islower() else 65) + next(it)))
        else:
            out.append(c)
    return "".join(out)


def _email(text, key, back):
    name, at, host = text.rpartition("@")
    value, radix = _classes(name)
    return _spell(name, permute(value, radix, key, "email" + str(len(value)), back)) + at + host


def _iban(text, key, back):
    flat = text.replace(" ", "")
    if not 15 <= len(flat) <= 34 or iban_remainder(flat) != 1:
        return None
    value, radix = _classes(flat[4:])
    body = _spell(flat[4:], permute(value, radix, key, "iban" + flat[:2], back))
    return _fill(text, flat[:2] + f"{98 - iban_remainder(flat[:2] + '00' + body):02d}" + body)


def _is_card(d):
    return luhn_digit(d[:-1]) == d[-1] and any(d)


def _card_ends(text, start):
    """(end, groups) of 13 to 19 digits in whole groups from ``start``, the
    shortest first."""
    groups, n, at = (), 0, start
    while (m := _GROUP.match(text, at)):
        n += len(m.group())
        groups += (len(m.group()),)
        at = m.end()
        if n > 19:
            return
        if n >= 13 and not re.match("[0-9A-Za-z_]", text[at:at + 1]):
            yield at, groups
        if text[at:at + 1] not in (" ", "-"):
            return
        at += 1


def _printed_card(text, start):
    return next((e for e, g in _card_ends(text, start) if g in CARD_GROUPS and _is_card(_digits(text[start:e]))), None)


def _card_end(text, start):
    """The end of the card that begins at ``start``: in printed groups, or in
    any groups where no card in printed groups begins inside it."""
    if (end := _printed_card(text, start)) is not None:
        return end
    for end, _ in _card_ends(text, start):
        if _is_card(_digits(text[start:end])) and not any(
                _printed_card(text, start + m.start()) for m in _GROUP.finditer(text[start:end]) if m.start()):
            return end
    return None


def _card(text, key, back):
    d = _digits(text)
    if not _is_card(d):
        return None
    alone = _card_end(text, 0) == len(text)
    while True:
        new = permute(d[:-1], [10] * (len(d) - 1), key, f"card{len(d)}", back)
        d = [*new, luhn_digit(new)]
        got = _fill(text, "".join(map(str, d)))
        # walk on past pseudonyms that hold a shorter card, which reveal would find
        if any(d) and (not alone or _card_end(got, 0) == len(got)):
            return got


def _iban_end(text, start):
    """The end of the IBAN that begins at ``start``: its country's length first,
    then every other one."""
    flat, at, ends = "", start, {}
    while len(flat) < 34 and (m := re.compile(r"\x20?[A-Z0-9]" if flat and len(flat) % 4 == 0 else "[A-Z0-9]").match(text, at)):
        flat, at = flat + m.group()[-1], m.end()
        if len(flat) >= 15 and not re.match("[A-Za-z0-9]", text[at:at + 1]):
            ends[len(flat)] = at
    own = IBAN_LENGTHS.get(flat[:2])
    for n in sorted(ends, key=lambda n: (n != own, n)):
        if iban_remainder(flat[:n]) == 1:
            return ends[n]
    return None


def _phone_end(text, start, end):
    """The end of the phone number in the greediest find: its plan's length, or
    else before the first group set off otherwise than the groups before it."""
    found = text[start:end]
    code = re.match(r"\+([0-9]{1,3})(?=[ .(-])|\+([17])", found)
    if not code:
        return end
    groups = list(_GROUP.finditer(found, code.end()))
    fixed = PHONE_DIGITS.get(code.group(1) or code.group(2))
    n, held = 0, None
    for m, after in zip(groups, [*groups[1:], None], strict=True):
        n += len(m.group())
        if n == fixed:
            return start + m.end()
        if held is None and after is not None:
            gap = found[m.end():after.start()]
            before = found[m.start() - 1]
            if n >= 7 and gap == " " and before in ".-":
                held = start + m.end()
    return held or end


def _ends(kind, text, start, end):
    if kind == "card":
        return _card_end(text, start)
    if kind == "iban":
        return _iban_end(text, start)
    return _phone_end(text, start, end) if kind == "phone" else end


def _ssn(text, key, back):
    def valid(d):
        area = d[0] * 100 + d[1] * 10 + d[2]
        return area not in (0, 666) and area < 900 and any(d[3:5]) and any(d[5:])
    d = _digits(text)
    if not valid(d):
        return None
    return _fill(text, "".join(map(str, _walk(d, [10] * 9, key, "ssn", back, valid))))


def _date(text, key, back):
    n = _digits(text)
    number = (lambda a, b: int("".join(map(str, n[a:b]))))
    iso = text[4] == "-"
    if iso:
        y, m, d = number(0, 4), number(4, 6), number(6, 8)
    else:
        d, m, y = number(0, 2), number(2, 4), number(4, 8)
    if not 1900 <= y <= 2099 or not 1 <= m <= 12 or not 1 <= d <= calendar.monthrange(y, m)[1]:
        return None
    days = LAST_DAY - FIRST_DAY + 1
    at = permute([datetime.date(y, m, d).toordinal() - FIRST_DAY], [days], key, "date", back)[0]
    new = datetime.date.fromordinal(FIRST_DAY + at)
    return _fill(text, f"{new:%Y%m%d}" if iso else f"{new:%d%m%Y}")


def _phone(text, key, back):
    code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]|", text).group()
    d = _digits(text[len(code):])
    if not 7 <= len(d) + len(code) - bool(code) <= 15 or len(d) < 6:
        return None
    return code + _fill(text[len(code):], "".join(map(str, permute(d, [10] * len(d), key, "phone" + code, back))))


def _ip(text, key, back):
    parts = text.split(".")
    v = [int(p) for p in parts]
    if max(v) > 255 or any(p != str(x) for p, x in zip(parts, v, strict=True)):
        return None
    return ".".join(map(str, permute(v, [256] * 4, key, "ip", back)))


_RULES = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "phone": _phone, "ip": _ip}


def pseudonym(kind: str, text: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of one value, None where it fails its check."""
    return _RULES[kind](text, key, back)


def replace(text: str, key: bytes, back: bool = False, rule=pseudonym) -> tuple[str, dict[str, int]]:
    counts = dict.fromkeys(KINDS, 0)
    out, upto, at = [], 0, 0
    while (m := _FIND.search(text, at)):
        kind, start = m.lastgroup, m.start()
        end = _ends(kind, text, start, m.end())
        got = None if end is None else rule(kind, text[start:end], key, back)
        if got is None:  # what fails as one kind may begin another within
            if kind == "card":
                at = _GROUP.match(text, start).end()
            else:
                at = start + 1 if kind in ("phone", "iban") else m.end()
            continue
        counts[kind] += 1
        out += [text[upto:start], got]
        upto = at = end
    return "".join([*out, text[upto:]]), counts


def reveal(text: str, key: bytes) -> str:
    """Undoes ``replace`` with the same key."""
    return replace(text, key, back=True)[0]


def pseudonymize(documents: DataFrame, key: bytes, column: str = "text") -> DataFrame:
    """``documents`` with personal values in ``column`` replaced, and a count
    n_<kind> per kind (columns of these names are replaced)."""
    added = [f"n_{k}" for k in KINDS]
    docs = documents.drop(*added)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(a, T.LongType()) for a in added]])

    def run(batches):
        rule = functools.lru_cache(100_000)(pseudonym)
        none = dict.fromkeys(KINDS, 0)
        for b in batches:
            texts, counts = [], []
            for t in b.column(column).to_pylist():
                if t is None:
                    texts.append(None)
                    counts.append(none)
                    continue
                new, found = replace(t, key, rule=rule) if _MAY.search(t) else (t, none)
                texts.append(new)
                counts.append(found)
            at = b.schema.get_field_index(column)
            cols = list(b.columns)
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [*cols, *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS]],
                [*b.schema.names, *added])
    return docs.mapInArrow(run, schema)
