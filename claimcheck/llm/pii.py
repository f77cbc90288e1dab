r"""Format-preserving pseudonyms for personal data (operator 3).

Only DataFrame expressions: one pattern finds candidates, each is validated,
and what is valid is replaced by another valid value of its format.  A value
becomes a number in a product of two ranges, A x B; eight Feistel rounds add to
one half a keyed hash of the other, modulo the half's range.  That permutes the
format's values, so equal values get equal pseudonyms in all documents, no two
values get one, and whoever has the key can go back.

    card    13-19 digits with a Luhn check digit; first digit kept, check digit made anew
    iban    mod-97 valid, check digits 02 to 98; digits of the account permuted, check digits made anew
    ssn     valid area-group-serial
    phone   North American; area and exchange from 200 stay so, others keep their first digits
    intl    + and 8-15 digits; the first two kept
    ip      four octets of at most 255 without leading zeros
    date    1900-01-01 to 2099-08-04 as y-m-d, y/m/d, m/d/y or d.m.y with two-digit days and months
    email   letters and digits of the name permuted by class; the domain kept
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DATE_FROM, DATE_SIDE = "1900-01-01", 270  # 270 * 270 days

# The formats, in order of preference at one place.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?:(?<![0-9])\+?1[ .-]?)?(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "intl": r"\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])",
}
PATTERN = "|".join(FORMATS.values())


def _hash(key: str, tag: Column, i: Column, v: Column, bits: int = 256) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), v.cast("string")), bits)


def _rounds(inverse: bool) -> Column:
    return F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))


def _quotient(x: Column, n: Column) -> Column:
    """x div n for longs."""
    return F.call_function("div", x, n).cast("long")


def feistel(x: Column, a: Column, b: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """Permutes the longs 0 .. a*b-1 under a key and a tag."""
    sign = -1 if inverse else 1
    number = lambda i, v: F.conv(F.substring(_hash(key, tag, i, v), 1, 12), 16, 10).cast("long")

    def step(s, i):
        odd = i % 2 == 1
        h = F.when(odd, F.pmod(s["h"] + sign * number(i, s["l"]), a)).otherwise(s["h"])
        low = F.when(odd, s["l"]).otherwise(F.pmod(s["l"] + sign * number(i, s["h"]), b))
        return F.struct(h.cast("long").alias("h"), low.cast("long").alias("l"))

    start = F.struct(_quotient(x, b).cast("long").alias("h"), (x % b).cast("long").alias("l"))
    return F.aggregate(_rounds(inverse), start, step, lambda s: s["h"] * b + s["l"])


def _div(x: Column, n: int) -> Column:
    return _quotient(x, _long(n))


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("long")


def _digits_permuted(d: Column, key: str, kind: str, inverse: bool) -> Column:
    """A digit string of 1 to 18 digits -> another of its length."""
    n = F.length(d)
    half = F.floor(n / 2).cast("int")
    tag = F.concat(F.lit(kind), n.cast("string"))
    out = feistel(d.cast("long"), _ten(n - half), _ten(half), key, tag, inverse)
    return F.lpad(out.cast("string"), n, F.lit("0"))


def _refill(layout: Column, digits: Column) -> Column:
    """The layout with its digits, from the left, replaced by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s, c):
        isdigit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(isdigit, digits.substr(s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + isdigit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(layout, ""), start, step, lambda s: s["out"])


def _num(m: Column, at: int, n: int) -> Column:
    return F.substring(m, at, n).try_cast("long")


def _card(m, key, inverse):
    d = F.regexp_replace(m, "[^0-9]", "")
    body = F.concat(F.substring(d, 1, 1), _digits_permuted(d.substr(F.lit(2), F.length(d) - 2), key, "card", inverse))
    check = F.element_at(F.filter(F.sequence(F.lit(0), F.lit(9)), lambda c: F.call_function("luhn_check", F.concat(body, c.cast("string")))), 1)
    return F.call_function("luhn_check", d), _refill(m, F.concat(body, check.cast("string")))


def _mod97(s: Column) -> Column:
    """Remainder by 97 of the number that letters (A = 10) and digits spell."""
    up = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def step(acc, c):
        v = F.call_function("instr", F.lit(up), c) - 1
        return F.when(v > 9, (acc * 100 + v) % 97).otherwise((acc * 10 + v) % 97)

    return F.aggregate(F.split(s, ""), F.lit(0), step)


def _iban(m, key, inverse):
    tail, country = m.substr(F.lit(5), F.length(m)), F.substring(m, 1, 2)
    d = F.regexp_replace(tail, "[^0-9]", "")
    one, two = F.substring(d, 1, 15), d.substr(F.lit(16), F.lit(15))
    fresh = F.concat(
        F.when(one != "", _digits_permuted(one, key, "iban1", inverse)).otherwise(""),
        F.when(two != "", _digits_permuted(two, key, "iban2", inverse)).otherwise(""),
    )
    body = _refill(tail, fresh)
    check = F.lit(98) - _mod97(F.concat(body, country, F.lit("00")))
    # 98 - remainder gives 02 to 98: other check digits would share a pseudonym with one of these
    ok = (_mod97(F.concat(tail, F.substring(m, 1, 4))) == 1) & (d != "") & F.substring(m, 3, 2).between("02", "98")
    return ok, F.concat(country, F.lpad(check.cast("string"), 2, "0"), body)


def _ip(m, key, inverse):
    o = [F.split(m, r"\.")[i].try_cast("long") for i in range(4)]
    x = ((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3]
    y = feistel(x, _long(65536), _long(65536), key, F.lit("ip"), inverse)
    parts = [F.shiftright(y, 24 - 8 * i).bitwiseAND(F.lit(255).cast("long")).cast("string") for i in range(4)]
    return (F.greatest(*o) <= 255) & ~m.rlike(r"(^|\.)0[0-9]"), F.concat_ws(".", *parts)


def _date(m, key, inverse):
    form = (
        F.when(F.substring(m, 5, 1) == "-", "yyyy-MM-dd")
        .when(F.substring(m, 5, 1) == "/", "yyyy/MM/dd")
        .when(F.substring(m, 3, 1) == "/", "MM/dd/yyyy")
        .otherwise("dd.MM.yyyy")
    )
    parts = F.split(m, "[./-]")
    year = F.when(F.length(parts[0]) == 4, parts[0]).otherwise(parts[2])
    month = F.when(form == "yyyy-MM-dd", parts[1]).when(form == "yyyy/MM/dd", parts[1]).when(form == "MM/dd/yyyy", parts[0]).otherwise(parts[1])
    day = F.when(F.length(parts[0]) == 4, parts[2]).when(form == "MM/dd/yyyy", parts[1]).otherwise(parts[0])
    date = F.concat_ws("-", year, month, day).try_cast("date")
    x = F.datediff(date, F.lit(DATE_FROM).cast("date")).cast("long")
    y = F.date_add(F.lit(DATE_FROM).cast("date"), feistel(x, _long(DATE_SIDE), _long(DATE_SIDE), key, F.lit("date"), inverse).cast("int")).cast("string")
    yy, mm, dd = F.substring(y, 1, 4), F.substring(y, 6, 2), F.substring(y, 9, 2)
    out = (
        F.when(form == "yyyy-MM-dd", y)
        .when(form == "yyyy/MM/dd", F.concat_ws("/", yy, mm, dd))
        .when(form == "MM/dd/yyyy", F.concat_ws("/", mm, dd, yy))
        .otherwise(F.concat_ws(".", dd, mm, yy))
    )
    return F.coalesce((x >= 0) & (x < DATE_SIDE**2), F.lit(False)), out


def _ssn(m, key, inverse):
    area, group, serial = _num(m, 1, 3), _num(m, 5, 2), _num(m, 8, 4)
    ok = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    x = ((area - 1 - (area > 666).cast("long")) * 99 + group - 1) * 9999 + serial - 1
    y = feistel(x, _long(898 * 99), _long(9999), key, F.lit("ssn"), inverse)
    s, g = y % 9999 + 1, _div(y, 9999)
    a = _div(g, 99) + 1
    a = a + (a >= 666).cast("long")
    return ok, F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((g % 99 + 1).cast("string"), 2, "0"), F.lpad(s.cast("string"), 4, "0"))


def _phone(m, key, inverse):
    all_d = F.regexp_replace(m, "[^0-9]", "")
    d = F.substring(all_d, -10, 10)
    lead = all_d.substr(F.lit(1), F.length(all_d) - 10)
    area, exchange, line = _num(d, 1, 3), _num(d, 4, 3), _num(d, 7, 4)
    good = (area >= 200) & (exchange >= 200)
    x = ((area - 200) * 800 + exchange - 200) * 10000 + line
    y = feistel(x, _long(80000), _long(80000), key, F.lit("phone"), inverse)
    z = _div(y, 10000)
    valid = F.concat(
        (_div(z, 800) + 200).cast("string"), (z % 800 + 200).cast("string"), F.lpad((y % 10000).cast("string"), 4, "0")
    )
    rest = _digits_permuted(F.concat(F.substring(d, 2, 2), F.substring(d, 5, 6)), key, "phone-other", inverse)
    other = F.concat(F.substring(d, 1, 1), F.substring(rest, 1, 2), F.substring(d, 4, 1), F.substring(rest, 3, 6))
    return F.lit(True), _refill(m, F.concat(lead, F.when(good, valid).otherwise(other)))


def _intl(m, key, inverse):
    d = F.regexp_replace(m, "[^0-9]", "")
    body = F.concat(F.substring(d, 1, 2), _digits_permuted(d.substr(F.lit(3), F.length(d) - 2), key, "intl", inverse))
    return F.length(d).between(8, 15), _refill(m, body)


def _email(m, key, inverse):
    """Feistel on the halves of the name: characters of one half move, within their class, by a keyed hash of the other."""
    name, domain = F.substring_index(m, "@", 1), F.concat(F.lit("@"), F.substring_index(m, "@", -1))
    cut = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(name.substr(F.lit(1), cut).alias("h"), name.substr(cut + 1, F.length(name)).alias("l"))
    sign = -1 if inverse else 1

    def moved(part, i, other):
        stream = _hash(key, F.lit("email"), i, other, 512)

        def one(c, at):
            k = F.conv(stream.substr(at * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            turn = lambda first, n: F.char(F.lit(first) + F.pmod(code - first + sign * k, F.lit(n)))
            return (
                F.when(code.between(97, 122), turn(97, 26)).when(code.between(65, 90), turn(65, 26)).when(code.between(48, 57), turn(48, 10)).otherwise(c)
            )

        return F.array_join(F.transform(F.split(part, ""), one), "")

    def step(s, i):
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, moved(s["h"], i, s["l"])).otherwise(s["h"]).alias("h"),
            F.when(odd, s["l"]).otherwise(moved(s["l"], i, s["h"])).alias("l"),
        )

    return F.lit(True), F.concat(F.aggregate(_rounds(inverse), start, step, lambda s: F.concat(s["h"], s["l"])), domain)


KINDS: dict[str, Callable] = {
    "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "intl": _intl, "card": _card,
}


def _replaced(m: Column, key: str, inverse: bool) -> Column:
    """struct(kind, out) of one match; kind is null where the value is not valid."""
    kind, out = F.lit(None).cast("string"), m
    for name in reversed(KINDS):
        ok, value = KINDS[name](m, key, inverse)
        is_it = m.rlike(f"^(?:{FORMATS[name]})$")
        valid = F.coalesce(ok, F.lit(False))
        kind = F.when(is_it, F.when(valid, F.lit(name))).otherwise(kind)
        out = F.when(is_it, F.when(valid, value).otherwise(m)).otherwise(out)
    return F.struct(kind.alias("kind"), out.alias("out"))


def _count(kinds: Column, kind: str) -> Column:
    return F.when(F.size("__found") > 0, F.size(F.filter(kinds, lambda x: x == kind))).otherwise(0)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", inverse: bool = False, counts: bool = True) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and, if asked, n_<kind> counts.

    ``key`` is the secret: whoever has it restores the values by ``inverse``.

    Defined cases: a null text stays null and counts 0; an empty text stays
    empty; values that are not valid stay, such as addresses with leading zeros
    in an octet; repeated rows get the same text; all other columns stay, but
    columns named n_<kind> are replaced by the counts; an empty table gives an
    empty result; an empty key is an error.  Row-wise, so no shuffle and no skew.
    """
    if not key:
        raise ValueError("a key is needed")
    t = F.col(f"`{text_col}`").cast("string")
    keep = [c for c in docs.columns if not (counts and c in {f"n_{k}" for k in KINDS}) and c != text_col]
    found = docs.withColumn("__found", F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>")))
    found = found.withColumn("__new", F.transform("__found", lambda m: _replaced(m, key, inverse)))
    pieces = F.split(t, PATTERN, -1)
    joined = F.array_join(
        F.zip_with(pieces, F.col("__new")["out"], lambda p, o: F.concat(p, F.coalesce(o, F.lit("")))), ""
    )
    text = F.when(F.size("__found") > 0, joined).otherwise(t).alias(text_col)
    kinds = F.col("__new")["kind"]
    n = [_count(kinds, k).alias(f"n_{k}") for k in KINDS] if counts else []
    order = [text if c == text_col else F.col(f"`{c}`") for c in docs.columns if c == text_col or c in keep]
    return found.select(*order, *n)
