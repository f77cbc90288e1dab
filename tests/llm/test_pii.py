"""Pseudonyms against an independent implementation in plain Python."""

import hashlib
import re
from datetime import date, timedelta

import pytest

from claimcheck.llm import pii

KEY = "a secret of the tests"


def prf(tag, i, v):
    return int(hashlib.sha256(f"{KEY}|{tag}|{i}|{v}".encode()).hexdigest()[:12], 16)


def feistel(x, a, b, tag):
    h, low = divmod(x, b)
    for i in range(1, 9):
        if i % 2:
            h = (h + prf(tag, i, low)) % a
        else:
            low = (low + prf(tag, i, h)) % b
    return h * b + low


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def digits(d, kind):
    n = len(d)
    return str(feistel(int(d), 10 ** (n - n // 2), 10 ** (n // 2), f"{kind}{n}")).zfill(n)


def refill(layout, new):
    it = iter(new)
    return re.sub("[0-9]", lambda m: next(it), layout)


def card(m):
    d = re.sub("[^0-9]", "", m)
    if not luhn(d):
        return m
    body = d[0] + digits(d[1:-1], "card")
    return refill(m, body + next(c for c in "0123456789" if luhn(body + c)))


def ip(m):
    o = [int(x) for x in m.split(".")]
    if max(o) > 255 or any(x != str(int(x)) for x in m.split(".")):
        return m
    y = feistel(int.from_bytes(bytes(o), "big"), 65536, 65536, "ip")
    return ".".join(map(str, y.to_bytes(4, "big")))


def phone(m):
    all_d = re.sub("[^0-9]", "", m)
    lead, d = all_d[:-10], all_d[-10:]
    a, e, n = int(d[:3]), int(d[3:6]), int(d[6:])
    if a >= 200 and e >= 200:
        y = feistel(((a - 200) * 800 + e - 200) * 10000 + n, 80000, 80000, "phone")
        z, n = divmod(y, 10000)
        new = f"{z // 800 + 200}{z % 800 + 200}{n:04d}"
    else:
        r = digits(d[1:3] + d[4:], "phone-other")
        new = d[0] + r[:2] + d[3] + r[2:]
    return refill(m, lead + new)


def email(m):
    name, domain = m.split("@")
    c = len(name) // 2
    h, low = name[:c], name[c:]

    def moved(part, i, other):
        s = hashlib.sha512(f"{KEY}|email|{i}|{other}".encode()).hexdigest()
        out = ""
        for k, ch in enumerate(part):
            r = int(s[2 * k : 2 * k + 2], 16)
            for first, n in ((97, 26), (65, 26), (48, 10)):
                if first <= ord(ch) < first + n:
                    ch = chr(first + (ord(ch) - first + r) % n)
                    break
            out += ch
        return out

    for i in range(1, 9):
        if i % 2:
            h = moved(h, i, low)
        else:
            low = moved(low, i, h)
    return f"{h}{low}@{domain}"


def iso_date(m):
    try:
        x = (date.fromisoformat(m) - date(1900, 1, 1)).days
    except ValueError:
        return m
    return str(date(1900, 1, 1) + timedelta(feistel(x, 270, 270, "date"))) if 0 <= x < 72900 else m


BRUTE = {"email": email, "ip": ip, "date": iso_date, "phone": phone, "card": card}


def brute(text):
    if text is None:
        return None

    def one(m):
        kind = next(k for k, p in pii.FORMATS.items() if re.fullmatch(p, m[0]))
        return BRUTE[kind](m[0])

    return re.sub(pii.PATTERN, one, text)


def test_documents_match_brute_force_and_come_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pii.pseudonymise(docs, KEY)
    rows = {r.doc_id: r for r in out.collect()}
    changed = 0
    for r in docs.collect():
        assert rows[r.doc_id].text == brute(r.text), r.doc_id
        changed += rows[r.doc_id].text != r.text
    assert changed > 20
    back = {r.doc_id: r.text for r in pii.pseudonymise(out, KEY, inverse=True, counts=False).collect()}
    assert all(back[r.doc_id] == r.text for r in docs.collect())


SAMPLES = [
    ("ssn", "ssn 123-45-6789, not 666-45-6789 or 000-12-3456"),
    ("iban", "pay GB82WEST12345698765432 now"),
    ("iban", "pay DE89370400440532013000 now"),
    ("date", "born 1984-02-29, 31.12.1999, 07/04/1976 and 2001/05/06; not 2001-13-01 or 02/30/2001"),
    ("card", "4111 1111 1111 1111, 5500-0000-0000-0004, 340000000000009; not 4111111111111112"),
    ("intl", "call +49 30 1234567 today"),
    ("phone", "(123) 055-1234 or 212-555-0147 or +1 (743) 555-3824."),
    ("email", "Jo.Doe+x9@mail.example.com, é.a@b.org; not a@b"),
    ("ip", "10.0.0.1, 255.255.255.255. not 256.1.1.1 or 1.2.3.4.5"),
]


def test_formats_stay_valid_linked_and_invertible(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(SAMPLES)], "doc_id int, text string")
    out = pii.pseudonymise(df, KEY)
    rows = {r.doc_id: r for r in out.collect()}
    again = {r.doc_id: r for r in pii.pseudonymise(out, KEY).collect()}
    back = {r.doc_id: r.text for r in pii.pseudonymise(out, KEY, inverse=True).collect()}
    for i, (kind, t) in enumerate(SAMPLES):
        assert rows[i][f"n_{kind}"] > 0 and rows[i].text != t
        assert again[i][f"n_{kind}"] == rows[i][f"n_{kind}"]  # pseudonyms are valid in their turn
        assert back[i] == t
        for word in (t.split("not ")[1].split(" or ") if "not " in t else []):
            assert word.strip() in rows[i].text
    two = spark.createDataFrame([(1, "x 212-555-0147"), (2, "212-555-0147 y")], "doc_id int, text string")
    a, b = (r.text for r in pii.pseudonymise(two, KEY).orderBy("doc_id").collect())
    assert a.split()[1] == b.split()[0]


def test_addresses_stay_apart_and_come_back(spark):
    odd = ["010.000.000.001", "10.0.0.1", "10.0.0.01", "00.0.0.0", "0.0.0.0", "255.255.255.255", "1.2.3.004", "1.2.3.4", "192.168.1.1"]
    odd += [f"10.{i}.0.{j}" for i in range(12) for j in range(12)]
    df = spark.createDataFrame([(i, f"at {x} now") for i, x in enumerate(odd)], "doc_id int, text string")
    out = pii.pseudonymise(df, KEY)
    new = {r.doc_id: r.text for r in out.collect()}
    assert len(set(new.values())) == len(set(odd))
    assert {r.doc_id: r.text for r in pii.pseudonymise(out, KEY, inverse=True).collect()} == {i: f"at {x} now" for i, x in enumerate(odd)}
    assert all((new[i] == f"at {x} now") == any(p != str(int(p)) for p in x.split(".")) for i, x in enumerate(odd))


def test_iban_check_digits_outside_the_rule_stay(spark):
    body, country = "370400440532013000", "DE"

    def rest(check):
        return int("".join(str(int(c, 36)) for c in body + country + check)) % 97

    same = [f"{i:02d}" for i in range(100) if rest(f"{i:02d}") == 1]
    texts = [f"{country}{c}{body}" for c in same] + [f"FR{i:02d}20041010050500013M02606" for i in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    out = pii.pseudonymise(df, KEY)
    new = {r.doc_id: r.text for r in out.collect()}
    assert len(set(new.values())) == len(set(texts))
    assert {r.doc_id: r.text for r in pii.pseudonymise(out, KEY, inverse=True).collect()} == dict(enumerate(texts))


def test_a_key_is_needed_and_decides(spark):
    df = spark.createDataFrame([("at 10.0.0.1",)], "text string")
    assert pii.pseudonymise(df, "one").first().text != pii.pseudonymise(df, "two").first().text
    with pytest.raises(ValueError):
        pii.pseudonymise(df, "")


def test_permutation_of_a_small_range(spark):
    from pyspark.sql import functions as F

    n = lambda x: F.lit(x).cast("long")
    y = [r[0] for r in spark.range(35 * 20).select(pii.feistel(F.col("id"), n(35), n(20), "k", F.lit("t"))).collect()]
    assert sorted(y) == list(range(700)) and y != sorted(y)


def test_edges(spark):
    df = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2, "x " * 100000 + "10.0.0.1", "c"), (3, "10.0.0.1", "d"), (3, "10.0.0.1", "d")], "doc_id int, text string, n_ip string")
    out = pii.pseudonymise(df, KEY)
    assert out.columns[:2] == ["doc_id", "text"] and dict(out.dtypes)["n_ip"] == "int"
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[None].text is None and rows[1].text == "" and rows[2].text.split()[-1] == rows[3].text == ip("10.0.0.1")
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0
