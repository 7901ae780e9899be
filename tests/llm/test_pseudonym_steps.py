"""Every kind of pseudonym, computed step by step in plain Python."""

import datetime as dt
import random
from hashlib import sha256, sha512

from corpusmill.llm import pii

KEY = "k"
draw = random.Random(8)


def shifted(c, by):
    for first, n in (("0", 10), ("a", 26), ("A", 26)):
        if 0 <= ord(c) - ord(first) < n:
            return chr(ord(first) + (ord(c) - ord(first) + by) % n)
    return c


def feistel(value, kind):
    left, right = value[: len(value) // 2], value[len(value) // 2 :]
    for n in range(pii.ROUNDS):
        digest = sha512("|".join((KEY, kind, str(len(value)), str(n), right)).encode()).hexdigest()
        moved = "".join(shifted(c, int(digest[i % 16 * 8 :][:8], 16)) for i, c in enumerate(left))
        left, right = right, moved
    return left + right


def filled(template, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in template)


def only_digits(s):
    return "".join(c for c in s if c.isdigit())


def luhn(body):
    """The digit that makes a number valid."""
    total = 0
    for i, c in enumerate(reversed(body)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def card(m):
    body = feistel(only_digits(m)[:-1], "card")
    return filled(m, body + luhn(body))


def iban_check(country, bban):
    return f"{98 - int(''.join(str(int(c, 36)) for c in bban + country + '00')) % 97:02d}"


def iban(m):
    s = m.replace(" ", "")
    bban = feistel(s[4:], "iban")
    rest = iter(s[:2] + iban_check(s[:2], bban) + bban)
    return "".join(c if c == " " else next(rest) for c in m)


def address(m):
    a, b, c, d = map(int, m.split("."))
    left, right = a * 256 + b, c * 256 + d
    for n in range(pii.ROUNDS):
        left, right = right, left ^ int(sha256(f"{KEY}|ip|{n}|{right}".encode()).hexdigest()[:4], 16)
    return ".".join(map(str, (left >> 8, left & 255, right >> 8, right & 255)))


def day(d):
    n = (d - dt.date(1900, 1, 1)).days
    span, offset = divmod(n, 250 * 292)
    b, a = divmod(offset, 250)
    for r in range(pii.ROUNDS):
        x = b if r % 2 == 0 else a
        by = int(sha256(f"{KEY}|date|{r}|{x}".encode()).hexdigest()[:12], 16)
        a, b = ((a + by) % 250, b) if r % 2 == 0 else (a, (b + by) % 292)
    return dt.date(1900, 1, 1) + dt.timedelta(days=span * 250 * 292 + b * 250 + a)


def number(n, first="0123456789"):
    return draw.choice(first) + "".join(draw.choice("0123456789") for _ in range(n - 1))


def values():
    """Values of every kind, each with its pseudonym."""
    for n in (13, 15, 16, 19):
        body = number(n - 1, "3456")
        m = body + luhn(body)
        yield m, card(m)
        spaced = " ".join(m[i : i + 4] for i in range(0, n, 4))
        yield spaced, card(spaced)
    for country, n in (("DE", 22), ("NO", 15), ("FR", 27), ("GB", 22)):
        bban = ("ABCD" if country == "GB" else "") + number(n - (8 if country == "GB" else 4))
        m = country + iban_check(country, bban) + bban
        yield m, iban(m)
        spaced = " ".join(m[i : i + 4] for i in range(0, n, 4))
        yield spaced, iban(spaced)
    for _ in range(4):
        m = ".".join(str(draw.randrange(256)) for _ in range(4))
        yield m, address(m)
        d = dt.date(1950, 1, 1) + dt.timedelta(days=draw.randrange(30_000))
        new = day(d)
        yield f"{d:%Y-%m-%d}", f"{new:%Y-%m-%d}"
        yield f"{d:%d.%m.%Y}", f"{new:%d.%m.%Y}"
        m = f"{draw.randint(1, 665):03d}-{draw.randint(1, 99):02d}-{draw.randint(1, 9999):04d}"
        yield m, filled(m, feistel(only_digits(m), "ssn"))
        local, domain = f"ann.B{number(3)}+x".lower(), "@mail.example.com"
        yield local.upper() + domain, feistel(local, "email") + domain
        m = f"+44 20 {number(4, '123456789')} {number(4)}"
        yield m, filled(m, "44" + feistel(only_digits(m)[2:], "phone"))
        m = f"({number(3, '23456789')}) {number(3)}-{number(4)}"
        yield m, filled(m, feistel(only_digits(m), "phone"))


def test_every_kind(spark):
    cases = list(values())
    df = spark.createDataFrame([(i, f"a {m}, b", 5, "x") for i, (m, _) in enumerate(cases)], "doc_id long, text string, n_pii int, _done string")
    done = pii.pseudonymise(df, KEY)
    assert done.columns == ["doc_id", "text", "_done", "n_pii"]
    got = {r["doc_id"]: r for r in done.collect()}
    for i, (m, new) in enumerate(cases):
        assert (got[i]["text"], got[i]["n_pii"], got[i]["_done"]) == (f"a {new}, b", 1, "x"), m
    assert pii.pseudonymise(df, KEY, count=None).columns == df.columns
