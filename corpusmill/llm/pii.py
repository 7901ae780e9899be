"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Every value found is validated, reduced to its canonical characters and permuted by a keyed Feistel
network over those characters, each within its own class (digit or letter). The result goes back
into the format of the original, with check digits made right again. The permutation depends only on key,
kind and canonical value, so equal values get equal pseudonyms in every document, and different ones differ.
All of it is column expressions: a text is cut at its values and put together again in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import let

ROUNDS = 8

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
_DATE = (
    r"(?<![\w.+-])(?:\d{4}-\d{2}-\d{2}|\d{4}\.\d{2}\.\d{2}|(?<!/)\d{4}/\d{1,2}/\d{1,2}(?!/)"
    r"|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?!(?!T\d{2}(?!\d))[\w-]|[./]\d)"
)
_IP = r"(?<![\w.+-])(?:\d{1,3}\.){3}\d{1,3}(?![\w-]|\.\d)"
# an international number ends where it has 8 to 15 digits; written out, as Java needs the bound of a look behind
_DIGIT = r"[ .()-]{0,2}\d"
_PHONE = (
    r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{2,5}){2,5}(?!\w)(?<=\+"
    + _DIGIT * 8 + f"(?:{_DIGIT})?" * 7 + ")"
    + r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
)
_SSN = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
# countries by the length of their IBANs
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(c for codes in _IBAN_LENGTHS.values() for c in codes.split())
_IBAN = (
    r"(?<!\w)(?=[A-Z]{2}\d{2})(?:"
    + "|".join(rf"(?:{'|'.join(codes.split())})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in _IBAN_LENGTHS.items())
    + rf"|(?!{_KNOWN})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?!\w)"
)
# groups of digits in a row, up to the next value of another kind; cards are looked for inside
_OTHER = r"\d{1,4}[./]\d|\d{4}-\d{2}-\d{2}(?![\w-])|\d{1,2}-\d{1,2}-\d{4}(?![\w-])|\d{3}-\d{2,3}-\d{4}(?![\w-])"
_CARD = rf"(?<![\w.+-])\d(?:(?: (?!{_OTHER})|-)?\d){{12,200}}(?![\w-])"
PATTERN = "|".join((_EMAIL, _DATE, _IP, _SSN, _PHONE, _IBAN, _CARD))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _number(c: Column) -> Column:
    return F.ascii(c) - 48


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits, those at places ``doubled`` modulo two from the right doubled less nine."""
    return F.aggregate(
        F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(i % 2 == doubled, (_number(c) * 2).cast("int")).otherwise(_number(c))),
        F.lit(0),
        lambda a, x: (a + F.when(x > 9, x - 9).otherwise(x)).cast("int"),
    )


def mod97(iban: Column) -> Column:
    """The remainder of an IBAN, letters as 10 to 35 and the first four characters last."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(
        _chars(turned),
        F.lit(0).cast("int"),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + _number(c)) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"),
    )


def feistel(value: Column, kind: str, key: str) -> Column:
    """A permutation of strings that keeps length and the class of every character.

    The halves take turns: each round moves the letters and digits of one half within their class, by amounts from
    a keyed digest of the other half.
    """

    def moved(part: Column, other: Column, n: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), F.length(value).cast("string"), n.cast("string"), other)

        def amount(digest: Column, i: Column) -> Column:
            return F.conv(F.substring(digest, (i % 16) * 8 + 1, F.lit(8)), 16, 10).cast("long")

        def shifted(digest: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                by = amount(digest, i)
                return (
                    F.when(c.rlike("[0-9]"), F.char(48 + (_number(c) + by) % 10))
                    .when(c.rlike("[a-z]"), F.char(97 + (F.ascii(c) - 97 + by) % 26))
                    .when(c.rlike("[A-Z]"), F.char(65 + (F.ascii(c) - 65 + by) % 26))
                    .otherwise(c)
                )

            return F.array_join(F.transform(_chars(part), one), "")

        # one digest moves 16 characters; longer halves take them from the same digest again
        return let(F.sha2(seed, 512), shifted)

    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.length(value)).alias("r"))
    last = F.aggregate(
        F.array(*(F.lit(i) for i in range(ROUNDS))),
        start,
        lambda s, n: F.struct(s["r"].alias("l"), moved(s["l"], s["r"], n).alias("r")),
    )
    return let(last, lambda s: F.concat(s["l"], s["r"]))


def filled(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, from the left."""
    return F.array_join(
        F.transform(
            _chars(template),
            lambda c, i: F.when(
                c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(template, F.lit(1), i + 1))), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )


_EPOCH, _DAYS_A, _DAYS_B = "1900-01-01", 250, 292  # dates move within spans of 250 * 292 days


_YEAR_FIRST = "^[0-9]{4}[./-]"


def _date_of(m: Column) -> Column:
    same = F.translate(m, ".-", "//")
    year_first, european, american = (
        F.try_to_timestamp(same, F.lit(f)).cast("date") for f in ("yyyy/M/d", "d/M/yyyy", "M/d/yyyy")
    )
    return F.when(m.rlike(_YEAR_FIRST), year_first).otherwise(F.coalesce(european, american))


def _date_format(m: Column, new: Column) -> Column:
    """The new date as the old one was written: year first, or day first, or month first if only that was a date."""
    sep = F.regexp_extract(m, "[./-]", 0)
    day_first = F.try_to_timestamp(F.translate(m, ".-", "//"), F.lit("d/M/yyyy")).isNotNull()
    padded = m.rlike("^0|[./-]0")
    d, mo = F.dayofmonth(new).cast("string"), F.month(new).cast("string")
    d, mo = (F.when(padded | (F.length(m) == 10), F.lpad(x, 2, "0")).otherwise(x) for x in (d, mo))
    y = F.lpad(F.year(new).cast("string"), 4, "0")
    return F.when(m.rlike(_YEAR_FIRST), F.concat(y, sep, mo, sep, d)).otherwise(
        F.concat(F.when(day_first, d).otherwise(mo), sep, F.when(day_first, mo).otherwise(d), sep, y)
    )


def permuted_day(day: Column, key: str) -> Column:
    """A keyed permutation of day numbers inside their span, by a Feistel network of mixed radix."""
    n = _DAYS_A * _DAYS_B
    span, offset = F.floor(day / n).cast("int"), F.pmod(day, F.lit(n)).cast("int")

    def draw(x: Column, r: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("date"), r.cast("string"), x.cast("string")), 256), 1, 12), 16, 10).cast("long")

    start = F.struct((offset % _DAYS_A).cast("int").alias("a"), F.floor(offset / _DAYS_A).cast("int").alias("b"))
    moved = F.aggregate(
        F.array(*(F.lit(i) for i in range(ROUNDS))),
        start,
        lambda s, r: F.when(
            r % 2 == 0,
            F.struct(((s["a"] + draw(s["b"], r)) % _DAYS_A).cast("int").alias("a"), s["b"].alias("b")),
        ).otherwise(F.struct(s["a"].alias("a"), ((s["b"] + draw(s["a"], r)) % _DAYS_B).cast("int").alias("b"))),
    )
    return let(moved, lambda s: span * n + s["b"] * _DAYS_A + s["a"]).cast("int")


def _address(octets: Column, key: str) -> Column:
    """A keyed permutation of IPv4 addresses: a Feistel network over the two 16-bit halves."""
    part = lambda i: F.get(octets, F.lit(i)).cast("int")

    def draw(x: Column, r: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("ip"), r.cast("string"), x.cast("string")), 256), 1, 4), 16, 10).cast("int")

    start = F.struct((part(0) * 256 + part(1)).alias("l"), (part(2) * 256 + part(3)).alias("r"))
    moved = F.aggregate(
        F.array(*(F.lit(i) for i in range(ROUNDS))),
        start,
        lambda s, n: F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(draw(s["r"], n)).alias("r")),
    )
    octet = lambda x, hi: (F.floor(x / 256) if hi else x % 256).cast("int").cast("string")
    return let(moved, lambda s: F.concat_ws(".", octet(s["l"], True), octet(s["l"], False), octet(s["r"], True), octet(s["r"], False)))


def cards(m: Column, key: str) -> Column:
    """``struct(text, n)``: the match with its cards replaced, and how many there are.

    A card is 13 to 19 digits from the start of a group to the end of one; of those that pass the check
    the first and longest counts. One that is not the whole match begins with 2 to 6, as payment cards do.
    """

    def card(w: Column) -> Column:
        d = _digits(w)
        new = feistel(F.substring(d, F.lit(1), F.length(d) - 1), "card", key)
        return let(new, lambda x: filled(w, F.concat(x, ((10 - luhn_sum(x, 0) % 10) % 10).cast("string"))))

    def window(s: Column, e: Column) -> Column:
        return F.substring(m, s, e - s + 1)

    def valid(s: Column, e: Column) -> Column:
        w = window(s, e)
        whole = (s == 1) & (e == F.length(m))
        shaped = w.rlike(r"^[0-9](?:[ -]?[0-9]){12,18}$") & (whole | w.rlike("^[2-6]"))
        return F.when(shaped, luhn_sum(_digits(w), 1) % 10 == 0).otherwise(F.lit(False))

    def edges(step: int) -> Column:
        """Places of digits with no letter or digit before (-1) or after (1) them."""
        def edge(i: Column) -> Column:
            beside = F.when((i + step >= 1) & (i + step <= F.length(m)), F.substring(m, i + step, F.lit(1))).otherwise(F.lit(""))
            return F.substring(m, i, F.lit(1)).rlike("[0-9]") & ~beside.rlike("[A-Za-z0-9]")
        return F.filter(F.sequence(F.lit(1), F.length(m)), edge)

    def scan(ends: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            end = F.array_max(F.filter(ends, lambda e: (e - s).between(12, 36) & valid(s, e)))
            taken = let(
                F.when(s >= state["at"], end),
                lambda e: F.when(e.isNull(), state).otherwise(
                    F.struct(
                        (e + 1).cast("int").alias("at"),
                        F.concat(state["text"], F.substring(m, state["at"], s - state["at"]), card(window(s, e))).alias("text"),
                        (state["n"] + 1).cast("int").alias("n"),
                    )
                ),
            )
            return taken

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"), F.lit(0).alias("n"))
        return let(
            F.aggregate(edges(-1), start, step),
            lambda z: F.struct(F.concat(z["text"], F.substring(m, z["at"], F.length(m))).alias("text"), z["n"].alias("n")),
        )

    return let(edges(1), scan)


def pseudonym(m: Column, key: str) -> Column:
    """``struct(text, n)``: the match with its values replaced, and how many there are.

    What is no valid value of its kind may still hold a card.
    """
    one = let(whole_pseudonym(m, key), lambda w: F.when(w.isNotNull(), F.struct(w.alias("text"), F.lit(1).alias("n"))))
    return let(one, lambda w: F.when(w.isNotNull(), w).otherwise(cards(m, key)))


def whole_pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match that is one value, or null if it is not a valid value of any kind but a card."""

    def iban(s: Column) -> Column:
        new = feistel(F.substring(s, F.lit(5), F.length(s)), "iban", key)
        check = let(new, lambda x: F.lpad((98 - mod97(F.concat(F.substring(s, 1, 2), F.lit("00"), x))).cast("string"), 2, "0"))
        joined = F.concat(F.substring(s, 1, 2), check, new)
        # spaces go back where they were
        return let(
            joined,
            lambda x: F.array_join(
                F.transform(
                    _chars(m),
                    lambda c, i: F.when(c == " ", c).otherwise(
                        F.substring(x, F.length(F.translate(F.substring(m, F.lit(1), i + 1), " ", "")), F.lit(1))
                    ),
                ),
                "",
            ),
        )

    def phone(d: Column) -> Column:
        country = F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})", 1))
        # of an unbroken international number the first digit counts as country code
        country = F.when(m.rlike(r"^\+[0-9]{4,}"), F.lit(1)).otherwise(country)
        return filled(
            m, F.concat(F.substring(d, F.lit(1), country), feistel(F.substring(d, country + 1, F.length(d)), "phone", key))
        )

    def ssn(d: Column) -> Column:
        valid = ~d.rlike("^(000|666|9)") & ~d.rlike("^[0-9]{3}00") & ~d.rlike("0000$")
        return F.when(valid, filled(m, feistel(d, "ssn", key)))

    digits = _digits(m)
    at = F.instr(m, "@")
    octets = F.split(m, r"\.")
    good_octets = ~F.exists(octets, lambda o: (F.length(o) > 3) | (F.lpad(o, 3, "0") > "255"))
    spaceless = F.translate(m, " ", "")
    day = _date_of(m)
    new_day = F.date_add(F.lit(_EPOCH).cast("date"), permuted_day(F.date_diff(day, F.lit(_EPOCH).cast("date")), key))
    return (
        F.when(at > 0, F.concat(feistel(F.lower(F.substring(m, F.lit(1), at - 1)), "email", key), F.substring(m, at, F.length(m))))
        .when(m.rlike("^[A-Z]"), let(spaceless, lambda s: F.when(mod97(s) == 1, iban(s))))
        .when(m.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"), F.when(good_octets, _address(octets, key)))
        .when(m.rlike(r"^([0-9]{4}([./-][0-9]{1,2}){2}|([0-9]{1,2}[./-]){2}[0-9]{4})$"), F.when(day.isNotNull(), _date_format(m, new_day)))
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), let(digits, ssn))
        .when(m.rlike(r"^[+(]|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$"), let(digits, lambda d: F.when(F.length(d).between(8, 15), phone(d))))
    )


def pseudonymised(text: Column, key: str) -> Column:
    """``struct(text, n)``: the text with its values replaced, and how many were."""
    pieces = F.split(text, PATTERN, -1)
    values = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def rebuilt(v: Column) -> Column:
        new = F.transform(v, lambda m: pseudonym(m, key))
        return let(
            new,
            lambda w: F.struct(
                F.array_join(
                    F.zip_with(pieces, w, lambda p, x: F.concat(p, F.coalesce(x["text"], F.lit("")))), ""
                ).alias("text"),
                F.aggregate(w, F.lit(0), lambda a, x: a + x["n"]).alias("n"),
            ),
        )

    untouched = F.struct(text.alias("text"), F.lit(0).alias("n"))
    return F.when(text.rlike("[0-9@]"), let(values, lambda v: F.when(F.size(v) > 0, rebuilt(v)).otherwise(untouched))).otherwise(untouched)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count: str | None = "n_pii") -> DataFrame:
    """The rows of ``docs`` with their text pseudonymised, and the number of values replaced as ``count`` (None: without it).

    E-mail addresses keep their domain, phone numbers their country code, cards and IBANs stay valid, dates and
    IPv4 addresses stay dates and addresses. Of a time only the date is moved. Numbers that fail their
    check are left as they are; a valid one beside other numbers or words is replaced, the rest is text. A null text
    stays null. No row depends on another; an existing column ``count`` is replaced, all others stay, whatever their names.
    """
    names = docs.columns
    done = "_done"
    while done in names:
        done += "_"
    rows = docs.withColumn(done, pseudonymised(F.col(text_col), key))
    columns = [F.col(done)["text"].alias(c) if c == text_col else F.col(f"`{c}`") for c in names if c != count]
    counted = [] if count is None else [F.coalesce(F.col(done)["n"], F.lit(0)).alias(count)]
    return rows.select(*columns, *counted)
