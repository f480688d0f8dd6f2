"""Personal data: format-preserving pseudonyms (operator 10), DataFrame functions only.

Found: e-mail addresses, phone numbers (ten digits as 3-3-4, the first three also in brackets, with
or without a country code; eight to fifteen digits after a plus, in any groups), payment cards of 13
to 19 digits that satisfy the Luhn sum (plain, in fours, as 4-6-5 or 4-6-4), social security numbers
with valid area, group and serial, IPv4 addresses with octets up to 255, and valid dates from 1800
to 2199, year first or last (day before month where both readings are valid). Digits may be parted
by blanks, dots or hyphens, those of dates by hyphens, dots or slashes; the marks are put back. Candidates that fail their validation stay as they are: a sixteen-digit number with a wrong
check digit is not a card.

Every validated value x of a finite domain 0..a*b-1 is replaced by an alternating Feistel network
over Z_a x Z_b: in round r one half gets F(key, kind, r, other half) added modulo its size. Each
round is invertible, so the whole is a keyed permutation of exactly the values of that format; no
cycle walking is needed. Equal values get equal pseudonyms in every document, and different values
never meet. ``restore`` runs the rounds backwards. Cards permute all digits but the last and get a
fresh check digit, phones keep their country code, dates map to dates of the same 400-year cycle. Dates with the year
last are permuted among the valid dates of the same reading and the same widths of day and month
(29 February among leap years), so that their pseudonym is read as they are.
E-mail addresses are not numbers; their local part becomes a keyed hash, the domain stays.

Defined results: null texts stay null with no finds, empty ones empty; every row comes back once
with all its columns; repeated rows get equal results; texts are processed whole.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats. Possessive quantifiers and look-behinds keep matching linear in the text.
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}")
# Country calling codes by the least and most digits of their national numbers.
CALLING_CODES = {
    (7, 7): "354", (7, 8): "372", (7, 9): "46 353", (7, 10): "358", (7, 11): "39 43 49", (8, 8):
    "45 47 65 370 371 852", (8, 9): "32 36 51 971 972", (8, 10): "64",
    (9, 9): "27 31 33 34 40 41 48 56 61 66 351 380 420 421 886", (9, 10): "44 60 81 82 84",
    (9, 11): "62", (10, 10): "1 7 20 30 52 54 57 58 63 90 91 92 98", (10, 11): "55 86"}
_CODES = sorted((c for codes in CALLING_CODES.values() for c in codes.split()), key=lambda c: (-len(c), c))
_NEXT = r"(?:(?:[ .-]| ?\(|\)[ .-]?)?[0-9])"                    # a digit, a mark before it
_INTERNATIONAL = "|".join(f"(?:{codes.replace(' ', '|')})(?: ?\\(0\\))?{_NEXT}{{{low},{high}}}"
                          for (low, high), codes in CALLING_CODES.items())
PHONE = (r"(?:(?<![0-9+])\+[0-9]{1,3}[ .-]?|(?<![0-9+])(?<![0-9][.-])1[ .-])?"
         r"\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9+])(?<![0-9][.-])(?:\+[0-9]{1,3}[ .-]|1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
         r"(?![0-9])(?![.-][0-9])"
         rf"|(?<![0-9+])\+(?:{_INTERNATIONAL})(?![0-9])"
         rf"|(?<![0-9+])\+[0-9]{_NEXT}{{7,14}}(?![0-9])")
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}"
        r"|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{4,5})(?![0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])"
DATE = (r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
        r"|(?<![0-9])(?<![0-9][./-])(?:[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{4}\.[0-9]{2}\.[0-9]{2}"
        r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
        r"|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4})(?![0-9])(?![./-][0-9])")
ANY = "|".join([EMAIL, PHONE, CARD, SSN, IPV4, DATE])
KINDS = ("email", "phone", "card", "ssn", "ipv4", "date")
_WHOLE = {k: f"^(?:{p})$" for k, p in zip(KINDS, (EMAIL, PHONE, CARD, SSN, IPV4, DATE))}

ROUNDS = 10
CYCLE_DAYS = (189, 773)              # 189 * 773 = 146097 days of 400 Gregorian years
SSN_AREAS, SSN_GROUPS, SSN_SERIALS = 898, 99, 9999
YEARS = range(1800, 2200)
LEAP = [y for y in YEARS if y % 4 == 0 and (y % 100 or y % 400 == 0)]


def _written_days() -> list[list[str]]:
    """Day and month as written before the year, "3/12", in classes of one reading and the same
    widths. Pairs that can be read day first are; 29 February is in classes of its own."""
    classes: dict[tuple, list[str]] = {}
    for first in (*range(1, 32), *(f"{k:02}" for k in range(1, 10))):
        for second in (*range(1, 32), *(f"{k:02}" for k in range(1, 10))):
            a, b = str(first), str(second)
            x, y = int(a), int(b)
            day, month = (x, y) if y <= 12 else (y, x)
            if month <= 12 and day <= calendar.monthrange(2000, month)[1]:
                leap = (day, month) == (29, 2)
                classes.setdefault((leap, y <= 12, len(a), len(b)), []).append(f"{a}/{b}")
    return [classes[k] for k in sorted(classes)]        # leap days last


WRITTEN = _written_days()


def _long(c: Column) -> Column:
    return c.cast("bigint")


def _div(x: Column, y: Column) -> Column:
    """Integer quotient of longs (``/`` would go through DOUBLE and lose digits)."""
    return F.call_function("div", x, y)


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _power10(n: Column) -> Column:
    """10^n as a long, exact for n up to 18."""
    return _long(F.rpad(F.lit("1"), _int(n + 1), "0"))


def _int(c: Column) -> Column:
    return c.cast("int")


def _round(key: str, kind: str, r: Column, half: Column) -> Column:
    """Fifteen hexadecimal digits of sha-256, an integer below 2^60."""
    text = F.concat_ws(":", F.lit(key), F.lit(kind), r.cast("string"), half.cast("string"))
    return _long(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10))


def feistel(x: Column, a: Column, b: Column, key: str, kind: str, back: bool = False) -> Column:
    """The keyed permutation of 0..a*b-1 applied to ``x`` (or undone)."""
    def step(s, r):
        left, right = s["l"], s["r"]
        sign = -1 if back else 1
        new_left = F.struct(F.pmod(left + sign * F.pmod(_round(key, kind, r, right), a), a)
                            .alias("l"), right.alias("r"))
        new_right = F.struct(left.alias("l"),
                             F.pmod(right + sign * F.pmod(_round(key, kind, r, left), b), b)
                             .alias("r"))
        return F.when(r % 2 == 0, new_left).otherwise(new_right)
    rounds = list(range(ROUNDS))
    order = F.array(*[F.lit(r) for r in (reversed(rounds) if back else rounds)])
    start = F.struct(_div(x, b).alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(order, start, step, lambda s: s["l"] * b + s["r"])


def _permute_digits(digits: Column, key: str, kind: str, back: bool) -> Column:
    """A digit string (at most 18 digits) permuted among those of its length."""
    n = F.length(digits)
    low = _long(F.floor(n / 2))
    a, b = _power10(low), _power10(n - low)
    # the length is part of the key, as each length is a domain of its own
    out = feistel(_long(digits), a, b, key, kind, back)
    return F.lpad(out.cast("string"), _int(n), "0")


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum of a digit string; ``doubled_last``: whether the last digit counts twice."""
    def add(s, d):
        twice = d * 2
        value = F.when(s["two"], twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
        return F.struct((s["sum"] + value).alias("sum"), (~s["two"]).alias("two"))
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: _int(c))
    start = F.struct(F.lit(0).alias("sum"), F.lit(doubled_last).alias("two"))
    return F.aggregate(each, start, add, lambda s: s["sum"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _card_valid(m: Column) -> Column:
    return _luhn_sum(_digits(m), False) % 10 == 0


def _card(m: Column, key: str, back: bool) -> Column:
    d = _digits(m)
    n = F.length(d)
    body = _permute_digits(F.substring(d, F.lit(1), n - 1), key, "card", back)
    return _put(m, _let(body, lambda x: F.concat(
        x, F.pmod(10 - _luhn_sum(x, True) % 10, F.lit(10)).cast("string"))))


def _put(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in turn, marks between them in their places."""
    def put(d):
        return F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(
            c.rlike("[0-9]"), F.substring(d, F.length(_digits(F.substring(m, F.lit(1), i + 1))),
                                          F.lit(1))).otherwise(c)), "")
    return _let(digits, put)


_TRUNK = "(\ue000)"                    # stands for "(0)", which is no part of the number


def _phone(m: Column, key: str, back: bool) -> Column:
    """The national number permuted, so that a number keeps one pseudonym whatever its notation:
    the country code stays, taken from the table where the number has a plus."""
    bare = F.regexp_replace(m, r"\(0\)", _TRUNK)
    digits = _digits(bare)
    code = F.when(m.startswith("+"), F.regexp_extract(digits, f"^(?:{'|'.join(_CODES)}|[0-9])", 0)) \
        .when(F.length(digits) == 11, F.lit("1")).otherwise(F.lit(""))
    new = _let(F.struct(digits.alias("d"), code.alias("c")), lambda x: F.concat(
        x["c"], _permute_digits(F.substring(x["d"], F.length(x["c"]) + 1, F.length(x["d"])),
                                key, "phone", back)))
    return F.replace(_put(bare, new), F.lit(_TRUNK), F.lit("(0)"))


def _ssn_parts(m: Column) -> tuple[Column, Column, Column]:
    return tuple(_long(F.substring(m, s, n)) for s, n in ((1, 3), (5, 2), (8, 4)))


def _ssn_valid(m: Column) -> Column:
    area, group, serial = _ssn_parts(m)
    return (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)


def _ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = _ssn_parts(m)
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)       # 0..897
    b = SSN_GROUPS * SSN_SERIALS
    x = rank * b + (group - 1) * SSN_SERIALS + serial - 1
    y = feistel(x, _long(F.lit(SSN_AREAS)), _long(F.lit(b)), key, "ssn", back)
    low = F.pmod(y, _long(F.lit(b)))
    top = _div(y, _long(F.lit(b)))
    new_serial = F.pmod(low, _long(F.lit(SSN_SERIALS)))
    new_group = _div(low, _long(F.lit(SSN_SERIALS)))
    new_area = top + 1 + F.when(top + 1 >= 666, 1).otherwise(0)
    return F.concat_ws("-", *[F.lpad(c.cast("string"), n, "0") for c, n in (
        (new_area, 3), (new_group + 1, 2), (new_serial + 1, 4))])


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda o: _long(o))


def _ipv4_valid(m: Column) -> Column:
    """Octets up to 255, written without leading zeros."""
    return ~F.exists(F.split(m, r"\."),
                     lambda o: (_long(o) > 255) | (o.startswith("0") & (F.length(o) > 1)))


def _ipv4(m: Column, key: str, back: bool) -> Column:
    x = F.aggregate(_octets(m), F.expr("0L"), lambda s, o: s * 256 + o)
    half = _long(F.lit(65536))
    y = feistel(x, half, half, key, "ipv4", back)
    return F.concat_ws(".", *[F.pmod(F.shiftright(y, s), F.lit(256)).cast("string")
                              for s in (24, 16, 8, 0)])


def _date(m: Column) -> Column:
    """The date written year first, or null where it is not one of the 400-year cycle."""
    iso = F.translate(m, "./", "--")
    return F.when(iso.between("1800-01-01", "2199-12-31"), iso.try_cast("date"))


def _written(m: Column) -> Column:
    """Of a date with the year last: place (from 0) of its day and month among all ``WRITTEN``, -1
    if there is none."""
    every = F.split(F.lit(",".join(t for c in WRITTEN for t in c)), ",")
    pair = F.substring(F.translate(m, ".-", "//"), F.lit(1), F.length(m) - 5)
    return _long(F.array_position(every, pair)) - 1


def _class(place: Column) -> Column:
    """The class of a place: its first place, its size, and whether it holds leap days."""
    out, at = None, 0
    for c in WRITTEN:
        own = F.struct(F.lit(at).cast("bigint").alias("first"), F.lit(len(c)).cast("bigint")
                       .alias("size"), F.lit(c[0].replace("0", "") in ("29/2", "2/29")).alias("leap"))
        out = own if out is None else F.when(place >= at, own).otherwise(out)
        at += len(c)
    return out


def _year_last(m: Column) -> Column:
    return m.rlike("[0-9]{4}$")


def _date_valid(m: Column) -> Column:
    year = F.substring(m, -4, 4).try_cast("int")
    late = _let(_written(m), lambda p: (p >= 0) & year.between(YEARS[0], YEARS[-1])
                & (~_class(p)["leap"] | year.isin(LEAP)))
    return F.when(_year_last(m), late).otherwise(_date(m).isNotNull())


def _date_out(m: Column, key: str, back: bool) -> Column:
    date, origin = _date(m), F.expr("date'1800-01-01'")
    a, b = (_long(F.lit(v)) for v in CYCLE_DAYS)
    y = feistel(_long(F.datediff(date, origin)), a, b, key, "date", back)
    iso = F.date_format(F.date_add(origin, _int(y)), "yyyy-MM-dd")
    return F.when(_year_last(m), _written_out(m, key, back)).otherwise(_put(
        m, _digits(iso)))


def _written_out(m: Column, key: str, back: bool) -> Column:
    year = F.substring(m, -4, 4).try_cast("bigint")
    leaps = F.array(*[F.lit(y).cast("bigint") for y in LEAP])
    every = F.split(F.lit(",".join(t for c in WRITTEN for t in c)), ",")

    def of_place(place):
        return _let(_class(place), lambda c: of_class(place, c))

    def of_class(place, c):
        years = _long(F.when(c["leap"], len(LEAP)).otherwise(len(YEARS)))
        number = F.when(c["leap"], F.array_position(leaps, year) - 1).otherwise(year - YEARS[0])
        y = feistel((place - c["first"]) * years + number, c["size"], years, key, "date-written",
                    back)
        return _let(y, lambda y: digits(c, _int(_div(y, years)), _int(F.pmod(y, years))))

    def digits(c, pair, number):
        new = F.when(c["leap"], F.get(leaps, number)).otherwise(number + YEARS[0])
        return F.concat(_digits(F.get(every, _int(c["first"]) + pair)), new.cast("string"))

    return _put(m, _let(_written(m), of_place))


def _email(m: Column, key: str) -> Column:
    local = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("user-"), F.substring(local, 1, 16), F.regexp_extract(m, "@.*$", 0))


_VALID = {"email": lambda m: F.lit(True), "phone": lambda m: F.lit(True), "card": _card_valid,
          "ssn": _ssn_valid, "ipv4": _ipv4_valid, "date": _date_valid}


def kind_of(m: Column) -> Column:
    """Kind of a found candidate, null where it fails its validation."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        own = F.when(_VALID[kind](m), F.lit(kind))
        out = F.when(m.rlike(_WHOLE[kind]), own).otherwise(out)
    return out


def pseudonym(m: Column, kind: Column, key: str, back: bool = False) -> Column:
    """Replacement of the candidate ``m`` of the given kind; candidates of no kind stay."""
    out = m
    for name, f in (("phone", _phone), ("card", _card), ("ssn", _ssn), ("ipv4", _ipv4),
                    ("date", _date_out)):
        out = F.when(kind == name, f(m, key, back)).otherwise(out)
    return out if back else F.when(kind == "email", _email(m, key)).otherwise(out)


def pseudonymise(docs: DataFrame, key: str, column: str = "text", found: str | None = None,
                 back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``column`` and, if ``found`` names a column, the list of
    replaced items as (kind, value, pseudonym) there. ``back`` restores all but e-mails."""
    text = F.col(f"`{column}`")
    hit = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    # candidates of a text, looked for only where there is a digit or an @
    cands = F.when(hit, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))) \
             .otherwise(F.array().cast("array<string>"))

    def item(m):
        kind = kind_of(m)
        return F.struct(kind.alias("kind"), m.alias("value"))

    def out(x):
        return F.struct(x["kind"].alias("kind"), x["value"].alias("value"),
                        F.when(x["kind"].isNull(), x["value"])
                        .otherwise(pseudonym(x["value"], x["kind"], key, back)).alias("pseudonym"))

    items, parts = "_pii_items", "_pii_parts"
    df = docs.withColumn(items, F.transform(cands, item))
    df = df.withColumn(items, F.transform(items, out))
    pieces = F.split(text, ANY, -1)
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        p, F.coalesce(F.get(F.col(items), i)["pseudonym"], F.lit("")))), "")
    df = df.withColumn(parts, F.when(F.size(items) > 0, joined).otherwise(text))
    keep = [F.col(parts).alias(column) if c == column else F.col(f"`{c}`") for c in docs.columns]
    if found:
        keep.append(F.filter(items, lambda x: x["kind"].isNotNull()).alias(found))
    return df.select(*keep)
