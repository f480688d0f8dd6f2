import collections
import datetime
import hashlib
import random

from cases import AWKWARD, frame
from ledgerspark.llm import pii
from pyspark.sql import functions as F


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def run(spark, texts, key="k", back=False, found="found"):
    got = pii.pseudonymise(frame(spark, texts), key, found=found, back=back).collect()
    return sorted(got, key=lambda r: r["doc_id"])


TEXTS = ["mail a.b+c@mail7.example.com or A.B+C@mail7.example.com!", "+1 (377) 555-0271, (377) 555-0271",
         "4418452524842581 then 4418-4525-2484-2581 and 4418 4525 2484 2581", "2390409500648960",
         "12.197.240.125 999.1.1.1 1.2.3 01.2.3.4 1.2.3.4.5", "123-45-6789 000-12-1234 666-11-1111",
         "1999-02-28 1999-02-30 1700-01-01 2199-12-31", "no digits", "4418452524842581"]


def test_only_validated_values_change(spark):
    rows = run(spark, AWKWARD + TEXTS)
    out = [r["text"] for r in rows]
    assert out[:len(AWKWARD)] == AWKWARD
    kinds = [collections.Counter(x["kind"] for x in r["found"]) for r in rows[len(AWKWARD):]]
    assert kinds == [{"email": 2}, {"phone": 2}, {"card": 3}, {}, {"ipv4": 1}, {"ssn": 1},
                     {"date": 2}, {}, {"card": 1}]
    mail, phone, card, bad, ip, ssn, date, none, again = out[len(AWKWARD):]
    assert bad == TEXTS[3] and none == TEXTS[7]
    assert "999.1.1.1 1.2.3 01.2.3.4 1.2.3.4.5" in ip and "12.197.240.125" not in ip
    assert ssn.endswith(" 000-12-1234 666-11-1111") and "123-45-6789" not in ssn
    assert " 1999-02-30 1700-01-01 " in date
    assert "a.b+c" not in mail.lower() and mail.count("@mail7.example.com") == 2
    for v in (x["pseudonym"] for r in rows for x in r["found"] if x["kind"] == "card"):
        assert luhn(v)
    for v in (x["pseudonym"] for r in rows for x in r["found"] if x["kind"] == "date"):
        datetime.date.fromisoformat(v)
    # equal values are linked across documents and notations
    digits = {"".join(c for c in x["pseudonym"] if c.isdigit())
              for r in rows for x in r["found"] if x["kind"] == "card"}
    assert len(digits) == 1 and again in digits


def test_restores(spark):
    texts = TEXTS[1:]
    hidden = [r["text"] for r in run(spark, texts)]
    back = [r["text"] for r in run(spark, hidden, back=True)]
    assert back == texts
    assert [r["text"] for r in run(spark, texts, key="other")] != hidden


def test_feistel_is_a_permutation(spark):
    for a, b in ((7, 11), (1, 13), (10, 10)):
        x = spark.range(a * b).select(
            pii.feistel(F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"), "k", "t")
            .alias("y"))
        assert sorted(r["y"] for r in x.collect()) == list(range(a * b))


def test_no_rows_and_column_order(spark):
    out = pii.pseudonymise(frame(spark, []), "k")
    assert out.count() == 0 and out.columns == frame(spark, []).columns


NOTATIONS = {
    "phone": ["555-123-4567", "555.123.4567", "(555)123-4567", "(555) 123-4567", "+1 555 123 4567",
              "1-555-123-4567", "+44 20 7946 0958", "+442079460958", "+49 (30) 901820-0"],
    "card": ["3782-822463-10005", "3782 822463 10005", "378282246310005", "4418.4525.2484.2581",
             "3056-930902-5904"],
    "date": ["03/12/1987", "3.12.1987", "12/25/1987", "25-12-1987", "29.02.2000", "2/29/1996",
             "1987/12/03", "1987.12.03", "31.1.1999", "9/9/1999"]}


def test_other_notations(spark):
    def shape(v):
        return "".join("d" if c.isdigit() else c for c in v)
    given = [(k, v) for k, own in NOTATIONS.items() for v in own]
    texts = [f"call {v}, then go. 5 x" for _, v in given] + [
        "31.02.1999 29.02.1999 13/13/1999 00.1.2000 1.2.1700 3782-822463-10006"]
    rows = run(spark, texts)
    for (kind, value), r in zip(given, rows):
        assert [(x["kind"], x["value"]) for x in r["found"]] == [(kind, value)], value
        new = r["found"][0]["pseudonym"]
        assert value not in r["text"] and shape(new) == shape(value)
        assert r["text"] == f"call {new}, then go. 5 x"
        assert kind != "card" or luhn(new)
    assert not rows[-1]["found"] and rows[-1]["text"] == texts[-1]
    back = [r["text"] for r in run(spark, [r["text"] for r in rows], back=True)]
    assert back == texts
    # one number has one pseudonym in all its notations
    ten = {"".join(c for c in r["found"][0]["pseudonym"] if c.isdigit())[-10:] for r in rows[:6]}
    assert len(ten) == 1


def test_written_dates_are_permuted_among_valid_ones(spark):
    days = [f"{d:02}/{m:02}/{y}" for y in (1999, 2000) for m in range(1, 13) for d in range(1, 32)]
    rows = run(spark, [" ; ".join(days)])
    found = {x["value"]: x["pseudonym"] for x in rows[0]["found"]}
    assert len(found) == 731 == len(set(found.values()))
    for v in found.values():
        datetime.datetime.strptime(v, "%d/%m/%Y")


def test_a_number_keeps_its_pseudonym_in_every_notation(spark):
    groups = [["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+44-20-7946-0958",
               "+44 (20) 7946 0958"],
              ["+1 555 123 4567", "+15551234567", "(555) 123-4567", "555.123.4567", "1-555-123-4567"],
              ["+354 555 1234", "+3545551234", "+354-555-1234"],
              ["+4930901820", "+49 30 901820", "+49 (30) 901820"]]
    texts = [f"call {v} 12 people, 3 rooms" if c != 3 else f"call {v}, 3 rooms"
             for c, g in enumerate(groups) for v in g]
    rows = run(spark, texts)
    assert [[x["value"] for x in r["found"]] for r in rows] == [[v] for g in groups for v in g]
    at = 0
    for g in groups:
        new = [r["found"][0]["pseudonym"] for r in rows[at:at + len(g)]]
        at += len(g)
        plain = {"".join(c for c in p.replace("(0)", "") if c.isdigit()) for p in new}
        assert len({p[-len(min(plain, key=len)):] for p in plain}) == 1
        assert all(p[:2] == v[:2] or v[0] != "+" for p, v in zip(new, g))
    assert [r["text"] for r in run(spark, [r["text"] for r in rows], back=True)] == texts


def test_a_number_followed_by_digits(spark):
    rows = run(spark, ["+44 20 7946 0958 12 people", "+44 20 7946 0958"])
    new = [r["found"][0]["pseudonym"] for r in rows]
    assert new[0] == new[1] and rows[0]["text"] == f"{new[0]} 12 people"


def feistel(x, a, b, kind, key="k"):
    """The permutation of 0..a*b-1, written with Python's integers."""
    left, right = divmod(x, b)
    for r in range(pii.ROUNDS):
        half, size = (right, a) if r % 2 == 0 else (left, b)
        digest = hashlib.sha256(f"{key}:{kind}:{r}:{half}".encode()).hexdigest()
        if r % 2 == 0:
            left = (left + int(digest[:15], 16)) % size
        else:
            right = (right + int(digest[:15], 16)) % size
    return left * b + right


def permuted(digits, kind):
    low = len(digits) // 2
    out = feistel(int(digits), 10 ** low, 10 ** (len(digits) - low), kind)
    return str(out).zfill(len(digits))


def expected(kind, value):
    digits = "".join(c for c in value if c.isdigit())
    if kind == "phone":
        return permuted(digits, "phone")
    if kind == "card":
        body = permuted(digits[:-1], "card")
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "ssn":
        area, group, serial = (int(x) for x in value.split("-"))
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        y = feistel(x, 898, 99 * 9999, "ssn")
        area, rest = divmod(y, 99 * 9999)
        area = area + 1 + (area + 1 >= 666)
        return f"{area:03}-{rest // 9999 + 1:02}-{rest % 9999 + 1:04}"
    if kind == "ipv4":
        a, b, c, d = (int(x) for x in value.split("."))
        y = feistel(((a * 256 + b) * 256 + c) * 256 + d, 65536, 65536, "ipv4")
        return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))
    origin = datetime.date(1800, 1, 1)
    days = (datetime.date.fromisoformat(value) - origin).days
    return (origin + datetime.timedelta(days=feistel(days, *pii.CYCLE_DAYS, "date"))).isoformat()


def test_pseudonyms_match_a_second_implementation(spark):
    r = random.Random(8)
    values = [("phone", f"555-{r.randrange(200, 999)}-{r.randrange(10_000):04}") for _ in range(20)]
    values += [("ssn", f"{r.randrange(1, 666):03}-{r.randrange(1, 100):02}-{r.randrange(1, 10_000):04}")
               for _ in range(20)]
    values += [("ipv4", ".".join(str(r.randrange(1, 256)) for _ in range(4))) for _ in range(20)]
    values += [("date", str(datetime.date(1800, 1, 1) + datetime.timedelta(days=r.randrange(146_097))))
               for _ in range(20)]
    for _ in range(20):
        body = "4" + "".join(str(r.randrange(10)) for _ in range(14))
        values.append(("card", next(body + c for c in "0123456789" if luhn(body + c))))
    for (kind, value), row in zip(values, run(spark, [f"x {v} y" for _, v in values])):
        got = row["found"][0]
        assert (got["kind"], got["value"]) == (kind, value)
        new = got["pseudonym"]
        if kind == "phone":
            new = new.replace("-", "")
        assert new == expected(kind, value)
