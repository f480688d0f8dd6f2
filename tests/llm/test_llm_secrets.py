import random
import re

from pyspark.sql import functions as F

from cases import AWKWARD, frame
from ledgerspark.llm import secret_scan as S

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def plain(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
            if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


TEXTS = [
    'é💡 password="abcdef1" Token : x9x9x9 api_key=short apikey=longenough',
    "password=token:abcdefgh secret==aaaaaa passwd = 'q'", "AKIA" + "A" * 16 + " AKIA" + "B" * 15,
    "AKIAAKIA" + "C" * 20, "0123456789abcdef01234567 0123456789abcdef0123456",
    "token=" + "a1" * 20, "x" * 50_000 + " secret: zzzzzz", "PASSWORD='Abc123'",
    "token=abcdef token=abcdef\ntoken=abcdef"]


def spans(spark, texts):
    got = S.scan(frame(spark, texts)).select(
        "doc_id", S.joined(S.F.col("plain")).alias("p"),
        S.joined(S.F.concat("plain", "linked")).alias("all")).collect()
    return [(r["p"], r["all"]) for r in sorted(got, key=lambda r: r["doc_id"])]


def test_plain_spans(spark):
    texts = AWKWARD + TEXTS
    assert [p for p, _ in spans(spark, texts)] == [plain(t) for t in texts]


def test_weak_parts_need_their_complements(spark):
    opaque, far = "Ab3dEf6hIjKlMnOpQrStUv8", "w " * 300
    texts = [f"client_id=bob92 then {opaque} at https://api.example.com/v1 end",
             f"just {opaque} alone", "https://x.example.com and client_id=zed99",
             f"user=amy99 {far} password=hunter22", f"user=amy99 {far} user=eve98 password=hunter22",
             f"https://x.example.com/ AKIA{'A' * 16} {opaque}"]
    got = [a for _, a in spans(spark, texts)]
    assert got[0] == "ident:0:15,opaque:21:44,endpoint:48:74"
    assert got[1:4] == ["", "", plain(texts[3])]
    start = texts[4].index("user=eve98")
    assert got[4] == f"ident:{start}:{start + 10},{plain(texts[4])}"
    assert [x.split(":")[0] for x in got[5].split(",")] == ["endpoint", "access", "opaque"]


def test_repeated_ids_and_no_rows(spark):
    rows = S.scan(frame(spark, ["token=abcdef", "nothing", None], [1, 1, None])).collect()
    assert sorted(len(r["plain"]) for r in rows) == [0, 0, 1]
    assert S.scan(frame(spark, [])).count() == 0


def kinds_of(text):
    """(kind, start, end) of every candidate, plain or weak."""
    out = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in plain(text).split(",") if x)]
    for kind, pattern, test in S.WEAK:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text, re.A)
                if not test or re.search(test, m[0])]
    return out


def linked(text, scope):
    """Weak candidates that all pairs of candidates back up."""
    every = kinds_of(text)
    plains = [x for x in every if x[0] not in S.NEEDS]
    free = [x for x in every if x[0] not in S.NEEDS
            or not any(p[1] < x[2] and p[2] > x[1] for p in plains)]
    out = []
    for x in free:
        near = {p for y in free if y[0] != x[0] and y[1] <= x[2] + scope and y[2] >= x[1] - scope
                for p in S.PARTS[y[0]]}
        if x[0] in S.NEEDS and set(S.NEEDS[x[0]]) <= near:
            out.append(x)
    return sorted(out)


def dense(seed, n):
    r = random.Random(seed)
    parts = ["client_id=bob{}", "user: eve{}", "password=hunter{}x", "AKIA" + "Q" * 16,
             "Ab3dEf6hIjKlMnOpQrStUv{}", "https://api{}.example.com/v1",
             "postgres://svc{}:Pa55word@db.example.com/x", "0123456789abcdef01234567", "nothing {}",
             "filler " * 12, "é💡 " * 9, "https://a:b@c{}", "key {} none"]
    return " ".join(r.choice(parts).replace("{}", str(r.randrange(100))) for _ in range(n))


def test_links_match_all_pairs_on_dense_texts(spark):
    texts = [dense(i, 40) for i in range(12)]
    for scope in (30, 400):
        got = S.scan(frame(spark, texts), scope=scope).select("doc_id", "linked").collect()
        got = {r["doc_id"]: sorted((x["kind"], x["start"], x["end"]) for x in r["linked"]) for r in got}
        want = {i: linked(t, scope) for i, t in enumerate(texts)}
        assert got == want
        assert sum(map(len, want.values())) > 100
        assert {k for v in want.values() for k, _, _ in v} == set(S.NEEDS)


def test_a_login_in_a_url_is_a_whole_credential(spark):
    texts = ["see postgres://svc:Pa55word@db.example.com/x there", "mailto svc:Pa55word@db.example.com"]
    got = [a for _, a in spans(spark, texts)]
    assert got == ["endpoint:4:44,login:15:27", ""]


def test_many_matches_in_one_text(spark):
    n = 50_000
    text = "token=abcdef1 AKIA" + "B" * 16 + " user=ann42 "
    row = S.scan(frame(spark, [text * n])).select(
        F.size("plain").alias("p"), F.size("linked").alias("l"),
        F.element_at("plain", n).alias("last")).first()
    assert (row["p"], row["l"]) == (2 * n, n)
    assert row["last"]["start"] == (n - 1) * len(text)
