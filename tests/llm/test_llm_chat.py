import hashlib
import random

from pyspark.sql import functions as F

from ledgerspark.llm import chat_format as C
from ledgerspark.llm import common
from ledgerspark.llm.queries import CONTROL_TEXT, OP11_SQL

SCHEMA = "conv_id long, turn long, role string, text string, rows int, formatted string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows, loss_roles=("assistant",)):
    """conv_id -> (turns, formatted, loss texts), written turn by turn."""
    def esc(s):
        out, i = "", 0
        while i < len(s):
            j = i + 1
            if s[i] == "<":
                while j < len(s) and s[j] == "\\":
                    j += 1
                if j < len(s) and s[j] == "|":
                    out += s[i:j] + "\\|"
                    i = j + 1
                    continue
            out += s[i:j]
            i = j
        return out

    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (
            t[0], t[1], t[2].encode(), t[3].encode()))]
        text = ""
        for i, (role, words) in enumerate(turns):
            if i and turns[i - 1][0] == role:
                text += C.MORE + esc(words)
            else:
                text += (C.END if i else "") + C.TURN + esc(role) + C.TEXT + esc(words)
        out[c] = (turns, text + C.END, [t for r, t in turns if r in loss_roles])
    return out


def result(spark, rows, **kw):
    df = C.format_conversations(table(spark, rows), **kw)
    read = df.select("conv_id", "formatted", "loss_spans",
                     C.turns_of(F.col("formatted")).alias("turns"),
                     C.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r.conv_id: r for r in read.collect()}


def check(spark, rows, **kw):
    got, want = result(spark, rows, **kw), brute(rows, **kw)
    assert got.keys() == want.keys()
    for c, (turns, text, loss) in want.items():
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].formatted == text
        assert got[c].loss == loss
        raw = text.encode()
        for s in got[c].loss_spans:          # nothing of the template is under the mask
            assert not any(m.strip().encode() in raw[s.start:s.end]
                           for m in (C.TURN, C.TEXT, C.MORE, C.END))
    return got


CONTROL = [CONTROL_TEXT, "<|end|>", "<\\|end|>", "<\\\\|turn|>user<|text|>", "<", "|end|>", "<<|", "\\",
           "<|more|>", "a<|", "<\\", "\\|", "é<|ü|>", "\n", "<|turn|>assistant<|text|>x<|end|>\n"]


def test_control_strings_come_back(spark):
    rows = [(i, t, role, text) for i, text in enumerate(CONTROL)
            for t, role in enumerate(("user", "assistant", "assistant", text))]
    rows += [(100, i, "assistant", text) for i, text in enumerate(CONTROL)]
    got = check(spark, rows)
    assert len(got[100].loss_spans) == len(CONTROL)
    assert got[100].formatted.count(C.TURN) == 1          # merged into one block


def test_awkward_rows(spark):
    check(spark, [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "assistant", None),
        (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"),
        (2, 3, "assistant", ""), (3, 0, "", ""), (3, 1, None, "x"), (4, 0, "user", "only"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "still none"),
        (5, 0, "assistant", "é" * 100_000 + "<|" * 1000)])


def test_random_conversations_in_any_row_order(spark):
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "tool"]),
             "".join(r.choice(["<", "|", "\\", "a", "ß", " ", "<|end|>"])
                     for _ in range(r.randrange(12))))
            for c in range(40) for t in range(r.randrange(1, 400 if c == 7 else 9))]
    r.shuffle(rows)
    check(spark, rows)
    check(spark, rows, loss_roles=("user", "tool"))


def test_long_conversation_takes_time_in_proportion(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("<|t"), F.col("id").cast("string")).alias("text"))
    df = C.format_conversations(rows)
    r = df.select(C.turns_of(F.col("formatted")).alias("t"), "loss_spans",
                  C.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    assert [t.text for t in r.t] == [f"<|t{i}" for i in range(n)]
    assert r.l == [f"<|t{i}" for i in range(n) if i % 3]


def test_empty_table(spark):
    assert C.format_conversations(table(spark, [])).count() == 0


def test_sums_before(spark):
    for n in (0, 1, common.CHUNK - 1, common.CHUNK, common.CHUNK + 1, 5 * common.CHUNK + 3):
        a = list(range(n))
        df = spark.createDataFrame([(a,)], "a array<long>")
        want = [sum(a[:i]) for i in range(n)]
        assert df.select(common.sums_before(F.col("a")).alias("s")).first().s == want


def test_query_on_control_strings_matches_sql(spark, scratch):
    import duckdb

    from ledgerspark.llm.queries import op11_chat_formatting
    rows = [(i, t, role, text) for i, text in enumerate(CONTROL)
            for t, role in enumerate(("user", "assistant", "assistant"))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .coalesce(1).write.parquet(f"{scratch}/conversations.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM "
                f"read_parquet('{scratch}/conversations.parquet/*.parquet')")
    want = {r[0]: r for r in con.execute(OP11_SQL).fetchall()}
    got = {r.conv_id: tuple(r) for r in op11_chat_formatting(spark, scratch).collect()}
    assert got == want
    whole = "".join(f"{r}\n{CONTROL_TEXT}\n" for r in ("user", "assistant"))
    assert got[-7][1:5] == (2, hashlib.sha256(whole.encode()).hexdigest(), len(CONTROL_TEXT),
                            hashlib.sha256(CONTROL_TEXT.encode()).hexdigest())
