r"""Chat formatting: conversations to training strings with a loss mask, and back.

Method (relational formatting): the turns of a conversation are collected as structs and sorted,
adjacent turns of one role are merged by array aggregation into blocks, and the blocks are
concatenated; all with Spark expressions. The template of a block is

    <|turn|>role<|text|>text of a turn<|more|>text of the next turn of that role<|end|>\n

Every marker starts with ``<|``. Inside roles and texts ``<``, any number of backslashes, ``|``
gets one backslash more, so that ``<|`` occurs in markers only; reading back takes one away. A
text without ``<`` is never changed.

The loss mask is ``loss_spans``: half-open ranges of UTF-8 bytes of the formatted text, one for
each turn of a role that is trained on, its escaped text without any marker. Byte offsets make
cutting a span cost its own length. Offsets are prefix sums in two levels (``common.sums_before``), so
the work grows in proportion to the turns of a conversation, not with their square.

Defined results: null roles and texts are empty; rows of a conversation are ordered by turn (null
first), role and text, so ties and repeated rows have one order and all stay; rows without conv_id
are one conversation without id; an empty table gives no rows; further columns are ignored. A
conversation is one row of the result and has to fit one Spark value (2 GB); a longer one fails,
none is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, sums_before

#: The markers of the template.
TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>\n"

def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def _blocks(turns: Column) -> Column:
    """Sorted turns (role, text, opens) to one struct (role, texts) a run of one role."""
    def of(opening: Column) -> Column:
        return F.transform(opening, lambda at, k: F.struct(
            F.get(turns, at)["role"].alias("role"),
            F.transform(F.slice(turns, at + 1, F.coalesce(F.get(opening, k + 1), F.size(turns))
                                - at), lambda t: t["text"]).alias("texts")))
    return let(F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                        lambda i: F.get(turns, i)["opens"]), of)


def _formatted(turns: Column) -> Column:
    block = lambda b: F.concat(F.lit(TURN), b["role"], F.lit(TEXT),                # noqa: E731
                               F.array_join(b["texts"], MORE), F.lit(END))
    return F.array_join(F.transform(_blocks(turns), block), "")


def _spans(turns: Column, loss_roles: Sequence[str]) -> Column:
    """Byte ranges of the texts whose role is trained on."""
    def lead(t: Column, i: Column) -> Column:
        opening = F.octet_length(t["role"]) + len(TURN + TEXT) + F.when(i > 0, len(END)).otherwise(0)
        return F.when(t["opens"], opening).otherwise(len(MORE))

    def of(sizes: Column) -> Column:
        both = F.transform(sizes, lambda s: s["lead"] + s["text"])
        spans = let(both, lambda b: F.zip_with(sizes, sums_before(b), lambda s, before: F.struct(
            s["loss"].alias("loss"), (before + s["lead"]).alias("start"),
            (before + s["lead"] + s["text"]).alias("end"))))
        return F.transform(F.filter(spans, lambda s: s["loss"]),
                           lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return let(F.transform(turns, lambda t, i: F.struct(
        lead(t, i).cast("long").alias("lead"), F.octet_length(t["text"]).cast("long").alias("text"),
        t["role"].isin([_escape(r) for r in loss_roles]).alias("loss"))), of)


def _escape(role: str) -> str:
    """``escaped`` of a role given in Python."""
    import re
    return re.sub(r"<(\\*)\|", lambda m: "<\\" + m.group(1) + "|", role)


def format_conversations(conversations: DataFrame,
                         loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans (array of start, end)."""
    empty = F.lit("")
    rows = conversations.select("conv_id", F.struct(
        "turn", F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text")).alias("row"))
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def marked(rows: Column) -> Column:
        return F.transform(rows, lambda t, i: F.struct(
            escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"),
            F.coalesce(t["role"] != F.get(rows, i - 1)["role"], F.lit(True)).alias("opens")))

    both = let(F.col("rows"), lambda rows: let(marked(rows), lambda turns: F.struct(
        _formatted(turns).alias("formatted"), _spans(turns, loss_roles).alias("loss_spans"))))
    return collected.select("conv_id", both.alias("both")).select("conv_id", "both.*")


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made of, read from its markers."""
    def quoted(*markers: str) -> str:
        return "|".join(m.strip().replace("|", r"\|") for m in markers)

    def block(parts: Column) -> Column:          # role, texts, the line end
        return let(unescaped(parts[0]), lambda role: F.transform(
            F.slice(parts, F.lit(2), F.size(parts) - 2),
            lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))))

    blocks = let(F.split(formatted, quoted(TURN)),
                 lambda b: F.slice(b, F.lit(2), F.size(b) - 1))
    return F.flatten(F.transform(
        blocks, lambda b: let(F.split(b, quoted(TEXT, MORE, END)), block)))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return let(F.encode(formatted, "UTF-8"), lambda raw: F.transform(
        spans, lambda s: unescaped(F.decode(
            F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")),
            "UTF-8"))))
