"""Secret scan with multipart credential linking (operator 9), DataFrame functions only.

Plain findings (``assign``, ``access``, ``hex``) stand on their own. Three weak kinds prove little
alone: ``ident`` (an assigned user, client or account name), ``opaque`` (a long run of letters of
both cases and digits), ``endpoint`` (a URL or connection string) and ``login`` (user:password in a
URL). They are reported only where complementary parts of one credential meet: an identifier with
a secret, an endpoint with both, a login with its endpoint, inside one scope, that is, at most
``scope`` characters apart in one document. Identifiers are ``access``, ``ident`` and ``login``;
secrets are ``assign``, ``hex``, ``opaque`` and ``login``.

The parts of all documents form a table (row, kind, start, end) that is joined with itself as an
interval join: every part belongs to the blocks of ``scope`` characters it comes near, and parts
meet by equality on (row, block). A block holds a bounded number of parts, so no document, however
long, makes a large group.

Spans are in code points, end exclusive. Defined results: null and empty texts have no spans and
an empty digest; each row is its own document, also where ids repeat or are null; a weak part that
overlaps a plain finding is not reported a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed patterns and least lengths of the plain kinds: (kind, pattern, group measured, least).
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
PLAIN = (("assign", ASSIGN, 2, 6),
         ("access", r"AKIA[A-Z0-9]+", 0, 20),
         ("hex", r"[0-9a-f]{24,}", 0, 24))     # runs are maximal, so short ones need no match
# Weak kinds: (kind, pattern, group whose text must satisfy the test, test).
IDENT = (r"(?i)(?<![A-Za-z0-9])(?:client_?id|user(?:_?name)?|login|account(?:_?id)?|access_?id)"
         r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{3,})")
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = (r"(?<![A-Za-z0-9])(?:https?|wss?|ftps?|amqps?|rediss?|mongodb|postgres(?:ql)?|mysql"
            r"|jdbc:[a-z]+)://[^\s\"'<>]{4,}")
#: user:password before the host of a URL: an identifier and a secret side by side.
LOGIN = r"(?<=://)[^\s:@/\"'<>]{1,64}:[^\s:@/\"'<>]{1,128}(?=@)"
MIXED = r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])"
WEAK = (("ident", IDENT, None), ("opaque", OPAQUE, MIXED), ("endpoint", ENDPOINT, None),
        ("login", LOGIN, None))
KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint", "login")
#: The parts of a credential that a kind is.
PARTS = {"assign": ("secret",), "access": ("id",), "hex": ("secret",), "ident": ("id",),
         "opaque": ("secret",), "endpoint": ("endpoint",), "login": ("id", "secret")}
#: What a weak kind needs in its scope, from other findings; a URL's login needs its endpoint.
NEEDS = {"ident": ("secret",), "opaque": ("id",), "endpoint": ("id", "secret"),
         "login": ("endpoint",)}
_SPAN = "array<struct<kind:string,start:int,end:int>>"


def _spans(text: Column, kind: str, pattern: str, measured: int, keep) -> Column:
    """Spans of the leftmost non-overlapping matches of which ``keep`` accepts group ``measured``.
    Where they begin are prefix sums over the pieces between them, so the work grows with the
    matches, not with their square. Texts without any match cost one search."""
    def every(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def sized(p: Column, m: Column) -> Column:
        return F.struct(F.length(p).cast("long").alias("gap"),
                        F.coalesce(F.length(m), F.lit(0)).cast("long").alias("size"))

    sizes = F.zip_with(F.split(text, pattern, -1), every(0), sized)     # the last has no match
    good = F.transform(every(measured), keep)

    def place(rows: Column) -> Column:
        before = common.sums_before(F.transform(rows, lambda r: r["gap"] + r["size"]))
        spans = F.zip_with(rows, before, lambda r, at: F.struct(
            F.lit(kind).alias("kind"), (at + r["gap"]).cast("int").alias("start"),
            (at + r["gap"] + r["size"]).cast("int").alias("end")))
        accepted = F.filter(F.zip_with(spans, good, lambda x, ok: F.struct(
            x.alias("span"), F.coalesce(ok, F.lit(False)).alias("ok"))), lambda x: x["ok"])
        return F.transform(accepted, lambda x: x["span"])

    return F.when(text.rlike(pattern), common.let(sizes, place)) \
        .otherwise(F.array().cast(_SPAN))


def _plain(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    return _spans(text, kind, pattern, group, lambda m: F.length(m) >= least)


def _weak(text: Column, kind: str, pattern: str, test: str | None) -> Column:
    return _spans(text, kind, pattern, 0, lambda m: m.rlike(test) if test else F.lit(True))


def parts(docs: DataFrame, column: str = "text") -> DataFrame:
    """One row per document: ``row`` (a number of its own), doc_id, ``plain`` and ``weak`` spans.
    Stored, so that the text is searched once and row numbers stay the same."""
    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    own = docs.select(F.col("doc_id"), text.alias("_t")).withColumn(
        "row", F.monotonically_increasing_id())
    t = F.col("_t")
    plain = F.concat(*[_plain(t, *p) for p in PLAIN])
    # weak kinds need one of :, = or a long run; the cheap test spares most texts three searches
    may = t.rlike(r"[:=]|[A-Za-z0-9+/_-]{20}")
    weak = F.when(may, F.concat(*[_weak(t, *w) for w in WEAK])).otherwise(F.array().cast(_SPAN))
    return common.stored(own.select("row", "doc_id", plain.alias("plain"), weak.alias("weak")),
                         "secret-parts")


def link(found: DataFrame, scope: int = 400) -> DataFrame:
    """Weak parts of ``found`` (rows of ``parts``) that complementary parts back up:
    (row, kind, start, end)."""
    flat = found.where(F.size("weak") > 0).select("row", F.explode(F.concat("plain", "weak"))
                                                  .alias("s")).select("row", "s.*")
    flat = common.stored(flat, "secret-flat")
    is_weak = F.col("kind").isin(*NEEDS)
    cells = flat.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))))
    plain = cells.where(~is_weak).select("row", "block", F.col("start").alias("s2"),
                                         F.col("end").alias("e2"))
    covered = cells.where(is_weak).join(plain, ["row", "block"]).where(
        (F.col("s2") < F.col("end")) & (F.col("e2") > F.col("start")))
    flat = flat.join(covered.select("row", "kind", "start", "end").distinct(),
                     ["row", "kind", "start", "end"], "left_anti")
    weak = flat.where(F.col("kind").isin(*NEEDS))
    # a weak part looks into every block that begins or ends within its reach
    first, last = F.col("start") - scope, F.col("end") + scope
    seek = weak.withColumn("block", F.explode(F.sequence(
        F.floor(F.greatest(first, F.lit(0)) / scope), F.floor(last / scope))))
    part = F.create_map(*[x for k, ps in PARTS.items() for x in (
        F.lit(k), F.array(*[F.lit(p) for p in ps]))])
    lies = flat.select("row", F.col("kind").alias("other"), F.element_at(part, F.col("kind"))
                       .alias("parts"), F.col("start").alias("s2"), F.col("end").alias("e2"),
                       F.explode(F.sequence(F.floor(F.col("start") / scope),
                                            F.floor(F.col("end") / scope))).alias("block"))
    near = seek.join(lies, ["row", "block"]).where(
        (F.col("s2") <= F.col("end") + scope) & (F.col("e2") >= F.col("start") - scope)
        & (F.col("other") != F.col("kind")))
    backed = near.groupBy("row", "kind", "start", "end").agg(*[
        F.max(F.array_contains("parts", p)).alias(f"by_{p}") for p in ("id", "secret", "endpoint")])
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        met = F.col("kind") == kind
        for p in needs:
            met = met & F.col(f"by_{p}")
        enough = enough | met
    return backed.where(enough).select("row", "kind", "start", "end")


def scan(docs: DataFrame, column: str = "text", scope: int = 400) -> DataFrame:
    """One row per document: doc_id, ``plain`` and ``linked`` (arrays of kind, start, end)."""
    found = parts(docs, column)
    linked = link(found, scope).groupBy("row").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    return found.join(linked, "row", "left").select(
        "doc_id", "plain", F.coalesce("linked", F.array().cast(_SPAN)).alias("linked"))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of ``KINDS``, comma-joined."""
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
