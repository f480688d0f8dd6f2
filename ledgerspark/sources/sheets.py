"""Bank statement sheets exported as CSV.

A9: one file is one account's statement. Line 1 (0-based) names the account, line 4 is the
header (columns found by name: Dags, Texti, Upphæð, Staða, Tilvísun), data starts at line 5.
Row position matters *within* a file, so each file is read whole (``wholetext``), split into
lines with ``posexplode`` (a deterministic line index) and parsed with ``from_csv``. The
header-to-position mapping is per file and is applied with ``array_position``; no row ever
leaves its file's task. ``large_statement_sheet_source`` gives the same rows from blocks, for files
that one task can't hold. Spreadsheet binaries (xlsx) are re-aimed at their CSV exports:
Spark has no Excel reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.currency import currency_from_name, currency_hint_from_text
from ..functions.dates import excel_serial_date, parse_sheet_date
from ..functions.money import parse_amount_en, parse_amount_is, parse_amount_keep
from ..operators.loading import staged
from ..functions.text import account_name_from_text, account_number_from_text, digits_and_dashes

# --- fixed values: sheet layout and header names --------------------------------------------
ACCOUNT_LINE, HEADER_LINE, FIRST_DATA_LINE = 1, 4, 5
COL_DATE, COL_TEXT, COL_AMOUNT, COL_BALANCE, COL_REFERENCE = (
    "Dags", "Texti", "Upphæð", "Staða", "Tilvísun")
# positional layout of the serial-date export: date col 0, text 10, amount 11, balance 12
POSITIONAL = {"date": 0, "text": 10, "amount": 11, "balance": 12}
# -----------------------------------------------------------------------------------------------

# A comma and a cell: quoted (quotes inside doubled or escaped) or bare.
_CELL = r',(\s*"(?:[^"\\]|\\.|"")*"\s*(?=,|$)|[^,]*)'


def _cells(line):
    """The cells of one CSV line, however many; empty cells are NULL."""
    def cell(raw):
        bare = F.trim(raw)
        inner = F.regexp_replace(F.regexp_replace(
            F.substring(bare, F.lit(2), F.length(bare) - 2), '""', '"'), r"\\(.)", "$1")
        quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) >= 2)
        return F.when(quoted, inner).when(raw != "", raw)
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1)), cell)


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """One row per sheet file: (file, file_name, lines ARRAY<STRING>)."""
    files = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
             .text(path, wholetext=True))
    return files.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_name").alias("file_name"),
                        F.split(F.regexp_replace("value", "\r", ""), "\n").alias("lines"))


def sheet_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file, file_name, line_no, cells) for every non-empty line of every sheet file."""
    lines = _files(spark, path, glob).select(
        "file", "file_name", F.posexplode("lines").alias("line_no", "line"))
    return lines.where(F.col("line") != "").select("file", "file_name", "line_no",
                                                   _cells(F.col("line")).alias("cells"))


def statement_sheet_source(spark: SparkSession, path: str, amount_format: str = "keep",
                           positional: bool = False) -> DataFrame:
    """Account lines (account, account_name, currency, date, description, amount,
    balance, reference, row_no, file). Rows without a parsable date are skipped.

    ``amount_format``: ``keep`` (B3), ``is`` (B4, ``1.234,50``) or ``en`` (B5).
    ``positional=True`` reads the serial-date export by column position (B14 dates).
    Per file, the header positions and the account line are taken from the file's own line
    array *before* the data lines are exploded, so the whole source runs without a shuffle.
    """
    f = _files(spark, path, "*.csv")
    f = f.select("file", "file_name", "lines", *_file_facts(
        F.try_element_at("lines", F.lit(ACCOUNT_LINE + 1)),
        F.try_element_at("lines", F.lit(HEADER_LINE + 1))))
    rows = f.select("*", F.posexplode("lines").alias("line_no", "line")).drop("lines")
    return _statement_rows(rows, amount_format, positional)


def _file_facts(account_line, header_line) -> list:
    """What the lines of a file are read by: its account line and the place of each column."""
    header = _cells(header_line)
    return [F.try_element_at(_cells(account_line), F.lit(1)).alias("account_line"),
            *[F.array_position(header, name).cast("int").alias(f"__p_{key}")
              for key, name in (("date", COL_DATE), ("text", COL_TEXT), ("amount", COL_AMOUNT),
                                ("balance", COL_BALANCE), ("ref", COL_REFERENCE))]]


def _statement_rows(rows: DataFrame, amount_format: str, positional: bool) -> DataFrame:
    """Numbered lines with the facts of their file to account lines."""
    rows = rows.where((F.col("line_no") >= FIRST_DATA_LINE) & (F.col("line") != ""))
    rows = rows.withColumn("cells", _cells(F.col("line")))

    def by_name(key):
        pos = F.col(f"__p_{key}")
        return F.when(pos > 0, F.try_element_at("cells", pos))

    if positional:
        date_raw = F.get("cells", POSITIONAL["date"])
        text, amount_raw, bal_raw = (F.get("cells", POSITIONAL[k])
                                     for k in ("text", "amount", "balance"))
        date = excel_serial_date(date_raw)
        ref = F.lit(None).cast("string")
    else:
        date_raw = by_name("date")
        text, amount_raw, bal_raw, ref = (by_name("text"), by_name("amount"),
                                          by_name("balance"), by_name("ref"))
        date = parse_sheet_date(date_raw)
    parser = {"keep": parse_amount_keep, "is": parse_amount_is, "en": parse_amount_en}[amount_format]
    out = rows.select(
        account_number_from_text("account_line").alias("account"),
        account_name_from_text("account_line").alias("account_name"),
        currency_from_name(F.col("file_name")).alias("currency"),
        date.alias("date"),
        F.coalesce(text, F.lit("")).alias("description"),
        parser(amount_raw).alias("amount"),
        parser(bal_raw).alias("balance"),
        F.coalesce(ref, F.lit("")).alias("reference"),
        F.col("line_no").alias("row_no"),
        "file")
    return out.where(F.col("date").isNotNull())


def numbered_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file, file_name, line_no, line) of sheets of any size: files are read in blocks, several
    tasks a file. A line's number is its place in the block plus the lines of the blocks before.

    The lines are stored once with their place: blocks depend on the cluster's size at the moment
    of reading, so places are only comparable within one reading."""
    text = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .option("lineSep", "\n").text(path))
    stored = staged(text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", "\r", "").alias("line")), "sheet-lines")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = stored.groupBy("file", "block").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return stored.join(_small(blocks), ["file", "block"]).select(
        "file", "file_name", (F.col("before") + F.col("place") - F.col("first")).cast("int")
        .alias("line_no"), "line")


def _small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast where a count shows that it is small; else the join is left to the optimizer."""
    df = staged(df, "sheet-facts")
    return F.broadcast(df) if df.count() <= rows else df


def large_statement_sheet_source(spark: SparkSession, path: str, amount_format: str = "keep",
                                 positional: bool = False) -> DataFrame:
    """A9 for sheets that are too large for one task: the rows of ``statement_sheet_source``, read
    block by block."""
    lines = numbered_lines(spark, path)
    at = lambda n: F.max(F.when(F.col("line_no") == n, F.col("line")))          # noqa: E731
    heads = lines.where(F.col("line_no").isin(ACCOUNT_LINE, HEADER_LINE)).groupBy("file").agg(
        at(ACCOUNT_LINE).alias("account"), at(HEADER_LINE).alias("header"))
    facts = heads.select("file", *_file_facts(F.col("account"), F.col("header")))
    return _statement_rows(lines.join(_small(facts), "file"), amount_format, positional)


def sheet_profile_source(spark: SparkSession, path: str, account_cols: list[str],
                         debit_cols: list[str] | None = None,
                         credit_cols: list[str] | None = None) -> DataFrame:
    """A10: header-keyed sheets (CSV export, header row) with candidate account columns;
    adds ``account_candidate`` (first non-empty candidate, kept to digits and dashes, valid
    when at least 8 characters) and numeric debit/credit sums per row (B5)."""
    df = (spark.read.option("header", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.csv").csv(path)
          .withColumn("file", F.col("_metadata.file_path")))
    cands = [digits_and_dashes(F.col(f"`{c}`")) for c in account_cols if c in df.columns]
    acct = F.coalesce(*[F.when(F.length(c) >= 8, c) for c in cands]) if cands else F.lit(None)
    out = df.withColumn("account_candidate", acct)

    def total(cols):
        present = [parse_amount_en(F.col(f"`{c}`")) for c in (cols or []) if c in df.columns]
        if not present:
            return F.lit(None).cast("decimal(18,2)")
        s = F.lit(0).cast("decimal(18,2)")
        for p in present:
            s = s + F.coalesce(p, F.lit(0))
        return s
    return out.withColumn("row_debit", total(debit_cols)).withColumn("row_credit", total(credit_cols))


def sheet_currency(spark: SparkSession, path: str, default: str = "Unknown",
                   default_isk_when: str | None = None) -> DataFrame:
    """B18 per file: the currency named by the *last* line whose text mentions one (GBP/£,
    EUR/€, ISK/kr.), as the source overwrites its guess row by row; files without any hint
    get ``default`` (or ISK when the file name contains ``default_isk_when``). Evaluated on
    the file's own line array (``transform`` / ``filter``): no shuffle, nothing collected."""
    f = _files(spark, path, "*.csv")
    hints = F.filter(F.transform("lines", lambda l: currency_hint_from_text(l)),
                     lambda h: h.isNotNull())
    fallback = F.lit(default)
    if default_isk_when:
        fallback = F.when(F.col("file_name").contains(default_isk_when), F.lit("ISK")).otherwise(fallback)
    return f.select("file", "file_name",
                    F.coalesce(F.try_element_at(hints, F.lit(-1)), fallback).alias("currency"))


def distinct_accounts(profile: DataFrame) -> DataFrame:
    """A10: the distinct account numbers discovered in the sheets."""
    return profile.where(F.col("account_candidate").isNotNull()).select(
        F.col("account_candidate").alias("account_number")).distinct()


def sheet_totals(profile: DataFrame) -> DataFrame:
    """Per file: rows, Σdebit, Σcredit, net, and the account when it is unique."""
    g = profile.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("row_debit"), F.lit(0)).alias("total_debit"),
        F.coalesce(F.sum("row_credit"), F.lit(0)).alias("total_credit"),
        F.countDistinct("account_candidate").alias("__n_acct"),
        F.min("account_candidate").alias("__acct"))
    return g.select("file", "rows", "total_debit", "total_credit",
                    (F.col("total_credit") - F.col("total_debit")).alias("net"),
                    F.when(F.col("__n_acct") == 1, F.col("__acct")).alias("account"))
