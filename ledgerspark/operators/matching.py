"""Joins and matching.

Rule and payment-type tables are configuration (their size is the number of configured
rules), created from parameters; Spark broadcasts them from their known in-memory size, so
the fact side is never shuffled for these lookups. Data-sized sides are left to the
optimizer: a sort-merge join on the key, converted to a broadcast by AQE only when the
measured runtime size is below the threshold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import MAX_CONFIG_ROWS, config_table
from ..operators.loading import staged
from ..operators.search import UUID_RE
from ..session import scratch_path


# ---------------------------------------------------------------- D2, D3, D4 (used by views)

def accounts_with_activity(accounts: DataFrame, summary: DataFrame) -> DataFrame:
    """Every account with its summary row(s), left join on the account number (the
    NULL -> 0 form is ``plans.ledger.gold_account_detail``)."""
    j = accounts.join(summary.withColumnRenamed("account_code", "__code"),
                      accounts["account_number"] == F.col("__code"), "left")
    return j.drop("__code")


def lines_with_invoice(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """D3: lines of active invoices (inner join on invoice_id)."""
    active = invoices.where(F.col("is_active") == 1).select(
        F.col("invoice_id").alias("__inv"), "invoice_number", "customer_id",
        F.col("status").alias("invoice_status"))
    return lines.join(active, lines["invoice_id"] == F.col("__inv"), "inner").drop("__inv")


# ---------------------------------------------------------------- D5, D6 account matching

def match_accounts_by_rule(accounts: DataFrame, rules: DataFrame, payment_types: DataFrame
                           ) -> DataFrame:
    """Each account gets the payment type of the rule for its account number; failing
    that, of the rule for its currency (lowest ``priority`` first among equal rules).
    ``matched`` tells which accounts got none.

    accounts: (account_number, currency, ...); rules: (priority, account_number, currency,
    payment_type_id) with either account_number or currency set; payment_types: (id, title).
    """
    by_number = (rules.where(F.col("account_number").isNotNull())
                 .groupBy("account_number").agg(F.min_by("payment_type_id", "priority")
                                                .alias("__pt_num")))
    by_cur = (rules.where(F.col("account_number").isNull() & F.col("currency").isNotNull())
              .groupBy("currency").agg(F.min_by("payment_type_id", "priority").alias("__pt_cur")))
    j = (accounts.join(by_number, "account_number", "left")
                 .join(by_cur, "currency", "left"))
    pt = payment_types.select(F.col("id").alias("payment_type_id"),
                              F.col("title").alias("payment_type_title"))
    j = j.withColumn("payment_type_id", F.coalesce("__pt_num", "__pt_cur")).drop("__pt_num", "__pt_cur")
    j = j.join(pt, "payment_type_id", "left")
    return j.withColumn("matched", F.col("payment_type_title").isNotNull())


def match_accounts_by_currency(accounts: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Every payment type of the same currency (a payment type without currency counts
    as ISK); 1:n, accounts without a candidate keep one row with NULLs."""
    pt = payment_types.select(F.col("id").alias("payment_type_id"),
                              F.col("title").alias("payment_type_title"),
                              F.coalesce("currency", F.lit("ISK")).alias("__pcur"))
    return accounts.join(pt, accounts["currency"] == pt["__pcur"], "left").drop("__pcur")


# ---------------------------------------------------------------- D7, D8, D9, D10

def number_to_uuid(updates: DataFrame, invoices: DataFrame, ref_col: str = "invoice_ref"
                   ) -> DataFrame:
    """Resolve each update's invoice reference (UUID -> by id, else by number) to an
    invoice id; unresolved rows get ``resolved = false`` (NOT_FOUND).

    Semi-join reduction: the invoice table is first cut down to the invoices the batch names
    (``left_semi`` against the batch's distinct references — the small side, which AQE
    broadcasts from its measured size), so the full invoice table is scanned once and never
    shuffled; the batch is then joined to that small set.
    """
    is_uuid = F.col(ref_col).rlike("(?i)" + UUID_RE.pattern)
    u = updates.withColumn("__is_uuid", is_uuid)
    ids = u.where("__is_uuid").select(F.col(ref_col).alias("__ref")).distinct()
    nos = u.where(~F.col("__is_uuid")).select(F.col(ref_col).alias("__ref")).distinct()
    by_id = (invoices.join(ids, invoices["invoice_id"] == ids["__ref"], "left_semi")
             .select(F.col("invoice_id").alias("__id_hit")))
    by_no = (invoices.join(nos, invoices["invoice_number"] == nos["__ref"], "left_semi")
             .select(F.col("invoice_number").alias("__no"), F.col("invoice_id").alias("__no_hit")))
    j = (u.join(by_id, (F.col("__is_uuid")) & (F.col(ref_col) == F.col("__id_hit")), "left")
          .join(by_no, (~F.col("__is_uuid")) & (F.col(ref_col) == F.col("__no")), "left"))
    return (j.withColumn("invoice_id", F.coalesce("__id_hit", "__no_hit"))
             .withColumn("resolved", F.col("invoice_id").isNotNull())
             .drop("__is_uuid", "__id_hit", "__no", "__no_hit"))


def orphan_lines(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoice lines whose invoice does not exist (foreign-key check)."""
    return lines.join(invoices.select("invoice_id"), "invoice_id", "left_anti")


def orphan_statements(statements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Statement lines whose account code is not in the chart of accounts."""
    return statements.join(accounts.select(F.col("account_number").alias("account_code")),
                           "account_code", "left_anti")


def new_rows_only(target: DataFrame, incoming: DataFrame, key_cols: list[str]) -> DataFrame:
    """Incoming rows whose key is not in the target (INSERT OR IGNORE's filter)."""
    return incoming.join(target.select(*key_cols), key_cols, "left_anti")


def account_groups_join(df: DataFrame, groups: DataFrame, type_col: str = "account_type",
                        subtype_col: str = "account_subtype") -> DataFrame:
    """Attach report_group, report_subgroup, statement and sign by (type, subtype);
    a group row with NULL subtype applies to every subtype of its type."""
    exact = groups.where(F.col("acct_subtype").isNotNull()).select(
        F.col("acct_type").alias("__t"), F.col("acct_subtype").alias("__s"),
        F.col("report_group").alias("__g1"), F.col("report_subgroup").alias("__sg1"),
        F.col("statement").alias("__st1"), F.col("sign").alias("__sign1"))
    anyst = groups.where(F.col("acct_subtype").isNull()).select(
        F.col("acct_type").alias("__t2"),
        F.col("report_group").alias("__g2"), F.col("report_subgroup").alias("__sg2"),
        F.col("statement").alias("__st2"), F.col("sign").alias("__sign2"))
    j = (df.join(exact, (df[type_col] == F.col("__t")) & (df[subtype_col] == F.col("__s")), "left")
           .join(anyst, df[type_col] == F.col("__t2"), "left"))
    return (j.withColumn("report_group", F.coalesce("__g1", "__g2"))
             .withColumn("report_subgroup", F.coalesce("__sg1", "__sg2"))
             .withColumn("statement", F.coalesce("__st1", "__st2"))
             .withColumn("sign", F.coalesce("__sign1", "__sign2"))
             .drop("__t", "__s", "__g1", "__sg1", "__st1", "__sign1", "__t2", "__g2", "__sg2",
                   "__st2", "__sign2"))


def default_account_groups(spark: SparkSession) -> DataFrame:
    """A starting group table: one group per account class, by the class sign rules."""
    return config_table(spark, default_account_group_rows(), GROUPS_SCHEMA)


def account_groups_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """The reporting groups of a CSV file with the columns of ``GROUPS_SCHEMA`` as its header;
    a blank subtype means every subtype, a row without a valid statement or sign is an error."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").schema(GROUPS_SCHEMA).csv(path)
    rows = rows.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                         for c, t in rows.dtypes])
    limit = MAX_CONFIG_ROWS + 1
    listed = [tuple(r) for r in rows.limit(limit).collect()]        # configuration, checked here
    bad = [r for r in listed if r[0] is None or r[4] not in ("PL", "BS") or r[5] not in (-1, 1)]
    if bad:
        raise ValueError(f"account groups need a type, PL or BS and a sign of 1 or -1: {bad[:3]}")
    return config_table(spark, listed, GROUPS_SCHEMA) if len(listed) < limit else rows


GROUPS_SCHEMA = ("acct_type string, acct_subtype string, report_group string, "
                 "report_subgroup string, statement string, sign int")


def default_account_group_rows() -> list[tuple]:
    """One type-level group row per account type name (both languages). ``sign`` times
    (debit - credit) reads positive on a class's normal side: -1 for revenue, liabilities and
    equity, +1 for expenses and assets."""
    from ..functions.accounting import ENGLISH_TYPES, ICELANDIC_TYPES
    spec = {"revenue": ("Revenue", "PL", -1), "expense": ("Operating expenses", "PL", 1),
            "asset": ("Assets", "BS", 1), "liability": ("Liabilities", "BS", -1),
            "equity": ("Equity", "BS", -1)}
    return [(t, None, group, None, stmt, sign) for cls, (group, stmt, sign) in spec.items()
            for t in (ICELANDIC_TYPES[cls],) + ENGLISH_TYPES[cls]]


# ---------------------------------------------------------------- D11 reconciliation

def _ranked(df: DataFrame, name: str) -> DataFrame:
    """(amount, day, id, date, rank): 0-based rank by id within (amount, day). Rows are dealt by
    range of (amount, day, id), so a day on which one amount occurs very often spreads over
    partitions; ranks are row numbers within the partition plus the counts of earlier ones."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    (df.repartitionByRange("amount", "day", "id")
       .withColumn("part", F.spark_partition_id()).write.parquet(path))
    dealt = spark.read.parquet(path)
    key = ["amount", "day", "part"]
    earlier = Window.partitionBy("amount", "day").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    before = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(
        *key, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = Window.partitionBy(*key).orderBy("id")
    return dealt.withColumn("rank", F.row_number().over(inner) - 1).join(before, key).select(
        "amount", "day", "id", "date", (F.col("rank") + F.col("before")).alias("rank"))


def _paired_counts(b: DataFrame, d: DataFrame, tolerance: int) -> DataFrame:
    """How many lines of an (amount, day) pair with documents ``off`` days later: amount, day, off,
    n, and the ranks from_b and from_d of the first that do."""
    days = b.select("amount", "day", F.lit(1).alias("b"), F.lit(0).alias("d")).unionByName(
        d.select("amount", "day", F.lit(0).alias("b"), F.lit(1).alias("d"))).groupBy(
        "amount", "day").agg(F.sum("b").alias("b"), F.sum("d").alias("d"))
    by_day = Window.partitionBy("amount").orderBy("day")
    gap = F.col("day") - F.lag("day").over(by_day)
    days = days.withColumn("gap", gap).withColumn("first", F.coalesce(
        F.col("gap") > tolerance, F.lit(True)))
    runs = days.withColumn("run", F.sum(F.col("first").cast("int")).over(by_day)) \
        .withColumn("gap", F.when(F.col("first"), 1).otherwise(F.col("gap"))) \
        .groupBy("amount", "run").agg(
            F.min("day").alias("start"), F.sum("b").alias("all_b"), F.sum("d").alias("all_d"),
            F.sort_array(F.collect_list(F.struct("day", "gap", "b", "d"))).alias("days")) \
        .where("all_b > 0 AND all_d > 0")

    def cell(b, d):
        return F.struct(*[c.cast("long").alias(n)
                          for n, c in (("b", b), ("d", d), ("b0", b), ("d0", d))])

    nothing = F.lit(0).cast("long")
    dense = F.flatten(F.transform("days", lambda x: F.concat(
        F.array_repeat(cell(nothing, nothing), x["gap"] - 1), F.array(cell(x["b"], x["d"])))))

    def step(state, off):
        at = state["cells"]
        left = F.transform(at, lambda x, i: F.struct(
            (x["b"] - F.least(x["b"], F.coalesce(F.get(at, i + off)["d"], nothing))).alias("b"),
            (x["d"] - F.least(x["d"], F.coalesce(F.get(at, i - off)["b"], nothing))).alias("d"),
            x["b0"].alias("b0"), x["d0"].alias("d0")))
        return F.struct(left.alias("cells"), F.concat(state["flows"], flow(at, off)).alias("flows"))

    def flow(at, off):
        def one(x, i):
            to = F.get(at, i + off)
            return F.struct(i.alias("i"), off.alias("off"),
                            F.least(x["b"], F.coalesce(to["d"], nothing)).alias("n"),
                            (x["b0"] - x["b"]).alias("from_b"), (to["d0"] - to["d"]).alias("from_d"))
        return F.filter(F.transform(at, one), lambda f: f["n"] > 0)

    both_ways = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max(tolerance, 1))),
                                      lambda k: F.array(k, -k)))
    every = F.array_prepend(both_ways, 0) if tolerance > 0 else F.array(F.lit(0))
    # most runs have few days: only the distances that occur in them are tried
    def days_with(side):
        return F.transform(F.filter("days", lambda x: x[side] > 0), lambda x: x["day"])

    of_b, of_d = days_with("b"), days_with("d")
    occur = F.flatten(F.transform(of_b, lambda x: F.transform(of_d, lambda y: y - x)))
    few = F.size(of_b) * F.size(of_d) <= 4 * tolerance + 2
    runs = runs.withColumn("offsets", F.when(few, F.array_intersect(every, occur)).otherwise(every))
    kind = "array<struct<i:int,off:int,n:bigint,from_b:bigint,from_d:bigint>>"
    start = F.struct(dense.alias("cells"), F.array().cast(kind).alias("flows"))
    folded = F.aggregate(F.col("offsets"), start, step, lambda state: state["flows"])
    return runs.select("amount", "start", F.explode(folded).alias("f")).select(
        "amount", (F.col("start") + F.col("f.i")).alias("day"), "f.off", "f.n", "f.from_b",
        "f.from_d")


def reconcile_bank(bank: DataFrame, documents: DataFrame, tolerance_days: int = 3) -> DataFrame:
    """One-to-one matches between bank lines and documents (invoices, expenses) of equal
    amount whose dates differ by at most ``tolerance_days``. Inputs: (id, amount, date).

    Nearer days go first: lines and documents of the same amount and day are paired by the order
    of their ids, then what is left with documents one day later, one day earlier, two days
    later, and so on. So n equal payments and n equal invoices give n pairs.

    How many rows each pass pairs follows from counts per (amount, day) alone. The days of an
    amount fall into runs with gaps of at most the tolerance, which can't meet each other. The
    counts of a run become one array with an entry a day (bounded by the calendar), and one fold
    over the distances 0, 1, -1, 2, ... pairs them; the plan is the same for any tolerance. Rows then
    find their partner by an equi-join on (amount, day, rank), only those on days that pair at all.

    Result: (bank_id, document_id, amount, bank_date, document_date, days_apart).
    """
    def slim(df):
        return df.select(F.col("id").cast("string").alias("id"), "amount", "date",
                         F.datediff("date", F.lit("1970-01-01").cast("date")).alias("day")).where(
            F.col("amount").isNotNull() & F.col("date").isNotNull())
    b, d = slim(bank), slim(documents)
    flows = staged(_paired_counts(b, d, int(tolerance_days)), "reconcile-flows")
    b_days = flows.select("amount", "day").distinct()
    d_days = flows.select("amount", (F.col("day") + F.col("off")).alias("day")).distinct()
    b, d = (x.join(days, ["amount", "day"], "left_semi") for x, days in ((b, b_days), (d, d_days)))
    left = _ranked(b, "bank").join(flows, ["amount", "day"]).where(
        (F.col("rank") >= F.col("from_b")) & (F.col("rank") < F.col("from_b") + F.col("n"))).select(
        F.col("id").alias("bank_id"), "amount", F.col("date").alias("bank_date"),
        (F.col("day") + F.col("off")).alias("day"), F.abs("off").alias("days_apart"),
        (F.col("rank") - F.col("from_b") + F.col("from_d")).alias("rank"))
    right = _ranked(d, "documents").select(
        F.col("id").alias("document_id"), "amount", F.col("date").alias("document_date"), "day",
        "rank")
    return left.join(right, ["amount", "day", "rank"]).select(
        "bank_id", "document_id", "amount", "bank_date", "document_date", "days_apart")
