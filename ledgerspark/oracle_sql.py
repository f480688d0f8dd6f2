"""DuckDB mirrors of the stand-in adapters, and the oracle SQL of every registered query.

The verification driver runs each registered Spark query and the SQL here side by side on
the same Parquet tables (pre-registered as views named after the tables). The stand-in
silver tables are defined once as CTEs and prepended to each query that uses them.
Oracle SQL is written the plain way (join, then aggregate), independently of the Spark plan.
"""

from __future__ import annotations

import re


def _money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def _cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def _half_up(num: str, den: str) -> str:
    return f"((({num}) * 2 + ({den})) // (({den}) * 2))"


_LINE_ID = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
            "CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)")

STANDINS: dict[str, str] = {}

STANDINS["dim_accounts"] = """
SELECT CAST(p_partkey AS VARCHAR) AS account_id,
       CAST(p_partkey AS VARCHAR) AS account_number,
       p_name AS account_name,
       CASE split_part(p_type, ' ', 1)
         WHEN 'SMALL' THEN 'Tekjur' WHEN 'MEDIUM' THEN 'Gjöld' WHEN 'LARGE' THEN 'Eignir'
         WHEN 'ECONOMY' THEN 'Skuldir' WHEN 'STANDARD' THEN 'Eigið fé' ELSE 'Annað' END AS account_type,
       p_brand AS account_subtype,
       CAST(NULL AS VARCHAR) AS parent_account_id,
       CASE WHEN p_size > 5 THEN 1 ELSE 0 END AS is_active,
       CAST(NULL AS VARCHAR) AS created_at,
       CAST(NULL AS VARCHAR) AS updated_at
FROM part"""

STANDINS["silver_account_statements"] = f"""
SELECT id, account_code, account_id, account_name, account_type, account_subtype,
       transaction_date, journal_date, description, reference, amount,
       CASE WHEN amount < 0 THEN -amount ELSE CAST(0 AS DECIMAL(18,2)) END AS debit,
       CASE WHEN amount > 0 THEN amount ELSE CAST(0 AS DECIMAL(18,2)) END AS credit,
       balance, currency, journal_id, journal_number, line_number, record_type, created_at
FROM (
  SELECT {_LINE_ID} AS id,
         CAST(l_partkey AS VARCHAR) AS account_code,
         CAST(l_partkey AS VARCHAR) AS account_id,
         'Account ' || CAST(l_partkey AS VARCHAR) AS account_name,
         '' AS account_type, '' AS account_subtype,
         CAST(l_shipdate AS DATE) AS transaction_date,
         CAST(l_shipdate AS DATE) AS journal_date,
         (CASE WHEN l_returnflag = 'R' THEN 'Return' WHEN l_returnflag = 'A' THEN 'Adjusted sale'
               ELSE 'Sale' END) || ' / supplier ' || CAST(l_suppkey AS VARCHAR) || ' / ' ||
         (CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'final' END) AS description,
         CAST(l_orderkey AS VARCHAR) AS reference,
         {_money(f"CASE WHEN l_returnflag = 'R' THEN -{_cents('l_extendedprice')} ELSE {_cents('l_extendedprice')} END")} AS amount,
         {_money("CAST(round(l_quantity * 10000) AS BIGINT)")} AS balance,
         CASE WHEN l_suppkey % 10 = 7 THEN 'EUR' WHEN l_suppkey % 10 = 8 THEN 'GBP' ELSE 'ISK' END AS currency,
         CAST(l_orderkey AS VARCHAR) AS journal_id,
         CAST(l_orderkey AS VARCHAR) AS journal_number,
         l_linenumber AS line_number,
         'transaction' AS record_type,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS created_at
  FROM lineitem) t"""

STANDINS["silver_account_statements_typed"] = """
SELECT s.* REPLACE (COALESCE(a.account_type, '') AS account_type,
                    COALESCE(a.account_subtype, '') AS account_subtype)
FROM silver_account_statements s LEFT JOIN dim_accounts a ON s.account_code = a.account_number"""

STANDINS["dim_invoices"] = f"""
SELECT 'inv-' || CAST(o_orderkey AS VARCHAR) AS invoice_id,
       CAST(o_orderkey AS VARCHAR) AS invoice_number,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN 'PAID' WHEN o_orderstatus = 'O' THEN 'SENT'
            WHEN o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '4' THEN 'CANCELLED'
            WHEN o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '5' THEN 'CREDIT'
            WHEN o_orderstatus = 'P' THEN 'DRAFT' ELSE o_orderstatus END AS status,
       CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN 'EUR' WHEN '3' THEN 'USD'
            WHEN '5' THEN 'GBP' ELSE 'ISK' END AS currency,
       {_money('sub_c')} AS subtotal,
       {_money('total_c - sub_c')} AS vat_amount,
       {_money('total_c')} AS total,
       CAST(o_orderdate AS DATE) AS invoice_date,
       CAST(o_orderdate AS DATE) + 30 AS due_date,
       CAST(o_orderdate AS DATE) + 45 AS final_due_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 20 AS VARCHAR) END AS paid_date,
       CASE WHEN o_orderstatus = 'F' THEN 'transfer' END AS payment_type,
       'Order ' || CAST(o_orderkey AS VARCHAR) AS description,
       'C' || CAST(o_custkey AS VARCHAR) AS reference,
       CASE WHEN o_orderkey % 10 <> 0 THEN 1 ELSE 0 END AS is_active,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS created_at,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS updated_at
FROM (SELECT *, {_cents('o_totalprice')} AS total_c,
             {_half_up(_cents('o_totalprice') + ' * 100', '124')} AS sub_c
      FROM orders) o"""

STANDINS["dim_invoice_lines"] = f"""
SELECT {_LINE_ID} AS id,
       'inv-' || CAST(l_orderkey AS VARCHAR) AS invoice_id,
       l_linenumber AS line_number,
       'Part ' || CAST(l_partkey AS VARCHAR) AS description,
       CAST(qty AS DECIMAL(18,2)) AS quantity,
       {_money(_half_up('price_c', 'greatest(qty, 1)'))} AS unit_price,
       CAST(disc_pct AS DECIMAL(18,2)) AS discount_percent,
       CAST(tax_pct AS DECIMAL(18,2)) AS vat_percent,
       {_money(_half_up('price_c * tax_pct', '100'))} AS vat_amount,
       {_money('price_c')} AS line_total,
       CAST(l_partkey AS VARCHAR) AS account_id,
       CAST(l_partkey AS VARCHAR) AS account_code,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS created_at
FROM (SELECT *, {_cents('l_extendedprice')} AS price_c, CAST(round(l_quantity) AS BIGINT) AS qty,
             CAST(round(l_tax * 100) AS BIGINT) AS tax_pct,
             CAST(round(l_discount * 100) AS BIGINT) AS disc_pct
      FROM lineitem) l"""

STANDINS["silver_bank_transactions"] = f"""
SELECT sha1(branch || '|' || ledger || '|' || account_no || '|' || CAST(booking_date AS VARCHAR) || '|' ||
            CASE WHEN contains(CAST(amount AS VARCHAR), '.')
                 THEN regexp_replace(regexp_replace(CAST(amount AS VARCHAR), '0+$', ''), '\\.$', '')
                 ELSE CAST(amount AS VARCHAR) END || '|' || rb_batchno || '|' || reference || '|' || text_key) AS id,
       branch, ledger, account_no, booking_date, booking_date AS value_date, amount, currency,
       balance, reference, text_key, CAST(NULL AS VARCHAR) AS payer_ssn, rb_batchno, type_code,
       description, raw_hash, strftime(booking_date, '%Y-%m') AS source_period, ingested_at
FROM (
  SELECT lpad(CAST(user_id % 5 + 100 AS VARCHAR), 4, '0') AS branch, '26' AS ledger,
         lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_no,
         CAST(ts AS DATE) AS booking_date,
         {_money("CASE WHEN event_type = 'purchase' THEN -value_c ELSE value_c END")} AS amount,
         CASE WHEN user_id % 7 = 0 THEN 'EUR' WHEN user_id % 7 = 1 THEN 'GBP' ELSE 'ISK' END AS currency,
         {_money('value_c * 10')} AS balance,
         CAST(event_id AS VARCHAR) AS reference, event_type AS text_key,
         CAST(event_id % 3 AS VARCHAR) AS rb_batchno, upper(event_type) AS type_code,
         'Bank ' || event_type || ' ' || CAST(user_id % 13 AS VARCHAR) AS description,
         sha1(props) AS raw_hash, ts AS ingested_at
  FROM (SELECT *, {_cents('value')} AS value_c FROM events
        WHERE event_type IN ('purchase', 'error', 'signup')) e) b"""

STANDINS["silver_card_transactions"] = f"""
SELECT 'C' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS card_id,
       CAST(event_id AS VARCHAR) AS entry_id,
       CASE WHEN event_type = 'click' THEN 'withdrawal' ELSE 'deposit' END AS kind,
       CAST(NULL AS VARCHAR) AS clearance_id,
       CAST(ts AS DATE) AS date,
       {_money("CASE WHEN event_type = 'click' THEN -value_c ELSE value_c END")} AS amount,
       CAST(NULL AS DECIMAL(18,2)) AS foreign_amount, 'ISK' AS currency,
       CAST(NULL AS VARCHAR) AS foreign_currency,
       CAST(user_id % 17 AS VARCHAR) AS merchant_id,
       'Merchant ' || CAST(user_id % 17 AS VARCHAR) AS merchant_name,
       CAST(NULL AS VARCHAR) AS trans_key, CAST(NULL AS VARCHAR) AS trans_descriptor,
       CAST(NULL AS VARCHAR) AS due_date, CAST(NULL AS VARCHAR) AS mcc,
       'Merchant ' || CAST(user_id % 17 AS VARCHAR) AS description,
       sha1(props) AS raw_hash, strftime(CAST(ts AS DATE), '%Y-%m') AS source_period,
       ts AS ingested_at
FROM (SELECT *, {_cents('value')} AS value_c FROM events WHERE event_type IN ('click', 'view')) e"""

STANDINS["customers"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS segment,
       CAST(c_nationkey AS VARCHAR) AS country, {_money(_cents('c_acctbal'))} AS balance
FROM customer"""

STANDINS["expenses"] = f"""
SELECT {_LINE_ID} AS expense_id, CAST(l_suppkey AS VARCHAR) AS creditor_id,
       CAST(l_shipdate AS DATE) AS date, {_money(_cents('l_extendedprice'))} AS amount,
       'Return of part ' || CAST(l_partkey AS VARCHAR) AS description,
       CAST(l_partkey AS VARCHAR) AS account_code
FROM lineitem WHERE l_returnflag = 'R'"""

STANDINS["payments"] = """
SELECT 'pay-' || invoice_number AS payment_id, invoice_id, customer_id,
       CAST(paid_date AS DATE) AS date, total AS amount, currency, payment_type
FROM dim_invoices WHERE status = 'PAID'"""

# dependency order for the WITH clause
_ORDER = ["dim_accounts", "silver_account_statements", "silver_account_statements_typed",
          "dim_invoices", "dim_invoice_lines", "silver_bank_transactions",
          "silver_card_transactions", "customers", "expenses", "payments"]
_DEPS = {"silver_account_statements_typed": ["silver_account_statements", "dim_accounts"],
         "payments": ["dim_invoices"]}


def with_standins(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the stand-in tables it mentions."""
    needed: set[str] = set()

    def add(name):
        if name in needed:
            return
        needed.add(name)
        for d in _DEPS.get(name, []):
            add(d)

    for name in _ORDER:
        if re.search(rf"\b{name}\b", sql):
            add(name)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({STANDINS[n]}\n)" for n in _ORDER if n in needed)
    body = sql.lstrip()
    if re.match(r"(?i)WITH\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------------------- query SQL

D = "CAST({} AS DOUBLE)".format


def _avg_money(x: str) -> str:
    """Exact half-up cents average, same arithmetic as ``functions.money.money_avg``."""
    s = f"CAST(SUM({x}) * 100 AS BIGINT)"
    n = f"COUNT({x})"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((abs({s}) * 2 + {n}) // ({n} * 2)) "
            f"AS DOUBLE) / 100.0 END")


QUERIES: dict[str, str] = {}
