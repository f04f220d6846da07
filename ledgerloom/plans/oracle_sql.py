"""Independent DuckDB formulations of the registered queries.

These are written the way the reference computes each result -- separate
aggregates joined back together, ``row_number``/``rank`` windows, plain GROUP BY
-- not as a transcription of the Spark plans, so a match checks the rewrite.
Tables ``lineitem orders part supplier customer nation region events`` are
views the checker registers.

Money is exact DECIMAL; ratios and rounded figures use the same exact HALF_UP
definition as the library (``ratio``), averages of money are exact sums divided
by counts.
"""

from __future__ import annotations

from ledgerloom.operators.signals import REFERENCE_MERCHANTS


def ratio(a: str, b: str, scale: int, unit: int = 10000) -> str:
    """Exact HALF_UP rounding of ``a / b`` to ``scale`` decimals, as DOUBLE (NULL if b = 0).
    ``unit`` turns the decimal operands into integers (10,000 for money)."""
    k = 10 ** scale
    ai = f"abs(CAST(({a}) * {unit} AS HUGEINT))"
    bi = f"abs(CAST(({b}) * {unit} AS HUGEINT))"
    sign = f"(CASE WHEN (({a}) < 0) <> (({b}) < 0) THEN -1 ELSE 1 END)"
    return (f"(CASE WHEN ({b}) <> 0 THEN {sign} * (({ai} * {2 * k} + {bi}) // ({bi} * 2)) / {float(k)} END)")


def half_up(x: str, scale: int) -> str:
    """HALF_UP of a DOUBLE, the same IEEE expression as the library's ``half_up``."""
    k = float(10 ** scale)
    return f"(sign({x}) * floor(abs({x}) * {k} + 0.5) / {k})"


def initcap(s: str) -> str:
    """Spark's initcap: first letter of each space-separated word upper, rest lower."""
    return (f"array_to_string(list_transform(string_split({s}, ' '), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")


RAW_LEDGER = """
raw_ledger AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         o.o_custkey AS customer_id,
         o.o_orderdate AS transaction_date,
         CAST(l.l_extendedprice AS DECIMAL(22,4)) AS amount,
         CASE WHEN l.l_returnflag = 'R' THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
         s.s_name AS merchant_name,
         p.p_type AS merchant_category,
         o.o_orderpriority AS channel
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

#: One line per (order, line number): a positive amount first, then the smallest values.
UNIQUE_LINES = """
lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY CASE WHEN TRY_CAST(l_extendedprice AS DECIMAL(22,4)) > 0 THEN 0 ELSE 1 END,
                 TRY_CAST(l_extendedprice AS DECIMAL(22,4)) ASC NULLS LAST, l_suppkey ASC NULLS LAST,
                 l_partkey ASC NULLS LAST, l_returnflag ASC NULLS LAST) AS rn
    FROM lineitem) x
  WHERE rn = 1)"""
UNIQUE_LEDGER = UNIQUE_LINES + "," + RAW_LEDGER.replace("FROM lineitem l", "FROM lines l")

RAW_EVENTS = """
raw_ledger AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         user_id AS customer_id,
         ts AS transaction_date,
         CAST(value AS DECIMAL(22,4)) AS amount,
         CASE WHEN event_type = 'signup' THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
         json_extract_string(props, '$.k') AS merchant_name,
         event_type AS merchant_category,
         (['POS', 'MOBILE', 'ONLINE', 'ATM'])[(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4) + 1] AS channel
  FROM events)"""

#: A usable copy first, then typed date and amount, then the rest; NULLs last.
DEDUP = """
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY CASE WHEN TRY_CAST(amount AS DECIMAL(22,4)) > 0 AND TRY_CAST(transaction_date AS TIMESTAMP) IS NOT NULL
                           AND customer_id IS NOT NULL THEN 0 ELSE 1 END,
                 TRY_CAST(transaction_date AS TIMESTAMP) ASC NULLS LAST, TRY_CAST(amount AS DECIMAL(22,4)) ASC NULLS LAST,
                 merchant_name ASC NULLS LAST, merchant_category ASC NULLS LAST, transaction_type ASC NULLS LAST,
                 channel ASC NULLS LAST, customer_id ASC NULLS LAST, amount ASC NULLS LAST) AS rn
    FROM raw_ledger WHERE transaction_id IS NOT NULL) d
  WHERE rn = 1)"""
UNIQUE_DEDUP = """
dedup AS (SELECT * FROM raw_ledger WHERE transaction_id IS NOT NULL)"""

STANDARD = """
standard AS (
  SELECT transaction_id, customer_id, TRY_CAST(transaction_date AS TIMESTAMP) AS transaction_date,
         TRY_CAST(amount AS DECIMAL(22,4)) AS amount,
         upper(trim(transaction_type)) AS transaction_type,
         upper(trim(merchant_name)) AS merchant_name,
         lower(trim(merchant_category)) AS merchant_category,
         upper(trim(channel)) AS channel
  FROM dedup)"""

CALENDAR = """
calendar AS (
  SELECT *,
         CAST(year(transaction_date) AS INTEGER) AS txn_year,
         CAST(month(transaction_date) AS INTEGER) AS txn_month,
         CAST(day(transaction_date) AS INTEGER) AS txn_day,
         CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS txn_day_of_week,
         CAST(hour(transaction_date) AS INTEGER) AS txn_hour,
         dayofweek(transaction_date) IN (0, 6) AS is_weekend,
         day(transaction_date) >= 20 AS is_month_end,
         day(transaction_date) BETWEEN 24 AND 26 AS is_salary_period
  FROM standard)"""

SILVER = """
silver AS (
  SELECT * FROM calendar
  WHERE amount > 0 AND transaction_id IS NOT NULL AND customer_id IS NOT NULL
    AND transaction_date IS NOT NULL)"""

CUSTOMERS = f"""
raw_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment, r.r_name AS province,
         c.c_acctbal AS monthly_income
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
customers_silver AS (
  SELECT customer_id, lower(trim(segment)) AS segment, {initcap('trim(province)')} AS province,
         CAST(monthly_income AS DOUBLE) AS monthly_income
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
               ORDER BY CASE WHEN monthly_income > 0 THEN 0 ELSE 1 END, segment ASC NULLS LAST,
                        province ASC NULLS LAST, monthly_income ASC NULLS LAST) AS rn
        FROM raw_customers WHERE customer_id IS NOT NULL) c
  WHERE rn = 1 AND monthly_income > 0)"""


def silver_ctes(events: bool = False) -> str:
    raw = [RAW_EVENTS, DEDUP] if events else [UNIQUE_LEDGER, UNIQUE_DEDUP]
    return ",".join([*raw, STANDARD, CALENDAR, SILVER])


def monthly_ctes(ties: str = "one") -> str:
    """The reference's join form of the monthly summary, as CTE ``monthly``."""
    order = "cat_spend DESC" + (", merchant_category ASC NULLS FIRST" if ties == "one" else "")
    fn = "row_number()" if ties == "one" else "rank()"
    return f"""
m_spend AS (
  SELECT customer_id, txn_year, txn_month, SUM(amount) AS spend, COUNT(transaction_id) AS debit_txn_count,
         COUNT(DISTINCT merchant_name) AS unique_merchants, MAX(amount) AS max_spend, COUNT(*) AS n_debits
  FROM silver WHERE transaction_type = 'DEBIT' GROUP BY customer_id, txn_year, txn_month),
m_income AS (
  SELECT customer_id, txn_year, txn_month, SUM(amount) AS income, COUNT(transaction_id) AS credit_txn_count
  FROM silver WHERE transaction_type = 'CREDIT' GROUP BY customer_id, txn_year, txn_month),
m_end AS (
  SELECT customer_id, txn_year, txn_month, SUM(amount) AS month_end
  FROM silver WHERE transaction_type = 'DEBIT' AND is_month_end GROUP BY customer_id, txn_year, txn_month),
m_cat AS (
  SELECT customer_id, txn_year, txn_month, merchant_category, SUM(amount) AS cat_spend
  FROM silver WHERE transaction_type = 'DEBIT' GROUP BY customer_id, txn_year, txn_month, merchant_category),
m_top AS (
  SELECT customer_id, txn_year, txn_month, merchant_category AS top_category FROM (
    SELECT *, {fn} OVER (PARTITION BY customer_id, txn_year, txn_month ORDER BY {order}) AS rk FROM m_cat) t
  WHERE rk = 1),
monthly AS (
  SELECT s.customer_id, s.txn_year, s.txn_month,
         CAST(s.spend AS DOUBLE) AS total_spend, s.debit_txn_count, s.unique_merchants,
         CAST(s.spend AS DOUBLE) / s.n_debits AS avg_txn_amount,
         CAST(s.max_spend AS DOUBLE) AS max_txn_amount,
         CAST(i.income AS DOUBLE) AS total_income_received, i.credit_txn_count,
         CAST(e.month_end AS DOUBLE) AS month_end_spend, t.top_category,
         {ratio('e.month_end', 's.spend', 4)} AS month_end_stress_ratio,
         {ratio('s.spend', 'i.income', 4)} AS spend_to_income_ratio
  FROM m_spend s
  LEFT JOIN m_income i USING (customer_id, txn_year, txn_month)
  LEFT JOIN m_end e USING (customer_id, txn_year, txn_month)
  LEFT JOIN m_top t USING (customer_id, txn_year, txn_month))"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


ORACLE: dict[str, str] = {
    "monthly_summary": with_ctes(silver_ctes(), monthly_ctes("one"), body="SELECT * FROM monthly"),
}


# ---------------------------------------------------------------------------- the rest

def _raw_named(name: str, events: bool) -> str:
    return (RAW_EVENTS if events else RAW_LEDGER).replace("raw_ledger AS (", f"{name} AS (", 1)


def _silver(body: str, events: bool = False) -> str:
    return with_ctes(silver_ctes(events), body=body)


def _monthly(body: str, ties: str = "one", events: bool = False) -> str:
    return with_ctes(silver_ctes(events), monthly_ctes(ties), body=body)


PROFILE_CTES = f"""
p_spend AS (
  SELECT customer_id, SUM(amount) AS spend, COUNT(transaction_id) AS lifetime_txn_count, COUNT(*) AS n_debits,
         COUNT(DISTINCT merchant_category) AS category_diversity
  FROM silver WHERE transaction_type = 'DEBIT' GROUP BY customer_id),
p_chan_counts AS (
  SELECT customer_id, channel, COUNT(*) AS cnt FROM silver WHERE transaction_type = 'DEBIT'
  GROUP BY customer_id, channel),
p_chan_one AS (
  SELECT customer_id, channel AS preferred_channel FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY cnt DESC, channel ASC NULLS FIRST) AS rk
    FROM p_chan_counts) t WHERE rk = 1),
p_chan_all AS (
  SELECT customer_id, channel AS preferred_channel FROM (
    SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY cnt DESC) AS rk FROM p_chan_counts) t WHERE rk = 1),
p_stress AS (
  SELECT customer_id,
         CASE WHEN COUNT(month_end_stress_ratio) > 0 THEN
           CAST(SUM(CAST(month_end_stress_ratio AS DECIMAL(20,4))) AS DOUBLE) / COUNT(month_end_stress_ratio) END
           AS avg_stress_ratio,
         CASE WHEN COUNT(spend_to_income_ratio) > 0 THEN
           CAST(SUM(CAST(spend_to_income_ratio AS DECIMAL(20,4))) AS DOUBLE) / COUNT(spend_to_income_ratio) END
           AS avg_spend_to_income,
         CASE WHEN COUNT(month_end_stress_ratio) > 0 THEN
           SUM(CAST(month_end_stress_ratio AS DECIMAL(20,4))) > 0.6 * COUNT(month_end_stress_ratio) END
           AS is_financially_stressed
  FROM monthly GROUP BY customer_id)"""


def _profile_body(ties: str = "one") -> str:
    chan = "p_chan_one" if ties == "one" else "p_chan_all"
    return f"""
profile AS (
  SELECT c.customer_id, c.segment, c.province, c.monthly_income,
         CAST(s.spend AS DOUBLE) AS lifetime_spend, s.lifetime_txn_count,
         CAST(s.spend AS DOUBLE) / s.n_debits AS avg_txn_value, s.category_diversity,
         ch.preferred_channel, st.avg_stress_ratio, st.avg_spend_to_income, st.is_financially_stressed
  FROM customers_silver c
  LEFT JOIN p_spend s USING (customer_id)
  LEFT JOIN {chan} ch USING (customer_id)
  LEFT JOIN p_stress st USING (customer_id))"""


def _profile(body: str, ties: str = "one") -> str:
    return with_ctes(silver_ctes(), CUSTOMERS, monthly_ctes(ties), PROFILE_CTES, _profile_body(ties), body=body)


QUARANTINE = """
SELECT * FROM (
  SELECT *, CASE WHEN TRY_CAST(amount AS DOUBLE) > 0 AND NOT coalesce(TRY_CAST(amount AS DECIMAL(22,4)) > 0, false) THEN 'amount'
                 WHEN TRY_CAST(amount AS DECIMAL(22,4)) > 0 AND TRY_CAST(transaction_date AS TIMESTAMP) IS NULL THEN 'date' END AS reason
  FROM dedup WHERE customer_id IS NOT NULL) r
WHERE reason IS NOT NULL"""

MONTH_IDX = "(txn_year * 12 + txn_month - 1)"

ORACLE.update({
    # ---------------- Silver
    "dedup_transactions": _silver("SELECT * FROM dedup"),
    "standardise_text": _silver("SELECT * FROM standard"),
    "date_parts": _silver("SELECT transaction_id, txn_year, txn_month, txn_day, txn_day_of_week, txn_hour, "
                          "is_weekend FROM silver", events=True),
    "calendar_flags": _silver("SELECT transaction_id, txn_day, is_month_end, is_salary_period, is_weekend "
                              "FROM silver", events=True),
    "filter_valid": with_ctes(RAW_LEDGER, body="""
SELECT transaction_id, customer_id, amount, upper(trim(transaction_type)) AS transaction_type FROM raw_ledger
WHERE amount > 0 AND transaction_id IS NOT NULL AND customer_id IS NOT NULL AND transaction_date IS NOT NULL"""),
    "clean_transactions": _silver("SELECT * FROM silver"),
    "clean_events": _silver("SELECT * FROM silver", events=True),
    "clean_customers": with_ctes(CUSTOMERS, body="SELECT * FROM customers_silver"),
    "quarantined_transactions": _silver(f"SELECT * FROM ({QUARANTINE}) q"),
    "null_flags": _silver("SELECT transaction_id, CAST(" + " + ".join(
        f"CAST({c} IS NULL AS INTEGER)" for c in
        ["transaction_id", "customer_id", "transaction_date", "amount", "transaction_type", "merchant_name",
         "merchant_category", "channel"]) + " AS INTEGER) AS null_fields FROM dedup"),
    "ledger_by_time": _silver("SELECT transaction_id, transaction_date, customer_id, amount FROM silver "
                              "ORDER BY transaction_date, transaction_id"),
    # ---------------- Gold parts
    "monthly_spend": _monthly("SELECT customer_id, txn_year, txn_month, CAST(spend AS DOUBLE) AS total_spend, "
                              "debit_txn_count, unique_merchants, CAST(spend AS DOUBLE) / n_debits AS avg_txn_amount, "
                              "CAST(max_spend AS DOUBLE) AS max_txn_amount FROM m_spend"),
    "monthly_income": _monthly("SELECT customer_id, txn_year, txn_month, CAST(income AS DOUBLE) AS "
                               "total_income_received, credit_txn_count FROM m_income"),
    "month_end_spend": _monthly("SELECT customer_id, txn_year, txn_month, CAST(month_end AS DOUBLE) AS "
                                "month_end_spend FROM m_end"),
    "category_spend": _monthly("SELECT customer_id, txn_year, txn_month, merchant_category, "
                               "CAST(cat_spend AS DOUBLE) AS cat_spend FROM m_cat"),
    "top_category": _monthly("SELECT * FROM m_top"),
    "top_category_ties": _monthly("SELECT * FROM m_top", ties="all"),
    "preferred_channel": _profile("SELECT * FROM p_chan_one"),
    "preferred_channel_ties": _profile("SELECT * FROM p_chan_all"),
    "lifetime_stats": _profile("SELECT customer_id, CAST(spend AS DOUBLE) AS lifetime_spend, lifetime_txn_count, "
                               "CAST(spend AS DOUBLE) / n_debits AS avg_txn_value, category_diversity FROM p_spend"),
    "stress_by_customer": _profile("SELECT * FROM p_stress"),
    "monthly_summary_ties": _monthly("SELECT * FROM monthly", ties="all"),
    "monthly_summary_events": _monthly("SELECT * FROM monthly", events=True),
    "customer_profile": _profile("SELECT * FROM profile"),
    "customer_profile_ties": _profile("SELECT * FROM profile", ties="all"),
    # ---------------- insights
    "spend_by_segment": _profile(f"""
SELECT segment,
       {ratio('SUM(CAST(lifetime_spend AS DECIMAL(32,4)))',
              'COUNT(lifetime_spend) * (SELECT max(' + MONTH_IDX + ') - min(' + MONTH_IDX + ') + 1 FROM silver '
              "WHERE transaction_type = 'DEBIT')", 2)} AS avg_monthly_spend,
       COUNT(customer_id) AS customer_count
FROM profile GROUP BY segment"""),
    "stress_by_province": _profile(f"""
SELECT province, {half_up('AVG(avg_stress_ratio) * 100.0', 1)} AS avg_stress_pct,
       CAST(SUM(CAST(is_financially_stressed AS INTEGER)) AS BIGINT) AS stressed_customers,
       COUNT(customer_id) AS total_customers
FROM profile GROUP BY province"""),
    "category_totals": _silver(f"""
SELECT merchant_category, {ratio('SUM(amount)', 'CAST(1000000 AS HUGEINT)', 2)} AS total_spend_millions
FROM silver WHERE transaction_type = 'DEBIT' GROUP BY merchant_category"""),
    "monthly_volume": _silver(f"""
SELECT txn_year, txn_month, COUNT(transaction_id) AS txn_count,
       {ratio('SUM(amount)', 'CAST(1000000 AS HUGEINT)', 2)} AS total_volume_millions,
       printf('%04d-%02d', txn_year, txn_month) AS period
FROM silver GROUP BY txn_year, txn_month"""),
    "stress_report": _profile("""
SELECT total_customers, stressed_customers, total_customers - stressed_customers AS not_stressed_customers,
       CASE WHEN total_customers > 0 THEN tenths / 10.0 END AS stressed_pct,
       CASE WHEN total_customers > 0 THEN (1000 - tenths) / 10.0 END AS not_stressed_pct
FROM (SELECT *, (stressed_customers * 2000 + total_customers) // (total_customers * 2) AS tenths
      FROM (SELECT COUNT(*) AS total_customers,
                   COUNT(*) FILTER (WHERE is_financially_stressed) AS stressed_customers FROM profile) a) b"""),
    "stress_by_segment": _profile(f"""
SELECT segment, CAST(SUM(CAST(is_financially_stressed AS INTEGER)) AS BIGINT) AS stressed,
       COUNT(customer_id) AS total, {half_up('AVG(avg_stress_ratio) * 100.0', 1)} AS avg_stress_pct
FROM profile GROUP BY segment"""),
    # ---------------- quality
    "null_report": _silver("SELECT " + ", ".join(
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in
        ["transaction_id", "customer_id", "transaction_date", "amount", "transaction_type", "merchant_name",
         "merchant_category", "channel"]) + " FROM silver"),
    "numeric_profile": _silver(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {mean} AS mean, "
        f"{half_up(f'stddev_samp(CAST({c} AS DOUBLE))', 6)} AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, "
        f"CAST(MAX({c}) AS DOUBLE) AS max FROM silver"
        for c, mean in [("amount", "CAST(SUM(amount) AS DOUBLE) / COUNT(amount)"),
                        ("txn_day", "AVG(CAST(txn_day AS DOUBLE))"),
                        ("txn_hour", "AVG(CAST(txn_hour AS DOUBLE))")])),
    "amount_quartiles": _silver(f"""
SELECT COUNT(amount) AS count, {ratio('SUM(amount)', 'COUNT(amount)', 2)} AS mean,
       {half_up('stddev_samp(CAST(amount AS DOUBLE))', 2)} AS std,
       CAST(MIN(amount) AS DOUBLE) AS min,
       CAST(quantile_disc(amount, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc(amount, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_disc(amount, 0.75) AS DOUBLE) AS p75, CAST(MAX(amount) AS DOUBLE) AS max
FROM silver"""),
    "type_split": _silver("SELECT transaction_type, COUNT(*) AS count FROM silver GROUP BY transaction_type"),
    "segment_mix": with_ctes(CUSTOMERS, body=f"""
SELECT segment, count, {ratio('count * 100', 'SUM(count) OVER ()', 1, unit=1)} AS share_pct
FROM (SELECT segment, COUNT(*) AS count FROM customers_silver GROUP BY segment) t"""),
    "top_merchants": _silver("""
SELECT merchant_name, COUNT(*) AS count FROM silver
WHERE transaction_type = 'DEBIT' AND merchant_name IS NOT NULL
GROUP BY merchant_name ORDER BY count DESC, merchant_name ASC LIMIT 10"""),
    "credits_by_day": _silver("SELECT txn_day, COUNT(*) AS count FROM silver WHERE transaction_type = 'CREDIT' "
                              "GROUP BY txn_day"),
    "quality_gate": _silver("""
SELECT *, (null_transaction_id = 0 AND null_customer_id = 0 AND null_amount = 0 AND null_transaction_date = 0
           AND null_merchant_category = 0) AS passed
FROM (SELECT """ + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_{c}" for c in
                              ["transaction_id", "customer_id", "amount", "transaction_date", "merchant_category"]) + """,
        COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS amount_mean,
        """ + half_up("stddev_samp(CAST(amount AS DOUBLE))", 6) + """ AS amount_stddev,
        CAST(MIN(amount) AS DOUBLE) AS amount_min, CAST(MAX(amount) AS DOUBLE) AS amount_max
      FROM silver) g"""),
    # ---------------- signals
    "salary_earners": _silver("""
SELECT customer_id, COUNT(*) AS active_months, COUNT(*) FILTER (WHERE hit) AS pay_months,
       COUNT(*) FILTER (WHERE hit) * 100 >= COUNT(*) * 50 AS is_salaried
FROM (SELECT customer_id, txn_year, txn_month,
             bool_or(transaction_type = 'CREDIT' AND is_salary_period) AS hit
      FROM silver GROUP BY customer_id, txn_year, txn_month) m
GROUP BY customer_id"""),
    "grant_recipients": _silver("""
SELECT customer_id, COUNT(*) AS active_months, COUNT(*) FILTER (WHERE hit) AS pay_months,
       COUNT(*) FILTER (WHERE hit) * 100 >= COUNT(*) * 50 AS is_grant_recipient
FROM (SELECT customer_id, txn_year, txn_month,
             bool_or(transaction_type = 'CREDIT' AND txn_day = 1) AS hit
      FROM silver GROUP BY customer_id, txn_year, txn_month) m
GROUP BY customer_id"""),
    "category_spikes": _silver(f"""
SELECT merchant_category, txn_year, txn_month, share_units / 10000.0 AS share,
       CASE WHEN t_n > 0 THEN t_sum / (t_n * 10000.0) END AS trailing_share,
       {ratio('share_units * t_n', 't_sum', 4, unit=1)} AS spike_ratio,
       CASE WHEN t_sum > 0 THEN share_units * t_n * 100 >= t_sum * 150 END AS is_spike
FROM (
  SELECT *, SUM(share_units) OVER w AS t_sum, COUNT(share_units) OVER w AS t_n
  FROM (
    SELECT merchant_category, txn_year, txn_month, {MONTH_IDX} AS idx,
           (CAST(cat * 10000 AS HUGEINT) * 20000 + CAST(total * 10000 AS HUGEINT))
             // (CAST(total * 10000 AS HUGEINT) * 2) AS share_units
    FROM (SELECT *, SUM(cat) OVER (PARTITION BY txn_year, txn_month) AS total
          FROM (SELECT txn_year, txn_month, merchant_category, SUM(amount) AS cat FROM silver
                WHERE transaction_type = 'DEBIT' GROUP BY txn_year, txn_month, merchant_category) c) t) s
  WINDOW w AS (PARTITION BY merchant_category ORDER BY idx RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)) r"""),
    "income_bands": with_ctes(CUSTOMERS, body="""
SELECT *, CASE WHEN monthly_income < 5000 THEN 'low' WHEN monthly_income < 18000 THEN 'middle'
               WHEN monthly_income IS NOT NULL THEN 'high' END AS income_band
FROM customers_silver"""),
    "favourite_category": _silver("""
SELECT customer_id, merchant_category AS favourite_category FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY spend DESC, merchant_category ASC NULLS FIRST) AS rk
  FROM (SELECT customer_id, merchant_category, SUM(amount) AS spend FROM silver
        WHERE transaction_type = 'DEBIT' GROUP BY customer_id, merchant_category) c) t
WHERE rk = 1"""),
    "avg_monthly_spend": _silver(f"""
SELECT customer_id, COUNT(*) AS active_months, {ratio('SUM(spend)', 'COUNT(*)', 2)} AS avg_monthly_spend
FROM (SELECT customer_id, txn_year, txn_month, SUM(amount) AS spend FROM silver
      WHERE transaction_type = 'DEBIT' GROUP BY customer_id, txn_year, txn_month) m
GROUP BY customer_id"""),
    "merchant_categories": _silver("""
SELECT s.transaction_id, s.merchant_name, s.merchant_category,
       COALESCE(d.category, s.merchant_category) AS assigned_category
FROM silver s LEFT JOIN (
  SELECT merchant_name, merchant_category AS category FROM (
    SELECT *, row_number() OVER (PARTITION BY merchant_name ORDER BY n DESC, merchant_category ASC) AS rk
    FROM (SELECT merchant_name, merchant_category, COUNT(*) AS n FROM silver
          WHERE transaction_type = 'DEBIT' AND merchant_name IS NOT NULL AND merchant_category IS NOT NULL
          GROUP BY merchant_name, merchant_category) c) t
  WHERE rk = 1) d ON upper(trim(s.merchant_name)) = upper(trim(d.merchant_name))"""),
    # ---------------- storage and streaming
    "bronze_roundtrip": with_ctes(RAW_LEDGER, body="SELECT *, 'lineitem+orders+part+supplier' AS _source_file, "
                                                   "'b1' AS _batch_id FROM raw_ledger"),
    "batch_replay": with_ctes(silver_ctes(), _raw_named("raw_b", True), body="""
SELECT transaction_id, customer_id, CAST(amount + 1 AS DECIMAL(22,4)) AS amount, 'b1' AS _batch_id FROM silver
UNION ALL SELECT transaction_id, customer_id, amount, 'b10' AS _batch_id FROM raw_b"""),
    "as_of_batch": with_ctes(silver_ctes(), _raw_named("raw_b", True), body="""
SELECT transaction_id, customer_id, amount, '007' AS _batch_id FROM silver
UNION ALL SELECT transaction_id, customer_id, amount, 'b10' AS _batch_id FROM raw_b"""),
    "as_of_after_replay": with_ctes(silver_ctes(), _raw_named("raw_b", True), body="""
SELECT transaction_id, customer_id, amount, 'b1' AS _batch_id FROM silver
UNION ALL SELECT transaction_id, customer_id, amount, 'b2' AS _batch_id FROM raw_b"""),
    "pruned_read": _silver("SELECT transaction_id, customer_id, amount, txn_year, txn_month, txn_day FROM silver "
                           "WHERE txn_year * 12 + txn_month BETWEEN 1998 * 12 + 10 AND 1998 * 12 + 12"),
    "csv_roundtrip": with_ctes(RAW_LEDGER, body="""
SELECT transaction_id, CAST(customer_id AS VARCHAR) AS customer_id, amount, transaction_type, merchant_name,
       merchant_category, channel, transaction_date FROM raw_ledger"""),
    "stream_landing": with_ctes(_raw_named("raw_a", False), _raw_named("raw_b", True),
                                body="SELECT * FROM raw_a UNION ALL SELECT * FROM raw_b"),
})


# The merchant catalogue, category and names in order.
CATALOGUE = {
    "grocery": ["Shoprite", "Checkers", "Pick n Pay", "Woolworths Food", "Spar", "Boxer"],
    "fuel": ["Engen", "Shell", "BP", "Sasol", "Total"],
    "telecoms": ["Vodacom Airtime", "MTN Airtime", "Cell C Airtime", "Telkom Mobile", "Vodacom Data", "MTN Data"],
    "streaming": ["Netflix", "DStv", "Showmax", "Spotify"],
    "banking_fees": ["Monthly Account Fee", "ATM Withdrawal Fee", "Transaction Fee"],
    "fast_food": ["KFC", "Nandos", "McDonald's", "Steers", "Chicken Licken"],
    "pharmacy": ["Clicks", "Dis-Chem", "Alpha Pharm"],
    "transport": ["Uber", "Bolt", "Gautrain"],
    "load_shedding": ["Builders Warehouse", "Makro Generator", "Incredible Connection", "Candles & Lamps"],
    "insurance": ["Discovery Life", "Old Mutual", "Sanlam"],
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CATALOGUE_CTE = "catalogue(category, display_name) AS (VALUES " + ", ".join(
    f"({_text(c)}, {_text(n)})" for c, names in CATALOGUE.items() for n in names) + ")"
_NAMES = "[" + ", ".join(_text(n) for names in CATALOGUE.values() for n in names) + "]"

ORACLE["reference_merchant_lookup"] = with_ctes(silver_ctes(), CATALOGUE_CTE, body="""
SELECT COALESCE(d.category, s.merchant_category) AS assigned_category, COUNT(*) AS transactions
FROM silver s LEFT JOIN catalogue d ON upper(trim(s.merchant_name)) = upper(trim(d.display_name))
GROUP BY 1""")
ORACLE["catalogue_lookup"] = with_ctes(silver_ctes(), CATALOGUE_CTE, body=f"""
SELECT s.transaction_id, s.merchant_name, COALESCE(d.category, s.merchant_category) AS assigned_category
FROM (SELECT * REPLACE (COALESCE({_NAMES}[CAST(regexp_extract(merchant_name, '([0-9]+)$', 1) AS BIGINT) % 43 + 1], merchant_name)
                        AS merchant_name) FROM silver) s
LEFT JOIN catalogue d ON upper(trim(s.merchant_name)) = upper(trim(d.display_name))""")

# ---------------------------------------------------------------------------- input with faults

MESSY = UNIQUE_LINES + "," + RAW_LEDGER.replace("FROM lineitem l", "FROM lines l").replace("raw_ledger AS (", "clean_ledger AS (", 1) + """,
keyed AS (SELECT *, CAST(split_part(transaction_id, '-', 1) AS BIGINT) AS k FROM clean_ledger),
faulty AS (
  SELECT transaction_id, CASE WHEN k % 29 <> 2 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
         CASE WHEN k % 29 <> 1 THEN strftime(transaction_date, '%Y-%m-%d %H:%M:%S') END AS transaction_date,
         CASE k % 23 WHEN 1 THEN '100000000000000000' WHEN 2 THEN '0.004' WHEN 3 THEN '0.00001' WHEN 4 THEN '5000000000000000000'
              WHEN 5 THEN 'n/a' WHEN 6 THEN '-3.50' WHEN 7 THEN '' ELSE CAST(amount AS VARCHAR) END AS amount,
         ' ' || lower(transaction_type) AS transaction_type, lower(merchant_name) || '  ' AS merchant_name,
         upper(merchant_category) AS merchant_category, CASE WHEN k % 29 <> 3 THEN channel END AS channel, k
  FROM keyed),
raw_ledger AS (
  SELECT * EXCLUDE (k) FROM faulty
  UNION ALL SELECT * EXCLUDE (k) REPLACE (CAST(NULL AS VARCHAR) AS transaction_date) FROM faulty WHERE k % 3 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE ('?' AS amount) FROM faulty WHERE k % 3 = 1)"""

MESSY_CUSTOMERS = CUSTOMERS.replace("customers_silver AS (", """messy_rows AS (
  SELECT * FROM raw_customers
  UNION ALL SELECT * REPLACE ('AAA' AS segment, CAST(NULL AS DOUBLE) AS monthly_income) FROM raw_customers WHERE customer_id % 2 = 0
  UNION ALL SELECT * REPLACE ('ZZZ' AS segment) FROM raw_customers WHERE customer_id % 2 = 0),
customers_silver AS (""", 1).replace("FROM raw_customers WHERE customer_id IS NOT NULL", "FROM messy_rows WHERE customer_id IS NOT NULL")


def _tied(body: str) -> str:
    silver = silver_ctes().replace("silver AS (", "untied AS (")
    tied = "silver AS (SELECT * REPLACE (CAST(1 AS DECIMAL(22,4)) AS amount, split_part(merchant_category, ' ', 1) AS merchant_category) FROM untied)"
    return with_ctes(silver, tied, monthly_ctes("all"), body=body)


ORACLE.update({
    "messy_dedup": with_ctes(MESSY, DEDUP, body="SELECT * FROM dedup"),
    "messy_clean": with_ctes(MESSY, DEDUP, STANDARD, CALENDAR, SILVER, body="SELECT * FROM silver"),
    "messy_quarantine": with_ctes(MESSY, DEDUP, body=f"SELECT transaction_id, amount, transaction_date, reason FROM ({QUARANTINE}) q"),
    "messy_null_flags": with_ctes(MESSY, body="SELECT transaction_id, concat_ws(',', " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in
        ["transaction_id", "customer_id", "transaction_date", "amount", "transaction_type", "merchant_name",
         "merchant_category", "channel"]) + ") AS null_fields FROM raw_ledger"),
    "messy_customers": with_ctes(MESSY_CUSTOMERS, body="SELECT * FROM customers_silver"),
    "tied_top_category": _tied("SELECT * FROM m_top"),
    "tied_monthly_summary": _tied("SELECT * FROM monthly"),
})

LATE = MESSY.replace("raw_ledger AS (", "first_batch AS (", 1) + """,
late AS (
  SELECT transaction_id, CAST(customer_id AS VARCHAR) AS customer_id,
         strftime(transaction_date - INTERVAL 40 DAY, '%Y-%m-%d %H:%M:%S') AS transaction_date, CAST(amount AS VARCHAR) AS amount,
         transaction_type, merchant_name, merchant_category, channel, k FROM keyed WHERE k % 10 = 0 AND year(transaction_date) = 1997),
raw_ledger AS (
  SELECT * FROM first_batch UNION ALL SELECT * EXCLUDE (k) FROM late
  UNION ALL SELECT * EXCLUDE (k) REPLACE (CAST(NULL AS VARCHAR) AS transaction_date) FROM late
  UNION ALL SELECT * EXCLUDE (k) REPLACE (transaction_id || '-late' AS transaction_id) FROM late WHERE k % 4 = 0)"""
ORACLE.update({
    "silver_upsert": with_ctes(LATE, DEDUP, STANDARD, CALENDAR, SILVER, body="SELECT * FROM silver"),
    "quarantine_upsert": with_ctes(LATE, DEDUP, body=f"SELECT transaction_id, amount, transaction_date, reason FROM ({QUARANTINE}) q"),
})

ORACLE["stream_dedup"] = with_ctes(RAW_EVENTS, body="""
SELECT DISTINCT transaction_id, customer_id, transaction_date, amount,
       CASE WHEN transaction_date < TIMESTAMP '2024-01-16' AND CAST(transaction_id AS BIGINT) % 50 = 7 THEN 'late' ELSE 'accepted' END AS outcome
FROM raw_ledger""")

ORACLE.update({
    "profile_from_months": ORACLE["customer_profile"],
    "yearly_distincts": _silver("""
SELECT customer_id, txn_year, count(DISTINCT merchant_name) AS unique_merchants, count(DISTINCT merchant_category) AS unique_categories
FROM silver WHERE transaction_type = 'DEBIT' GROUP BY customer_id, txn_year"""),
})

_CODES = "[" + ", ".join("'" + code + "'" for _category, _name, code in REFERENCE_MERCHANTS) + "]"
ORACLE.update({
    "recurring_credits": _silver("""
SELECT customer_id, amount_class, gaps + 1 AS days, gaps, mode AS interval,
       CASE WHEN mode BETWEEN 6 AND 8 THEN 'weekly' WHEN mode BETWEEN 12 AND 16 THEN 'fortnightly' WHEN mode BETWEEN 26 AND 33 THEN 'monthly'
            ELSE 'other' END AS rhythm,
       near / gaps AS regularity, gaps >= 3 AND near * 100 >= gaps * 75 AS is_recurring
FROM (
  SELECT customer_id, amount_class, sum(n)::BIGINT AS gaps, any_value(mode) AS mode,
         coalesce(sum(n) FILTER (abs(gap - mode) <= 3), 0)::BIGINT AS near
  FROM (
    SELECT *, first(gap) OVER (PARTITION BY customer_id, amount_class ORDER BY n DESC, gap) AS mode FROM (
      SELECT customer_id, amount_class, gap, count(*) AS n FROM (
        SELECT *, date_diff('day', lag(day) OVER (PARTITION BY customer_id, amount_class ORDER BY day), day)::INTEGER AS gap FROM (
          SELECT DISTINCT customer_id, CAST(transaction_date AS DATE) AS day,
                 (len(floor(amount)::DECIMAL(22,0)::VARCHAR) * 10 + left(floor(amount)::DECIMAL(22,0)::VARCHAR, 1)::INTEGER)::INTEGER AS amount_class
          FROM silver WHERE transaction_type = 'CREDIT'))
      WHERE gap IS NOT NULL GROUP BY ALL))
  GROUP BY customer_id, amount_class)"""),
    "quantile_sketches": _silver("""
SELECT txn_year, p, count(*) AS n, TRUE AS within FROM silver, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) q(p)
WHERE amount IS NOT NULL GROUP BY txn_year, p"""),
    "longest_code_lookup": with_ctes(silver_ctes(), f"""
coded AS (SELECT code, min(category) AS category FROM (SELECT unnest({_CODES}) AS code, unnest([{', '.join("'" + c + "'" for c, _n, _k in REFERENCE_MERCHANTS)}]) AS category) GROUP BY code),
written AS (
  SELECT * REPLACE (coalesce(CASE WHEN num % 44 = 7 THEN {_CODES}[num % 43 + 1] || 'X STORE'
      ELSE {_CODES}[num % 43 + 1] || '  ' || lpad((num % 977)::VARCHAR, 4, '0') || ' SANDTON' END, merchant_name) AS merchant_name)
  FROM (SELECT *, CAST(regexp_extract(merchant_name, '([0-9]+)$', 1) AS BIGINT) AS num FROM silver))""", body="""
SELECT transaction_id, merchant_name, code AS matched_code, coalesce(category, merchant_category) AS assigned_category FROM (
  SELECT w.*, c.code, c.category, row_number() OVER (PARTITION BY transaction_id ORDER BY length(c.code) DESC) AS rn
  FROM written w LEFT JOIN coded c ON w.merchant_name = c.code OR starts_with(w.merchant_name, c.code || ' ')) WHERE rn = 1"""),
})

_KEY = "CAST(split_part(transaction_id, '-', 1) AS BIGINT)"
ORACLE.update({
    "contract_evolution": with_ctes(RAW_LEDGER, body=f"""
SELECT transaction_id, customer_id, CASE WHEN {_KEY} % 2 = 0 THEN CAST(CAST(amount AS DECIMAL(18,2)) AS DECIMAL(22,4)) ELSE amount END AS amount,
       CASE WHEN {_KEY} % 2 = 1 THEN channel END AS channel, CASE WHEN {_KEY} % 2 = 1 THEN {_KEY} % 7 END AS store,
       CASE WHEN {_KEY} % 2 = 0 THEN 'b1' ELSE 'b2' END AS _batch_id
FROM raw_ledger"""),
    "rescued_fields": with_ctes(RAW_LEDGER, body=f"""
SELECT transaction_id, CASE WHEN {_KEY} % 5 <> 0 THEN amount END AS amount, CAST(NULL AS VARCHAR) AS channel,
       CASE WHEN {_KEY} % 5 = 0 THEN 'n/a' END AS amount_text, CASE WHEN {_KEY} % 3 = 0 THEN CAST({_KEY} % 7 AS VARCHAR) END AS store
FROM raw_ledger"""),
    "clustered_read": _silver("""
SELECT 'customer' AS asked, transaction_id, customer_id, amount FROM silver WHERE customer_id IN (1, 100)
UNION ALL SELECT 'day', transaction_id, customer_id, amount FROM silver
WHERE CAST(transaction_date AS DATE) IN (DATE '1995-03-15', DATE '1997-07-01')"""),
})

ORACLE.update({
    "landing_counts": """
SELECT 'b1' AS _batch_id, count(*) AS observed, count(*) AS counted FROM lineitem
UNION ALL SELECT 'b2', count(*), count(*) FROM events UNION ALL SELECT 'b3', 0, 0""",
    "layer_report": _monthly("""
SELECT 'silver_transactions' AS layer, count(*) AS rows, 12 AS contract_columns FROM silver
UNION ALL SELECT 'silver_customers', count(*), 2 FROM customers_silver
UNION ALL SELECT 'gold_monthly', count(*), 14 FROM monthly""").replace("WITH ", "WITH " + CUSTOMERS.strip() + ",", 1),
})
