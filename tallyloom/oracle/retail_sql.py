"""Statements for retail profiles, associations and the ETL."""

from __future__ import annotations

from itertools import combinations

from .. import catalog
from ..functions import fixed_values as fv
from .sql import (
    FACTS, LINES, WORK, count_if, describe, half_even, money, pct, quantiles, ratio, share, strip, with_ctes,
)

ROW_COLUMNS = (
    "invoice, stock_code, description, quantity, invoice_datetime, price, customer_id_raw, country, "
    "line_amount"
)
FACT_COLUMNS = (
    "invoice_no, stock_code, description, quantity, unit_price, total_amount, invoice_datetime, "
    "customer_id, country"
)
AMOUNT = "CAST(line_amount AS DECIMAL(24,4))"
LEVELS = f"""levels AS (
  SELECT invoice, COUNT(*) AS rows, {count_if("is_customer_missing")} AS missing,
    SUM({AMOUNT}) AS amount, bool_or(upper(stock_code) = 'DOT') AS has_dot,
    bool_or(is_damage) AS has_damage,
    bool_or(is_customer_missing AND quantity > 0 AND price > 0) AS has_positive_missing,
    CASE WHEN {count_if("is_customer_missing")} = 0 THEN 'all_present'
      WHEN {count_if("is_customer_missing")} = COUNT(*) THEN 'all_missing'
      ELSE 'mixed_missing_present' END AS customer_id_pattern
  FROM work GROUP BY invoice)"""


def work(body: str, *more: str) -> str:
    return with_ctes(WORK, *more) + body


def facts(body: str, *more: str) -> str:
    return with_ctes(FACTS, *more) + body


def null_rows(source: str, columns: list[str], table: str | None = None) -> str:
    extra = f"'{table}' AS \"table\", " if table else ""
    parts = []
    for c in columns:
        n = count_if(f'"{c}" IS NULL')
        parts.append(
            f"SELECT {extra}'{c}' AS \"column\", {n} AS missing_rows, {pct(n, 'COUNT(*)')} AS missing_pct FROM {source}"
        )
    return " UNION ALL ".join(parts)


def flag_pairs(source: str, flags: dict[str, str], kind: str, unit: str) -> str:
    parts = []
    for a, c in combinations(flags, 2):
        x, y = count_if(flags[a]), count_if(flags[c])
        z = count_if(f"({flags[a]}) AND ({flags[c]})")
        parts.append(f"""SELECT '{a}' AS left_{kind}, '{c}' AS right_{kind}, {x} AS left_{unit},
          {y} AS right_{unit}, {z} AS both_{unit}, {share(z, "COUNT(*)")} AS support_pct,
          {share(z, x)} AS left_to_right_conf_pct, {share(z, y)} AS right_to_left_conf_pct,
          {ratio(f"CAST({z} AS DOUBLE) * CAST(COUNT(*) AS DOUBLE)", f"CAST({x} AS DOUBLE) * CAST({y} AS DOUBLE)")} AS lift,
          ({ratio(z, x)} + {ratio(z, y)}) / 2::DOUBLE * 100::DOUBLE AS kulczynski_pct
          FROM {source} HAVING {z} > 0""")
    return " UNION ALL ".join(parts)


DESCRIPTIONS = f"""descriptions AS (
  SELECT stock_code, {strip("description")} AS description, COUNT(*) AS n
  FROM work WHERE is_gross_sale AND description IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, {strip("description")}) = 1)"""

PAIRS = f"""{DESCRIPTIONS}, baskets AS (
  SELECT DISTINCT invoice, stock_code FROM work WHERE is_gross_sale
), sizes AS (SELECT invoice, COUNT(*) AS size FROM baskets GROUP BY 1
), totals AS (SELECT COUNT(*) AS n FROM sizes
), items AS (SELECT stock_code, COUNT(*) AS n FROM baskets GROUP BY 1 HAVING COUNT(*) >= {catalog.PAIR_MIN_ITEM}
), pairs AS (
  SELECT a.stock_code AS l, c.stock_code AS r, COUNT(*) AS n,
    {count_if(f"size >= {catalog.PAIR_LARGE}")} AS large
  FROM baskets a JOIN baskets c ON a.invoice = c.invoice AND a.stock_code < c.stock_code
    JOIN sizes s ON a.invoice = s.invoice
  WHERE a.stock_code IN (SELECT stock_code FROM items) AND c.stock_code IN (SELECT stock_code FROM items)
  GROUP BY 1, 2 HAVING COUNT(*) >= {catalog.PAIR_MIN_PAIR}
), rules AS (
  SELECT p.l AS left_code, COALESCE(dl.description, '') AS left_description, p.r AS right_code,
    COALESCE(dr.description, '') AS right_description, p.n AS pair_invoices,
    {share("p.n", "t.n")} AS support_pct, {share("p.n", "il.n")} AS left_to_right_conf_pct,
    {share("p.n", "ir.n")} AS right_to_left_conf_pct,
    {ratio("p.n", "t.n")} / ({ratio("il.n", "t.n")} * {ratio("ir.n", "t.n")}) AS lift,
    ({ratio("p.n", "il.n")} + {ratio("p.n", "ir.n")}) / 2::DOUBLE * 100::DOUBLE AS kulczynski_pct,
    least({ratio("p.n", "il.n")}, {ratio("p.n", "ir.n")}) * 100::DOUBLE AS all_confidence_pct,
    {ratio("abs(il.n - ir.n)", "(il.n + ir.n - p.n)")} AS imbalance_ratio,
    {pct("p.large", "p.n")} AS large_basket_pair_pct
  FROM pairs p JOIN items il ON p.l = il.stock_code JOIN items ir ON p.r = ir.stock_code
    LEFT JOIN descriptions dl ON p.l = dl.stock_code LEFT JOIN descriptions dr ON p.r = dr.stock_code,
    totals t)"""

STATUS = """CASE WHEN matched_original_invoice IS NOT NULL THEN 'matched_exact_prior_sale'
  WHEN eligible THEN 'unmatched_no_exact_prior_sale'
  WHEN quantity >= 0 THEN 'not_eligible_non_negative_c_invoice'
  WHEN customer_id IS NULL THEN 'not_eligible_missing_customer_id'
  WHEN stock_category <> 'product_like' THEN 'not_eligible_non_product_stock_code'
  WHEN unit_price <= 0 THEN 'not_eligible_non_positive_price' ELSE 'not_eligible_other' END"""


def _measures(source: str = "work") -> str:
    return f"""SELECT 'gross_product_sales' AS measure, {money(where="is_gross_sale")} AS amount FROM {source}
      UNION ALL SELECT 'net_product_sales', {money(where="is_net_line")} FROM {source}
      UNION ALL SELECT 'financial_total', {money()} FROM {source}"""


def _buckets() -> str:
    masks = {
        "normal positive line: Quantity > 0 and Price > 0": "quantity > 0 AND price > 0",
        "damage / inventory loss: Price = 0 and Quantity < 0": "is_damage",
        "zero-price positive quantity": "price = 0 AND quantity > 0",
        "cancellation / return: C invoice": "is_cancellation",
        "bad debt: A invoice": "is_bad_debt",
    }
    return " UNION ALL ".join(
        f"""SELECT '{k}' AS bucket, {count_if(m)} AS rows, {pct(count_if(m), "COUNT(*)")} AS pct_of_missing_rows,
        {money(where=m)} AS amount_sum FROM work WHERE is_customer_missing"""
        for k, m in masks.items()
    )


def _amount_bins() -> str:
    edges = [*fv.AMOUNT_BINS, None]
    parts = []
    for label, lo, hi in zip(fv.AMOUNT_LABELS, edges[:-1], edges[1:]):
        cond = f"line_amount > {lo}" + ("" if hi is None else f" AND line_amount <= {hi}")
        parts.append(
            f"SELECT '{label}' AS amount_bucket, {count_if(cond)} AS rows, {money(where=cond)} AS amount_sum, "
            f"{pct(count_if(cond), 'COUNT(*)')} AS row_pct FROM anon"
        )
    return " UNION ALL ".join(parts)


def _string_profile() -> str:
    parts = []
    for c in ["Invoice", "StockCode", "Description", "Customer ID", "Country"]:
        parts.append(f"""SELECT '{c}' AS "column", (SELECT COUNT(DISTINCT "{c}") FROM lines) AS unique_values,
          string_agg(shown || ': ' || n, '; ' ORDER BY n DESC, shown) AS top_10_values
          FROM (SELECT COALESCE("{c}", '<missing>') AS shown, COUNT(*) AS n FROM lines GROUP BY 1
            ORDER BY n DESC, shown LIMIT 10)""")
    return with_ctes(LINES) + " UNION ALL ".join(parts)


def _violations() -> str:
    rules = [
        ("facts", "sale sells at least one piece", "quantity > 0"),
        ("facts", "sale has a price above zero", "unit_price > 0"),
        ("facts", "sale brings in money", "total_amount > 0"),
        ("facts", "sale is dated", "invoice_datetime IS NOT NULL"),
        ("features", "feature row names its customer", "customer_id IS NOT NULL"),
        ("features", "last purchase is not in the future", "recency_days >= 0"),
        ("features", "customer bought once or more", "frequency >= 1"),
        ("features", "customer spent no less than nothing", "monetary >= 0"),
        ("log", "return comes from a cancellation", "invoice_no LIKE 'C%'"),
        (
            "log",
            "return undoes a sale, not a cancellation",
            "matched_original_invoice IS NULL OR matched_original_invoice NOT LIKE 'C%'",
        ),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, {count_if(f'({cond}) IS NOT TRUE')} AS violations FROM {t}"
        for t, name, cond in rules
    )


def _summary() -> str:
    ok = "eligible AND matched_original_invoice IS NOT NULL"
    return f"""SELECT 'input_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM work
      UNION ALL SELECT 'sales_facts_rows', CAST(COUNT(*) AS DOUBLE) FROM facts
      UNION ALL SELECT 'customer_features_rows', CAST(COUNT(*) AS DOUBLE) FROM features
      UNION ALL SELECT 'returns_log_rows', CAST(COUNT(*) AS DOUBLE) FROM log
      UNION ALL SELECT 'eligible_return_rows', CAST({count_if("eligible")} AS DOUBLE) FROM log
      UNION ALL SELECT 'matched_eligible_returns', CAST({count_if(ok)} AS DOUBLE) FROM log
      UNION ALL SELECT 'eligible_return_match_rate_pct',
        COALESCE({pct(count_if(ok), count_if("eligible"))}, 0::DOUBLE) FROM log"""


def statements() -> dict[str, str]:
    lines_nulls = null_rows("lines", fv.RETAIL_COLUMNS)
    kinds = {"Quantity": "bigint", "InvoiceDate": "timestamp_ntz", "Price": "double"}
    dtype = "CASE \"column\" " + " ".join(
        f"WHEN '{c}' THEN '{k}'" for c, k in kinds.items()
    ) + " ELSE 'string' END"
    both_medians = quantiles("work", "line_amount", {"med": 0.5}, "is_customer_missing")
    basket = {"median_unique_products": 0.5, "p75_unique_products": 0.75, "p90_unique_products": 0.9,
              "p95_unique_products": 0.95, "p99_unique_products": 0.99}
    quote = ", ".join(f'"{c}"' for c in fv.RETAIL_COLUMNS)
    item_groups = f"""SELECT stock_code, description, COUNT(*) AS rows, {money()} AS amount_sum,
      CAST(SUM(quantity) AS BIGINT) AS quantity_sum"""
    flags = {
        "CustomerID_missing": "is_customer_missing",
        "Description_missing": "is_description_missing",
        "Damage_inventory_loss": "is_damage",
        "Cancellation_C_invoice": "is_cancellation",
        "Bad_debt_A_invoice": "is_bad_debt",
        "Non_product_stockcode": "NOT is_product_like",
        "Zero_price": "price = 0",
        "Negative_quantity": "quantity < 0",
        "Positive_product_sale": "is_gross_sale",
    }
    patterns = ["all_missing", "any_dot", "any_damage", "any_non_product", "any_bad_debt", "large_basket_50plus"]
    pattern_flags = {p: p for p in patterns} | {
        k: f"country = '{v}'"
        for k, v in {"UK": "United Kingdom", "Germany": "Germany", "France": "France", "EIRE": "EIRE"}.items()
    }
    return {
        "retail_source": with_ctes(LINES) + f"SELECT {quote} FROM lines",
        "retail_work": work("SELECT * FROM work"),
        "stock_code_class": work(
            "SELECT stock_code, stock_category, COUNT(*) AS rows FROM work GROUP BY 1, 2"
        ),
        "customer_id_norm": work(
            """SELECT customer_id_raw, COALESCE(
              CAST(CAST(TRY_CAST(trim(customer_id_raw) AS DOUBLE) AS BIGINT) AS VARCHAR),
              trim(customer_id_raw)) AS customer_id, COUNT(*) AS rows FROM work GROUP BY 1, 2"""
        ),
        "quantity_extremes": work(
            f"""SELECT {ROW_COLUMNS} FROM work WHERE quantity = (SELECT max(quantity) FROM work)
            OR quantity = (SELECT min(quantity) FROM work)"""
        ),
        "extreme_gap_minutes": work(
            """SELECT COUNT(*) AS rows, CASE WHEN COUNT(*) = 2 THEN
              CAST(epoch_us(max(invoice_datetime)) - epoch_us(min(invoice_datetime)) AS DOUBLE) / 60e6 END
              AS minutes_between
            FROM work WHERE quantity = (SELECT max(quantity) FROM work)
              OR quantity = (SELECT min(quantity) FROM work)"""
        ),
        "negative_price_rows": work(f"SELECT {ROW_COLUMNS} FROM work WHERE price < 0"),
        "bad_debt_rows": work(f"SELECT {ROW_COLUMNS} FROM work WHERE is_bad_debt"),
        "price_issue_counts": work(
            f"""SELECT 'Price < 0' AS issue, {count_if("price < 0")} AS rows FROM work UNION ALL
            SELECT 'Price = 0', {count_if("price = 0")} FROM work UNION ALL
            SELECT 'Damage / inventory loss: Price = 0 and Quantity < 0', {count_if("is_damage")} FROM work"""
        ),
        "missing_description_audit": work(
            f"""SELECT COUNT(*) AS rows, {count_if("price = 0")} AS price_zero_rows,
            {count_if("is_customer_missing")} AS customer_missing_rows,
            {count_if("quantity < 0")} AS negative_quantity_rows,
            {pct(count_if("quantity < 0"), "COUNT(*)")} AS negative_quantity_pct
            FROM work WHERE is_description_missing"""
        ),
        "high_price_items": work(
            f"""SELECT stock_code, description, COUNT(*) AS rows,
            {half_even(ratio(money("price"), "COUNT(*)"))} AS avg_price
            FROM anon WHERE description IS NOT NULL AND price > (SELECT q FROM ({quantiles("anon", "price", {"q": 0.99})}))
            GROUP BY 1, 2 ORDER BY rows DESC, stock_code, description LIMIT 15"""
        ),
        "null_report": with_ctes(LINES)
        + f'SELECT "column", {dtype} AS dtype, missing_rows, missing_pct FROM ({lines_nulls})',
        "output_null_report": facts(
            " UNION ALL ".join(
                [
                    null_rows("facts", FACT_COLUMNS.split(", "), "sales_facts"),
                    null_rows(
                        "features",
                        ["customer_id", "recency_days", "frequency", "monetary", "first_purchase_date",
                         "last_purchase_date", "unique_products", "country", "is_one_time_buyer"],
                        "customer_features",
                    ),
                    null_rows("log", [*FACT_COLUMNS.split(", "), "matched_original_invoice"], "returns_log"),
                ]
            )
        ),
        "numeric_profile": work(describe("work", ["quantity", "price"], [0.25, 0.5, 0.75])),
        "line_amount_profile": work(
            describe("anon", ["line_amount"], [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])
        ),
        "string_profile": _string_profile(),
        "invoice_prefix_summary": work(
            f"""SELECT invoice_prefix, COUNT(*) AS rows, COUNT(DISTINCT invoice) AS invoices,
            CAST(SUM(quantity) AS BIGINT) AS quantity_sum, {money()} AS amount_sum,
            {count_if("quantity < 0")} AS negative_quantity_rows, {count_if("price < 0")} AS negative_price_rows,
            {count_if("price = 0")} AS zero_price_rows, {count_if("is_customer_missing")} AS missing_customer_rows
            FROM work GROUP BY 1"""
        ),
        "stock_category_summary": work(
            f"""SELECT stock_category, COUNT(*) AS rows, COUNT(DISTINCT stock_code) AS distinct_codes,
            {money()} AS amount_sum, {pct("COUNT(*)", "(SELECT COUNT(*) FROM work)", 3)} AS row_pct,
            {pct(f"SUM({AMOUNT})", f"(SELECT SUM({AMOUNT}) FROM work)", 3)} AS amount_pct
            FROM work GROUP BY 1"""
        ),
        "non_product_codes": work(
            """SELECT stock_category AS category,
            (SELECT COUNT(DISTINCT stock_code) FROM work x WHERE x.stock_category = w.stock_category) AS distinct_codes,
            stock_code, COUNT(*) AS rows FROM work w WHERE NOT is_product_like GROUP BY stock_category, stock_code"""
        ),
        "customer_missing_summary": work(
            f"""SELECT CASE WHEN is_customer_missing THEN 'Customer ID missing' ELSE 'Customer ID present' END AS segment,
            COUNT(*) AS rows, {pct("COUNT(*)", "(SELECT COUNT(*) FROM work)")} AS row_pct, {money()} AS amount_sum,
            {pct(f"SUM({AMOUNT})", f"(SELECT SUM({AMOUNT}) FROM work)")} AS amount_pct_of_net,
            {half_even(ratio(f"SUM({AMOUNT})", "COUNT(*)"))} AS avg_line_amount,
            {half_even("any_value(med)")} AS median_line_amount,
            {pct(count_if("country = 'United Kingdom'"), "COUNT(*)")} AS uk_pct,
            {count_if("quantity > 0 AND price > 0")} AS positive_qty_price_rows,
            {count_if("is_damage")} AS damage_loss_rows
            FROM work JOIN ({both_medians}) USING (is_customer_missing) GROUP BY is_customer_missing"""
        ),
        "customer_missing_buckets": work(_buckets()),
        "invoice_completeness": work(
            f"""SELECT customer_id_pattern, COUNT(*) AS invoices, CAST(SUM(rows) AS BIGINT) AS rows,
            CAST(SUM(amount) AS DOUBLE) AS amount_sum, {count_if("has_dot")} AS dotcom_postage_invoices,
            {count_if("has_damage")} AS damage_loss_invoices,
            {pct("COUNT(*)", "(SELECT COUNT(*) FROM levels)")} AS invoice_pct,
            {pct("SUM(rows)", "(SELECT COUNT(*) FROM work)")} AS row_pct
            FROM levels GROUP BY 1""",
            LEVELS,
        ),
        "anonymous_invoice_patterns": work(
            f"""SELECT customer_id_pattern, COUNT(*) AS invoices,
            {pct("COUNT(*)", "(SELECT COUNT(*) FROM levels WHERE has_positive_missing)")} AS pct
            FROM levels WHERE has_positive_missing GROUP BY 1""",
            LEVELS,
        ),
        "mixed_invoices": work(
            """SELECT invoice, rows AS total_rows, rows - missing AS present_customer, missing AS missing_customer
            FROM levels WHERE customer_id_pattern = 'mixed_missing_present' AND has_positive_missing""",
            LEVELS,
        ),
        "dot_share_of_missing_invoices": work(
            f"""SELECT COUNT(*) AS invoices, {count_if("has_dot")} AS dot_invoices,
            {pct(count_if("has_dot"), "COUNT(*)")} AS dot_pct
            FROM levels WHERE customer_id_pattern = 'all_missing'""",
            LEVELS,
        ),
        "missing_customer_overlap": work(
            f"""SELECT {count_if("is_damage AND is_customer_missing")} AS damage_missing_rows,
            {count_if("is_damage")} AS damage_rows,
            {pct(count_if("is_damage AND is_customer_missing"), count_if("is_customer_missing"))} AS damage_pct_of_missing,
            {count_if("is_description_missing AND is_customer_missing")} AS no_description_missing_rows,
            {count_if("is_description_missing")} AS no_description_rows FROM work"""
        ),
        "sales_measures": work(_measures()),
        "sales_metric_table": work(
            _measures()
            + f""" UNION ALL SELECT 'sales_facts_total_amount', {money()} FROM work WHERE is_gross_sale
            UNION ALL SELECT 'sales_facts_quantity_sum', CAST(SUM(quantity) AS DOUBLE) FROM work WHERE is_gross_sale"""
        ),
        "basket_sizes": work(
            f"""SELECT q.*, COUNT(*) AS gross_product_invoices, max(size) AS max_unique_products,
            {count_if("size >= 50")} AS invoices_with_50_plus_products,
            {pct(count_if("size >= 50"), "COUNT(*)")} AS pct_invoices_with_50_plus_products
            FROM sizes, ({quantiles("sizes", "size", basket)}) q GROUP BY ALL""",
            """sizes AS (SELECT invoice, COUNT(DISTINCT stock_code) AS size FROM work
              WHERE is_gross_sale GROUP BY 1)""",
        ),
        "item_description": work("SELECT stock_code, description FROM descriptions", DESCRIPTIONS),
        "all_missing_description_codes": work(
            f"""SELECT stock_code, COUNT(*) AS rows, {count_if("is_description_missing")} AS missing_description_rows,
            bool_and(is_description_missing) AS all_description_missing, min(stock_category) AS stock_code_category
            FROM work GROUP BY 1 HAVING bool_and(is_description_missing)"""
        ),
        "damage_descriptions": work(
            """SELECT upper(COALESCE(description, '<missing>')) AS description, COUNT(*) AS rows
            FROM work WHERE is_damage GROUP BY 1 ORDER BY rows DESC, 1 LIMIT 20"""
        ),
        "top_anonymous_items": work(
            f"""{item_groups} FROM work WHERE is_customer_missing GROUP BY 1, 2
            ORDER BY rows DESC, stock_code, description NULLS FIRST LIMIT 15"""
        ),
        "top_positive_anonymous_items": work(
            f"""{item_groups}, COUNT(DISTINCT invoice) AS invoices,
            {half_even(ratio(money("price"), "COUNT(*)"))} AS avg_price,
            {pct("COUNT(*)", "(SELECT COUNT(*) FROM anon)")} AS row_pct,
            {pct(f"SUM({AMOUNT})", f"(SELECT SUM({AMOUNT}) FROM anon)")} AS amount_pct
            FROM anon GROUP BY 1, 2 ORDER BY rows DESC, stock_code, description NULLS FIRST LIMIT 20"""
        ),
        "duplicate_check": work(
            f"""SELECT (SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lines))
              AS exact_duplicate_rows,
            {pct("((SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lines)))", "COUNT(*)")}
              AS exact_duplicate_pct,
            {count_if("is_description_missing")} AS description_missing_rows,
            {count_if("is_description_missing AND is_customer_missing")} AS description_missing_customer_missing_rows,
            {count_if("is_description_missing AND is_damage")} AS description_missing_damage_loss_rows,
            min(invoice_datetime) AS min_invoice_date, max(invoice_datetime) AS max_invoice_date FROM work"""
        ),
        "duplicate_rows": with_ctes(LINES)
        + f"SELECT {quote} FROM lines QUALIFY COUNT(*) OVER (PARTITION BY {quote}) > 1",
        "description_conflicts": work(
            f"""SELECT stock_code, COUNT(DISTINCT upper({strip("description")})) AS distinct_descriptions,
            COUNT(*) AS rows FROM work WHERE description IS NOT NULL GROUP BY 1
            HAVING COUNT(DISTINCT upper({strip("description")})) > 1"""
        ),
        "code_descriptions": work(
            f"""SELECT upper({strip("description")}) AS description, COUNT(*) AS rows, {money()} AS amount_sum
            FROM work WHERE stock_code = '20022' GROUP BY 1"""
        ),
        "anonymous_by_country": work(
            f"""SELECT country, COUNT(*) AS rows, {money()} AS amount_sum, COUNT(DISTINCT invoice) AS invoices,
            {pct("COUNT(*)", "(SELECT COUNT(*) FROM anon)")} AS row_pct,
            {pct(f"SUM({AMOUNT})", f"(SELECT SUM({AMOUNT}) FROM anon)")} AS amount_pct FROM anon GROUP BY 1"""
        ),
        "rows_per_invoice_hist": work(
            """SELECT rows_per_invoice, COUNT(*) AS invoice_count
            FROM (SELECT COUNT(*) AS rows_per_invoice FROM anon GROUP BY invoice) GROUP BY 1"""
        ),
        "rows_per_invoice_profile": work(
            describe("sizes", ["rows_per_invoice"], [0.25, 0.5, 0.75]),
            "sizes AS (SELECT COUNT(*) AS rows_per_invoice FROM anon GROUP BY invoice)",
        ),
        "anonymous_by_month": work(
            f"""SELECT year(invoice_datetime) AS year, quarter(invoice_datetime) AS quarter,
            month(invoice_datetime) AS month, COUNT(*) AS rows, {money()} AS amount_sum,
            COUNT(DISTINCT invoice) AS invoices, {pct("COUNT(*)", "(SELECT COUNT(*) FROM anon)")} AS row_pct
            FROM anon GROUP BY 1, 2, 3"""
        ),
        "month_totals": work(
            f"""SELECT strftime(invoice_datetime, '%Y-%m') AS month, COUNT(*) AS rows, {money()} AS amount_sum
            FROM work GROUP BY 1 ORDER BY 1 DESC LIMIT 6"""
        ),
        "amount_buckets": work(_amount_bins()),
        "sketched_profile": work(
            f"""SELECT measure, CAST(p AS DOUBLE) AS p, n, true AS within_error
            FROM (SELECT 'quantity' AS measure, COUNT(quantity) AS n FROM work UNION ALL SELECT 'price', COUNT(price) FROM work),
            (SELECT unnest({catalog.SKETCHED_AT}) AS p)"""
        ),
        "date_range": work(
            """SELECT min(invoice_datetime) AS min_invoice_date, max(invoice_datetime) AS max_invoice_date,
            strftime(max(invoice_datetime), '%Y-%m') AS last_month,
            day(max(invoice_datetime)) AS last_month_last_day_in_data FROM work"""
        ),
        "item_pair_rules": work("SELECT * FROM rules", PAIRS),
        "item_pairs_top_support": work(
            "SELECT * FROM rules ORDER BY pair_invoices DESC, lift DESC, left_code, right_code LIMIT 12", PAIRS
        ),
        "item_pairs_balanced": work(
            """SELECT * FROM rules WHERE all_confidence_pct >= 5 AND imbalance_ratio <= 0.5
            ORDER BY lift DESC, pair_invoices DESC, left_code, right_code LIMIT 12""",
            PAIRS,
        ),
        "flag_rules": work(flag_pairs("work", flags, "flag", "rows")),
        "invoice_pattern_rules": work(
            flag_pairs("shapes", pattern_flags, "pattern", "invoices"),
            """main AS (SELECT invoice, country, COUNT(*) AS n FROM work WHERE country IS NOT NULL GROUP BY 1, 2
              QUALIFY row_number() OVER (PARTITION BY invoice ORDER BY n DESC, country) = 1),
            shapes AS (SELECT w.invoice, any_value(m.country) AS country, bool_and(is_customer_missing) AS all_missing,
              bool_or(upper(stock_code) = 'DOT') AS any_dot, bool_or(is_damage) AS any_damage,
              bool_or(NOT is_product_like) AS any_non_product, bool_or(is_bad_debt) AS any_bad_debt,
              COUNT(DISTINCT stock_code) FILTER (WHERE is_gross_sale) >= 50 AS large_basket_50plus
              FROM work w LEFT JOIN main m ON w.invoice = m.invoice GROUP BY w.invoice)""",
        ),
        "retail_csv": with_ctes(LINES) + f"SELECT {quote} FROM lines",
        "published_sales_facts": facts("SELECT * FROM facts"),
        "published_customer_features": facts("SELECT * FROM features"),
        "published_returns_log": facts(f"SELECT {FACT_COLUMNS}, matched_original_invoice FROM log"),
        "sales_facts": facts("SELECT * FROM facts"),
        "customer_features": facts("SELECT * FROM features"),
        "primary_country": facts("SELECT * FROM main_country"),
        "eligible_returns": facts(f"SELECT {FACT_COLUMNS} FROM cancels WHERE eligible"),
        "return_match": facts(f"SELECT {FACT_COLUMNS}, matched_original_invoice FROM log WHERE eligible"),
        "returns_log": facts(f"SELECT {FACT_COLUMNS}, matched_original_invoice FROM log"),
        "return_status": facts(f"SELECT {STATUS} AS status, COUNT(*) AS rows FROM log GROUP BY 1"),
        "unmatched_samples": facts(
            f"""SELECT {FACT_COLUMNS} FROM log WHERE eligible AND matched_original_invoice IS NULL
            ORDER BY invoice_datetime, invoice_no, stock_code, description NULLS FIRST, quantity, unit_price,
              total_amount, customer_id, country LIMIT 10"""
        ),
        "output_violations": facts(_violations()),
        "published_checks": facts(_violations()),
        "etl_summary": facts(_summary()),
        "feature_profile": facts(
            describe("features", ["recency_days", "frequency", "monetary", "unique_products"], [0.25, 0.5, 0.75])
        ),
    }
