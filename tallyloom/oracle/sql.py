"""Pieces of DuckDB SQL shared by the statements."""

from __future__ import annotations

from ..sources import bindings as b


def quoted(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def half_even(x: str, digits: int = 2) -> str:
    return f"(round_even(({x}) * {10**digits}::DOUBLE, 0) / {10**digits}::DOUBLE)"


def half_up(x: str, digits: int = 2) -> str:
    return f"(floor(({x}) * {10**digits}::DOUBLE + 0.5::DOUBLE) / {10**digits}::DOUBLE)"


def ratio(a: str, c: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({c} AS DOUBLE), 0::DOUBLE))"


def share(a: str, c: str) -> str:
    return f"({ratio(a, c)} * 100::DOUBLE)"


def pct(a: str, c: str, digits: int = 2) -> str:
    return half_even(share(a, c), digits)


def money(x: str = "line_amount", where: str | None = None) -> str:
    cond = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(COALESCE(SUM(CAST({x} AS DECIMAL(24,4))){cond}, 0) AS DOUBLE)"


def count_if(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


def strip(x: str) -> str:
    """Without white space at either end; trim() alone takes off blanks only."""
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LINES = f"""src AS (
  SELECT l.*, o.o_orderkey, o.o_custkey, o.o_orderdate, p.p_type, n.n_nationkey, n.n_name,
    l_returnflag = 'R' AS cancelled,
    l_returnflag <> 'R' AND o_orderkey % 1000 = 7 AS bad_debt,
    l_returnflag <> 'R' AND (l_partkey + l_linenumber) % 53 = 0 AS zero_price,
    l_returnflag = 'N' AND (l_partkey + l_linenumber) % 53 = 0 AS loss,
    CAST(CASE WHEN l_quantity = 50 AND l_discount = 0.1::DOUBLE AND l_tax = 0.08::DOUBLE
         THEN floor(l_extendedprice / 10) ELSE ceil(l_quantity / 10) END AS BIGINT) AS size,
    floor(l_extendedprice / l_quantity / 4000) * 4::DOUBLE + 0.95::DOUBLE AS list_price,
    COALESCE({quoted(b.SPECIAL_CODES)}[CAST(l_partkey % {b.SPECIAL_MODULUS} AS INT) + 1],
      (20000 + l_partkey) || CASE WHEN l_partkey % 5 = 0 THEN 'A' ELSE '' END) AS code
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN part p ON l_partkey = p_partkey
    JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey
), lines AS (
  SELECT CASE WHEN cancelled THEN 'C' WHEN bad_debt THEN 'A' ELSE '' END
      || CASE WHEN o_custkey % 10 = 3 THEN {b.WHOLESALE} + o_custkey ELSE o_orderkey END AS "Invoice",
    code AS "StockCode",
    CASE WHEN code = 'C3' OR (zero_price AND l_suppkey % 4 = 0) THEN NULL
      WHEN loss AND l_linenumber % 2 = 1 THEN 'damaged' WHEN loss THEN 'Lost '
      ELSE p_type END AS "Description",
    CASE WHEN (cancelled AND o_orderkey % 331 <> 5) OR loss THEN -size ELSE size END AS "Quantity",
    o_orderdate + to_minutes((o_orderkey * 37) % 1440) AS "InvoiceDate",
    CASE WHEN zero_price THEN 0::DOUBLE WHEN bad_debt AND l_linenumber <= 4 THEN -list_price
      ELSE list_price END AS "Price",
    CASE WHEN o_orderkey % 9 = 0 OR (o_orderkey % 50 = 1 AND l_linenumber = 6) THEN NULL
      WHEN o_custkey % 101 = 0 THEN 'guest-' || o_custkey
      ELSE o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END END AS "Customer ID",
    COALESCE({quoted(b.NAMED_COUNTRIES)}[n_nationkey + 1], n_name) AS "Country"
  FROM src
)"""

WORK = (
    LINES
    + f""", typed AS (
  SELECT "Invoice" AS invoice, {strip(chr(34) + "StockCode" + chr(34))} AS stock_code, "Description" AS description,
    "Quantity" AS quantity, "InvoiceDate" AS invoice_datetime, "Price" AS price,
    "Customer ID" AS customer_id_raw,
    COALESCE(CAST(CAST(TRY_CAST({strip(chr(34) + "Customer ID" + chr(34))} AS DOUBLE) AS BIGINT) AS VARCHAR),
      {strip(chr(34) + "Customer ID" + chr(34))}) AS customer_id, "Country" AS country, "Quantity" * "Price" AS line_amount,
    COALESCE(NULLIF(regexp_extract("Invoice", '^([A-Za-z]+)', 1), ''), 'numeric') AS invoice_prefix,
    CASE
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) IN ('POST', 'DOT', 'C2') THEN 'postage_carriage_dotcom'
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) = 'D' THEN 'discount'
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) IN ('M', 'ADJUST', 'ADJUST2') THEN 'manual_adjustment'
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) IN ('BANK CHARGES', 'AMAZONFEE', 'CRUK', 'B') THEN 'fees_commission_bad_debt'
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) LIKE 'GIFT%' THEN 'gift_voucher'
      WHEN upper({strip(chr(34) + "StockCode" + chr(34))}) IN ('S', 'TEST001', 'TEST002', 'PADS')
        OR upper({strip(chr(34) + "StockCode" + chr(34))}) LIKE 'DCGS%' THEN 'sample_test_internal'
      WHEN regexp_full_match(upper({strip(chr(34) + "StockCode" + chr(34))}), '[0-9]+[A-Z]*') THEN 'product_like'
      ELSE 'other_non_product_or_unknown' END AS stock_category
  FROM lines
), work AS (
  SELECT *, invoice LIKE 'C%' AS is_cancellation, invoice LIKE 'A%' AS is_bad_debt,
    customer_id_raw IS NULL AS is_customer_missing, description IS NULL AS is_description_missing,
    price = 0 AND quantity < 0 AND invoice NOT LIKE 'C%' AND invoice NOT LIKE 'A%' AS is_damage,
    stock_category = 'product_like' AS is_product_like,
    invoice_prefix = 'numeric' AND stock_category = 'product_like' AND quantity > 0 AND price > 0
      AS is_gross_sale,
    stock_category = 'product_like' AND invoice NOT LIKE 'A%' AND price > 0 AND quantity <> 0
      AS is_net_line
  FROM typed
), anon AS (SELECT * FROM work WHERE is_customer_missing AND quantity > 0 AND price > 0)"""
)

FACTS = (
    WORK
    + """, fact_rows AS (
  SELECT invoice AS invoice_no, stock_code, description, quantity, price AS unit_price,
    line_amount AS total_amount, invoice_datetime,
    customer_id, country, stock_category, is_gross_sale, is_cancellation
  FROM work
), facts AS (
  SELECT invoice_no, stock_code, description, quantity, unit_price, total_amount, invoice_datetime,
    customer_id, country FROM fact_rows WHERE is_gross_sale
), cancels AS (
  SELECT row_number() OVER () AS rid, invoice_no, stock_code, description, quantity, unit_price,
    total_amount, invoice_datetime, customer_id, country,
    quantity < 0 AND unit_price > 0 AND customer_id IS NOT NULL
      AND stock_category = 'product_like' AS eligible, stock_category
  FROM fact_rows WHERE is_cancellation
), candidates AS (
  SELECT rid, f.invoice_no AS sale, row_number() OVER (
    PARTITION BY rid ORDER BY f.invoice_datetime DESC, f.invoice_no DESC) AS pos
  FROM cancels c JOIN facts f ON c.customer_id = f.customer_id AND c.stock_code = f.stock_code
    AND abs(c.quantity) = f.quantity AND f.invoice_datetime < c.invoice_datetime
  WHERE eligible
), log AS (
  SELECT c.*, sale AS matched_original_invoice
  FROM cancels c LEFT JOIN (SELECT * FROM candidates WHERE pos = 1) USING (rid)
), country_counts AS (
  SELECT customer_id, country, COUNT(*) AS n FROM facts WHERE customer_id IS NOT NULL GROUP BY 1, 2
), main_country AS (
  SELECT customer_id, country FROM country_counts
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country) = 1
), features AS (
  SELECT f.customer_id,
    CAST(floor(epoch((SELECT max(invoice_datetime) FROM work) - max(invoice_datetime)) / 86400) AS BIGINT)
      AS recency_days,
    COUNT(DISTINCT invoice_no) AS frequency, """
    + money("total_amount")
    + """ AS monetary,
    min(invoice_datetime) AS first_purchase_date, max(invoice_datetime) AS last_purchase_date,
    COUNT(DISTINCT stock_code) AS unique_products, any_value(m.country) AS country,
    COUNT(DISTINCT invoice_no) = 1 AS is_one_time_buyer
  FROM facts f JOIN main_country m USING (customer_id)
  GROUP BY f.customer_id
)"""
)


def quantiles(source: str, value: str, names: dict[str, float], by: str | None = None) -> str:
    """Interpolated quantiles from row numbers, one row per group."""
    part = f"PARTITION BY {by}" if by else ""
    cells = []
    for name, p in names.items():
        pos = f"((n - 1) * {p!r}::DOUBLE)"
        low = f"max(v) FILTER (WHERE rn = floor({pos}))"
        high = f"max(v) FILTER (WHERE rn = ceil({pos}))"
        frac = f"max({pos} - floor({pos}))"
        cells.append(f"{low} + ({high} - {low}) * {frac} AS {name}")
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {key}{", ".join(cells)} FROM (
      SELECT {key}CAST({value} AS DOUBLE) AS v,
        row_number() OVER ({part} ORDER BY CAST({value} AS DOUBLE)) - 1 AS rn,
        count(*) OVER ({part}) AS n
      FROM {source} WHERE {value} IS NOT NULL) {group}"""


def describe(source: str, columns: list[str], probs: list[float]) -> str:
    """metric/value rows per column."""
    parts = []
    for c in columns:
        q = {f"p{round(p * 100)}": p for p in probs}
        cells = [
            "('count', n)",
            f"('mean', {half_even('mean')})",
            f"('std', {half_even('std')})",
            "('min', lo)",
            "('max', hi)",
            *[f"('{round(p * 100)}%', {half_even(f'p{round(p * 100)}')})" for p in probs],
        ]
        parts.append(f"""SELECT '{c}' AS "column", u.metric, u.value FROM (
          SELECT CAST(count(*) AS DOUBLE) AS n, avg(d) AS mean, stddev_samp(d) AS std,
            min(d) AS lo, max(d) AS hi
          FROM (SELECT CAST({c} AS DOUBLE) AS d FROM {source} WHERE {c} IS NOT NULL)
        ) m, ({quantiles(source, c, q)}) z, LATERAL (VALUES {", ".join(cells)}) AS u(metric, value)""")
    return " UNION ALL ".join(parts)
