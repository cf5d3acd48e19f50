"""DuckDB SQL twins of the registered queries (correctness oracle).

Written independently of the Spark code path: the same stand-in inputs and
the same operator semantics, expressed in plain SQL over the driver's views.
RE2 (DuckDB) has no class intersection or look-around, so the text cleaning
and whole-word patterns are spelled out differently here.
"""

from __future__ import annotations

# -- reusable SQL fragments -------------------------------------------------

# Zs/Zl/Zp characters other than the ASCII space, plus every C* character.
_NONPRINT = r"[\p{C}\x{00A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean(x: str) -> str:
    return (
        "nullif(trim(regexp_replace(regexp_replace(regexp_replace("
        f"{x}, '[\\t\\r\\n]', ' ', 'g'), '{_NONPRINT}', '', 'g'), ' {{2,}}', ' ', 'g')), '')"
    )


def digits(x: str) -> str:
    return f"nullif(regexp_replace(regexp_replace(trim({x}), '\\.0+$', ''), '[^0-9]', '', 'g'), '')"


def pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


INV = f"""inv AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN {pad('l_partkey', 5)} || '-0000-00'
              ELSE {pad('l_partkey', 5)} || '000000' END AS ndc,
         l_quantity AS inventory,
         CASE WHEN l_returnflag = 'N' THEN (CASE WHEN l_linestatus = 'O' THEN '   ' END)
              ELSE l_returnflag END AS hold_codes
  FROM lineitem)"""

OO = f"""oo AS (
  SELECT CASE WHEN l_tax = 0 THEN '9' || substr({pad('l_partkey', 5)}, 2, 4) ELSE {pad('l_partkey', 5)} END
           || '-' || CASE WHEN l_discount = 0 THEN '00' ELSE '000' END || '-00' AS sku,
         l_quantity AS total,
         CASE WHEN l_returnflag <> 'A' THEN 'Pick Completed' WHEN l_linestatus = 'F' THEN 'Loaded' ELSE ' open ' END AS status
  FROM lineitem)"""

UP = f"""up AS (
  SELECT {pad('l_partkey', 5)} || '-0000-00' AS ndc_code,
         CAST(l_linenumber AS VARCHAR) || '.0' AS reason_code,
         CASE WHEN l_returnflag = 'R' AND l_tax < 0.04 THEN ' Yes' ELSE 'no' END AS action,
         l_quantity AS sales_order_qty
  FROM lineitem)"""

NET_CTES = f"""{INV},
{OO},
{UP},
stock AS (
  SELECT k AS ndc, coalesce(sum(inventory), 0) AS inventory FROM (
    SELECT {digits('ndc')} AS k, inventory FROM inv WHERE trim(coalesce(hold_codes, '')) = '') t
  WHERE k IS NOT NULL GROUP BY k),
segs AS (
  SELECT string_split(sku, '-') AS s, total FROM oo
  WHERE upper(trim(coalesce(status, ''))) NOT IN ('PICK COMPLETED', 'LOADED')),
alloc AS (
  SELECT ndc, sum(total) AS total FROM (
    SELECT CASE WHEN len(s) = 3 AND regexp_full_match(s[1], '[0-9]{{5}}') AND regexp_full_match(s[2], '[0-9]{{3}}')
                     AND regexp_full_match(s[3], '[0-9]{{2}}')
                THEN s[1] || lpad(s[2], 4, '0') || s[3] END AS ndc, coalesce(total, 0) AS total
    FROM segs) t
  WHERE ndc IS NOT NULL GROUP BY ndc),
upl AS (
  SELECT {digits('ndc_code')} AS ndc, sum(coalesce(sales_order_qty, 0)) AS upload_qty FROM up
  WHERE regexp_replace(trim(reason_code), '^([+-]?[0-9]+)\\.0+$', '\\1') IN ('1', '4')
    AND lower(trim(action)) IN ('y', 'yes')
  GROUP BY 1),
net AS (
  SELECT coalesce(s.ndc, a.ndc) AS ndc, coalesce(s.inventory, 0) AS inventory, coalesce(a.total, 0) AS total,
         coalesce(u.upload_qty, 0) AS upload_qty
  FROM stock s FULL OUTER JOIN alloc a ON s.ndc = a.ndc
  LEFT JOIN upl u ON u.ndc = coalesce(s.ndc, a.ndc))"""

MASTER = f"""m AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_returnflag,
         l.l_linestatus, l.l_shipdate, o.o_custkey, o.o_orderdate, c.c_name, c.c_mktsegment, p.p_name, p.p_size, p.p_type,
         CASE WHEN l.l_returnflag = 'R' THEN NULL
              ELSE {pad('l.l_partkey', 5)} || '-' || {pad('l.l_suppkey', 4)} || '-01' END AS ndc_code,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN '  ' || lower(c.c_name) || chr(9)
              WHEN 'AUTOMOBILE' THEN replace(c.c_name, '#', ' ' || chr(10) || '#  ')
              WHEN 'MACHINERY' THEN c.c_name || chr(160) || chr(8203) || ' x'
              WHEN 'FURNITURE' THEN '   ' ELSE c.c_name END AS sold_to
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)"""

LOOKUP_EXPR = f"nullif(coalesce({digits('ndc_code')}, '') || coalesce(upper({clean('sold_to')}), ''), '')"

MONTHS_CASE = """CASE lower({x})
  WHEN 'jan' THEN 1 WHEN 'january' THEN 1 WHEN 'feb' THEN 2 WHEN 'february' THEN 2
  WHEN 'mar' THEN 3 WHEN 'march' THEN 3 WHEN 'apr' THEN 4 WHEN 'april' THEN 4 WHEN 'may' THEN 5
  WHEN 'jun' THEN 6 WHEN 'june' THEN 6 WHEN 'jul' THEN 7 WHEN 'july' THEN 7 WHEN 'aug' THEN 8
  WHEN 'august' THEN 8 WHEN 'sep' THEN 9 WHEN 'sept' THEN 9 WHEN 'september' THEN 9
  WHEN 'oct' THEN 10 WHEN 'october' THEN 10 WHEN 'nov' THEN 11 WHEN 'november' THEN 11
  WHEN 'dec' THEN 12 WHEN 'december' THEN 12 END"""

KW = r"(?i)(gear|RED |bolt|pl\.te)"
KW_WORD = r"(?i)[^\p{L}\p{Nd}](gear|RED |bolt|pl\.te)[^\p{L}\p{Nd}]"

MOQ_INPUT = """mi AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag, l.l_linestatus,
         CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity ELSE l.l_quantity * 2 END AS q,
         CASE WHEN p.p_type = 'SMALL' THEN NULL WHEN p.p_type = 'PROMO' THEN 0.0
              WHEN p.p_type = 'LARGE' THEN NULL ELSE CAST(p.p_size AS DOUBLE) END AS s,
         p.p_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

MOQ_REMAINDER = "(CASE WHEN s IS NOT NULL AND q IS NOT NULL AND s <> 0 THEN NOT ((q - s * floor(q / s)) <= 1e-9 OR (s - (q - s * floor(q / s))) <= 1e-9) ELSE false END)"

SUMMARY_INPUT = f"""{MASTER},
si AS (
  SELECT p_name AS material, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_name END AS sold_to_name,
         {LOOKUP_EXPR} AS lookup, ndc_code, l_quantity * 300 AS ups,
         CASE WHEN l_linestatus = 'O' THEN l_quantity END AS qty, l_extendedprice AS mtd
  FROM m),
summ AS (
  SELECT material, sold_to_name, lookup, ndc_code, max(ups) AS max_ups, coalesce(sum(qty), 0) AS sum_qty,
         max(mtd) AS max_mtd
  FROM si GROUP BY material, sold_to_name, lookup, ndc_code)"""

REPORT_MONTH = """rp AS (
  SELECT m AS p FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)
  ORDER BY n DESC, m ASC LIMIT 1)"""

SQL: dict[str, str] = {
    "F1_net_inventory": f"""WITH {NET_CTES}
SELECT ndc, round(inventory, 2) AS inventory, round(total, 2) AS total, round(upload_qty, 2) AS upload_qty,
       round(greatest(inventory - total - upload_qty, 0), 2) AS ups_inventory
FROM net""",
    "F1_net_counters": f"""WITH {NET_CTES}
SELECT (SELECT count(*) FROM stock) AS inventory_rows,
       (SELECT count(*) FROM alloc) AS allocated_rows,
       (SELECT count(*) FROM alloc WHERE ndc NOT IN (SELECT ndc FROM stock)) AS missing_inventory,
       (SELECT count(DISTINCT ndc) FROM net) AS unique_ndcs,
       (SELECT count(*) FROM net WHERE total = 0) AS missing_allocations""",
    "C6_hold_filter_counters": f"""WITH {INV},
k AS (SELECT {digits('ndc')} AS k, inventory AS q, trim(coalesce(hold_codes, '')) = '' AS keep FROM inv)
SELECT count(*) AS total_rows, count_if(keep) AS blank_hold_rows, count_if(NOT keep) AS excluded_hold_rows,
       count(DISTINCT k) AS unique_keys_before, count(DISTINCT CASE WHEN keep THEN k END) AS unique_keys_after,
       round(sum(coalesce(q, 0)), 2) AS qty_before,
       round(coalesce(sum(CASE WHEN keep THEN coalesce(q, 0) END), 0), 2) AS qty_after
FROM k""",
    "E10_missing_inventory": f"""WITH {NET_CTES}
SELECT ndc FROM alloc WHERE ndc NOT IN (SELECT ndc FROM stock)""",
    "C8_upload_totals": f"""WITH {NET_CTES}
SELECT ndc, round(upload_qty, 2) AS upload_qty FROM upl""",
    "B1_clean_documents": f"""SELECT doc_id, md5(c) AS clean_md5, length(c) AS clean_len
FROM (SELECT doc_id, {clean('text')} AS c FROM documents)""",
    "B2_text_keys_customer": f"""WITH c AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || lower(c_name) || chr(9)
              WHEN 'AUTOMOBILE' THEN replace(c_name, '#', ' ' || chr(10) || '#  ')
              WHEN 'MACHINERY' THEN c_name || chr(160) || chr(8203) || ' x'
              WHEN 'FURNITURE' THEN '   ' ELSE c_name END AS dirty
  FROM customer),
k AS (SELECT c_custkey, dirty, {clean('dirty')} AS clean FROM c)
SELECT c_custkey, clean, upper(clean) AS text_key, clean AS ident_key, clean IS NULL AS is_blank,
       coalesce(regexp_replace(dirty, '^\\s+|\\s+$', '', 'g') <> upper(clean), false) AS changed
FROM k""",
    "B4_digits_keys_orders": f"""WITH x AS (
  SELECT o_orderkey,
         CAST(o_orderkey * 1000 + 7 AS VARCHAR) AS d_float,
         CAST(o_orderkey AS VARCHAR) || '.0' AS ndc_text,
         {pad('o_custkey', 5)} || '/' || o_orderpriority AS ndc_mixed,
         CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) || '.00'
              WHEN 'O' THEN '-' || CAST(o_custkey AS VARCHAR) || '.50' ELSE o_orderpriority END AS code_text,
         ' ' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ',' ||
           lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || ' ' AS price_text
  FROM orders)
SELECT o_orderkey, d_float, {digits('ndc_text')} AS d_text, {digits('ndc_mixed')} AS d_mixed,
       CASE WHEN regexp_full_match(code_text, '[+-]?[0-9]+\\.0+') THEN split_part(code_text, '.', 1) ELSE code_text END AS stz,
       CASE WHEN regexp_full_match(code_text, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
            THEN CAST(trim(code_text) AS DOUBLE) END AS num,
       CAST(trim(replace(price_text, ',', '')) AS DOUBLE) AS price_num
FROM x""",
    "B9_sku_to_ndc": f"""WITH p AS (
  SELECT p_partkey, {pad('p_partkey', 5)} || '-' ||
         CASE WHEN p_type = 'SMALL' THEN {pad('p_size', 2)} ELSE {pad('p_size', 3)} END || '-' ||
         {pad('length(p_name)', 2)} AS sku
  FROM part),
s AS (SELECT p_partkey, sku, string_split(sku, '-') AS seg FROM p)
SELECT p_partkey, sku,
       CASE WHEN len(seg) = 3 AND regexp_full_match(seg[1], '[0-9]{{5}}') AND regexp_full_match(seg[2], '[0-9]{{3}}')
                 AND regexp_full_match(seg[3], '[0-9]{{2}}')
            THEN seg[1] || lpad(seg[2], 4, '0') || seg[3] END AS ndc
FROM s""",
    "B12_lookup_keys": f"""WITH {MASTER}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {LOOKUP_EXPR} AS lookup,
       CASE WHEN {digits('ndc_code')} IS NULL AND {clean('sold_to')} IS NULL THEN NULL
            ELSE coalesce({digits('ndc_code')}, '') || '|' || coalesce(upper({clean('sold_to')}), '') END AS composite
FROM m""",
    "B17_month_headers": f"""WITH h AS (
  SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%b-%y')
         WHEN 'O' THEN ' ' || strftime(o_orderdate, '%B %Y') || ' '
         ELSE strftime(o_orderdate, '%b.%Y') END AS header
  FROM orders),
p AS (
  SELECT header,
         regexp_extract(trim(header), '^([A-Za-z]+)\\.?\\s*[-\\s]?\\s*([0-9]{{2,4}})$', 1) AS mname,
         regexp_extract(trim(header), '^([A-Za-z]+)\\.?\\s*[-\\s]?\\s*([0-9]{{2,4}})$', 2) AS ytxt
  FROM h),
q AS (SELECT header, {MONTHS_CASE.format(x='mname')} AS mon, ytxt FROM p)
SELECT header,
       CAST(CASE WHEN mon IS NOT NULL AND length(ytxt) IN (2, 4)
            THEN CASE WHEN length(ytxt) = 2 THEN 2000 + CAST(ytxt AS INTEGER) ELSE CAST(ytxt AS INTEGER) END END AS INTEGER) AS year,
       CAST(CASE WHEN mon IS NOT NULL AND length(ytxt) IN (2, 4) THEN mon END AS INTEGER) AS month
FROM q""",
    "B18_month_labels": """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
SELECT m, strftime(m, '%b') AS label, CAST(m - INTERVAL 3 MONTH AS DATE) AS p1, CAST(m - INTERVAL 1 MONTH AS DATE) AS p3
FROM m""",
    "G9_reporting_month": f"""WITH {REPORT_MONTH}
SELECT CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month FROM rp""",
    "H2_prior_months": f"""WITH {REPORT_MONTH},
w AS (
  SELECT o_custkey,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 3 MONTH THEN o_totalprice END) AS m1,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 2 MONTH THEN o_totalprice END) AS m2,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 1 MONTH THEN o_totalprice END) AS m3
  FROM orders, rp GROUP BY o_custkey)
SELECT c_custkey, round(m1, 2) AS m1, round(m2, 2) AS m2, round(m3, 2) AS m3,
       round((coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0)) /
             nullif(CAST(m1 IS NOT NULL AS INTEGER) + CAST(m2 IS NOT NULL AS INTEGER) + CAST(m3 IS NOT NULL AS INTEGER), 0), 4) AS average
FROM customer LEFT JOIN w ON c_custkey = o_custkey""",
    "F2_keyword_flag": f"""SELECT p_partkey, regexp_matches(p_name, '{KW}') AS flag,
       regexp_matches(' ' || p_name || ' ', '{KW_WORD}') AS flag_word
FROM part""",
    "F3_price_issue": """WITH o AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0
              WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END AS u,
         CASE WHEN o_orderpriority = '5-LOW' THEN round(o_totalprice, -1)
              WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice END AS r
  FROM orders)
SELECT o_orderkey,
       (coalesce(u, 0) = 0) OR (coalesce(u - r, 0) <> 0 AND u IS NOT NULL AND r IS NOT NULL) AS price_issue,
       round(u - r, 2) AS price_difference
FROM o""",
    "F4_low_stock": """SELECT l_partkey, round(sum(l_quantity), 2) AS stock, coalesce(sum(l_quantity) < 800, false) AS low_stock
FROM lineitem GROUP BY l_partkey""",
    "F5_moq_checks": f"""WITH {MOQ_INPUT}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN s IS NOT NULL AND s <> 0 THEN
            ((coalesce(q, 0) / s - floor(coalesce(q, 0) / s)) > 1e-6 AND (1 - (coalesce(q, 0) / s - floor(coalesce(q, 0) / s))) > 1e-6)
            ELSE false END AS moq_lenient,
       CASE WHEN s IS NOT NULL AND q IS NOT NULL AND s <> 0 THEN (q / s <> floor(q / s)) ELSE true END AS moq_strict,
       {MOQ_REMAINDER} AS moq_remainder
FROM mi""",
    "F8_rule_counters": f"""WITH {MASTER},
x AS (
  SELECT p_name, l_quantity AS q, l_extendedprice AS u,
         CASE WHEN l_returnflag = 'A' THEN round(l_extendedprice, -2) ELSE l_extendedprice END AS r,
         CAST(p_size AS DOUBLE) AS s, l_quantity * 500 AS stock
  FROM m)
SELECT count_if(regexp_matches(p_name, '{KW}')) AS controlled_product_count,
       count_if((coalesce(u, 0) = 0) OR (coalesce(u - r, 0) <> 0 AND u IS NOT NULL AND r IS NOT NULL)) AS price_issue_count,
       count_if(CASE WHEN s IS NOT NULL AND s <> 0 THEN
            ((coalesce(q, 0) / s - floor(coalesce(q, 0) / s)) > 1e-6 AND (1 - (coalesce(q, 0) / s - floor(coalesce(q, 0) / s))) > 1e-6)
            ELSE false END) AS moq_issue_count,
       count_if(coalesce(stock < 10000, false)) AS low_stock_count
FROM x""",
    "F9_highlights": f"""WITH {MOQ_INPUT},
h AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE lower(trim(CASE WHEN l_returnflag = 'R' THEN ' Cancel'
                              WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'HOLD ' ELSE '' END))
              WHEN 'cancel' THEN 'FF0000' WHEN 'hold' THEN 'ADD8E6' END AS act,
         CASE WHEN regexp_matches(p_name, '{KW}') THEN 'FFC0CB' END AS pink,
         l_linestatus = 'F' AS price_flag,
         {MOQ_REMAINDER} AS moq
  FROM mi)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       coalesce(act, pink) AS row_fill,
       coalesce(act, CASE WHEN price_flag THEN 'FFA500' END, pink) AS price_fill,
       coalesce(act, CASE WHEN moq THEN 'FFFF00' END, pink) AS qty_fill
FROM h""",
    "G1_sales_summary": f"""WITH {SUMMARY_INPUT}
SELECT material AS material_description, sold_to_name AS sold_to_party_name, lookup, ndc_code,
       round(max_ups, 2) AS max_ups_inventory, round(sum_qty, 2) AS sum_sales_order_qty,
       round(max_mtd, 2) AS max_sales_qty_mtd, CAST(NULL AS DOUBLE) AS max_forecast_qty
FROM summ""",
    "F10_low_stock_highlight": f"""WITH {SUMMARY_INPUT}
SELECT lookup, material AS material_description, CASE WHEN max_ups < 10000 THEN 'FFFF00' END AS low_stock_fill
FROM summ""",
    "E4_first_order_per_customer": """WITH f AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders)
SELECT c_custkey, o_orderkey, o_orderdate, round(o_totalprice, 2) AS o_totalprice, o_orderkey IS NOT NULL AS matched
FROM customer LEFT JOIN f ON c_custkey = o_custkey AND rn = 1""",
}


# -- enrichment / lookups ---------------------------------------------------

ENRICH_CTES = """master AS (
  SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderpriority = '1-URGENT' THEN 'PRESET' END AS c_mktsegment
  FROM orders),
src AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 0 AS src_rank FROM customer
  UNION ALL SELECT c_custkey, c_name, c_acctbal, 'ALT', 1 FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal, c_mktsegment, 2 FROM customer WHERE c_acctbal > 9000),
b AS (
  SELECT CAST(c_custkey AS VARCHAR) AS k, c_mktsegment, c_acctbal, c_name,
         row_number() OVER (PARTITION BY CAST(c_custkey AS VARCHAR) ORDER BY src_rank, c_custkey) AS rn
  FROM src),
j AS (
  SELECT m.o_orderkey, coalesce(m.c_mktsegment, b.c_mktsegment) AS c_mktsegment, b.c_acctbal, b.c_name, b.k IS NOT NULL AS hit
  FROM master m LEFT JOIN b ON CAST(m.o_custkey AS VARCHAR) = b.k AND b.rn = 1)"""

_LI_ORDER = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice"

AWARD_CTES = f"""src AS (
  SELECT {_LI_ORDER},
         CASE WHEN l_shipdate >= TIMESTAMP '1997-01-01' THEN 'N' || CAST(l_partkey AS VARCHAR) || '/S' || CAST(l_suppkey AS VARCHAR)
              WHEN l_linestatus = 'O' THEN ' p' || CAST(l_partkey AS VARCHAR) || '/s' || CAST(l_suppkey AS VARCHAR)
              ELSE 'P' || CAST(l_partkey AS VARCHAR) || '/S' || CAST(l_suppkey AS VARCHAR) END AS lookup,
         {pad('l_partkey', 5)} || CASE WHEN l_shipdate >= TIMESTAMP '1997-01-01' THEN '-9999-99' ELSE '-0000-00' END AS ndc,
         CASE WHEN l_returnflag = 'R' THEN 'Secondary' WHEN l_linestatus = 'O' THEN 'primary ' ELSE 'Primary' END AS award
  FROM lineitem),
s2 AS (SELECT *, upper({clean('lookup')}) AS lk, {digits('ndc')} AS nk, upper({clean('award')}) AS n FROM src),
pt AS (
  SELECT lk AS k, CASE WHEN count(DISTINCT n) = 1 THEN first(award ORDER BY {_LI_ORDER}) END AS value,
         CASE WHEN count(DISTINCT n) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status
  FROM s2 WHERE lk IS NOT NULL AND n IS NOT NULL GROUP BY lk),
ft AS (
  SELECT nk AS k, CASE WHEN count(DISTINCT n) = 1 THEN first(award ORDER BY {_LI_ORDER}) END AS value,
         CASE WHEN count(DISTINCT n) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status
  FROM s2 WHERE nk IS NOT NULL AND n IS NOT NULL GROUP BY nk),
m AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
              ELSE 'P' || CAST(l_partkey AS VARCHAR) || '/S' || CAST(l_suppkey AS VARCHAR) END AS lookup,
         {pad('l_partkey', 5)} || '000000' AS ndc_code,
         'Customer ' || CAST(l_suppkey AS VARCHAR) AS customer
  FROM lineitem),
r AS (
  SELECT m.*, CASE WHEN p.status IS NOT NULL THEN p.value WHEN f.status IS NOT NULL THEN f.value END AS award_type,
         coalesce(p.status, f.status, 'NOT_FOUND') AS award_status,
         CASE WHEN p.status IS NOT NULL THEN 'Lookup (Customer+NDC)'
              WHEN f.status IS NOT NULL THEN 'NDC (product-level fallback)' END AS award_strategy
  FROM m LEFT JOIN pt p ON upper({clean('m.lookup')}) = p.k LEFT JOIN ft f ON {digits('m.ndc_code')} = f.k)"""


#: Values of one chunk of joined text.
_CHUNK = 1000


def _observed(src: str, key: str, val: str, order: str) -> str:
    """per key with >1 distinct normalised value: its first-original values, sorted and joined in chunks."""
    return f"""(SELECT k, chunk, string_agg(v, '; ' ORDER BY v) AS observed FROM (
      SELECT k, v, (row_number() OVER (PARTITION BY k ORDER BY v) - 1) // {_CHUNK} AS chunk FROM (
        SELECT {key} AS k, n, first({val} ORDER BY {order}) AS v, count(*) OVER (PARTITION BY {key}) AS n_values FROM {src}
        WHERE {key} IS NOT NULL AND n IS NOT NULL GROUP BY {key}, n) WHERE n_values > 1) GROUP BY k, chunk)"""


PRIO_CTES = f"""g AS (
  SELECT c_name AS ko, CASE WHEN c_nationkey < 10 THEN c_mktsegment END AS v, c_custkey AS o1, 0 AS o0 FROM customer
  UNION ALL SELECT c_name, CASE WHEN c_nationkey < 3 AND c_acctbal < 0 THEN 'Special' END, c_custkey, 1 FROM customer
  UNION ALL SELECT c_name, CASE WHEN c_nationkey < 10 AND c_acctbal > 5000 THEN lower(c_mktsegment) END, c_custkey, 2 FROM customer),
t AS (
  SELECT lower(c_name) || CASE WHEN c_nationkey BETWEEN 5 AND 15 THEN '' ELSE ' closed' END AS ko,
         CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'Retail' END AS v, c_custkey AS o1, 0 AS o0 FROM customer),
op AS (
  SELECT ' ' || c_name || ' ' AS ko, CASE WHEN c_nationkey BETWEEN 12 AND 20 THEN substr(c_mktsegment, 1, 4) ELSE '  ' END AS v,
         c_custkey AS o1, 0 AS o0 FROM customer),
allsrc AS (
  SELECT 'Buying Groups' AS source, 1 AS priority, 0 AS rnk, * FROM g
  UNION ALL SELECT 'Sales Trend', 2, 1, * FROM t
  UNION ALL SELECT 'Open Orders', 3, 2, * FROM op),
n AS (SELECT *, upper({clean('ko')}) AS k, upper({clean('v')}) AS n FROM allsrc),
nn AS (SELECT * FROM n WHERE k IS NOT NULL AND n IS NOT NULL),
firsts AS (
  SELECT source, priority, rnk, k, n, first(v ORDER BY o0, o1) AS v, first(ko ORDER BY o0, o1) AS ko
  FROM nn GROUP BY source, priority, rnk, k, n),
tbl AS (
  SELECT source, priority, rnk, k,
         CASE WHEN count(DISTINCT n) = 1 THEN min(v) END AS value,
         CASE WHEN count(DISTINCT n) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status,
         min(ko) AS min_ko, count(*) AS n_values
  FROM firsts GROUP BY source, priority, rnk, k),
chunks AS (
  SELECT source, priority, k, chunk, string_agg(v, '; ' ORDER BY v) AS observed, string_agg(DISTINCT ko, '; ' ORDER BY ko) AS observed_keys FROM (
    SELECT *, (row_number() OVER (PARTITION BY source, k ORDER BY v) - 1) // 1000 AS chunk, count(*) OVER (PARTITION BY source, k) AS n_values FROM firsts)
  WHERE n_values > 1 GROUP BY source, priority, k, chunk),
win AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY priority, rnk) AS rn FROM tbl) WHERE rn = 1),
mst AS (
  SELECT o.o_orderkey,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN '  ' || lower(c.c_name) || chr(9)
              WHEN 'AUTOMOBILE' THEN replace(c.c_name, '#', ' ' || chr(10) || '#  ')
              WHEN 'MACHINERY' THEN c.c_name || chr(160) || chr(8203) || ' x'
              WHEN 'FURNITURE' THEN '   ' ELSE c.c_name END AS sold_to
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
res AS (
  SELECT m.o_orderkey, m.sold_to, w.value AS buying_group,
         CASE WHEN w.status = 'MATCHED' THEN w.source END AS buying_group_source,
         coalesce(w.status, 'NOT_FOUND') AS buying_group_status
  FROM mst m LEFT JOIN win w ON upper({clean('m.sold_to')}) = w.k)"""

EV_CTES = f"""src AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS ndc, event_type AS comment FROM events),
s2 AS (SELECT *, {digits('ndc')} AS k, upper({clean('comment')}) AS n FROM src),
nn AS (SELECT * FROM s2 WHERE k IS NOT NULL AND n IS NOT NULL),
tbl AS (
  SELECT k, count(DISTINCT n) AS nd, first(comment ORDER BY event_id) AS fst,
         first(comment ORDER BY ts DESC NULLS LAST, event_id) AS newest, max(ts) IS NOT NULL AS any_date,
         first(ndc ORDER BY event_id) AS first_ndc
  FROM nn GROUP BY k),
obs AS (
  SELECT k, chunk, string_agg(v, '; ' ORDER BY v) AS observed FROM (
    SELECT k, v, (row_number() OVER (PARTITION BY k ORDER BY v) - 1) // 1000 AS chunk FROM (
      SELECT k, first(comment ORDER BY event_id) AS v FROM nn GROUP BY k, n)) GROUP BY k, chunk),
mst AS (SELECT c_custkey, c_name, CAST(c_custkey AS VARCHAR) AS ndc_code FROM customer)"""


def _ev(dated: bool) -> str:
    if dated:
        value = "CASE WHEN nd = 1 THEN fst WHEN any_date THEN newest END"
        status = "CASE WHEN nd = 1 OR any_date THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END"
    else:
        value = "CASE WHEN nd = 1 THEN fst END"
        status = "CASE WHEN nd = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END"
    return f"""{EV_CTES},
t2 AS (SELECT k, {value} AS value, {status} AS status, nd, first_ndc FROM tbl),
res AS (
  SELECT m.c_custkey, m.c_name, m.ndc_code, t2.value AS sc_comments, coalesce(t2.status, 'NOT_FOUND') AS sc_comments_status
  FROM mst m LEFT JOIN t2 ON {digits('m.ndc_code')} = t2.k)"""


def _ev_exceptions(dated: bool) -> str:
    return f"""WITH {_ev(dated)}
SELECT t2.first_ndc AS ndc, t2.k AS normalized_ndc, '' AS customer, o.observed AS comments, CAST(o.chunk AS INTEGER) AS chunk, t2.status,
       CASE WHEN t2.status = 'MATCHED' THEN 'Multiple comments; resolved by the most recent date'
            ELSE 'Multiple different comments and no date to resolve them' END AS reason
FROM t2 JOIN obs o ON t2.k = o.k WHERE t2.nd > 1
UNION ALL
SELECT DISTINCT ndc_code AS ndc, {digits('ndc_code')} AS normalized_ndc, c_name AS customer, '' AS comments, 0 AS chunk,
       'NOT_FOUND' AS status, 'NDC not present in the source' AS reason
FROM res WHERE sc_comments_status = 'NOT_FOUND'"""


STAT_MASTER = f"""{MASTER},
x AS (
  SELECT l_orderkey, o_custkey, ndc_code, {LOOKUP_EXPR} AS lookup,
         CASE WHEN p_type <> 'SMALL' THEN p_name END AS material,
         CASE WHEN p_type <> 'PROMO' THEN p_size END AS moq,
         CASE WHEN l_returnflag <> 'R' THEN l_quantity * 10 END AS stock,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS buying_group,
         CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS award,
         CASE WHEN p_size > 10 THEN p_type END AS comments
  FROM m)"""

GRAIN_CTES = """o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders),
a AS (SELECT * FROM o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
ad AS (SELECT DISTINCT o_orderkey, o_custkey FROM a),
dropped AS (
  SELECT DISTINCT o.o_orderkey, o.o_custkey FROM o
  WHERE NOT EXISTS (SELECT 1 FROM ad WHERE ad.o_orderkey IS NOT DISTINCT FROM o.o_orderkey
                                       AND ad.o_custkey IS NOT DISTINCT FROM o.o_custkey))"""

_LI_OTHER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate")

SQL.update({
    "E1_enrich": f"""WITH {ENRICH_CTES}
SELECT o_orderkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal, c_name FROM j""",
    "J1_enrich_audit": f"""WITH {ENRICH_CTES},
sel AS (SELECT c_custkey, c_mktsegment, c_acctbal, c_name FROM src),
grp AS (
  SELECT c_custkey, count(*) AS n,
         count(DISTINCT CAST(c_mktsegment AS VARCHAR)) > 1 AS x1,
         count(DISTINCT CAST(c_acctbal AS VARCHAR)) > 1 AS x2,
         count(DISTINCT CAST(c_name AS VARCHAR)) > 1 AS x3
  FROM sel GROUP BY c_custkey),
d AS (
  SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dup,
         CAST(coalesce(sum(CASE WHEN n >= 2 THEN CAST(x1 AS INTEGER) + CAST(x2 AS INTEGER) + CAST(x3 AS INTEGER) ELSE 0 END), 0) AS BIGINT) AS conf
  FROM grp)
SELECT 'customer' AS source, 'c_acctbal, c_name' AS columns_added, 'o_custkey' AS join_key,
       (SELECT count_if(hit) FROM j) AS rows_updated,
       (SELECT count(*) FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS k FROM src)
         WHERE k NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM master)) AS rows_missing,
       dup AS duplicate_keys_found,
       'Customer Number; conflicting values=' || CAST(conf AS VARCHAR) AS comments
FROM d""",
    "G5_duplicate_analysis": f"""WITH g AS (
  SELECT l_orderkey, l_linenumber, count(*) AS n,
         {', '.join(f'count(DISTINCT CAST({c} AS VARCHAR)) > 1 AS x{i}' for i, c in enumerate(_LI_OTHER))}
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_keys_found,
       CAST(coalesce(sum(CASE WHEN n >= 2 THEN {' + '.join(f'CAST(x{i} AS INTEGER)' for i in range(len(_LI_OTHER)))} ELSE 0 END), 0) AS BIGINT) AS conflicting_values
FROM g""",
    "E6_award_lookup": f"""WITH {AWARD_CTES}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, award_type, award_status, award_strategy FROM r""",
    "J3_award_exceptions": f"""WITH {AWARD_CTES},
pobs AS {_observed('s2', 'lk', 'award', _LI_ORDER)},
fobs AS {_observed('s2', 'nk', 'award', _LI_ORDER)}
SELECT '' AS customer, '' AS ndc, k AS lookup, observed AS value, CAST(chunk AS INTEGER) AS chunk, 'Lookup (Customer+NDC)' AS match_strategy,
       'DUPLICATE_CONFLICT' AS status, 'Same Lookup maps to multiple distinct values in the source' AS reason FROM pobs
UNION ALL
SELECT '', k, '', observed, CAST(chunk AS INTEGER), 'NDC (product-level fallback)', 'DUPLICATE_CONFLICT',
       'NDC maps to multiple distinct values across customers; ambiguous at product level' FROM fobs
UNION ALL
SELECT DISTINCT customer, ndc_code, lookup, '', 0, '', 'NOT_FOUND', 'No record found by Lookup or by NDC in the source'
FROM r WHERE award_status = 'NOT_FOUND'""",
    "J3_award_conflict_rows": f"""WITH {AWARD_CTES},
pv AS (SELECT lk AS k, n, first(award ORDER BY {_LI_ORDER}) AS v, count(*) OVER (PARTITION BY lk) AS nv FROM s2
       WHERE lk IS NOT NULL AND n IS NOT NULL GROUP BY lk, n),
fv AS (SELECT nk AS k, n, first(award ORDER BY {_LI_ORDER}) AS v, count(*) OVER (PARTITION BY nk) AS nv FROM s2
       WHERE nk IS NOT NULL AND n IS NOT NULL GROUP BY nk, n)
SELECT '' AS ndc, k AS lookup, v AS value, 'Lookup (Customer+NDC)' AS match_strategy,
       'Same Lookup maps to multiple distinct values in the source' AS reason FROM pv WHERE nv > 1
UNION ALL
SELECT k, '', v, 'NDC (product-level fallback)', 'NDC maps to multiple distinct values across customers; ambiguous at product level'
FROM fv WHERE nv > 1""",
    "J6_comment_conflict_rows": f"""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS k, upper({clean('event_type')}) AS n, event_type, event_id FROM events),
v AS (SELECT k, n, first(event_type ORDER BY event_id) AS comments, count(*) OVER (PARTITION BY k) AS nv FROM e
      WHERE k IS NOT NULL AND n IS NOT NULL GROUP BY k, n)
SELECT k AS normalized_ndc, comments, 'DUPLICATE_CONFLICT' AS status FROM v WHERE nv > 1""",
    "E6_award_counters": f"""WITH {AWARD_CTES}
SELECT count(*) AS total_master_rows, count_if(award_status = 'MATCHED') AS matched_rows,
       count_if(award_status = 'MATCHED' AND award_strategy = 'Lookup (Customer+NDC)') AS matched_by_lookup,
       count_if(award_status = 'MATCHED' AND award_strategy = 'NDC (product-level fallback)') AS matched_by_ndc,
       count_if(award_status = 'NOT_FOUND') AS not_found_rows,
       count_if(award_status = 'DUPLICATE_CONFLICT') AS duplicate_conflict_rows,
       count(award_type) AS populated_rows
FROM r""",
    "E7_priority_lookup": f"""WITH {PRIO_CTES}
SELECT o_orderkey, buying_group, buying_group_source, buying_group_status FROM res""",
    "J4_priority_exceptions": f"""WITH {PRIO_CTES}
SELECT observed_keys AS customer, k AS normalized_customer, '' AS selected_value, observed AS rejected_value,
       CAST(chunk AS INTEGER) AS chunk, '' AS selected_source, source AS rejected_source, 'DUPLICATE_CONFLICT' AS status,
       'Multiple different values within one priority tier (' || source || ', priority ' || CAST(priority AS VARCHAR) || ')' AS reason
FROM chunks
UNION ALL
SELECT w.min_ko, o.k, coalesce(w.value, ''), coalesce(o.value, ''), 0, w.source, o.source, 'LOWER_PRIORITY_DISAGREEMENT',
       'Resolved by source priority: ' || w.source || ' (priority ' || CAST(w.priority AS VARCHAR) || ') outranks ' ||
       o.source || ' (priority ' || CAST(o.priority AS VARCHAR) || ')'
FROM tbl o JOIN win w ON o.k = w.k
WHERE (o.priority <> w.priority OR o.rnk <> w.rnk) AND upper({clean('o.value')}) IS NOT NULL
  AND upper({clean('w.value')}) IS NOT NULL AND upper({clean('o.value')}) <> upper({clean('w.value')})
UNION ALL
SELECT DISTINCT sold_to, upper({clean('sold_to')}), '', '', 0, '', '', 'NOT_FOUND', 'Customer not present in any configured source'
FROM res WHERE buying_group_status = 'NOT_FOUND' AND sold_to IS NOT NULL""",
    "G10_matches_by_source": f"""WITH {PRIO_CTES}
SELECT buying_group_source AS source, count(*) AS matched_rows FROM res WHERE buying_group_status = 'MATCHED'
GROUP BY buying_group_source""",
    "E8_latest_lookup": f"""WITH {_ev(True)}
SELECT c_custkey, sc_comments, sc_comments_status FROM res""",
    "J6_latest_exceptions": _ev_exceptions(True),
    "E8_conflict_lookup": f"""WITH {_ev(False)}
SELECT c_custkey, sc_comments, sc_comments_status FROM res""",
    "J6_conflict_exceptions": _ev_exceptions(False),
    "G8_master_statistics": f"""WITH {STAT_MASTER}
SELECT (SELECT count(*) FROM lineitem) AS original_rows, count(*) AS rows_after_merge,
       count(DISTINCT l_orderkey) AS unique_sales_orders, count(DISTINCT o_custkey) AS unique_customers,
       count(DISTINCT ndc_code) AS unique_ndcs,
       count(*) - count(DISTINCT ndc_code) - CASE WHEN count_if(ndc_code IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_ndcs,
       count(*) - count(DISTINCT lookup) - CASE WHEN count_if(lookup IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_lookups,
       count_if(material IS NULL) AS missing_0, count_if(moq IS NULL) AS missing_1, count_if(stock IS NULL) AS missing_2,
       count_if(buying_group IS NULL) AS missing_3, count_if(award IS NULL) AS missing_4,
       count_if(comments IS NULL) AS missing_5, count(*) AS missing_6,
       round(avg(CASE WHEN material IS NOT NULL AND moq IS NOT NULL AND stock IS NOT NULL AND buying_group IS NOT NULL
                      AND award IS NOT NULL AND comments IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100, 2) AS completion_pct
FROM x""",
    "E11_grain_check": f"""WITH {GRAIN_CTES}
SELECT o_orderkey, o_custkey FROM dropped""",
    "E11_grain_counts": f"""WITH {GRAIN_CTES}
SELECT (SELECT count(*) FROM o) AS rows_before, (SELECT count(*) FROM a) AS rows_after,
       (SELECT count(*) FROM dropped) AS dropped_keys""",
    "E15_membership": f"""WITH {MASTER},
ref AS (SELECT upper({clean("CASE WHEN c_acctbal > 0 THEN c_name ELSE c_name || ' closed' END")}) AS k FROM customer)
SELECT count(*) AS total, count_if(upper({clean('sold_to')}) IN (SELECT k FROM ref WHERE k IS NOT NULL)) AS matched,
       count(*) - count_if(upper({clean('sold_to')}) IN (SELECT k FROM ref WHERE k IS NOT NULL)) AS missing
FROM m""",
    "J10_key_health": f"""WITH {MASTER},
x AS (SELECT ndc_code, sold_to, {LOOKUP_EXPR} AS lookup FROM m)
SELECT count(*) AS total_rows, count(ndc_code) AS rows_with_ndc, count(sold_to) AS rows_with_customer,
       count(lookup) AS rows_with_lookup, count(*) - count(lookup) AS rows_missing_lookup
FROM x""",
    "E13_summary_enriched": f"""WITH {SUMMARY_INPUT},
d AS (
  SELECT {LOOKUP_EXPR} AS lookup, c_mktsegment AS bg, l_returnflag AS award,
         row_number() OVER (PARTITION BY {LOOKUP_EXPR} ORDER BY {_LI_ORDER}) AS rn
  FROM m)
SELECT s.lookup, s.material AS material_description, s.sold_to_name AS sold_to_party_name, s.ndc_code,
       d.bg AS buying_group, d.award AS award_type, CAST(NULL AS VARCHAR) AS sc_comments
FROM summ s LEFT JOIN d ON s.lookup = d.lookup AND d.rn = 1""",
})


# -- sources / profiling -----------------------------------------------------

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")
_TLIST = ", ".join(f"'{t}'" for t in _TABLES)
# a sheet per language in a workbook per source; its headers are the words of its documents
WORD_HEADERS = """hdr AS (
  SELECT DISTINCT workbook, sheet, header FROM (
    SELECT source AS workbook, lang AS sheet, unnest(string_split(text, ' ')) AS header FROM documents))"""

_NUM_RE = r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
_DATE_SHAPE_RE = r"[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)?"

CONV_SHEETS = f"""raw AS (
  SELECT CAST(conv_id AS VARCHAR) AS sheet, turn AS row_idx,
         list_concat([role, CAST(turn AS VARCHAR)], string_split(text, ' ')) AS cells
  FROM conversations),
cells AS (SELECT sheet, row_idx, unnest(cells) AS c FROM raw),
kinds AS (
  SELECT sheet, row_idx,
         CASE WHEN {clean('c')} IS NULL THEN 'blank'
              WHEN regexp_full_match(trim(c), '{_NUM_RE}') THEN 'numeric'
              WHEN regexp_full_match(trim(c), '{_DATE_SHAPE_RE}')
                   AND coalesce(try_strptime(trim(c), '%Y-%m-%d'), try_strptime(trim(c), '%Y-%m-%d %H:%M:%S'),
                                try_strptime(trim(c), '%m/%d/%Y'), try_strptime(trim(c), '%m/%d/%y')) IS NOT NULL THEN 'date'
              ELSE 'string' END AS k
  FROM cells),
rs AS (
  SELECT sheet, row_idx,
         CASE WHEN count_if(k <> 'blank') = 0 THEN -1000000000
              ELSE 3 * count_if(k = 'string') + 2 * count_if(k = 'date') + count_if(k <> 'blank') - count_if(k = 'numeric') END AS score,
         count_if(k <> 'blank') > 0 AS non_blank
  FROM kinds GROUP BY sheet, row_idx),
hr AS (
  SELECT sheet, first(row_idx ORDER BY score DESC, row_idx) AS header_idx, max(score) AS score,
         max(CASE WHEN non_blank THEN row_idx END) AS last_nb
  FROM rs GROUP BY sheet)"""

REGISTRY_VALUES = """reg(logical, header) AS (VALUES
  ('english', 'the'), ('english', 'and'), ('german', 'der'), ('german', 'die'), ('one_file', 'le'), ('one_file', 'que'),
  ('one_sheet', 'that'), ('unmatched_word', 'that'), ('dashed', 'TH-E'), ('spelled', 'THE'), ('spelled', 'And '),
  ('missing_src', 'no_such_column')),
meta(logical, preferred, keywords, mandatory) AS (VALUES
  ('english', []::VARCHAR[], []::VARCHAR[], true), ('german', ['de'], ['src7'], true),
  ('one_file', []::VARCHAR[], ['src11'], false), ('one_sheet', ['en'], ['src19'], true),
  ('unmatched_word', []::VARCHAR[], ['x_no_match'], false), ('dashed', []::VARCHAR[], []::VARCHAR[], false),
  ('spelled', []::VARCHAR[], ['src4'], false), ('missing_src', []::VARCHAR[], []::VARCHAR[], false))"""


def _discovery(norm: bool) -> str:
    hk = (lambda x: f"lower(trim(regexp_replace({x}, '[_\\-\\s]+', ' ', 'g')))") if norm else (lambda x: x)
    return f"""WITH {WORD_HEADERS},
{REGISTRY_VALUES},
r2 AS (SELECT DISTINCT logical, {hk('header')} AS hk FROM reg),
h2 AS (SELECT DISTINCT workbook, sheet, {hk('header')} AS hk FROM hdr),
need AS (SELECT logical, count(*) AS need FROM r2 GROUP BY logical),
hits AS (SELECT r2.logical, h2.workbook, h2.sheet, count(*) AS got FROM r2 JOIN h2 ON r2.hk = h2.hk GROUP BY ALL),
cands AS (SELECT hits.* FROM hits JOIN need USING (logical) WHERE got = need),
c AS (
  SELECT cands.logical, workbook, sheet, list_contains(preferred, sheet) AS pref,
         len(list_filter(keywords, lambda k: contains(lower(workbook), k))) > 0 AS kw, len(keywords) > 0 AS haskw
  FROM cands JOIN meta USING (logical)),
agg AS (
  SELECT logical, count(*) AS n, count(DISTINCT workbook) AS files, count_if(pref) AS n_pref, count_if(kw) AS n_kw,
         bool_or(haskw) AS has_kw, min(sheet) AS only_sheet, min(CASE WHEN pref THEN sheet END) AS pref_sheet,
         min(CASE WHEN kw THEN sheet END) AS kw_sheet,
         string_agg(workbook || '::' || sheet, ',' ORDER BY workbook || '::' || sheet) AS candidates
  FROM c GROUP BY logical),
d AS (
  SELECT m.logical, m.mandatory, a.candidates,
         CASE WHEN a.n = 1 THEN a.only_sheet WHEN a.n_pref = 1 THEN a.pref_sheet
              WHEN a.files > 1 AND a.has_kw AND a.n_kw = 1 THEN a.kw_sheet END AS pick
  FROM meta m LEFT JOIN agg a USING (logical))
SELECT logical, CASE WHEN candidates IS NULL THEN 'NOT_FOUND' WHEN pick IS NOT NULL THEN 'RESOLVED' ELSE 'AMBIGUOUS' END AS status,
       pick AS sheet{', coalesce(candidates, \'\') AS candidates, mandatory' if not norm else ''}
FROM d"""


def _profile_table(name: str, cols: list[tuple[str, str]], src: str) -> str:
    blank = " AND ".join(f"({clean(f'CAST({c} AS VARCHAR)')} IS NULL OR lower({clean(f'CAST({c} AS VARCHAR)')}) = 'nan')" for c, _ in cols)
    nonblank = " + ".join(
        f"CASE WHEN count_if(NOT ({clean(f'CAST({c} AS VARCHAR)')} IS NULL OR lower({clean(f'CAST({c} AS VARCHAR)')}) = 'nan')) = 0 THEN 1 ELSE 0 END"
        for c, _ in cols)
    size = " + ".join(f"coalesce(length({c}), 0)" if t == "string" else f"CASE WHEN {c} IS NOT NULL THEN 8 ELSE 0 END" for c, t in cols)
    names = ", ".join(c for c, _ in cols)
    return f"""SELECT '{name}' AS "table", count(*) AS rows, {len(cols)} AS columns, count_if({blank}) AS empty_rows,
       {nonblank} AS empty_columns,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {src})) AS duplicate_rows,
       CAST(coalesce(sum({size}), 0) AS BIGINT) AS text_bytes
FROM {src}"""


_CUSTOMER_COLS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]
_ORDERS_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


_LINEITEM_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
                  ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                  ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
# the priority on one side or the other, a null beside it
SWAPPED = """(SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS a, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS b FROM orders)"""


def _fingerprint(name: str, cols: list[tuple[str, str]]) -> str:
    """Doubles are compared as whole hundredths: engines print them differently."""
    texts = [f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" if t == "double" else f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if t.startswith("time")
             else f"CAST({c} AS VARCHAR)" for c, t in cols]
    row = " || ".join(f"coalesce(length({x}) || ':' || {x}, '~')" for x in texts)
    nulls = " || ".join(f"CASE WHEN {c} IS NULL THEN '0' ELSE '1' END" for c, _ in cols)
    bits = lambda x: f"CAST(coalesce(sum(('0x' || substr(md5({x}), 1, 15))::BIGINT::HUGEINT), 0) AS VARCHAR)"
    return f"""SELECT '{name}' AS "table", '{"|".join(c for c, _ in cols)}' AS headers, {len(cols)} AS columns, count(*) AS rows,
       {bits(row)} AS value_hash, {bits(nulls)} AS fill_hash FROM {name}"""


def _column_profile(cols, src, order):
    parts = []
    for i, (c, t) in enumerate(cols):
        txt = f"CAST({c} AS VARCHAR)"
        nb = f"NOT ({clean(txt)} IS NULL OR lower({clean(txt)}) = 'nan')"
        parts.append(f"""SELECT 'customer' AS "table", {i} AS position, '{c}' AS "column", '{t}' AS dtype,
       count_if({c} IS NULL) AS null_count, count_if({c} IS NULL) > 0 AS nullable, count(DISTINCT {c}) AS distinct_count,
       coalesce(first({txt} ORDER BY {order}) FILTER (WHERE {nb}), '') AS sample
FROM {src}""")
    return "\nUNION ALL\n".join(parts)


def _infer_types() -> str:
    cols = {
        "o_orderkey": "CAST(o_orderkey AS VARCHAR)", "o_custkey": "CAST(o_custkey AS VARCHAR)",
        "o_orderstatus": "o_orderstatus", "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
        "o_orderdate": "CAST(o_orderdate AS VARCHAR)", "o_orderpriority": "o_orderpriority",
        "is_final": "CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'No' END",
        "credit": "'(' || CAST(o_custkey AS VARCHAR) || ')'",
        "note": "CASE WHEN o_orderstatus = 'P' THEN ' ' END",
    }
    parts = []
    for i, (name, expr) in enumerate(cols.items()):
        t = f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"
        present = f"NOT ({clean(expr)} IS NULL OR lower({clean(expr)}) = 'nan')"
        num_text = f"regexp_replace(regexp_replace(regexp_replace({t}, ',', '', 'g'), '^\\((.*)\\)$', '-\\1'), '\\s', '', 'g')"
        is_num = f"regexp_full_match({num_text}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
        is_int = f"regexp_full_match({num_text}, '[+-]?[0-9]+(\\.0*)?')"
        is_bool = f"lower({t}) IN ('y', 'n', 'yes', 'no', 'true', 'false', '0', '1')"
        parsed = (f"coalesce(try_strptime({t}, '%Y-%m-%d'), try_strptime({t}, '%Y-%m-%d %H:%M:%S'), "
                  f"try_strptime({t}, '%m/%d/%y'), try_strptime({t}, '%m/%d/%Y'))")
        date_named = any(h in name.lower() for h in ("date", "eta", "time", "day"))
        parts.append(f"""SELECT 'orders' AS "table", {i} AS position, '{name}' AS "column",
       CASE WHEN count_if({present}) = 0 THEN 'Text'
            WHEN count_if({present} AND NOT {is_bool}) = 0 THEN 'Boolean'
            WHEN count_if({present} AND NOT {is_int}) = 0 THEN 'Integer'
            WHEN count_if({present} AND NOT {is_num}) = 0 THEN 'Decimal'
            WHEN {str(date_named).lower()} AND count_if({present} AND {parsed} IS NOT NULL) >= count_if({present}) * 0.7 THEN 'Date'
            ELSE 'Text' END AS logical_type
FROM orders""")
    return "\nUNION ALL\n".join(parts)


JOIN_HINT_VALUES = """hints(key_name, hint) AS (VALUES
  ('article', 'the'), ('article', 'DER'), ('article', 'le'), ('conjunction', 'and'), ('conjunction', ' UND '),
  ('relative', 'that'), ('relative', 'que'), ('rare', 'edthe'), ('absent', 'no_such_header'))"""

SQL.update({
    "A3_header_rows": f"""WITH {CONV_SHEETS}
SELECT sheet, header_idx, CAST(score AS INTEGER) AS score, coalesce(last_nb > header_idx, false) AS has_data FROM hr""",
    "C5_header_issues": f"""WITH {CONV_SHEETS},
hdrs AS (
  SELECT r.sheet, unnest(r.cells) AS header, generate_subscripts(r.cells, 1) - 1 AS position
  FROM raw r JOIN hr ON r.sheet = hr.sheet AND r.row_idx = hr.header_idx)
SELECT sheet, 'DUPLICATE_HEADERS' AS code, header AS detail FROM hdrs WHERE {clean('header')} IS NOT NULL
GROUP BY sheet, header HAVING count(*) > 1
UNION ALL
SELECT sheet, 'BLANK_HEADERS', 'position ' || CAST(position AS VARCHAR) FROM hdrs WHERE {clean('header')} IS NULL""",
    "D8_fingerprint": "\nUNION ALL\n".join([_fingerprint("orders", _ORDERS_COLS), _fingerprint("lineitem", _LINEITEM_COLS)]),
    "A2_discover_sources": _discovery(False),
    "A6_discover_normalized": _discovery(True),
    "C4_validation_issues": f"""WITH staged AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'X' THEN 'never' END AS o_comment,
         CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE o_orderpriority END AS o_orderpriority FROM orders),
br AS (SELECT CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey AS VARCHAR) END AS k,
              CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS s FROM staged),
issues("table", severity, code, detail) AS (VALUES
  ('orders_src', 'ERROR', 'MISSING_REQUIRED_COLUMN', 'o_custkey'),
  ('orders_src', 'WARNING', 'MISSING_OPTIONAL_COLUMN', 'o_clerk'),
  ('uploads', 'WARNING', 'MISSING_OPTIONAL_WORKBOOK', 'uploads'),
  ('awards', 'ERROR', 'MISSING_WORKBOOK', 'awards'))
SELECT * FROM issues
UNION ALL
SELECT 'orders_src', 'WARNING', 'EMPTY_COLUMNS', c FROM (
  SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_comment', 'o_orderpriority']) AS c,
         unnest([count_if({clean('CAST(o_orderkey AS VARCHAR)')} IS NOT NULL), count_if({clean('o_orderstatus')} IS NOT NULL),
                 count_if({clean('o_comment')} IS NOT NULL), count_if({clean('o_orderpriority')} IS NOT NULL)]) AS nb
  FROM staged) WHERE nb = 0
UNION ALL
SELECT 'orders_src', 'WARNING', 'EMPTY_ROWS', CAST(n AS VARCHAR) || ' empty rows' FROM (
  SELECT count_if({clean('CAST(o_orderkey AS VARCHAR)')} IS NULL AND {clean('o_orderstatus')} IS NULL
                  AND {clean('o_comment')} IS NULL AND {clean('o_orderpriority')} IS NULL) AS n FROM staged) WHERE n > 0
UNION ALL
SELECT 'blank_rows', 'WARNING', 'EMPTY_ROWS', CAST(n AS VARCHAR) || ' empty rows' FROM (
  SELECT count_if({clean('k')} IS NULL AND {clean('s')} IS NULL) AS n FROM br) WHERE n > 0
UNION ALL
SELECT 'blank_rows', 'WARNING', 'EMPTY_COLUMNS', c FROM (
  SELECT unnest(['k', 's']) AS c, unnest([count_if({clean('k')} IS NOT NULL), count_if({clean('s')} IS NOT NULL)]) AS nb FROM br)
WHERE nb = 0""",
    "D1_table_profile": "\nUNION ALL\n".join([
        _profile_table("customer", _CUSTOMER_COLS, "customer"),
        _profile_table("orders", _ORDERS_COLS, "orders"),
        _profile_table("lineitem", _LINEITEM_COLS, "lineitem"),
        _profile_table("swapped", [("a", "string"), ("b", "string")], SWAPPED),
    ]),
    "D2_column_profile": _column_profile(_CUSTOMER_COLS, "customer", "c_custkey"),
    "D4_infer_types": _infer_types(),
    "D6_join_key_candidates": f"""WITH {WORD_HEADERS},
{JOIN_HINT_VALUES},
h AS (SELECT workbook, sheet, lower(trim(regexp_replace(header, '\\s+', ' ', 'g'))) AS h FROM hdr),
hn AS (SELECT key_name, lower(trim(regexp_replace(hint, '\\s+', ' ', 'g'))) AS h FROM hints),
tot AS (SELECT count(DISTINCT workbook) AS tw, count(DISTINCT (workbook, sheet)) AS ts FROM hdr),
f AS (SELECT key_name, count(DISTINCT workbook) AS workbook_count, count(DISTINCT (workbook, sheet)) AS worksheet_count
      FROM h JOIN hn USING (h) GROUP BY key_name)
SELECT key_name, workbook_count, worksheet_count,
       round((workbook_count / tw * 0.7 + worksheet_count / ts * 0.3) * 100, 2) AS confidence_pct
FROM f, tot""",
    "D7_recommended_keys": f"""WITH {WORD_HEADERS},
p AS (SELECT workbook, list(header) AS hs FROM hdr GROUP BY workbook)
SELECT workbook AS table_name, concat_ws(',',
  CASE WHEN list_contains(hs, 'the') THEN 'english' END,
  CASE WHEN list_contains(hs, 'der') AND list_contains(hs, 'die') THEN 'german' END,
  CASE WHEN list_contains(hs, 'edthe') THEN 'rare' END,
  CASE WHEN list_contains(hs, 'no_such_header') THEN 'none' END) AS keys
FROM p""",
    "D3_column_dictionary": f"""WITH cols AS (SELECT column_name AS "column" FROM information_schema.columns WHERE table_name = 'orders')
SELECT "column",
  CASE WHEN lower("column") IN ('c_custkey', 'o_custkey', 'customer key') THEN 'customer_key'
       WHEN lower("column") IN ('o_orderkey', 'l_orderkey') THEN 'order_key'
       WHEN lower("column") IN ('p_partkey', 'l_partkey', 'ps_partkey') THEN 'part_key'
       WHEN lower("column") IN ('doc_id') THEN 'document'
       WHEN lower("column") IN ('n_nationkey', 'c_nationkey', 's_nationkey') THEN 'nation'
       WHEN lower("column") IN ('no_such_header') THEN 'absent' ELSE 'UNKNOWN' END AS join_key,
  CASE WHEN contains(lower("column"), 'ndc') THEN 'Potential National Drug Code field'
       WHEN contains(lower("column"), 'material') THEN 'Potential material identifier or description'
       WHEN contains(lower("column"), 'customer') OR contains(lower("column"), 'sold-to') OR contains(lower("column"), 'sold to')
            THEN 'Potential customer/account field'
       WHEN contains(lower("column"), 'qty') OR contains(lower("column"), 'quantity') THEN 'Potential quantity field'
       WHEN contains(lower("column"), 'date') THEN 'Potential date field'
       WHEN contains(lower("column"), 'lookup') THEN 'Potential composite lookup key' ELSE 'UNKNOWN' END AS business_meaning
FROM cols""",
})


# -- cleaning, key table, validation table, audits ---------------------------

def _stz(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+\\.0+') THEN split_part({x}, '.', 1) ELSE {x} END"


def _num(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{_NUM_RE}') THEN CAST(trim({x}) AS DOUBLE) END"


_PRIO_SOURCES = (("Buying Groups", 1, "g"), ("Sales Trend", 2, "t"), ("Open Orders", 3, "op"))

SQL.update({
    "C1_clean_columns": f"""WITH base AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '.0' AS order_no, ' ' || CAST(o_custkey AS VARCHAR) || '  ' AS customer,
         CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS amount, o_orderpriority || chr(9) AS priority,
         o_orderstatus AS status
  FROM orders),
u AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE status = 'P'),
c AS (SELECT {clean('order_no')} AS a, {clean('customer')} AS b, {clean('amount')} AS c, {clean('priority')} AS d, status FROM u),
s AS (SELECT {_stz('a')} AS a, {_stz('b')} AS b, {_stz('c')} AS c, {_stz('d')} AS d, status FROM c)
SELECT DISTINCT {_num('a')} AS order_no, b AS customer, {_num('c')} AS amount, d AS priority, status FROM s""",
    "B13_lookup_key_table": f"""WITH {MASTER}
SELECT {LOOKUP_EXPR} AS lookup, ndc_code AS ndc, sold_to AS customer, c_name AS customer_name FROM m""",
    "B14_key_change_counters": f"""WITH {MASTER},
x AS (SELECT regexp_replace(ndc_code, '^\\s+|\\s+$', '', 'g') AS on_, {digits('ndc_code')} AS nk,
             regexp_replace(sold_to, '^\\s+|\\s+$', '', 'g') AS oc, upper({clean('sold_to')}) AS ck, {LOOKUP_EXPR} AS lk FROM m)
SELECT count(*) AS rows,
       count_if(on_ IS NOT NULL AND nk IS NOT NULL AND on_ <> nk) AS ndc_changed,
       count_if(oc IS NOT NULL AND ck IS NOT NULL AND oc <> ck) AS customer_changed,
       count(lk) - count(DISTINCT lk) AS duplicate_lookups
FROM x""",
    "F6_moq_validation": f"""WITH {MOQ_INPUT}
SELECT l_orderkey AS sales_order, l_partkey AS material, s AS pack_size, q AS sales_order_qty,
       CASE WHEN s IS NOT NULL AND q IS NOT NULL AND s <> 0 THEN (q / s <> floor(q / s)) ELSE true END AS moq_issue
FROM mi""",
    "J5_priority_audit": f"""WITH {PRIO_CTES},
counts AS (
  SELECT count(*) AS total, count_if(buying_group_status = 'MATCHED') AS matched,
         count_if(buying_group_status = 'NOT_FOUND') AS nf, count_if(buying_group_status = 'DUPLICATE_CONFLICT') AS dc,
         count(buying_group) AS populated, count_if(buying_group IS NULL) AS blank
  FROM res),
dis AS (
  SELECT count(*) AS n FROM tbl o JOIN win w ON o.k = w.k
  WHERE (o.priority <> w.priority OR o.rnk <> w.rnk) AND upper({clean('o.value')}) IS NOT NULL
    AND upper({clean('w.value')}) IS NOT NULL AND upper({clean('o.value')}) <> upper({clean('w.value')})),
dups AS (SELECT sum(c) AS n FROM (SELECT source, count(*) - count(DISTINCT (k, n)) AS c FROM nn GROUP BY source))
SELECT * FROM (VALUES
  ('Total master rows', (SELECT CAST(total AS VARCHAR) FROM counts)),
  ('Master rows after merge', (SELECT CAST(total AS VARCHAR) FROM counts)),
  ('Matched rows', (SELECT CAST(matched AS VARCHAR) FROM counts)),
  ('NOT_FOUND rows', (SELECT CAST(nf AS VARCHAR) FROM counts)),
  ('DUPLICATE_CONFLICT rows', (SELECT CAST(dc AS VARCHAR) FROM counts)),
  ('Populated rows', (SELECT CAST(populated AS VARCHAR) FROM counts)),
  ('Blank rows', (SELECT CAST(blank AS VARCHAR) FROM counts)),
  ('Unique master customers', (SELECT CAST(count(DISTINCT upper({clean('sold_to')})) AS VARCHAR) FROM mst)),
  ('Unique consolidated source customers', (SELECT CAST(count(*) AS VARCHAR) FROM win)),
  ('Same-priority conflicting customers', (SELECT CAST(count_if(status = 'DUPLICATE_CONFLICT') AS VARCHAR) FROM win)),
  ('Lower-priority disagreements', (SELECT CAST(n AS VARCHAR) FROM dis)),
  ('Exact duplicate source rows removed', (SELECT CAST(n AS VARCHAR) FROM dups)),
  {", ".join(f"('Source record count - {n} (priority {p})', (SELECT CAST(count(*) AS VARCHAR) FROM {t}))" for n, p, t in _PRIO_SOURCES)},
  {", ".join(f"('Master rows matched from {n}', (SELECT CAST(count_if(buying_group_status = 'MATCHED' AND buying_group_source = '{n}') AS VARCHAR) FROM res))" for n, p, t in _PRIO_SOURCES)}
) v(metric, value)
UNION ALL
SELECT DISTINCT 'Final source for customer ''' || sold_to || '''', buying_group_source || ' -> ' || buying_group
FROM res WHERE buying_group_status = 'MATCHED'""",
    "J8_summary_audit": f"""WITH {SUMMARY_INPUT},
{REPORT_MONTH},
hk AS (SELECT DISTINCT upper({clean("CASE WHEN c_acctbal > 0 THEN c_name ELSE c_name || ' closed' END")}) AS k FROM customer)
SELECT (SELECT count(*) FROM m) AS total_master_rows, (SELECT count(*) FROM summ) AS aggregated_rows,
       (SELECT count(DISTINCT lookup) FROM summ) AS unique_lookup_values,
       (SELECT count(lookup) - count(DISTINCT lookup) FROM summ) AS duplicate_lookup_values,
       (SELECT CAST(year(p) AS INTEGER) FROM rp) AS reporting_year, (SELECT CAST(month(p) AS INTEGER) FROM rp) AS reporting_month,
       (SELECT count_if(upper({clean('sold_to')}) IN (SELECT k FROM hk WHERE k IS NOT NULL)) FROM m) AS historical_matches,
       (SELECT count(*) - count_if(upper({clean('sold_to')}) IN (SELECT k FROM hk WHERE k IS NOT NULL)) FROM m) AS historical_misses""",
})


# -- the whole flow ---------------------------------------------------------

_PAD_NDC = f"{pad('l_partkey', 5)} || '-' || {pad('l_suppkey', 4)} || '-01'"

_LOOKUP_KEY = f"upper({clean('lookup')})"


def _firsts(name: str, src: str, key: str, order: str) -> str:
    """E1's build side: the first row per normalised key."""
    return f"""{name} AS (SELECT * FROM (SELECT *, {key} AS k, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1 AND k IS NOT NULL)"""


FLOW_CTES = f"""{MASTER},
fm AS (
  SELECT {_LI_ORDER}, o_orderdate, l_orderkey AS order_number, l_linenumber AS item_number,
         CASE WHEN l_returnflag <> 'A' THEN CAST(l_partkey AS VARCHAR) END AS material_code0, ndc_code AS ndc, sold_to AS customer,
         CASE WHEN p_type <> 'SMALL' THEN p_name END AS description0, p_size * 10 AS total_stock,
         CASE WHEN p_type <> 'PROMO' THEN p_size END AS pack_size0, l_quantity AS quantity,
         CASE WHEN l_linestatus = 'O' THEN l_quantity * 2 END AS mtd0, CASE WHEN l_returnflag = 'N' THEN l_quantity * 3 END AS forecast0,
         o_custkey, c_mktsegment, l_extendedprice AS unit_price, round(l_extendedprice * l_quantity, 2) AS sales_value,
         CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE round(l_extendedprice, 0) END AS reference_price, c_name, p_type, l_returnflag,
         CASE WHEN l_returnflag = 'R' THEN ' Cancel' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'HOLD ' ELSE '' END AS action,
         {LOOKUP_EXPR} AS lookup, {digits('ndc_code')} AS nk
  FROM m),
fpart AS (
  SELECT CAST(p_partkey AS VARCHAR) AS k, 'M: ' || p_name AS description, CASE WHEN p_type <> 'LARGE' THEN p_size + 1 END AS moq FROM part),
fli AS (SELECT *, {_PAD_NDC} AS ndcx FROM lineitem),
finv AS (
  SELECT {_LI_ORDER}, CASE WHEN l_linestatus = 'O' THEN ndcx ELSE replace(ndcx, '-', '') END AS ndc, l_quantity AS actual_quantity,
         l_quantity * 40 AS inventory, l_linenumber AS allocated_quantity, l_returnflag AS description, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS hold
  FROM fli),
foo AS (
  SELECT {_LI_ORDER}, {pad('l_partkey', 5)} || '-' || {pad('l_suppkey', 3)} || '-01' AS sku, l_quantity AS total,
         CASE WHEN l_returnflag <> 'A' THEN 'Pick Completed' WHEN l_linestatus = 'F' THEN 'Loaded' ELSE 'Open' END AS status,
         ' ' || c_name || ' ' AS customer, CASE WHEN p_type <> 'PROMO' THEN substr(c_mktsegment, 1, 4) ELSE '  ' END AS customer_group
  FROM m),
fgr AS (
  SELECT c_name AS customer, CASE WHEN c_nationkey < 10 THEN c_mktsegment END AS buying_group, c_custkey, 0 AS r FROM customer
  UNION ALL SELECT c_name, CASE WHEN c_nationkey < 3 AND c_acctbal < 0 THEN 'Special' END, c_custkey, 1 FROM customer),
ftrk AS (
  SELECT {_LI_ORDER}, ndcx AS ndc, CASE WHEN l_linestatus = 'O' THEN 'Backorder' ELSE 'Shipped' END AS comments, l_linestatus AS customer_eta FROM fli),
fsold AS (
  SELECT {_LI_ORDER}, ndc_code AS ndc, {LOOKUP_EXPR} AS lookup, CASE WHEN p_size > 25 THEN p_size + 2 END AS summary_pack_size, l_quantity AS quantity,
         l_quantity * 5 AS quantity_mtd, l_quantity * 7 AS forecast, 'S: ' || p_name AS material_description
  FROM m),
fper AS (
  SELECT mm AS p FROM (SELECT date_trunc('month', o_orderdate) AS mm, count(*) AS c FROM fm GROUP BY 1)
  ORDER BY c DESC, mm LIMIT 1),
ftrend AS (
  SELECT lookup, l_linestatus AS status,
         CASE WHEN min(c_mktsegment) = 'HOUSEHOLD' THEN min(c_name) || ' closed' ELSE lower(min(c_name)) END AS customer,
         CASE WHEN max(p_size) > 40 THEN 'Retail' ELSE min(c_mktsegment) END AS customer_group,
         'C' || CAST(min(l_suppkey) AS VARCHAR) AS contract_id, 'T: ' || min(p_name) AS material_description,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 3 MONTH THEN floor(l_extendedprice) END) AS m1,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 2 MONTH THEN floor(l_extendedprice) END) AS m2,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 1 MONTH THEN floor(l_extendedprice) END) AS m3
  FROM (SELECT *, {LOOKUP_EXPR} AS lookup FROM m), fper WHERE lookup IS NOT NULL GROUP BY lookup, l_linestatus),
fstock AS (
  SELECT k AS ndc, coalesce(sum(inventory), 0) AS inventory
  FROM (SELECT {digits('ndc')} AS k, inventory FROM finv WHERE trim(coalesce(hold, '')) = '') WHERE k IS NOT NULL GROUP BY k),
falloc AS (
  SELECT ndc, sum(total) AS total FROM (
    SELECT CASE WHEN len(s) = 3 AND regexp_full_match(s[1], '[0-9]{{5}}') AND regexp_full_match(s[2], '[0-9]{{3}}')
                     AND regexp_full_match(s[3], '[0-9]{{2}}') THEN s[1] || lpad(s[2], 4, '0') || s[3] END AS ndc, total
    FROM (SELECT string_split(sku, '-') AS s, total FROM foo WHERE upper(trim(status)) NOT IN ('PICK COMPLETED', 'LOADED')))
  WHERE ndc IS NOT NULL GROUP BY ndc),
fup AS (
  SELECT {digits('ndcx')} AS ndc, sum(l_quantity) AS upload_qty FROM fli
  WHERE l_returnflag = 'R' AND CAST(l_linenumber AS VARCHAR) IN ('1', '4') AND l_tax < 0.04
  GROUP BY 1),
fnet AS (
  SELECT coalesce(s.ndc, a.ndc) AS ndc, s.ndc IS NOT NULL AS stocked, a.ndc IS NOT NULL AS allocated, coalesce(a.total, 0) AS total,
         greatest(coalesce(s.inventory, 0) - coalesce(a.total, 0) - coalesce(u.upload_qty, 0), 0) AS ups_inventory
  FROM fstock s FULL OUTER JOIN falloc a ON s.ndc = a.ndc LEFT JOIN fup u ON u.ndc = coalesce(s.ndc, a.ndc)),
fsc AS (
  SELECT k, CASE WHEN count(DISTINCT upper(comments)) = 1 THEN first(comments ORDER BY {_LI_ORDER})
                 ELSE first(comments ORDER BY l_shipdate DESC NULLS LAST, {_LI_ORDER}) END AS value
  FROM (SELECT *, {digits('ndc')} AS k FROM ftrk) WHERE k IS NOT NULL GROUP BY k),
faw0 AS (
  SELECT m.* REPLACE (CASE WHEN l_shipdate >= TIMESTAMP '1997-01-01' THEN '99999-9999-99' ELSE ndc_code END AS ndc_code),
         CASE WHEN l_returnflag = 'R' THEN 'Secondary' ELSE 'Primary' END AS award FROM m),
faw AS (SELECT {_LI_ORDER}, award, {LOOKUP_EXPR} AS lk, {digits('ndc_code')} AS nk FROM faw0),
fpt AS (
  SELECT lk AS k, CASE WHEN count(DISTINCT award) = 1 THEN first(award ORDER BY {_LI_ORDER}) END AS value,
         CASE WHEN count(DISTINCT award) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status
  FROM faw WHERE lk IS NOT NULL GROUP BY lk),
fft AS (
  SELECT nk AS k, CASE WHEN count(DISTINCT award) = 1 THEN first(award ORDER BY {_LI_ORDER}) END AS value,
         CASE WHEN count(DISTINCT award) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status
  FROM faw WHERE nk IS NOT NULL GROUP BY nk),
ftier AS (
  SELECT 'Buying Groups' AS source, 1 AS priority, upper({clean('customer')}) AS k, upper({clean('buying_group')}) AS n, buying_group AS v, CAST(r AS VARCHAR) AS o0, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS o1 FROM fgr
  UNION ALL SELECT 'Sales Trend', 2, upper({clean('customer')}), upper({clean('customer_group')}), customer_group, lookup, status FROM ftrend
  UNION ALL SELECT 'Open Orders', 3, upper({clean('customer')}), upper({clean('customer_group')}), customer_group, '', '' FROM foo),
ftbl AS (
  SELECT source, priority, k, count(*) AS n_rows, count(DISTINCT n) AS n_values, min(n) AS n,
         CASE WHEN count(DISTINCT n) = 1 THEN first(v ORDER BY o0, o1) END AS value,
         CASE WHEN count(DISTINCT n) = 1 THEN 'MATCHED' ELSE 'DUPLICATE_CONFLICT' END AS status
  FROM ftier WHERE k IS NOT NULL AND n IS NOT NULL GROUP BY source, priority, k),
fwin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY priority) AS rn FROM ftbl) WHERE rn = 1),
{_firsts('x2', 'finv', digits('ndc'), _LI_ORDER)},
{_firsts('x3', 'foo', f"upper({clean('customer')})", _LI_ORDER)},
{_firsts('x4', 'fsold', _LOOKUP_KEY, _LI_ORDER)},
{_firsts('x5', 'ftrend', _LOOKUP_KEY, 'lookup, status')},
{_firsts('x6', 'ftrk', digits('ndc'), _LI_ORDER)},
fd AS (
  SELECT fm.*, material_code0 AS material_code, coalesce(description0, x1.description, x4.material_description, x5.material_description) AS description,
         coalesce(mtd0, x4.quantity_mtd) AS mtd, coalesce(forecast0, x4.forecast) AS forecast,
         coalesce(x4.summary_pack_size, x1.moq, pack_size0) AS pack_size, x1.moq, x2.actual_quantity, x6.comments, fn.ups_inventory,
         x1.k IS NOT NULL AS h1, x2.k IS NOT NULL AS h2, x3.k IS NOT NULL AS h3, x4.k IS NOT NULL AS h4, x5.k IS NOT NULL AS h5, x6.k IS NOT NULL AS h6,
         sc.value AS sc_comments, CASE WHEN pa.status IS NOT NULL THEN pa.value WHEN fa.status IS NOT NULL THEN fa.value END AS award_type,
         coalesce(pa.status, fa.status, 'NOT_FOUND') AS award_status, pa.status IS NOT NULL AS by_lookup,
         w.value AS buying_group, x5.m1, x5.m2, x5.m3,
         (coalesce(x5.m1, 0) + coalesce(x5.m2, 0) + coalesce(x5.m3, 0)) /
           nullif(CAST(x5.m1 IS NOT NULL AS INTEGER) + CAST(x5.m2 IS NOT NULL AS INTEGER) + CAST(x5.m3 IS NOT NULL AS INTEGER), 0) AS average
  FROM fm LEFT JOIN fpart x1 ON material_code0 = x1.k
  LEFT JOIN x2 ON fm.nk = x2.k LEFT JOIN x3 ON upper({clean('fm.customer')}) = x3.k LEFT JOIN x4 ON fm.lookup = x4.k
  LEFT JOIN x5 ON fm.lookup = x5.k LEFT JOIN x6 ON fm.nk = x6.k
  LEFT JOIN fnet fn ON fm.nk = fn.ndc LEFT JOIN fsc sc ON fm.nk = sc.k
  LEFT JOIN fpt pa ON fm.lookup = pa.k LEFT JOIN fft fa ON fm.nk = fa.k
  LEFT JOIN fwin w ON upper({clean('fm.customer')}) = w.k),
fr AS (
  SELECT fd.*,
         coalesce(regexp_matches(description, '{KW}'), false) AS controlled,
         (coalesce(unit_price, 0) = 0) OR (unit_price - reference_price <> 0) AS price_issue,
         CASE WHEN pack_size IS NOT NULL AND pack_size <> 0 THEN
              ((quantity / pack_size - floor(quantity / pack_size)) > 1e-6
               AND (1 - (quantity / pack_size - floor(quantity / pack_size))) > 1e-6) ELSE false END AS moq_issue,
         coalesce(ups_inventory < 10000, false) AS low_stock,
         CASE lower(trim(action)) WHEN 'cancel' THEN 'FF0000' WHEN 'hold' THEN 'ADD8E6' END AS act,
         CASE WHEN pack_size IS NOT NULL AND pack_size <> 0 THEN
              NOT ((quantity - pack_size * floor(quantity / pack_size)) <= 1e-9
                   OR (pack_size - (quantity - pack_size * floor(quantity / pack_size))) <= 1e-9) ELSE false END AS moq_rem
  FROM fd),
ff AS (
  SELECT fr.*, coalesce(act, CASE WHEN controlled THEN 'FFC0CB' END) AS row_fill,
         coalesce(act, CASE WHEN price_issue THEN 'FFA500' END, CASE WHEN controlled THEN 'FFC0CB' END) AS price_fill,
         coalesce(act, CASE WHEN moq_rem THEN 'FFFF00' END, CASE WHEN controlled THEN 'FFC0CB' END) AS qty_fill
  FROM fr),
fsum AS (
  SELECT description, customer, lookup, ndc, max(ups_inventory) AS max_ups, coalesce(sum(quantity), 0) AS sum_qty, max(mtd) AS max_mtd, max(forecast) AS max_forecast
  FROM ff GROUP BY description, customer, lookup, ndc),
fcount AS (
  SELECT count(*) AS n, count_if(controlled) AS controlled, count_if(price_issue) AS price, count_if(moq_issue) AS moq, count_if(low_stock) AS low,
         count_if(h5) AS hist, count_if(sc_comments IS NULL) AS no_comment, count_if(buying_group IS NULL) AS no_group, count_if(award_type IS NULL) AS no_award,
         (SELECT count(DISTINCT ndc) FROM ff) AS ndcs, (SELECT count(DISTINCT lookup) FROM ff) AS lookups,
         (SELECT count(*) - count(DISTINCT upper({clean('lookup')})) FROM ftrend) AS repeated
  FROM ff)"""


def _merge_row(name: str, src: str, own: str, payload: tuple[str, ...], added: str, join_key: str, label: str, skey: str, mkey: str, hit: str) -> str:
    """J1's row of one enriching source."""
    more = [f"count(DISTINCT CAST({c} AS VARCHAR)) > 1 AS x{i}" for i, c in enumerate(payload)]
    conflicts = " + ".join(f"CAST(x{i} AS INTEGER)" for i in range(len(payload)))
    return f"""SELECT '{name}' AS source, '{added}' AS columns_added, '{join_key}' AS join_key, (SELECT count_if({hit}) FROM fd) AS rows_updated,
       (SELECT count(*) FROM (SELECT DISTINCT {skey} AS k FROM {src}) WHERE k IS NOT NULL AND k NOT IN (SELECT {mkey} FROM fm WHERE {mkey} IS NOT NULL)) AS rows_missing,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_keys_found,
       '{label}; conflicting values=' || CAST(CAST(coalesce(sum(CASE WHEN n >= 2 THEN {conflicts} ELSE 0 END), 0) AS BIGINT) AS VARCHAR) AS comments
FROM (SELECT {own}, count(*) AS n, {', '.join(more)} FROM {src} GROUP BY {own})"""


_MERGE_ROWS = [
    _merge_row("moq", "(SELECT *, k AS material_code FROM fpart)", "material_code", ("description", "moq"), "moq", "material_code", "Material Number", "material_code", "material_code0", "h1"),
    _merge_row("inventory", "finv", "ndc", ("actual_quantity", "inventory", "allocated_quantity", "description"),
               "actual_quantity, inventory, allocated_quantity, description", "ndc", "NDC Code", digits("ndc"), "nk", "h2"),
    _merge_row("open_order_summary", "foo", "customer", ("total", "sku"), "total, sku", "customer", "Sold To Party Name",
               f"upper({clean('customer')})", f"upper({clean('customer')})", "h3"),
    _merge_row("sales_summary", "fsold", "lookup", ("quantity", "quantity_mtd", "forecast", "material_description", "summary_pack_size"),
               "summary_pack_size", "lookup", "Lookup", _LOOKUP_KEY, "lookup", "h4"),
    _merge_row("sales_trend", "ftrend", "lookup", ("material_description", "customer_group", "contract_id"), "customer_group, contract_id", "lookup", "Lookup", _LOOKUP_KEY, "lookup", "h5"),
    _merge_row("critical_inventory_tracker", "(SELECT *, NULL AS description FROM ftrk)", "ndc", ("comments", "customer_eta"), "comments, customer_eta", "ndc", "NDC Code", digits("ndc"), "nk", "h6"),
]


def _metric_rows(table: str, values: dict[str, str], only_positive: bool = False) -> str:
    rows = ", ".join(f"('{table}', '{k}', CAST(({v}) AS BIGINT))" for k, v in values.items())
    return f"SELECT t AS \"table\", metric, CAST(v AS VARCHAR) AS value FROM (VALUES {rows}) x(t, metric, v){' WHERE v > 0' if only_positive else ''}"


def _c(what: str) -> str:
    return f"SELECT {what} FROM fcount"


_RUN_COUNTS = {
    "Total Master Rows": _c("n"), "Unique NDCs": _c("ndcs"), "Unique Lookup Values": _c("lookups"), "Controlled Products": _c("controlled"),
    "Price Issues": _c("price"), "MOQ Issues": _c("moq"), "Low UPS Inventory Rows": _c("low"), "Historical Sales Matches": _c("hist"),
    "Historical Sales Misses": _c("n - hist"), "Missing SC Comments": _c("no_comment"), "Missing Buying Groups": _c("no_group"), "Missing Awards": _c("no_award"),
}
_RUN_EXCEPTIONS = {
    "MISSING_HISTORICAL_SALES": _c("n - hist"), "DUPLICATE_HISTORICAL_KEY": _c("repeated"), "MISSING_SC_COMMENTS": _c("no_comment"),
    "MISSING_BUYING_GROUP": _c("no_group"), "MISSING_AWARD": _c("no_award"), "PRICE_ISSUE": _c("price"), "MOQ_ISSUE": _c("moq"), "LOW_UPS_INVENTORY": _c("low"),
}
_SUMMARY_COUNTS = {
    "Total Master Rows": _c("n"), "Aggregated Rows": "SELECT count(*) FROM fsum", "Unique Lookup Values": _c("lookups"),
    "Duplicate Lookup Values": "SELECT count(lookup) - count(DISTINCT lookup) FROM fsum", "Reporting Year": "SELECT year(p) FROM fper",
    "Reporting Month": "SELECT month(p) FROM fper", "Historical Matches": _c("hist"), "Historical Misses": _c("n - hist"), "Duplicate Historical Keys": _c("repeated"),
}
_DERIVED_COUNTS = {
    "Inventory Rows": "SELECT count_if(stocked) FROM fnet", "Allocated Rows": "SELECT count_if(allocated) FROM fnet",
    "Unique NDCs": "SELECT count(ndc) FROM fnet", "Missing Inventory": "SELECT count_if(allocated AND NOT stocked) FROM fnet",
    "Missing Allocations": "SELECT count_if(total = 0) FROM fnet",
    "MOQ Failures": """SELECT count_if(CASE WHEN summary_pack_size IS NOT NULL AND summary_pack_size <> 0
      THEN quantity / summary_pack_size <> floor(quantity / summary_pack_size) ELSE true END) FROM fsold""",
}

SQL.update({
    "FLOW_detail": f"""WITH {FLOW_CTES}
SELECT order_number AS sales_order_no, item_number AS item_no, lookup, material_code AS matl_code, ndc AS ndc_code, description AS material_description,
       total_stock AS total_stock_in_hand, round(ups_inventory, 4) AS ups_inventory, CAST(pack_size AS VARCHAR) AS pack_size_moq, round(quantity, 4) AS sales_order_qty,
       round(mtd, 4) AS sales_qty_mtd, round(forecast, 4) AS forecast_qty, o_custkey AS sold_to_party, customer AS sold_to_party_name, action,
       c_mktsegment AS s_o_type, round(unit_price, 4) AS unit_price, round(sales_value, 4) AS sales_value_fc, round(reference_price, 4) AS wac_bg_price_in_edi,
       'PO' || CAST(order_number AS VARCHAR) AS po_number, o_orderdate AS po_date, o_custkey AS ship_to_party, c_name AS ship_to_party_name, p_type AS street,
       c_mktsegment AS city, CAST(NULL AS VARCHAR) AS region, {pad('o_custkey', 5)} AS postal_code, CAST(NULL AS VARCHAR) AS country, l_returnflag AS reas_rej,
       CAST(NULL AS VARCHAR) AS reason_for_rejection, CAST(NULL AS VARCHAR) AS material_blk, CAST(NULL AS VARCHAR) AS floor_limit_blk,
       CAST(NULL AS VARCHAR) AS multiple_of_moq_blk, CAST(NULL AS VARCHAR) AS expected_price_blk, CAST(NULL AS VARCHAR) AS dea_number_customer_master,
       l_shipdate AS req_delivery_date, CAST(NULL AS VARCHAR) AS som_indc, row_fill, price_fill, qty_fill
FROM ff""",
    "FLOW_summary": f"""WITH {FLOW_CTES},
ffirst AS (
  SELECT lookup, buying_group, award_type, sc_comments, m1, m2, m3, average,
         row_number() OVER (PARTITION BY lookup ORDER BY {_LI_ORDER}) AS rn
  FROM ff WHERE lookup IS NOT NULL)
SELECT s.description AS material_description, s.customer AS sold_to_party_name, s.lookup, s.ndc AS ndc_code,
       round(s.max_ups, 4) AS max_of_ups_inventory, round(s.sum_qty, 4) AS sum_of_sales_order_qty, round(s.max_mtd, 4) AS max_of_sales_qty_mtd,
       round(s.max_forecast, 4) AS max_of_forecast_qty, CAST(NULL AS VARCHAR) AS manual_comments, round(f.m1, 4) AS m1, round(f.m2, 4) AS m2,
       round(f.m3, 4) AS m3, round(f.average, 4) AS avg, f.buying_group, f.award_type, f.sc_comments,
       CASE WHEN s.max_ups < 2000 THEN 'FFFF00' END AS low_stock_fill,
       (SELECT strftime(p - INTERVAL 3 MONTH, '%b') || ',' || strftime(p - INTERVAL 2 MONTH, '%b') || ',' || strftime(p - INTERVAL 1 MONTH, '%b') FROM fper) AS months
FROM fsum s LEFT JOIN ffirst f ON s.lookup = f.lookup AND f.rn = 1""",
    "FLOW_statistics": f"""WITH {FLOW_CTES}
SELECT (SELECT count(*) FROM fm) AS original_rows, count(*) AS rows_after_merge,
       count(DISTINCT order_number) AS unique_sales_orders, count(DISTINCT customer) AS unique_customers,
       count(DISTINCT ndc) AS unique_ndcs,
       count(*) - count(DISTINCT ndc) - CASE WHEN count_if(ndc IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_ndcs,
       count(*) - count(DISTINCT lookup) - CASE WHEN count_if(lookup IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_lookups,
       count_if(description IS NULL) AS missing_0, count_if(pack_size IS NULL) AS missing_1,
       count_if(actual_quantity IS NULL) AS missing_2, count_if(buying_group IS NULL) AS missing_3,
       count_if(award_type IS NULL) AS missing_4, count_if(comments IS NULL) AS missing_5,
       round(avg(CASE WHEN description IS NOT NULL AND pack_size IS NOT NULL AND actual_quantity IS NOT NULL
                       AND buying_group IS NOT NULL AND award_type IS NOT NULL AND comments IS NOT NULL
                      THEN 1.0 ELSE 0.0 END) * 100, 2) AS completion_pct
FROM fd""",
    "FLOW_audit_counts": f"WITH {FLOW_CTES} " + " UNION ALL ".join([
        _metric_rows("audit", _RUN_COUNTS), _metric_rows("exceptions", _RUN_EXCEPTIONS, True), _metric_rows("summary", _SUMMARY_COUNTS), _metric_rows("derived", _DERIVED_COUNTS),
        _metric_rows("grain", {"rows_before": "SELECT count(*) FROM fm", "rows_after": _c("n"), "dropped_keys": "SELECT 0"})]),
    "FLOW_merge_audit": f"WITH {FLOW_CTES} " + " UNION ALL ".join(_MERGE_ROWS) + f"""
UNION ALL
SELECT 'Buying Groups, Sales Trend, Open Orders', 'buying_group', 'customer', (SELECT count(buying_group) FROM fd), (SELECT count_if(buying_group IS NULL) FROM fd),
       (SELECT count_if(status = 'DUPLICATE_CONFLICT') FROM fwin),
       'exact_duplicate_source_rows_removed=' || (SELECT CAST(sum(n_rows - n_values) AS BIGINT) FROM ftbl) || '; same_priority_conflicts=' ||
       (SELECT count_if(status = 'DUPLICATE_CONFLICT') FROM fwin) || '; lower_priority_disagreements=' ||
       (SELECT count(*) FROM ftbl o JOIN fwin w ON o.k = w.k WHERE o.priority <> w.priority AND o.n_values = 1 AND w.n_values = 1 AND o.n <> w.n)
UNION ALL
SELECT 'awards', 'award_type', 'lookup, ndc', count(award_type), count_if(award_type IS NULL), count_if(award_status = 'DUPLICATE_CONFLICT'),
       'matched_by_lookup=' || count_if(award_status = 'MATCHED' AND by_lookup) || '; matched_by_ndc=' || count_if(award_status = 'MATCHED' AND NOT by_lookup) ||
       '; not_found=' || count_if(award_status = 'NOT_FOUND') || '; duplicate_conflict=' || count_if(award_status = 'DUPLICATE_CONFLICT')
FROM fd""",
})


from . import extra  # noqa: E402

SQL.update(extra.SQL)
