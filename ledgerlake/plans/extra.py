"""Further registered queries, each with its DuckDB statement beside it: typed
text inputs, partial keys, layouts, invariants, missing sources, wide history."""

from __future__ import annotations

from pyspark.sql import functions as F

import uuid

from ..functions import keys as K
from ..operators import audit, clean, history, lookup, summary
from ..sources import discovery, layout, readers, registry, sinks, validate
from . import inputs as I
from .session import cut_lineage, ensure_checkpoint_dir


def _text_dates(spark, sf):
    """Orders with their date as text: ISO, as month/day/year, or no date at all, by status."""
    o = I.table(spark, sf, "orders")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.lit(" TBD "))
    )
    return o.select("o_orderkey", "o_custkey", text.alias("d"))


TEXT_DATES = """td AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS d FROM orders)"""


def q_parse_dates(spark, sf):
    return _text_dates(spark, sf).select("o_orderkey", F.date_format(K.parse_date("d"), "yyyy-MM-dd").alias("day"))


def q_text_month(spark, sf):
    return history.reporting_month(_text_dates(spark, sf), "d")


def q_to_text(spark, sf):
    li = I.table(spark, sf, "lineitem")
    flag = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag"))
    return li.withColumn("flag", K.to_text(flag)).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def q_text_measures(spark, sf):
    """G1 on text measures: thousands with commas, and no number at all where the tax is zero."""
    li = I.table(spark, sf, "lineitem")
    whole = F.floor("l_extendedprice")
    text = F.when(F.col("l_tax") == 0, F.lit(" - ")).otherwise(F.concat(F.lit(" "), F.format_number(whole, 0)))
    rows = li.select("l_returnflag", "l_linestatus", text.alias("price"))
    values = [summary.ValueAgg("price", "max", "highest"), summary.ValueAgg("price", "sum", "total"), summary.ValueAgg("absent", "max", "missing")]
    return summary.sales_summary(rows, ["l_returnflag", "l_linestatus"], values)


def q_partial_keys(spark, sf):
    """B12 where the code, the name or both columns are absent or have another name."""
    c = I.table(spark, sf, "customer").select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("NDC code "), F.col("c_name").alias("Customer"))
    names = ["NDC Code", "NDC"], ["Sold-to party Name", "customer"]
    both = audit.with_key_columns(c, *names, lookup="both_key")
    name = audit.with_key_columns(both.drop("NDC code "), *names, lookup="name_key").select("c_custkey", "both_key", "name_key")
    return audit.with_key_columns(name, *names, lookup="no_key")


def q_key_table_fallbacks(spark, sf):
    c = I.table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("Party"))
    rows, _ = audit.lookup_key_table(c, ["NDC Code", "NDC"], ["Sold-to", "party"])
    return rows


def q_layout(spark, sf):
    """Layout, renames, right-to-left coalesce, alias and blank columns, and the original order first."""
    c = I.table(spark, sf, "customer").withColumn("late", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    c = clean.ensure_blank_column(clean.alias_column(c, "c_name", "party"), "manual")
    c = c.withColumn("early", F.when(F.col("c_nationkey") < 12, F.lit("low")))
    out = summary.project(
        c, ["custkey", "segment", "party", "manual", "absent"], renames={"c_custkey": "custkey"},
        coalesce_groups={"segment": ["early", "late", "not there"]})
    return summary.keep_original_order(out, ["party", "custkey"])


def q_row_invariant(spark, sf):
    m = I.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("k"))
    src = I.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("k"), "l_orderkey", "l_linenumber", "l_returnflag")
    after = lookup.keyed_lookup(m, F.col("k"), src, F.col("k"), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_returnflag"])
    # beside the lookup, a plain join that multiplies rows: there the invariant fails
    plain = m.join(src, "k", "left")
    kept = audit.row_count_invariant(m, after).withColumn("step", F.lit("lookup"))
    return kept.unionByName(audit.row_count_invariant(m, plain).withColumn("step", F.lit("plain join")))


def q_missing_source(spark, sf):
    """The same lookup with its source, without it, and with a source that lacks the value column."""
    m = I.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("ndc"))
    src = I.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("ndc"), F.lit("ordered").alias("comment"), "o_orderkey")
    out = None
    for name, source in (("given", src), ("absent", None), ("no column", src.drop("comment"))):
        r = lookup.latest_lookup(m, source, master_ndc="ndc", master_customer="c_name", source_ndc="ndc", value_col="comment", order_by=["o_orderkey"])
        one = r.frame.groupBy("sc_comments", "sc_comments_status").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _trend(spark, sf):
    """A sales trend: a row per customer and a text column for every month that has orders. Each January is there
    twice, the second time under another header with other numbers: the first header counts."""
    o = I.table(spark, sf, "orders").select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m"), F.floor("o_totalprice").alias("p"))
    months = sorted(r["m"] for r in o.select("m").distinct().collect())  # one row per month
    headers = I.trend_headers(months)
    sums = o.groupBy("o_custkey").agg(*[F.sum(F.when(F.col("m") == F.lit(m), F.col("p"))).alias(h) for m, h in headers.items()])
    text = [F.coalesce(F.format_number(F.col(f"`{h}`"), 0), F.lit(" - ")).alias(h) for h in headers.values()]
    text += [F.lit("1").alias(f"January {m.year}") for m in months if m.month == 1]
    name = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit(" key "), F.col("o_custkey").cast("string"))).otherwise(F.concat(F.lit("KEY "), F.col("o_custkey").cast("string")))
    return sums.select(name.alias("Lookup"), "o_custkey", *text)


def q_prior_months_wide(spark, sf):
    # the months before February lie in two years
    r = history.prior_months_wide(_trend(spark, sf), 1996, 2, order_by=["o_custkey"])
    nov, dec, jan = r.labels
    return r.frame.select(F.col("_k").alias("lookup"), F.col(nov).alias("m1"), F.col(dec).alias("m2"), F.col(jan).alias("m3"), F.round("average", 4).alias("average"))


def q_months_long(spark, sf):
    return history.months_long(_trend(spark, sf), ["o_custkey"])


def q_listing_issues(spark, sf):
    """A workbook per language and source, its sheets the size classes of its documents; sources recur over
    languages, a class that two rows name is listed twice, and small workbooks have no sheet."""
    d = I.table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("most"))
    book = F.concat(F.lit("in/"), F.col("lang"), F.lit("/"), F.col("source"))
    size = F.when(F.col("most") > 4000, F.lit("long")).when(F.col("most") > 2000, F.lit("short"))
    again = d.where("n > 10").select(book.alias("workbook"), F.lit("long").alias("sheet"))
    return validate.validate_listing(d.select(book.alias("workbook"), size.alias("sheet")).unionByName(again))


def _shared(spark) -> str:
    """A new folder in the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


def q_stored_join(spark, sf):
    """E17 on stored tables: order lines and supplier totals bucketed by one key and joined without an exchange."""
    base = _shared(spark)
    li = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")).alias("k"))
    sup = I.table(spark, sf, "supplier")
    known = sup.select(F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("k2"), F.col(sup.columns[1]).alias("name"))
    left, right = layout.write_bucketed(li, f"{base}/lines", "k", 8), layout.write_bucketed(known, f"{base}/known", "k2", 8)
    return left.join(right, F.col("k") == F.col("k2"), "left").select("l_orderkey", "l_linenumber", "l_partkey", "k", "name")


def q_stored_history(spark, sf):
    """H2 on history that is stored by month: the reporting month prunes the partitions that are read."""
    o = I.table(spark, sf, "orders")
    stored = layout.write_history(o, f"{_shared(spark)}/history", F.col("o_custkey"), F.col("o_orderdate"), F.col("o_totalprice"))
    wide = layout.prior_months_stored(stored, history.reporting_month(o, "o_orderdate"))
    return wide.select(F.col("_k").alias("c_custkey"), *[F.round(c, 2).alias(c) for c in ("m1", "m2", "m3")], F.round("average", 4).alias("average"))


def q_csv_round_trip(spark, sf):
    """A1, A10: orders as CSV files under three headers (plain, other column order, below a title), read back by header."""
    o = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order"), F.col("o_custkey").cast("string").alias("Customer"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('said "x", '), F.col("o_orderpriority"))).otherwise(F.col("o_orderpriority")).alias("Note"), "o_orderstatus")
    base = _shared(spark)
    for i, (status, columns) in enumerate((("F", ["Order", "Customer", "Note"]), ("O", ["Note", "Order", "Customer"]))):
        part = o.where(F.col("o_orderstatus") == status).select(*columns).repartition(3)
        part.write.option("header", True).option("escape", '"').csv(f"{base}/plain/{i}")
    rest = sinks.blank_nulls(o.where(~F.col("o_orderstatus").isin("F", "O")).select("Order", "Customer", "Note"))
    title = spark.range(1).select(F.lit("Report\n\nOrder,Customer,Note").alias("value"))
    lines = rest.select(F.concat_ws(",", *[F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in rest.columns]).alias("value"))
    title.unionByName(lines).coalesce(1).write.text(f"{base}/titled")
    plain = readers.read_csv_table(spark, [f"{base}/plain/0", f"{base}/plain/1"])
    titled = readers.read_csv_table(spark, f"{base}/titled", 2)
    return plain.unionByName(titled)


def q_resolved_sources(spark, sf):
    """How each source of a registry ends -- found, skipped, or the error that a run would stop with."""
    from .catalog import _registry, _word_sheets

    decided = cut_lineage(discovery.discover(_word_sheets(spark, sf), _registry()))  # a row per source, read once for each
    rows = []
    for d in _registry():
        try:
            found = discovery.resolve(decided.where(F.col("logical") == d.name), [d])
            rows.append((d.name, "resolved" if d.name in found.resolved else "skipped"))
        except (discovery.SourceNotFoundError, discovery.AmbiguousSourceError) as e:
            rows.append((d.name, type(e).__name__))
    return spark.createDataFrame(rows, "logical string, outcome string")


def q_preset_cleaning(spark, sf):
    """The stock preset on stock rows, and the error that a table without its columns gives."""
    li = I.table(spark, sf, "lineitem")
    stock = li.select(
        F.concat(F.lit(" "), I.lpad_num("l_partkey", 5), F.lit(".0")).alias("NDC"), F.concat(F.lit("S\t"), F.col("l_suppkey").cast("string")).alias("SKU"),
        F.col("l_returnflag").alias("Description"), F.col("l_quantity").cast("int").cast("string").alias("Actual Quantity"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("Allocated Quantity"),
        F.when(F.col("l_tax") > 0, F.floor("l_extendedprice").cast("string")).otherwise(F.lit("n/a")).alias("Inventory"))
    out = clean.clean_columns(stock, clean.INVENTORY_SPEC)
    try:
        validate.require_columns(stock, clean.ITEM_SPEC.required, "moq")
        missing = ""
    except ValueError as e:
        missing = str(e)
    names = {c: c.lower().replace(" ", "_") for c in out.columns}
    return out.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.lit(missing).alias("missing"))


def q_tolerant_uploads(spark, sf):
    """C8 and C9 through the registry: uploads whose headers are spelled otherwise, and none at all."""
    from ..operators import netting

    u = I.upload_rows(spark, sf).select(
        F.col("ndc_code").alias(" NDC"), F.col("reason_code").alias("REASON CODE"), F.col("action").alias("action"), F.col("sales_order_qty").alias("Sales_Order_Qty"))
    tables = {"upload_sheet": u}
    sheet = readers.get_table(tables, "upload_sheet")
    assert readers.get_table(tables, "sales_summary", required=False) is None
    view = next(s for s in registry.SOURCES if s.name == "upload_sheet").view(sheet)
    totals = netting.upload_totals(view, "ndc", "reason", "action", "quantity")
    return totals.select("ndc", F.round("upload_qty", 2).alias("upload_qty"))


QUERIES = {
    "E17_stored_join": q_stored_join,
    "H2_stored_history": q_stored_history,
    "A1_csv_round_trip": q_csv_round_trip,
    "A13_resolved_sources": q_resolved_sources,
    "C2_preset_cleaning": q_preset_cleaning,
    "C9_tolerant_uploads": q_tolerant_uploads,
    "B20_parse_dates": q_parse_dates,
    "G9_text_month": q_text_month,
    "B7_to_text": q_to_text,
    "G1_text_measures": q_text_measures,
    "B12_partial_keys": q_partial_keys,
    "B13_key_table_fallbacks": q_key_table_fallbacks,
    "C12_layout": q_layout,
    "E14_row_invariant": q_row_invariant,
    "E18_missing_source": q_missing_source,
    "H2_prior_months_wide": q_prior_months_wide,
    "H3_months_long": q_months_long,
    "C4_listing_issues": q_listing_issues,
}

_TREND = """o AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, sum(floor(o_totalprice)) AS v FROM orders GROUP BY 1, 2),
s AS (
  SELECT o_custkey, sum(CASE WHEN m = DATE '1995-11-01' THEN v END) AS m1, sum(CASE WHEN m = DATE '1995-12-01' THEN v END) AS m2,
         sum(CASE WHEN m = DATE '1996-01-01' THEN v END) AS m3
  FROM o GROUP BY o_custkey)"""

SQL = {
    "E17_stored_join": """SELECT l_orderkey, l_linenumber, l_partkey, 'S-' || CAST(l_suppkey AS VARCHAR) AS k, s.name
FROM lineitem LEFT JOIN (SELECT s_suppkey, s_name AS name FROM supplier) s ON s_suppkey = l_suppkey""",
    "H2_stored_history": """WITH rp AS (SELECT m AS p FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, m LIMIT 1),
h AS (
  SELECT o_custkey, sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 3 MONTH THEN o_totalprice END) AS m1,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 2 MONTH THEN o_totalprice END) AS m2,
         sum(CASE WHEN date_trunc('month', o_orderdate) = p - INTERVAL 1 MONTH THEN o_totalprice END) AS m3
  FROM orders, rp WHERE date_trunc('month', o_orderdate) >= p - INTERVAL 3 MONTH AND date_trunc('month', o_orderdate) < p GROUP BY o_custkey)
SELECT o_custkey AS c_custkey, round(m1, 2) AS m1, round(m2, 2) AS m2, round(m3, 2) AS m3,
  round((coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0)) / nullif((m1 IS NOT NULL)::INT + (m2 IS NOT NULL)::INT + (m3 IS NOT NULL)::INT, 0), 4) AS average
FROM h""",
    "A1_csv_round_trip": """SELECT CAST(o_orderkey AS VARCHAR) AS "Order", CAST(o_custkey AS VARCHAR) AS "Customer",
  CASE WHEN o_orderstatus = 'F' THEN 'said "x", ' ELSE '' END || o_orderpriority AS "Note" FROM orders""",
    "A13_resolved_sources": """WITH hdr AS (SELECT DISTINCT source AS workbook, lang AS sheet, unnest(string_split(text, ' ')) AS header FROM documents),
reg(logical, header) AS (VALUES ('english', 'the'), ('english', 'and'), ('german', 'der'), ('german', 'die'), ('one_file', 'le'), ('one_file', 'que'), ('one_sheet', 'that'),
  ('unmatched_word', 'that'), ('dashed', 'TH-E'), ('spelled', 'THE'), ('spelled', 'And '), ('missing_src', 'no_such_column')),
meta(logical, pref, kw, mandatory) AS (VALUES ('english', NULL, NULL, true), ('german', 'de', 'src7', true), ('one_file', NULL, 'src11', false), ('one_sheet', 'en', 'src19', true),
  ('unmatched_word', NULL, 'x_no_match', false), ('dashed', NULL, NULL, false), ('spelled', NULL, 'src4', false), ('missing_src', NULL, NULL, false)),
need AS (SELECT logical, count(*) AS n FROM reg GROUP BY logical),
hits AS (SELECT r.logical, h.workbook, h.sheet, count(*) AS got FROM reg r JOIN hdr h ON h.header = r.header GROUP BY r.logical, h.workbook, h.sheet),
cand AS (SELECT hits.* FROM hits JOIN need ON need.logical = hits.logical AND need.n = hits.got),
agg AS (
  SELECT m.logical, mandatory, count(c.workbook) AS n, count(DISTINCT c.workbook) AS files, count_if(c.sheet = pref) AS n_pref, count_if(contains(lower(c.workbook), kw)) AS n_kw, max(kw) AS kw
  FROM meta m LEFT JOIN cand c ON c.logical = m.logical GROUP BY m.logical, mandatory)
SELECT logical, CASE WHEN n = 1 OR n_pref = 1 OR (files > 1 AND kw IS NOT NULL AND n_kw = 1) THEN 'resolved' WHEN NOT mandatory THEN 'skipped'
  WHEN n = 0 THEN 'SourceNotFoundError' ELSE 'AmbiguousSourceError' END AS outcome FROM agg""",
    "C2_preset_cleaning": """SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS ndc, 'S ' || CAST(l_suppkey AS VARCHAR) AS sku, l_returnflag AS description,
  CAST(l_quantity AS DOUBLE) AS actual_quantity, CAST(l_linenumber AS DOUBLE) AS allocated_quantity, CASE WHEN l_tax > 0 THEN floor(l_extendedprice) END AS inventory,
  'moq is missing required columns: HANA Material, NDC code, Material Description, MOQ ' AS missing FROM lineitem""",
    "C9_tolerant_uploads": """SELECT lpad(CAST(l_partkey AS VARCHAR), 5, '0') || '000000' AS ndc, round(sum(l_quantity), 2) AS upload_qty FROM lineitem
WHERE l_linenumber IN (1, 4) AND l_returnflag = 'R' AND l_tax < 0.04 GROUP BY 1""",
    "B20_parse_dates": f"WITH {TEXT_DATES} SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day FROM td",
    "G9_text_month": f"""WITH {TEXT_DATES}, m AS (SELECT date_trunc('month', d) AS m, count(*) AS n FROM td WHERE d IS NOT NULL GROUP BY 1)
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM m ORDER BY n DESC, m LIMIT 1""",
    "B7_to_text": "SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag, count(*) AS n FROM lineitem GROUP BY 1",
    "G1_text_measures": """SELECT l_returnflag, l_linestatus, max(CASE WHEN l_tax <> 0 THEN floor(l_extendedprice) END) AS highest,
  coalesce(sum(CASE WHEN l_tax <> 0 THEN floor(l_extendedprice) END), 0) AS total, CAST(NULL AS DOUBLE) AS missing
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "B12_partial_keys": """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 5, '0') || upper(c_name) AS both_key, upper(c_name) AS name_key,
  CAST(NULL AS VARCHAR) AS no_key FROM customer""",
    "B13_key_table_fallbacks": "SELECT upper(c_name) AS lookup, CAST(NULL AS VARCHAR) AS ndc, c_name AS customer FROM customer",
    "C12_layout": """SELECT c_name AS party, c_custkey AS custkey,
  coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, CASE WHEN c_nationkey < 12 THEN 'low' END) AS segment,
  CAST(NULL AS VARCHAR) AS manual, CAST(NULL AS VARCHAR) AS absent FROM customer""",
    "E14_row_invariant": """WITH n AS (SELECT count(*) AS n FROM orders), s AS (SELECT l_suppkey, count(*) AS c FROM lineitem GROUP BY 1),
j AS (SELECT CAST(sum(coalesce(c, 1)) AS BIGINT) AS n FROM orders LEFT JOIN s ON o_custkey = l_suppkey)
SELECT n AS rows_before, n AS rows_after, true AS preserved, 'lookup' AS step FROM n
UNION ALL SELECT n.n, j.n, n.n = j.n, 'plain join' FROM n, j""",
    "E18_missing_source": """SELECT CASE WHEN found THEN 'ordered' END AS sc_comments, CASE WHEN found THEN 'MATCHED' ELSE 'NOT_FOUND' END AS sc_comments_status,
  count(*) AS n, source FROM (
    SELECT s.source, s.source = 'given' AND c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer, (VALUES ('given'), ('absent'), ('no column')) s(source))
GROUP BY source, found""",
    "H2_prior_months_wide": f"""WITH {_TREND}
SELECT 'KEY ' || CAST(o_custkey AS VARCHAR) AS lookup, m1, m2, m3,
  round((coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0)) / nullif((m1 IS NOT NULL)::INT + (m2 IS NOT NULL)::INT + (m3 IS NOT NULL)::INT, 0), 4) AS average
FROM s""",
    "H3_months_long": f"""WITH {_TREND} SELECT o_custkey, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, v AS value FROM o""",
    "C4_listing_issues": """WITH d AS (
  SELECT 'in/' || lang || '/' || source AS workbook, source, count(*) AS n, max(n_chars) AS most FROM documents GROUP BY lang, source),
l AS (
  SELECT workbook, source, CASE WHEN most > 4000 THEN 'long' WHEN most > 2000 THEN 'short' END AS sheet FROM d
  UNION ALL SELECT workbook, source, 'long' FROM d WHERE n > 10)
SELECT source AS "table", 'ERROR' AS severity, 'DUPLICATE_WORKBOOK_NAME' AS code, source AS detail
FROM (SELECT source FROM d GROUP BY source HAVING count(*) > 1)
UNION ALL
SELECT workbook, 'ERROR', 'MISSING_WORKSHEET', workbook FROM (SELECT workbook FROM l GROUP BY workbook HAVING count(sheet) = 0)
UNION ALL
SELECT workbook, 'ERROR', 'DUPLICATE_WORKSHEET_NAME', sheet FROM (SELECT workbook, sheet FROM l WHERE sheet IS NOT NULL GROUP BY workbook, sheet HAVING count(*) > 1)""",
}
