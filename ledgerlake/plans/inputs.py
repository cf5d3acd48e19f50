"""Stand-in operational tables derived from the driver's star-schema tables.

The library's operators expect operational inputs (stock rows, open orders,
uploads, lookup sources, a master order table). The driver ships TPC-H-like
tables, so each registered query derives its inputs from them with plain
Column expressions -- including the dirty keys, blank codes and conflicting
sources the operators exist to handle. Every derivation reads whole tables;
subsets are chosen by data attributes, never by id arithmetic.

Each derivation has a twin in ``oracle.py`` written as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import cut_lineage

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lpad_num(c, width: int):
    return F.lpad(F.col(c).cast("string"), width, "0")


def inventory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock rows: one per line item. NDC text in two layouts that reduce to the
    same digits; hold code blank for return flag N (null or spaces), else
    the flag itself."""
    li = table(spark, sf_dir, "lineitem")
    part5 = lpad_num("l_partkey", 5)
    return li.select(
        F.when(F.col("l_linestatus") == "O", F.concat(part5, F.lit("-0000-00")))
        .otherwise(F.concat(part5, F.lit("000000"))).alias("ndc"),
        F.col("l_quantity").alias("inventory"),
        F.when(F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") == "O", F.lit("   ")))
        .otherwise(F.col("l_returnflag")).alias("hold_codes"),
    )


def open_order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders: every line item. SKU 5-3-2 digits, with a 2-digit middle
    segment (invalid) when the discount is zero, and of a part that has no
    stock when the tax is zero; status 'Pick Completed' (excluded) unless the
    return flag is A, 'Loaded' (excluded) for finished lines."""
    li = table(spark, sf_dir, "lineitem")
    part5 = F.when(F.col("l_tax") == 0, F.concat(F.lit("9"), F.substring(lpad_num("l_partkey", 5), 2, 4))).otherwise(lpad_num("l_partkey", 5))
    mid = F.when(F.col("l_discount") == 0, F.lit("00")).otherwise(F.lit("000"))
    return li.select(
        F.concat(part5, F.lit("-"), mid, F.lit("-00")).alias("sku"),
        F.col("l_quantity").alias("total"),
        F.when(F.col("l_returnflag") != "A", F.lit("Pick Completed"))
        .when(F.col("l_linestatus") == "F", F.lit("Loaded")).otherwise(F.lit(" open ")).alias("status"),
    )


def upload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order uploads: every line item. Reason code is the line number written as
    a float ('1.0'); action ' Yes' for return flag R and low tax, else 'no'."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(lpad_num("l_partkey", 5), F.lit("-0000-00")).alias("ndc_code"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("reason_code"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") < 0.04), F.lit(" Yes")).otherwise(F.lit("no")).alias("action"),
        F.col("l_quantity").alias("sales_order_qty"),
    )


def dirty_customer_name(c: str = "c_name", seg: str = "c_mktsegment"):
    """Customer names with injected tabs, newlines, case changes, NBSP and
    zero-width characters and blanks, chosen by market segment."""
    name = F.col(c)
    s = F.col(seg)
    return (
        F.when(s == "BUILDING", F.concat(F.lit("  "), F.lower(name), F.lit("\t")))
        .when(s == "AUTOMOBILE", F.replace(name, F.lit("#"), F.lit(" \n#  ")))
        .when(s == "MACHINERY", F.concat(name, F.lit("\u00a0\u200b x")))
        .when(s == "FURNITURE", F.lit("   "))
        .otherwise(name)
    )


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers, written as a table: fewer and narrower rows than the lines that they meet."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return cut_lineage(o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey"))


def master_orders(spark: SparkSession, sf_dir: str, bought: DataFrame | None = None) -> DataFrame:
    """Order lines as the master table: line item x order x customer x part
    with an NDC code (dashed text) and a sold-to name (dirty). ``bought``:
    the orders with their customers, where ``buyers`` has written them."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    if bought is not None:
        j = li.join(bought, li.l_orderkey == bought.o_orderkey)
    else:
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    return j.join(p, F.col("l_partkey") == p.p_partkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate", "o_custkey", "o_orderdate", "c_name", "c_mktsegment", "p_name", "p_size", "p_type",
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.concat(lpad_num("l_partkey", 5), F.lit("-"), lpad_num("l_suppkey", 4), F.lit("-01"))).alias("ndc_code"),
        dirty_customer_name().alias("sold_to"),
    )


LINE_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")


# --------------------------------------------------------------------------
# The sources of the whole flow, under their role names
# --------------------------------------------------------------------------

def trend_headers(months: list) -> dict:
    """The trend's month headers, written in the ways that exports write them: first day of the month -> header."""
    styles = (" {:%b-%Y} ", "{:%B %Y}", " {:%b %Y}")
    short = " {:%b-%y} "  # two digits are a year of this century
    return {m: (short if m.year >= 2000 and m.month % 3 == 1 else styles[(m.month - 1) % 3]).format(m) for m in months}


def sales_trend(spark: SparkSession, m: DataFrame) -> DataFrame:
    """Per lookup and line status a row with a text column for every month that has orders. Every January is there
    twice, the second time with other numbers under another header: the first header counts."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    months = sorted(r["m"] for r in m.select(month.alias("m")).distinct().collect())  # one row per month
    rows = m.select(
        _written_lookup(m).alias("lookup"), F.col("l_linestatus").alias("status"), month.alias("_m"), F.floor("l_extendedprice").alias("_p"),
        "c_mktsegment", "c_name", "p_size", "l_suppkey", "p_name").where("lookup is not null")
    # a sum per month first, then a map of a row's months: the columns are made when the row is whole
    kept = {"c_mktsegment": F.min, "c_name": F.min, "p_size": F.max, "l_suppkey": F.min, "p_name": F.min}
    by_month = rows.groupBy("lookup", "status", "_m").agg(*[f(c).alias(c) for c, f in kept.items()], F.sum("_p").alias("_p"))
    cell = F.when(F.col("_m").isNotNull(), F.struct("_m", "_p"))
    whole = by_month.groupBy("lookup", "status").agg(*[f(c).alias(c) for c, f in kept.items()], F.map_from_entries(F.collect_list(cell)).alias("_by"))
    sums, again = [], []
    for first, header in trend_headers(months).items():
        total = F.try_element_at("_by", F.lit(first))
        sums.append(F.coalesce(F.format_number(total, 0), F.lit(" - ")).alias(header))
        if first.month == 1:
            again.append(F.lit("1").alias(f"January {first.year}"))
    facts = [
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat("c_name", F.lit(" closed"))).otherwise(F.lower("c_name")).alias("customer"),
        F.when(F.col("p_size") > 40, F.lit("Retail")).otherwise(F.col("c_mktsegment")).alias("customer_group"),
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("contract_id"), F.concat(F.lit("T: "), F.col("p_name")).alias("material_description"),
    ]
    return whole.select("lookup", "status", *facts, *sums, *again)


def _lookup():
    from ..functions.keys import lookup_key

    return lookup_key("ndc_code", "sold_to")


def _written_lookup(m: DataFrame):
    """The lines' Lookup: the column, where it is written beside them."""
    return F.col("_lookup") if "_lookup" in m.columns else _lookup()


def flow_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, tuple[str, ...]]]:
    """The logical sources of the flow from the driver's tables, with each one's row order. The order lines that
    several of them come from, with the Lookup that the sources among them hold, and the trend with its column per
    month are written as tables."""
    m = cut_lineage(master_orders(spark, sf_dir).withColumn("_lookup", _lookup()))
    li, customer = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    ndc = F.concat(lpad_num("l_partkey", 5), F.lit("-"), lpad_num("l_suppkey", 4), F.lit("-01"))
    qty = F.col("l_quantity")
    orderbook = m.select(
        *LINE_ORDER, F.col("l_orderkey").alias("order_number"), F.col("l_linenumber").alias("item_number"),
        F.when(flag != "A", F.col("l_partkey").cast("string")).alias("material_code"), F.col("ndc_code").alias("ndc"), F.col("sold_to").alias("customer"),
        F.when(F.col("p_type") != "SMALL", F.col("p_name")).alias("material_description"), (F.col("p_size") * 10).alias("total_stock"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size")).alias("pack_size"), qty.alias("quantity"),
        F.when(status == "O", qty * 2).alias("quantity_mtd"), F.when(flag == "N", qty * 3).alias("forecast"),
        F.col("o_custkey").alias("sold_to_party"), F.col("c_mktsegment").alias("order_type"), F.col("l_extendedprice").alias("unit_price"),
        F.round(F.col("l_extendedprice") * qty, 2).alias("sales_value"),
        F.when(status == "O", F.col("l_extendedprice")).otherwise(F.round("l_extendedprice", 0)).alias("reference_price"),
        F.concat(F.lit("PO"), F.col("l_orderkey").cast("string")).alias("po_number"), F.col("o_orderdate").alias("po_date"),
        F.col("o_custkey").alias("ship_to_party"), F.col("c_name").alias("ship_to_name"), F.col("p_type").alias("street"),
        F.col("c_mktsegment").alias("city"), lpad_num("o_custkey", 5).alias("postal_code"), flag.alias("reject_code"),
        F.col("l_shipdate").alias("delivery_date"),
        F.when(flag == "R", F.lit(" Cancel")).when((flag == "A") & (status == "O"), F.lit("HOLD ")).otherwise(F.lit("")).alias("action"),
    )
    moq = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("material_code"), F.concat(F.lit("M: "), F.col("p_name")).alias("material_description"),
        F.when(F.col("p_type") != "LARGE", F.col("p_size") + 1).alias("moq"))
    inventory = li.select(
        *LINE_ORDER, F.when(status == "O", ndc).otherwise(F.replace(ndc, F.lit("-"), F.lit(""))).alias("ndc"), qty.alias("actual_quantity"),
        (qty * 40).alias("inventory"), F.col("l_linenumber").alias("allocated_quantity"), flag.alias("description"),
        F.when(flag != "N", flag).alias("hold_codes"))
    open_orders = m.select(
        *LINE_ORDER, F.concat(lpad_num("l_partkey", 5), F.lit("-"), lpad_num("l_suppkey", 3), F.lit("-01")).alias("sku"), qty.alias("total"),
        F.when(flag != "A", F.lit("Pick Completed")).when(status == "F", F.lit("Loaded")).otherwise(F.lit("Open")).alias("status"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("customer"),
        F.when(F.col("p_type") != "PROMO", F.substring("c_mktsegment", 1, 4)).otherwise(F.lit("  ")).alias("customer_group"))
    groups = customer.select(
        F.col("c_name").alias("customer"), F.when(F.col("c_nationkey") < 10, F.col("c_mktsegment")).alias("buying_group"), "c_custkey", F.lit(0).alias("r"))
    groups = groups.unionByName(customer.select(
        F.col("c_name").alias("customer"), F.when((F.col("c_nationkey") < 3) & (F.col("c_acctbal") < 0), F.lit("Special")).alias("buying_group"), "c_custkey", F.lit(1).alias("r")))
    late = F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")  # awards of an NDC that no line has
    awarded = m.withColumn("ndc_code", F.when(late, F.lit("99999-9999-99")).otherwise(F.col("ndc_code")))
    awards = awarded.select(*LINE_ORDER, _lookup().alias("lookup"), F.col("ndc_code").alias("ndc"), F.when(flag == "R", F.lit("Secondary")).otherwise(F.lit("Primary")).alias("award_type"))
    tracker = li.select(
        *LINE_ORDER, ndc.alias("ndc"), F.when(status == "O", F.lit("Backorder")).otherwise(F.lit("Shipped")).alias("comments"),
        F.col("l_shipdate").alias("tracker_date"), status.alias("customer_eta"))
    sold = m.select(
        *LINE_ORDER, F.col("l_orderkey").alias("order_number"), F.col("ndc_code").alias("ndc"), _written_lookup(m).alias("lookup"),
        F.when(F.col("p_size") > 25, F.col("p_size") + 2).alias("summary_pack_size"), qty.alias("quantity"), (qty * 5).alias("quantity_mtd"),
        (qty * 7).alias("forecast"), F.concat(F.lit("S: "), F.col("p_name")).alias("material_description"))
    uploads = li.select(
        ndc.alias("ndc"), F.col("l_linenumber").cast("string").alias("reason"),
        F.when((flag == "R") & (F.col("l_tax") < 0.04), F.lit("Yes")).otherwise(F.lit("no")).alias("action"), qty.alias("quantity"))
    tables = {
        "orderbook": orderbook, "moq": moq, "inventory": inventory, "open_order_summary": open_orders, "buying_groups": groups, "awards": awards,
        "critical_inventory_tracker": tracker, "sales_summary": sold, "sales_trend": cut_lineage(sales_trend(spark, m)), "upload_sheet": uploads,
    }
    order = {name: LINE_ORDER for name in ("orderbook", "inventory", "open_order_summary", "awards", "critical_inventory_tracker", "sales_summary")}
    return tables, order | {"moq": ("material_code",), "buying_groups": ("r", "c_custkey"), "sales_trend": ("lookup", "status")}
