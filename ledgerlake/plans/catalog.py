"""Registered queries: one per operator (or operator group) of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Inputs are
the driver's tables (or stand-ins derived from them in ``inputs.py``); the
work is done by the library operators. Floating results are rounded to a
fixed scale so an independent engine summing in another order still matches.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import months as M
from ..operators import history, lookup, netting, rules, summary
from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]


def _r(c, scale: int = 2):
    return F.round(F.col(c) if isinstance(c, str) else c, scale)


# --------------------------------------------------------------------------
# Netting (flagship): C6, C7, C8, G2, G3, E9, E10, F1, B4, B8, B9
# --------------------------------------------------------------------------

def _net(spark, sf):
    return netting.build_net_inventory(
        I.inventory_rows(spark, sf), I.open_order_rows(spark, sf),
        inv_ndc="ndc", inv_qty="inventory", inv_hold="hold_codes",
        oo_sku="sku", oo_total="total", oo_status="status",
        uploads=I.upload_rows(spark, sf), up_ndc="ndc_code", up_reason="reason_code",
        up_action="action", up_qty="sales_order_qty",
    )


def q_net_inventory(spark, sf):
    n = _net(spark, sf).frame
    return n.select("ndc", *[_r(c).alias(c) for c in ("inventory", "total", "upload_qty", "ups_inventory")])


def q_net_counters(spark, sf):
    return _net(spark, sf).counters


def q_hold_filter_counters(spark, sf):
    c = netting.hold_filter_counters(I.inventory_rows(spark, sf), "ndc", "inventory", "hold_codes")
    return c.select(
        "total_rows", "blank_hold_rows", "excluded_hold_rows", "unique_keys_before", "unique_keys_after",
        _r("qty_before").alias("qty_before"), _r("qty_after").alias("qty_after"),
    )


def q_missing_inventory(spark, sf):
    return _net(spark, sf).missing_inventory


def q_upload_totals(spark, sf):
    u = netting.upload_totals(I.upload_rows(spark, sf), "ndc_code", "reason_code", "action", "sales_order_qty")
    return u.select("ndc", _r("upload_qty").alias("upload_qty"))


# --------------------------------------------------------------------------
# Scalar keys: B1-B9, B14-B16
# --------------------------------------------------------------------------

def q_clean_documents(spark, sf):
    d = I.table(spark, sf, "documents")
    c = K.clean_text("text")
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_len"))


def q_text_keys_customer(spark, sf):
    c = I.table(spark, sf, "customer").select("c_custkey", I.dirty_customer_name().alias("dirty"))
    t = K.text_key("dirty")
    return c.select(
        "c_custkey",
        K.clean_text("dirty").alias("clean"),
        t.alias("text_key"),
        K.ident_key("dirty").alias("ident_key"),
        K.is_blank("dirty").alias("is_blank"),
        K.changed_by_normalising("dirty", t).alias("changed"),
    )


def q_digits_keys_orders(spark, sf):
    o = I.table(spark, sf, "orders")
    price_text = F.concat(
        F.lit(" "),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string"), F.lit(","),
        F.lpad(F.pmod(F.floor(F.col("o_totalprice")).cast("bigint"), F.lit(1000)).cast("string"), 3, "0"),
        F.lit(" "),
    )
    x = o.select(
        "o_orderkey",
        (F.col("o_orderkey") * 1000 + 7).cast("double").alias("ndc_float"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("ndc_text"),
        F.concat(F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit("/"), F.col("o_orderpriority")).alias("ndc_mixed"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_custkey").cast("string"), F.lit(".00")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".50")))
        .otherwise(F.col("o_orderpriority")).alias("code_text"),
        price_text.alias("price_text"),
    )
    return x.select(
        "o_orderkey",
        K.digits_key("ndc_float", "double").alias("d_float"),
        K.digits_key("ndc_text").alias("d_text"),
        K.digits_key("ndc_mixed").alias("d_mixed"),
        K.strip_trailing_zero("code_text").alias("stz"),
        K.to_number("code_text").alias("num"),
        K.parse_number_text("price_text").alias("price_num"),
    )


def q_sku_to_ndc(spark, sf):
    p = I.table(spark, sf, "part")
    mid = F.when(F.col("p_type") == "SMALL", F.lpad(F.col("p_size").cast("string"), 2, "0")).otherwise(
        F.lpad(F.col("p_size").cast("string"), 3, "0"))
    sku = F.concat(F.lpad(F.col("p_partkey").cast("string"), 5, "0"), F.lit("-"), mid, F.lit("-"),
                   F.lpad(F.length("p_name").cast("string"), 2, "0"))
    x = p.select("p_partkey", sku.alias("sku"))
    return x.select("p_partkey", "sku", K.segment_key("sku", "-", (5, 3, 2), (5, 4, 2)).alias("ndc"))


def q_lookup_keys(spark, sf):
    m = I.master_orders(spark, sf)
    return m.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        K.lookup_key("ndc_code", "sold_to").alias("lookup"),
        K.compose_key([K.key_for_mode("ndc_code", "ndc"), K.key_for_mode("sold_to", "text")]).alias("composite"),
    )


# --------------------------------------------------------------------------
# Months / history: B17-B19, G9, G11, H1-H3
# --------------------------------------------------------------------------

def q_month_headers(spark, sf):
    o = I.table(spark, sf, "orders")
    hdr = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MMM-yy")) \
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" "))) \
        .otherwise(F.date_format("o_orderdate", "MMM.yyyy"))
    h = o.select(hdr.alias("header")).distinct()
    p = h.select("header", K.col_of(M.month_header_parts("header")).alias("p"))
    return p.select("header", F.col("p.year").alias("year"), F.col("p.month").alias("month"))


def q_reporting_month(spark, sf):
    return history.reporting_month(I.table(spark, sf, "orders"), "o_orderdate")


def q_prior_months(spark, sf):
    o = I.table(spark, sf, "orders")
    period = history.reporting_month(o, "o_orderdate")
    wide = history.prior_months_long(o, F.col("o_custkey"), F.col("o_orderdate"), F.col("o_totalprice"), period, 3)
    cust = I.table(spark, sf, "customer").select("c_custkey")
    j = cust.join(wide, cust.c_custkey == wide._k, "left")
    # the average of two 2-dp values has 3 decimals: round at 4 to avoid half-way ties
    return j.select("c_custkey", *[_r(c).alias(c) for c in ("m1", "m2", "m3")], _r("average", 4).alias("average"))


def q_month_labels(spark, sf):
    o = I.table(spark, sf, "orders")
    m = o.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m")).distinct()
    prev = M.previous_month_starts(F.col("m"), 3)
    return m.select(
        "m", M.month_label_col("m").alias("label"),
        F.element_at(prev, 1).alias("p1"), F.element_at(prev, 3).alias("p3"),
    )


# --------------------------------------------------------------------------
# Rules: F2-F8, F10
# --------------------------------------------------------------------------

KEYWORDS = ("gear", "RED ", "bolt", "pl.te")


def q_keyword_flag(spark, sf):
    p = I.table(spark, sf, "part")
    return p.select("p_partkey", rules.controlled_flag(p, "p_name", KEYWORDS).alias("flag"),
                    rules.controlled_flag(p, "p_name", KEYWORDS, whole_word=True).alias("flag_word"))


def _priced_orders(spark, sf):
    o = I.table(spark, sf, "orders")
    unit = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0.0)) \
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "2-HIGH"), F.lit(None).cast("double")) \
        .otherwise(F.col("o_totalprice"))
    ref = F.when(F.col("o_orderpriority") == "5-LOW", F.round(F.col("o_totalprice"), -1)) \
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None).cast("double")) \
        .otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus", unit.alias("unit_price"), ref.alias("ref_price"))


def q_price_issue(spark, sf):
    o = _priced_orders(spark, sf)
    issue, diff = rules.price_issue(o, "unit_price", "ref_price")
    return o.select("o_orderkey", issue.alias("price_issue"), _r(diff).alias("price_difference"))


def q_low_stock(spark, sf):
    li = I.table(spark, sf, "lineitem")
    s = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("stock"))
    return s.select("l_partkey", _r("stock").alias("stock"), rules.low_stock_flag(s, "stock", 800).alias("low_stock"))


def _moq_input(spark, sf):
    li = I.table(spark, sf, "lineitem").select(*I.LINE_ORDER, "l_quantity", "l_returnflag", "l_linestatus")
    p = I.table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    size = F.when(F.col("p_type") == "SMALL", F.lit(None).cast("string")) \
        .when(F.col("p_type") == "PROMO", F.lit("0")) \
        .when(F.col("p_type") == "LARGE", F.lit("n/a")) \
        .otherwise(F.col("p_size").cast("string"))
    qty = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(F.col("l_quantity") * 2)
    return j.select(*I.LINE_ORDER, qty.alias("qty"), size.alias("pack_size"), "l_returnflag", "l_linestatus")


def q_moq_checks(spark, sf):
    x = _moq_input(spark, sf)
    q = K.to_number("qty", "double")
    s = K.to_number("pack_size")
    return x.select(
        *I.LINE_ORDER[:4],
        rules.moq_issue(q, s, "lenient").alias("moq_lenient"),
        rules.moq_issue(q, s, "strict").alias("moq_strict"),
        rules.moq_issue(q, s, "remainder").alias("moq_remainder"),
    )


def q_rule_counters(spark, sf):
    m = I.master_orders(spark, sf)
    x = m.select(
        "p_name", "l_quantity",
        F.col("l_extendedprice").alias("unit_price"),
        F.when(F.col("l_returnflag") == "A", F.round(F.col("l_extendedprice"), -2)).otherwise(F.col("l_extendedprice")).alias("ref_price"),
        F.col("p_size").alias("pack_size"),
        (F.col("l_quantity") * 500).alias("stock"),
    )
    cols = rules.RuleColumns(description="p_name", unit_price="unit_price", reference_price="ref_price",
                             stock="stock", qty="l_quantity", pack_size="pack_size")
    _, counters = rules.apply_business_rules(x, cols, KEYWORDS)
    return counters


def q_highlights(spark, sf):
    x = _moq_input(spark, sf)
    p = I.table(spark, sf, "part").select("p_partkey", "p_name")
    x = x.join(p, x.l_partkey == p.p_partkey)
    action = F.when(F.col("l_returnflag") == "R", F.lit(" Cancel")).when(
        (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit("HOLD ")).otherwise(F.lit(""))
    controlled = rules.controlled_flag(x, "p_name", KEYWORDS)
    price_flag = F.col("l_linestatus") == "F"
    fills = rules.highlight_classes(controlled, price_flag, K.to_number("qty", "double"), K.to_number("pack_size"), action)
    return x.select(*I.LINE_ORDER[:4], *[v.alias(k) for k, v in fills.items()])


def _summary_rows(spark, sf, bought=None):
    """The detail that the summary is built from, with its order and the columns that E13 carries over."""
    m = I.master_orders(spark, sf, bought)
    return m.select(
        *I.LINE_ORDER, F.col("c_mktsegment").alias("Buying Group"), F.col("l_returnflag").alias("Award Type"),
        F.col("p_name").alias("Material Description"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("Sold-to party Name"),
        K.lookup_key("ndc_code", "sold_to").alias("Lookup"),
        F.col("ndc_code").alias("NDC Code"),
        (F.col("l_quantity") * 300).alias("UPS Inventory"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("Sales Order Qty"),
        F.col("l_extendedprice").alias("Sales Qty MTD"),
    )


def _summary(spark, sf):
    return summary.sales_summary(_summary_rows(spark, sf))


def q_sales_summary(spark, sf):
    s = _summary(spark, sf)
    return s.select(
        F.col("Material Description").alias("material_description"), F.col("Sold-to party Name").alias("sold_to_party_name"),
        F.col("Lookup").alias("lookup"), F.col("NDC Code").alias("ndc_code"),
        _r("Max of UPS Inventory").alias("max_ups_inventory"), _r("Sum of Sales Order Qty").alias("sum_sales_order_qty"),
        _r("Max of Sales Qty MTD").alias("max_sales_qty_mtd"), F.col("Max of Forecast Qty").alias("max_forecast_qty"),
    )


def q_low_stock_highlight(spark, sf):
    s = _summary(spark, sf)
    out, _ = rules.low_stock_highlight(s, "Max of UPS Inventory", 10000)
    return out.select(F.col("Lookup").alias("lookup"), F.col("Material Description").alias("material_description"),
                      F.col("low_stock_fill").alias("low_stock_fill"))


# --------------------------------------------------------------------------
# Lookups: E4, I6
# --------------------------------------------------------------------------

def q_first_order_per_customer(spark, sf):
    c = I.table(spark, sf, "customer").select("c_custkey", "c_name")
    o = I.table(spark, sf, "orders")
    out = lookup.keyed_lookup(c, F.col("c_custkey").cast("string"), o, F.col("o_custkey").cast("string"),
                              ["o_orderkey", "o_orderdate", "o_totalprice"], ["o_orderdate", "o_orderkey"])
    return out.select("c_custkey", "o_orderkey", "o_orderdate", _r("o_totalprice").alias("o_totalprice"), F.col("_matched").alias("matched"))



# --------------------------------------------------------------------------
# Enrichment: E1, E2, E3, G5, J1
# --------------------------------------------------------------------------

def _enrich_inputs(spark, sf):
    o = I.table(spark, sf, "orders")
    master = o.select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("PRESET")).alias("c_mktsegment"),
    )
    c = I.table(spark, sf, "customer")
    base = c.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.lit(0).alias("src_rank"))
    alt = c.filter(F.col("c_acctbal") < 0).select("c_custkey", "c_name", "c_acctbal", F.lit("ALT").alias("c_mktsegment"), F.lit(1).alias("src_rank"))
    ghost = c.filter(F.col("c_acctbal") > 9000).select(
        (F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment", F.lit(2).alias("src_rank"))
    source = base.unionByName(alt).unionByName(ghost)
    strategies = [
        lookup.JoinStrategy.on("Lookup", ("Lookup", "Lookup", "lookup")),
        lookup.JoinStrategy.on("Customer Number", ("o_custkey", "c_custkey", "alnum")),
    ]
    return master, source, strategies


def _enrich(spark, sf):
    master, source, strategies = _enrich_inputs(spark, sf)
    return lookup.enrich(master, source, strategies, ["c_mktsegment", "c_acctbal", "c_name"], ["src_rank", "c_custkey"], "customer")


def q_enrich(spark, sf):
    out, _ = _enrich(spark, sf)
    return out.select("o_orderkey", "c_mktsegment", _r("c_acctbal").alias("c_acctbal"), "c_name")


def q_enrich_audit(spark, sf):
    _, audit = _enrich(spark, sf)
    return audit


def q_duplicate_analysis(spark, sf):
    li = I.table(spark, sf, "lineitem")
    return lookup.duplicate_analysis(li, ["l_orderkey", "l_linenumber"])


# --------------------------------------------------------------------------
# Conflict-aware lookup with fallback: E6, G6, J3
# --------------------------------------------------------------------------

def _award_source(spark, sf):
    li = I.table(spark, sf, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")  # under keys that no master row has
    lk = F.when(late, F.concat(F.lit("N"), F.col("l_partkey").cast("string"), F.lit("/S"), F.col("l_suppkey").cast("string"))).when(F.col("l_linestatus") == "O", F.concat(F.lit(" p"), F.col("l_partkey").cast("string"), F.lit("/s"), F.col("l_suppkey").cast("string")))\
        .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("/S"), F.col("l_suppkey").cast("string")))
    v = F.when(F.col("l_returnflag") == "R", F.lit("Secondary")).when(F.col("l_linestatus") == "O", F.lit("primary ")).otherwise(F.lit("Primary"))
    return li.select(*I.LINE_ORDER, lk.alias("lookup"), F.concat(I.lpad_num("l_partkey", 5), F.when(late, F.lit("-9999-99")).otherwise(F.lit("-0000-00"))).alias("ndc"), v.alias("award"))


def _award_master(spark, sf):
    li = I.table(spark, sf, "lineitem")
    lk = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None).cast("string"))\
        .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("/S"), F.col("l_suppkey").cast("string")))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", lk.alias("lookup"),
                     F.concat(I.lpad_num("l_partkey", 5), F.lit("0000"), F.lit("00")).alias("ndc_code"),
                     F.concat(F.lit("Customer "), F.col("l_suppkey").cast("string")).alias("customer"))


def _awards(spark, sf, write=False):
    return lookup.award_lookup(
        _award_master(spark, sf), _award_source(spark, sf),
        master_lookup="lookup", master_ndc="ndc_code", master_customer="customer",
        source_lookup="lookup", source_ndc="ndc", value_col="award", order_by=list(I.LINE_ORDER), write=write,
    )


def q_award_lookup(spark, sf):
    r = _awards(spark, sf).frame
    return r.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "award_type", "award_status", "award_strategy")


def q_award_exceptions(spark, sf):
    return _awards(spark, sf, write=True).exceptions


def q_award_conflict_rows(spark, sf):
    rows = _awards(spark, sf, write=True).long_exceptions().filter("status = 'DUPLICATE_CONFLICT'")
    return rows.select("ndc", "lookup", "value", "match_strategy", "reason")


def q_award_counters(spark, sf):
    return _awards(spark, sf).counters


# --------------------------------------------------------------------------
# Multi-source priority lookup: E7, I1, I7, J4, G10
# --------------------------------------------------------------------------

def _priority_sources(spark, sf):
    """Three tiers over every customer. Misses come from groups that are blank and from names that no master has."""
    c = I.table(spark, sf, "customer")
    nation, name = F.col("c_nationkey"), F.col("c_name")

    def listed(group, has, r):
        return c.select(name.alias("customer"), F.when(has, group).alias("group"), "c_custkey", F.lit(r).alias("r"))

    groups = listed(F.col("c_mktsegment"), nation < 10, 0)
    groups = groups.unionByName(listed(F.lit("Special"), (nation < 3) & (F.col("c_acctbal") < 0), 1))
    groups = groups.unionByName(listed(F.lower("c_mktsegment"), (nation < 10) & (F.col("c_acctbal") > 5000), 2))
    trend = c.select(
        F.concat(F.lower(name), F.when(nation.between(5, 15), F.lit("")).otherwise(F.lit(" closed"))).alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(F.lit("Retail")).alias("cust_group"), "c_custkey")
    opens = c.select(
        F.concat(F.lit(" "), name, F.lit(" ")).alias("soldto"),
        F.when(nation.between(12, 20), F.substring("c_mktsegment", 1, 4)).otherwise(F.lit("  ")).alias("cgroup"), "c_custkey")
    return [
        lookup.PrioritySource(groups, "customer", "group", 1, "Buying Groups", ("r", "c_custkey")),
        lookup.PrioritySource(trend, "name", "cust_group", 2, "Sales Trend", ("c_custkey",)),
        lookup.PrioritySource(opens, "soldto", "cgroup", 3, "Open Orders", ("c_custkey",)),
    ]


def _priority_master(spark, sf):
    o = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = I.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", I.dirty_customer_name().alias("sold_to"))


def _priority(spark, sf, write=False):
    return lookup.priority_lookup(_priority_master(spark, sf), "sold_to", _priority_sources(spark, sf), write=write)


def q_priority_lookup(spark, sf):
    return _priority(spark, sf).frame.select("o_orderkey", "buying_group", "buying_group_source", "buying_group_status")


def q_priority_exceptions(spark, sf):
    return _priority(spark, sf, write=True).exceptions


def q_matches_by_source(spark, sf):
    from ..operators import audit

    r = _priority(spark, sf).frame
    return audit.matches_by_source(r, "buying_group_status", "buying_group_source").select(
        F.col("buying_group_source").alias("source"), "matched_rows")


# --------------------------------------------------------------------------
# Latest-wins / conflict lookup: E8, I2, J6
# --------------------------------------------------------------------------

def _latest(spark, sf, dated: bool, write=False):
    ev = I.table(spark, sf, "events")
    src = ev.select("event_id", "ts", F.col("user_id").cast("string").alias("ndc"), F.col("event_type").alias("comment"))
    master = I.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("ndc_code"))
    return lookup.latest_lookup(
        master, src, master_ndc="ndc_code", master_customer="c_name", source_ndc="ndc", value_col="comment",
        order_by=["event_id"], date=F.col("ts") if dated else None, write=write,
    )


def q_latest_lookup(spark, sf):
    return _latest(spark, sf, True).frame.select("c_custkey", "sc_comments", "sc_comments_status")


def q_latest_exceptions(spark, sf):
    return _latest(spark, sf, True, write=True).exceptions


def q_comment_conflict_rows(spark, sf):
    rows = _latest(spark, sf, False, write=True).long_exceptions().filter("status <> 'NOT_FOUND'")
    return rows.select("normalized_ndc", "comments", "status")


def q_conflict_lookup(spark, sf):
    return _latest(spark, sf, False).frame.select("c_custkey", "sc_comments", "sc_comments_status")


def q_conflict_exceptions(spark, sf):
    return _latest(spark, sf, False, write=True).exceptions


# --------------------------------------------------------------------------
# Statistics, grain, summary enrichment: G8, E11, E13, E15, J10
# --------------------------------------------------------------------------

def _stat_master(spark, sf):
    m = I.master_orders(spark, sf)
    return m.select(
        "l_orderkey", "o_custkey", "ndc_code", K.lookup_key("ndc_code", "sold_to").alias("lookup"),
        F.when(F.col("p_type") != "SMALL", F.col("p_name")).alias("material"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size")).alias("moq"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * 10).alias("stock"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("buying_group"),
        F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("award"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("comments"),
    )


def q_master_statistics(spark, sf):
    from ..operators import audit

    m = _stat_master(spark, sf)
    return audit.master_statistics(
        m, I.table(spark, sf, "lineitem"), order_col="l_orderkey", customer_col="o_custkey", ndc_col="ndc_code",
        lookup_col="lookup", completion_cols=["material", "moq", "stock", "buying_group", "award", "comments", "not_there"],
    )


def q_grain_check(spark, sf):
    from ..operators import audit

    o = I.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    li = I.table(spark, sf, "lineitem").select("l_orderkey")
    after = o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
    _, dropped = audit.grain_check(o, after, ["o_orderkey", "o_custkey"])
    return dropped


def q_grain_counts(spark, sf):
    from ..operators import audit

    o = I.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    li = I.table(spark, sf, "lineitem").select("l_orderkey")
    after = o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
    counts, _ = audit.grain_check(o, after, ["o_orderkey", "o_custkey"])
    return counts


def _closed_customers(spark, sf):
    """Every customer; one without a positive balance goes by another name, so that masters miss it."""
    c = I.table(spark, sf, "customer")
    return c.withColumn("c_name", F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit(" closed"))))


def q_membership(spark, sf):
    from ..operators import audit

    m = I.master_orders(spark, sf)
    return audit.membership_count(m, K.text_key("sold_to"), _closed_customers(spark, sf), K.text_key("c_name"))


def q_key_health(spark, sf):
    from ..operators import audit

    m = I.master_orders(spark, sf).withColumn("lookup", K.lookup_key("ndc_code", "sold_to"))
    return audit.key_health(m, "ndc_code", "sold_to", "lookup")


def q_summary_enriched(spark, sf):
    # the aggregate and the first row per Lookup in one pass over the detail
    e = summary.sales_summary_with_firsts(
        _summary_rows(spark, sf, I.buyers(spark, sf)), "Lookup", ["Buying Group", "Award Type", "SC Comments"], list(I.LINE_ORDER))
    return e.select(
        F.col("Lookup").alias("lookup"), F.col("Material Description").alias("material_description"),
        F.col("Sold-to party Name").alias("sold_to_party_name"), F.col("NDC Code").alias("ndc_code"),
        F.col("Buying Group").alias("buying_group"), F.col("Award Type").alias("award_type"),
        F.col("SC Comments").alias("sc_comments"),
    )



# --------------------------------------------------------------------------
# Sources: A2-A7, A13, C4, C5, C15 over data-derived sheets and schemas
# --------------------------------------------------------------------------

def _conversation_sheets(spark, sf):
    """Raw 'sheets': one per conversation, one row per turn, cells = role,
    turn number and the words of the turn (whole texts)."""
    cv = I.table(spark, sf, "conversations")
    cells = F.concat(F.array(F.col("role"), F.col("turn").cast("string")), F.split(F.col("text"), " ", -1))
    return cv.select(F.lit("conversations").alias("workbook"), F.col("conv_id").cast("string").alias("sheet"),
                     F.col("turn").alias("row_idx"), cells.alias("cells"))


def q_header_rows(spark, sf):
    from ..sources import discovery as D

    return D.detect_header_rows(_conversation_sheets(spark, sf)).select("sheet", "header_idx", "score", "has_data")


def q_header_issues(spark, sf):
    from ..sources import discovery as D

    raw = _conversation_sheets(spark, sf)
    return D.header_issues(D.header_table(raw)).select("sheet", "code", "detail")


def _word_sheets(spark, sf):
    """A header table from data: a sheet per language in a workbook per source, its headers the words of its documents."""
    words = I.table(spark, sf, "documents").select(
        F.col("source").alias("workbook"), F.col("lang").alias("sheet"), F.explode(F.split("text", " ", -1)).alias("header"))
    return words.distinct().withColumn("has_data", F.lit(True))


# The registry used to exercise discovery on these sheets.
def _registry():
    from ..sources.discovery import SourceDefinition as S

    return [
        S("english", ("the", "and")),
        S("german", ("der", "die"), preferred_sheets=("de",), filename_keywords=("src7",)),
        S("one_file", ("le", "que"), filename_keywords=("src11",), mandatory=False),
        S("one_sheet", ("that",), preferred_sheets=("en",), filename_keywords=("src19",)),
        S("unmatched_word", ("that",), filename_keywords=("x_no_match",), mandatory=False),
        S("dashed", ("TH-E",), mandatory=False),
        S("spelled", ("THE", "And "), filename_keywords=("src4",), mandatory=False),
        S("missing_src", ("no_such_column",), mandatory=False),
    ]


def q_discover_sources(spark, sf):
    from ..sources import discovery as D

    return D.discover(_word_sheets(spark, sf), _registry()).select(
        "logical", "status", "sheet", F.array_join("candidates", ",").alias("candidates"), "mandatory")


def q_discover_normalized(spark, sf):
    from ..sources import discovery as D

    return D.discover(_word_sheets(spark, sf), _registry(), match="normalized").select("logical", "status", "sheet")


def q_validation_issues(spark, sf):
    from ..sources import validate as V
    from ..sources.discovery import SourceDefinition as S

    o = I.table(spark, sf, "orders")
    staged = o.select("o_orderkey", "o_orderstatus",
                      F.when(F.col("o_orderstatus") == "X", F.lit("never")).alias("o_comment"),
                      F.when(F.col("o_orderstatus") == "F", F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    blank_rows = staged.select(F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey").cast("string")).alias("k"),
                               F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("s"))
    tables = {"orders_src": staged, "blank_rows": blank_rows}
    defs = [S("orders_src", ("o_orderkey", "o_custkey"), ("o_orderpriority", "o_clerk")),
            S("blank_rows", ("k",)), S("uploads", ("NDC Code",), mandatory=False), S("awards", ("Award Type",))]
    return V.validate_tables(spark, tables, defs)


# --------------------------------------------------------------------------
# Profiling: D1, D2, D4, D6, D7, D8
# --------------------------------------------------------------------------

def q_table_profile(spark, sf):
    from ..operators import profile as P

    return P.table_profile(I.table(spark, sf, "customer"), "customer").unionByName(
        P.table_profile(I.table(spark, sf, "orders"), "orders")).unionByName(
        P.table_profile(I.table(spark, sf, "lineitem"), "lineitem")).unionByName(
        P.table_profile(_swapped(spark, sf), "swapped"))


def _swapped(spark, sf):
    """The priority on one side or the other, a null beside it: equal values that are different rows."""
    final = F.col("o_orderstatus") == "F"
    return I.table(spark, sf, "orders").select(
        F.when(final, F.col("o_orderpriority")).alias("a"), F.when(~final, F.col("o_orderpriority")).alias("b"))


def q_column_profile(spark, sf):
    from ..operators import profile as P

    return P.column_profile(I.table(spark, sf, "customer"), "customer", order_by=["c_custkey"])


def q_infer_types(spark, sf):
    from ..operators import profile as P

    o = I.table(spark, sf, "orders").select(
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")],
        F.when(F.col("o_orderstatus") == "F", F.lit("yes")).otherwise(F.lit("No")).alias("is_final"),
        F.concat(F.lit("("), F.col("o_custkey").cast("string"), F.lit(")")).alias("credit"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ")).alias("note"),
    )
    return P.infer_types(o, "orders")


JOIN_HINTS = {
    "customer_key": ("c_custkey", "o_custkey", "Customer Key"),
    "order_key": ("o_orderkey", "L_ORDERKEY"),
    "part_key": ("p_partkey", "l_partkey", "ps_partkey"),
    "document": ("doc_id",),
    "nation": ("n_nationkey", "c_nationkey", "s_nationkey"),
    "absent": ("no_such_header",),
}

WORD_HINTS = {
    "article": ("the", "DER", "le"),
    "conjunction": ("and", " UND "),
    "relative": ("that", "que"),
    "rare": ("edthe",),
    "absent": ("no_such_header",),
}

KEY_RULES = (
    ("english", ("the",)),
    ("german", ("der", "die")),
    ("rare", ("edthe",)),
    ("none", ("no_such_header",)),
)


def q_join_key_candidates(spark, sf):
    from ..operators import profile as P

    return P.join_key_candidates(_word_sheets(spark, sf), WORD_HINTS)


def q_recommended_keys(spark, sf):
    from ..operators import profile as P

    return P.recommended_keys(_word_sheets(spark, sf), KEY_RULES).select(F.col("workbook").alias("table_name"), F.array_join("recommended_keys", ",").alias("keys"))


def q_fingerprint(spark, sf):
    from ..operators import profile as P

    def whole(name):
        # doubles as whole hundredths and times as text: engines print them differently
        df = I.table(spark, sf, name)
        text = {"double": lambda c: F.round(F.col(c) * 100).cast("long"), "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")}
        return df.select(*[text.get(t, F.col)(c).alias(c) for c, t in df.dtypes])

    return P.fingerprint(whole("orders"), "orders").unionByName(P.fingerprint(whole("lineitem"), "lineitem"))


def q_column_dictionary(spark, sf):
    from ..operators import profile as P

    prof = P.column_profile(I.table(spark, sf, "orders"), "orders", order_by=["o_orderkey"])
    return P.column_dictionary(prof, JOIN_HINTS).select("column", "join_key", "business_meaning")



# --------------------------------------------------------------------------
# Whole flow: E16, E17, C10, C11, J2, J9
# --------------------------------------------------------------------------

def _flow(spark, sf):
    from . import flow

    tables, order = I.flow_tables(spark, sf)
    return flow.run_phases(flow.FlowInputs(tables, order, flow.FlowConfig(keywords=KEYWORDS, low_stock_threshold=2000.0)))


def _named(c: str) -> str:
    """A header as a plain column name."""
    return re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_")


def q_flow_detail(spark, sf):
    d = _flow(spark, sf).detail
    return d.select(*[(F.round(F.col(f"`{c}`"), 4) if t == "double" else F.col(f"`{c}`")).alias(_named(c)) for c, t in d.dtypes])


def q_flow_summary(spark, sf):
    r = _flow(spark, sf)
    months = {m: f"m{i + 1}" for i, m in enumerate(r.month_labels)}
    named = r.summary.select(*[
        (F.round(F.col(f"`{c}`"), 4) if t == "double" else F.col(f"`{c}`")).alias(months.get(c) or _named(c)) for c, t in r.summary.dtypes])
    return named.withColumn("months", F.lit(",".join(r.month_labels)))


def q_flow_statistics(spark, sf):
    return _flow(spark, sf).statistics


def q_flow_audit_counts(spark, sf):
    r = _flow(spark, sf)
    return r.audits()


def q_flow_merge_audit(spark, sf):
    return _flow(spark, sf).merge_audit


# --------------------------------------------------------------------------
# Cleaning, key table, validation table, audits: C1, B13, B14, F6, J5, J8
# --------------------------------------------------------------------------

def _messy_orders(spark, sf):
    o = I.table(spark, sf, "orders")
    base = o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("order_no"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("  ")).alias("customer"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("amount"),
        F.concat(F.col("o_orderpriority"), F.lit("\t")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    return base.unionByName(base.filter(F.col("status") == "P"))


def q_clean_columns(spark, sf):
    from ..operators import clean as C

    spec = C.CleanSpec(required=("order_no", "customer", "amount", "priority"), numeric=("order_no", "amount"))
    return C.clean_columns(_messy_orders(spark, sf), spec)


def q_lookup_key_table(spark, sf):
    from ..operators import audit

    m = I.master_orders(spark, sf)
    proj, _ = audit.lookup_key_table(m, "ndc_code", "sold_to", "c_name")
    return proj


def q_key_change_counters(spark, sf):
    from ..operators import audit

    _, counters = audit.lookup_key_table(I.master_orders(spark, sf), "ndc_code", "sold_to", "c_name")
    return counters


def q_moq_validation(spark, sf):
    x = _moq_input(spark, sf)
    return rules.moq_validation(x, "l_orderkey", "l_partkey", "pack_size", "qty")


def q_priority_audit(spark, sf):
    from ..operators import audit

    m, srcs = _priority_master(spark, sf), _priority_sources(spark, sf)
    r = lookup.priority_lookup(m, "sold_to", srcs, write=True)
    return audit.priority_audit(r, srcs, m, "sold_to")


def q_summary_audit(spark, sf):
    from ..operators import audit

    m = I.master_orders(spark, sf)
    s = _summary(spark, sf)
    period = history.reporting_month(I.table(spark, sf, "orders"), "o_orderdate")
    hist_keys = _closed_customers(spark, sf).select(K.text_key("c_name").alias("k"))
    return audit.summary_audit(m, s, period, hist_keys, K.text_key("sold_to"))


QUERIES: dict[str, Query] = {
    "F1_net_inventory": q_net_inventory,
    "F1_net_counters": q_net_counters,
    "C6_hold_filter_counters": q_hold_filter_counters,
    "E10_missing_inventory": q_missing_inventory,
    "C8_upload_totals": q_upload_totals,
    "B1_clean_documents": q_clean_documents,
    "B2_text_keys_customer": q_text_keys_customer,
    "B4_digits_keys_orders": q_digits_keys_orders,
    "B9_sku_to_ndc": q_sku_to_ndc,
    "B12_lookup_keys": q_lookup_keys,
    "B17_month_headers": q_month_headers,
    "B18_month_labels": q_month_labels,
    "G9_reporting_month": q_reporting_month,
    "H2_prior_months": q_prior_months,
    "F2_keyword_flag": q_keyword_flag,
    "F3_price_issue": q_price_issue,
    "F4_low_stock": q_low_stock,
    "F5_moq_checks": q_moq_checks,
    "F8_rule_counters": q_rule_counters,
    "F9_highlights": q_highlights,
    "F10_low_stock_highlight": q_low_stock_highlight,
    "G1_sales_summary": q_sales_summary,
    "E4_first_order_per_customer": q_first_order_per_customer,
    "E1_enrich": q_enrich,
    "J1_enrich_audit": q_enrich_audit,
    "G5_duplicate_analysis": q_duplicate_analysis,
    "E6_award_lookup": q_award_lookup,
    "J3_award_exceptions": q_award_exceptions,
    "J3_award_conflict_rows": q_award_conflict_rows,
    "E6_award_counters": q_award_counters,
    "E7_priority_lookup": q_priority_lookup,
    "J4_priority_exceptions": q_priority_exceptions,
    "G10_matches_by_source": q_matches_by_source,
    "E8_latest_lookup": q_latest_lookup,
    "J6_latest_exceptions": q_latest_exceptions,
    "E8_conflict_lookup": q_conflict_lookup,
    "J6_conflict_exceptions": q_conflict_exceptions,
    "J6_comment_conflict_rows": q_comment_conflict_rows,
    "G8_master_statistics": q_master_statistics,
    "E11_grain_check": q_grain_check,
    "E11_grain_counts": q_grain_counts,
    "E15_membership": q_membership,
    "J10_key_health": q_key_health,
    "E13_summary_enriched": q_summary_enriched,
    "A3_header_rows": q_header_rows,
    "C5_header_issues": q_header_issues,
    "A2_discover_sources": q_discover_sources,
    "A6_discover_normalized": q_discover_normalized,
    "C4_validation_issues": q_validation_issues,
    "D1_table_profile": q_table_profile,
    "D2_column_profile": q_column_profile,
    "D4_infer_types": q_infer_types,
    "D6_join_key_candidates": q_join_key_candidates,
    "D7_recommended_keys": q_recommended_keys,
    "D8_fingerprint": q_fingerprint,
    "D3_column_dictionary": q_column_dictionary,
    "FLOW_detail": q_flow_detail,
    "FLOW_summary": q_flow_summary,
    "FLOW_statistics": q_flow_statistics,
    "FLOW_audit_counts": q_flow_audit_counts,
    "FLOW_merge_audit": q_flow_merge_audit,
    "C1_clean_columns": q_clean_columns,
    "B13_lookup_key_table": q_lookup_key_table,
    "B14_key_change_counters": q_key_change_counters,
    "F6_moq_validation": q_moq_validation,
    "J5_priority_audit": q_priority_audit,
    "J8_summary_audit": q_summary_audit,
}


from . import extra  # noqa: E402

QUERIES.update(extra.QUERIES)
