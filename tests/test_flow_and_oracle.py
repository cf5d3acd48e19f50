"""End-to-end flow on the smallest driver tables and every registered query
against its DuckDB oracle (the driver's correctness gate, at sf0.001)."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def flow_run(spark):
    from ledgerlake.plans import flow, inputs

    tables, order = inputs.flow_tables(spark, SF)
    return flow.run_phases(flow.FlowInputs(tables, order)), tables


def test_flow_preserves_grain_and_lays_out_every_column(flow_run):
    r, tables = flow_run
    n_master = tables["orderbook"].count()
    assert r.detail.count() == n_master
    g = r.grain.collect()[0]
    assert g["rows_before"] == g["rows_after"] == n_master and g["dropped_keys"] == 0
    assert len(r.detail.columns) == 37 + 3 and r.detail.columns[:4] == ["Sales Order No.", "Item No.", "Lookup", "Matl.\nCode"]
    assert r.summary.columns[:4] == [" Material Description", "Sold-to party Name", "Lookup", "NDC Code"]
    assert r.summary.columns[9:13] == [*r.month_labels, "Avg"]
    filled = r.summary.selectExpr("count(`Max of Sales Qty MTD`) a", "count(`Max of Forecast Qty`) b", "count(Avg) c").first()
    assert min(filled) > 0


def test_flow_results_read_what_was_written(flow_run):
    """The result tables read the written lines, and not the joins or sources before them."""
    r, _ = flow_run
    for df in (r.detail, r.summary, r.statistics, r.grain, r.audit_counts, r.exception_counts, r.summary_audit, r.exceptions["sc_comments"]):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderpriority" not in plan and "o_totalprice" not in plan and plan.count("Join") <= 8
    assert "Join" not in r.grain._jdf.queryExecution().optimizedPlan().toString()


def test_observed_counters_agree_with_the_written_lines(flow_run):
    r, _ = flow_run
    got = {(x["table"], x["metric"]): int(x["value"]) for x in r.audits().collect()}
    lines = r.lines
    assert got["audit", "Missing Awards"] == lines.filter("award_type is null").count()
    assert got["audit", "Price Issues"] == lines.filter("price_issue").count()
    assert got["audit", "Unique NDCs"] == lines.select("ndc").distinct().filter("ndc is not null").count()
    assert got["summary", "Aggregated Rows"] == r.summary.count()
    assert got["exceptions", "MISSING_HISTORICAL_SALES"] == lines.filter("not _hit_history").count()


CSVS = {
    "export 1.csv": """Orderbook of the day

Sales Order No.,Item No.,Matl.Code,NDC Code,Material Description,Sales Order Qty,Sales Qty MTD,Forecast Qty,Sold-to party Name,PackSize(MOQ),Unit Price,WAC/BG price in EDI,PO date,Action
1,10,M1,64380-0161-01,,24,,"1,000",Acme Corp,12,5.00,5.00,2026-08-03,
1,20,M1,64380-0161-01,Old text,7,3,,acme  corp,12,0.00,5.00,2026-08-04,Hold
2,10,M2,11111-0222-33,Gear,10,,,Beta,,2.50,2.00,2026-08-05,Cancel
2,10,M2,11111-0222-33,Gear,10,,,Beta,,2.50,2.00,2026-08-05,Cancel
3,10,M9,99999-999-99,"Plate, red",5,,,Nobody,0,1.00,1.00,2026-07-30,
""",
    "items.csv": """HANA Material,NDC code,Material Description,MOQ 
M1,64380016101,Paracetamol,6
M2,11111022233,Gear text,4
""",
    "stock.csv": """NDC,SKU,Description,Actual Quantity,Allocated Quantity,Inventory,Hold Codes
64380016101,s1,d1,50,1,12000,
64380016101,s1,d1,9,1,500,Q
11111022233,s2,d2,5,0,30,
""",
    "open.csv": """SKU, Total ,Pickticket Status,PH_SOLDTO_NAME,Customer Group
64380-161-01,100,Open,Acme Corp,OPEN GROUP
64380-161-01,900,Loaded,Acme Corp,
11111-222-33,50,Open,Beta,Beta Open
""",
    "groups.csv": """Customer,Customer buying group
ACME CORP,Group A
Acme Corp,group a
""",
    "awards.csv": """NDC,Customer,Award Type,Lookup
64380016101,Acme Corp,Primary,64380016101ACME CORP
11111022233,Other,Secondary,11111022233OTHER
""",
    "tracker.csv": """NDC,Comments,Tracker Date,Customer ETA
64380016101,Short supply,2026-08-01,Sept
64380016101,Back in stock,2026-08-02,Oct
""",
    "trend.csv": """Material Description,Cust Group,NDC Code,Sold-to party Name,x, May-26 ,June 2026, Jul-26 ,July 2026
p,Trend Group,64380016101,Acme Corp,64380016101acme corp,10, - ,"1,040",7
""",
    "adjustments.csv": """NDC Code,Reason Code,Action,Sales Order Qty
64380016101,1.0,Yes,200
64380016101,9,Yes,999
""",
    "detail.csv": """NDC,Comments
our own,output
""",
}


def test_from_csv_files_to_written_tables(spark, tmp_path):
    from ledgerlake.plans import flow
    from ledgerlake.sources import sinks

    (tmp_path / "in").mkdir()
    for name, text in CSVS.items():
        (tmp_path / "in" / name).write_text(text)
    flow.run_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), flow.FlowConfig(keywords=("PARACETAMOL",)))
    got = sinks.read_run(spark, str(tmp_path / "out"))
    detail = {(r["Sales Order No."], r["Item No."]): r for r in got["detail"].collect()}
    assert sorted(detail) == [("1", "10"), ("1", "20"), ("2", "10"), ("3", "10")]  # the repeated line is gone
    a, b, c, d = (detail[k] for k in sorted(detail))
    assert (a["Lookup"], a["Material Description"], b["Material Description"]) == ("64380016101ACME CORP", "Paracetamol", "Old text")
    assert (float(a["UPS Inventory"]), float(c["UPS Inventory"]), d["UPS Inventory"]) == (11700.0, 0.0, None)  # 12000 - 100 - 200; 30 - 50
    assert (a["Pack Size (MOQ)"], c["Pack Size (MOQ)"], d["Pack Size (MOQ)"]) == ("6", "4", "0")
    assert (b["row_fill"], c["row_fill"], a["row_fill"], d["row_fill"]) == ("ADD8E6", "FF0000", "FFC0CB", None)
    assert b["price_fill"] == "ADD8E6" and a["Forecast Qty"] == "1,000" and d["SOM Indc."] is None
    summary = {r["Lookup"]: r for r in got["summary"].collect()}
    assert got["summary"].columns[9:13] == ["May", "Jun", "Jul", "Avg"]
    assert summary["64380016101ACME CORP"]["Buying Group"] == "Group A" and summary["11111022233BETA"]["Buying Group"] == "Beta Open"
    acme = summary["64380016101ACME CORP"]
    assert (acme["May"], acme["Jun"], acme["Jul"], acme["Avg"], acme["SC Comments"], acme["Award Type"]) == (10.0, None, 1040.0, 525.0, "Back in stock", "Primary")
    audits = {(r["table"], r["metric"]): r["value"] for r in got["audit_counts"].collect()}
    assert audits["audit", "Total Master Rows"] == "4" and audits["summary", "Reporting Month"] == "8"
    assert audits["derived", "Inventory Rows"] == "2" and audits["grain", "dropped_keys"] == "0"
    merge = {r["source"]: r for r in got["merge_audit"].collect()}
    assert merge["moq"]["rows_updated"] == 3 and merge["sales_trend"]["join_key"] == "lookup" and "sales_summary" not in merge


def test_registry_views_and_lint(spark):
    from ledgerlake.sources import discovery as D
    from ledgerlake.sources import registry as R

    definitions = [s.definition() for s in R.SOURCES]
    assert ("critical_inventory_tracker", "orderbook") not in D.signature_collisions(definitions)
    assert len({d.name for d in definitions}) == 10 and sum(not d.mandatory for d in definitions) == 2
    upload = next(s for s in R.SOURCES if s.name == "upload_sheet")
    df = spark.createDataFrame([("1", "2", "y", 3, "z")], "` NDC ` string, reason_code string, ACTION string, `Sales order qty` int, other string")
    assert upload.view(df).columns == ["ndc", "reason", "action", "quantity", "other"]
    assert upload.header("reason") == "Reason Code"


def test_counters_do_not_expand_rows(spark):
    from ledgerlake.plans.catalog import QUERIES

    assert "Expand" not in QUERIES["C6_hold_filter_counters"](spark, SF)._jdf.queryExecution().toString()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_all_queries_match_oracle(spark):
    import duckdb

    from ledgerlake.plans.catalog import QUERIES
    from ledgerlake.plans.oracle import SQL

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    assert sorted(SQL) == sorted(QUERIES)
    for name, fn in QUERIES.items():
        df = fn(spark, SF)
        cols = sorted(df.columns)
        srows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        res = con.execute(SQL[name])
        dcols = [d[0] for d in res.description]
        idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
        if idx is None:
            bad.append((name, "columns", cols, sorted(dcols)))
            continue
        drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
        if srows != drows:
            bad.append((name, len(srows), len(drows)))
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["ndc", "inventory", "total", "upload_qty", "ups_inventory"]
    assert df.count() >= 0


def test_lines_are_dealt_once_per_kind_of_key(spark):
    """Joins on one key follow each other whatever the sources' order, and columns still fill in that order."""
    import datetime as dt

    from ledgerlake.plans import flow

    make = spark.createDataFrame
    day = dt.date(2026, 4, 2)
    tables = {
        "orderbook": make([(1, 1, "1", "11", "Ann", None, day, 1), (2, 1, "2", "22", "Bob", "own", day, 2), (3, 1, None, None, None, None, day, 3)],
                          "order_number int, item_number int, material_code string, ndc string, customer string, material_description string, po_date date, _row long"),
        "moq": make([("1", "by moq", 5, 0)], "material_code string, material_description string, moq int, _row long"),
        "inventory": make([("11", 7, 9, None, 0)], "ndc string, actual_quantity int, inventory int, hold_codes string, _row long"),
        "open_order_summary": make([("00011-000-00", 1, "open", " ann ", "G", 0)], "sku string, total int, status string, customer string, customer_group string, _row long"),
        "sales_summary": make([("11ANN", "11", 4, "by sales", 0), ("22BOB", "22", 6, "by sales", 1)], "lookup string, ndc string, quantity int, material_description string, _row long"),
        "sales_trend": make([("22BOB", "bob", "T", "by trend", "3", 0)], "lookup string, customer string, customer_group string, material_description string, `Mar 2026` string, _row long"),
        "awards": make([("11ANN", "11", "Primary", 0)], "lookup string, ndc string, award_type string, _row long"),
        "critical_inventory_tracker": make([("22", "soon", 0)], "ndc string, comments string, _row long"),
    }
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    keep = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fi = flow.FlowInputs(tables)
        r = flow.run_phases(fi)
        lines, _ = flow.order_lines(fi)
        hist, period = flow.prior_months(fi, lines)
        m = flow.build_master(fi, lines, flow.net_stock(fi), hist, r.month_labels)
        plan = m.frame._jdf.queryExecution().executedPlan().toString()
        assert [plan.count(f"hashpartitioning({k}#") for k in ("_ndc_k", "_lk_k", "_cust_k")] == [1, 1, 1]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    got = {x.order_number: x for x in r.lines.collect()}
    assert [got[i].material_description for i in (1, 2, 3)] == ["by moq", "own", None]
    assert (got[1].inventory, got[1].award_type, got[1].buying_group, got[1].quantity, got[2].Mar, got[2].sc_comments, got[2].buying_group) == (9, "Primary", "G", 4, 3.0, "soon", "T")
    assert [x.rows_updated for x in r.merge_audit.collect()] == [1, 1, 1, 2, 1, 1, 2, 1]


def test_trend_sums_one_value_per_month(spark):
    """The trend's months are one sum each and no aggregate column each; a month without a price is blank."""
    import datetime as dt

    from ledgerlake.plans import inputs

    at = lambda m: dt.datetime(1995, m, 3)
    rows = [("1-1", "Ann", "O", at(2), 1000.7, "HOUSEHOLD", "Ann", 50, 4, "nut"), ("11", "ann", "O", at(2), 500.2, "HOUSEHOLD", "Ann", 3, 3, "gear"),
            ("11", "Ann", "O", at(3), None, "HOUSEHOLD", "Ann", 3, 9, "nut"), (None, " ", "O", at(1), 5.0, "BUILDING", "Bob", 3, 9, "nut")]
    m = spark.createDataFrame(rows, "ndc_code string, sold_to string, l_linestatus string, o_orderdate timestamp, l_extendedprice double, c_mktsegment string, "
                                    "c_name string, p_size int, l_suppkey long, p_name string")
    trend = inputs.sales_trend(spark, m)
    assert trend._jdf.queryExecution().optimizedPlan().toString().count("sum(") == 1
    (got,) = trend.collect()
    feb, mar, jan = [next(c for c in trend.columns if c.strip().startswith(n) and "1995" in c or c.strip() == f"{n}-95") for n in ("Feb", "Mar", "Jan")]
    assert (got["lookup"], got["status"], got["customer"], got["customer_group"], got["contract_id"], got["material_description"]) == ("11ANN", "O", "Ann closed", "Retail", "C3", "T: gear")
    assert (got[feb], got[mar], got[jan], got["January 1995"]) == ("1,500", " - ", " - ", "1")


def _below(plan, exchange):
    """The operator that feeds each exchange of this kind."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, x in enumerate(lines) if f"hashpartitioning({exchange}#" in x]


def test_lookups_deal_keys_and_not_whole_lines(spark):
    """The lines' own columns are dealt once, by the lines' number."""
    import datetime as dt

    from ledgerlake.plans import flow

    make = spark.createDataFrame
    orders = make([(1, 1, "7", "11", "Ann", "note", dt.date(2026, 4, 2), 0), (2, 1, None, None, None, None, dt.date(2026, 4, 2), 1)],
                  "order_number int, item_number int, material_code string, ndc string, customer string, po_number string, po_date date, _row long")
    stock = make([("11", 7, 9, None, 0)], "ndc string, actual_quantity int, inventory int, hold_codes string, _row long")
    sold = make([("11", 1, "open", "Ann", "G", 0)], "sku string, total int, status string, customer string, customer_group string, _row long")
    moq = make([("7", "nut", 5, 0)], "material_code string, material_description string, moq int, _row long")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    keep = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fi = flow.FlowInputs({"orderbook": orders, "inventory": stock, "open_order_summary": sold, "moq": moq})
        lines, _ = flow.order_lines(fi)
        m = flow.build_master(fi, lines, flow.net_stock(fi), None, ("Mar 2026",)).frame
        plan = m._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    for key in ("_ndc_k", "_cust_k", "_mk_moq"):
        (fed,) = _below(plan, key)
        assert "po_number" not in fed, key
    got = {x.order_number: x for x in m.collect()}
    assert (got[1].po_number, got[1].moq, got[1].actual_quantity, got[1].buying_group) == ("note", 5, 7, "G")
    assert (got[2].moq, got[2].actual_quantity, got[2].buying_group, len(got)) == (None, None, None, 2)


def test_a_written_table_leaves_no_shuffle_files(spark):
    """What was shuffled for one written step does not lie on the disks beside the next step's."""
    from ledgerlake.plans.session import cut_lineage

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    before = files()
    table = cut_lineage(spark.range(1000).repartition(3, "id"))
    assert not files() - before and table.count() == 1000


def test_audits_make_each_key_once(spark):
    """Counting the keys that no line has makes a row's key once, and the sources among the lines read their Lookup."""
    from ledgerlake.operators import lookup
    from ledgerlake.plans import inputs

    source = spark.createDataFrame([(" a ",), ("A",), ("b",), (None,), ("  ",)], "name string")
    lines = spark.createDataFrame([("b ",), (None,)], "customer string")
    missing = lookup.missing_keys(source, lines, lookup.JoinStrategy.on("Name", ("customer", "name", "text")))
    assert missing._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 2
    assert [r.rows_missing for r in missing.collect()] == [1]
    tables, _ = inputs.flow_tables(spark, SF)
    assert "translate(" not in tables["sales_summary"]._jdf.queryExecution().optimizedPlan().toString()
    sold = tables["sales_summary"].select("ndc", "lookup").distinct()
    assert sold.where("ndc is null and lookup like '1%'").count() == 0 and sold.where("lookup is not null").count() > 0


def _small_flow(spark, lines=40):
    import datetime as dt

    from ledgerlake.plans import flow

    make, day = spark.createDataFrame, dt.date(2026, 4, 2)
    orders = make([(i, 1, str(i % 5), None if i % 7 == 0 else str(i % 9), None if i % 3 == 0 else f"C{i % 4}", "note", 2.0, day, i) for i in range(lines)],
                  "order_number int, item_number int, material_code string, ndc string, customer string, po_number string, quantity double, po_date date, _row long")
    return flow.FlowInputs({
        "orderbook": orders,
        "inventory": make([("1", 7, 9, None, 0), ("2", 1, 5, None, 1)], "ndc string, actual_quantity int, inventory int, hold_codes string, _row long"),
        "open_order_summary": make([("11", 1, "open", "C1", "G", 0)], "sku string, total int, status string, customer string, customer_group string, _row long"),
        "moq": make([("2", "nut", 5, 0)], "material_code string, material_description string, moq int, _row long"),
        "awards": make([("1C1", "1", "Primary", 0), ("x", "4", "Second", 1)], "lookup string, ndc string, award_type string, _row long"),
        "critical_inventory_tracker": make([("2", "soon", 0), ("2", "late", 1)], "ndc string, comments string, _row long"),
        "sales_trend": make([("1C1", "C1", "T", "3", 0)], "lookup string, customer string, customer_group string, `Mar 2026` string, _row long"),
    })


def test_each_kind_of_key_is_written_before_the_next(spark):
    """What each kind of key finds lies in a table of its own, without the lines' columns; the last plan deals by the lines' number only."""
    from ledgerlake.plans import flow
    from ledgerlake.plans.session import cut_lineage

    fi = _small_flow(spark)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    keep = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    given = []

    def write(df):
        given.append(df._jdf.queryExecution().executedPlan().toString())
        assert "po_number" not in df.columns
        return cut_lineage(df)

    try:
        lines, _ = flow.order_lines(fi)
        hist, _ = flow.prior_months(fi, lines)
        net = flow.net_stock(fi)
        apart, whole = flow.build_master(fi, lines, net, hist, ("Mar",), write), flow.build_master(fi, lines, net, hist, ("Mar",))
        kinds = [{k for k in ("_ndc_k", "_lk_k", "_cust_k") if f"hashpartitioning({k}#" in plan} for plan in (*given, apart.frame._jdf.queryExecution().executedPlan().toString())]
        assert all(len(k) <= 1 for k in kinds) and set().union(*kinds) == {"_ndc_k", "_lk_k", "_cust_k"} and not kinds[-1]
        assert apart.frame.columns == whole.frame.columns
        got = sorted(map(str, apart.frame.collect()))
        assert len(got) == 40 and got == sorted(map(str, whole.frame.collect()))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_lines_meet_what_was_found_in_passes(spark, monkeypatch):
    """Several passes hold every line once, count the same and deal a part of the lines each; tables read by nothing more are deleted."""
    import re

    from ledgerlake.plans import flow, session

    fi = _small_flow(spark)
    one = flow.run_phases(fi)
    monkeypatch.setattr(flow, "PASS_LINES", 9)
    lines, before = flow.order_lines(fi)
    parts = flow._passes(lines, lines, before["_rows"])
    sizes = [p.count() for p in parts]
    assert len(sizes) == 5 and sum(sizes) == 40 and max(sizes) < 20
    deleted, forget = [], session.forget
    monkeypatch.setattr(flow, "forget", lambda t: (deleted.append(re.search("table-[0-9a-f]+", t.inputFiles()[0])[0]), forget(t)))
    several = flow.run_phases(fi)
    shown = lambda df: sorted(str(r.asDict()) for r in df.drop("_rid").collect())
    for a, b in ((one.lines, several.lines), (one.summary, several.summary), (one.merge_audit, several.merge_audit), (one.audits(), several.audits()),
                 (one.statistics, several.statistics), (one.exceptions["award"], several.exceptions["award"])):
        assert shown(a) == shown(b)
    assert len(deleted) >= 6 and not set(os.listdir(session.ensure_checkpoint_dir(spark).removeprefix("file:"))) & set(deleted)


def test_a_first_row_leaves_no_shuffle_files(spark):
    from ledgerlake.plans.session import first_row

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    before = files()
    assert first_row(spark.range(1000).repartition(3, "id").selectExpr("count(distinct id) n"))["n"] == 1000
    assert not files() - before
