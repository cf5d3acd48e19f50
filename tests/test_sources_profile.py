"""Sources (A1-A13, C3-C5, C15, C16), profiling (D1-D8) and audit tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import audit as A
from ledgerlake.operators import profile as P
from ledgerlake.sources import discovery as D
from ledgerlake.sources import readers as RD
from ledgerlake.sources import sinks as SK
from ledgerlake.sources import validate as V


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="ledgerlake-test-")


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_header_row_detection_and_csv_read(spark, scratch):
    p = write(os.path.join(scratch, "inventory_0730.csv"),
              "Daily report,,\n2026-07-30,,\nNDC,Inventory,Hold Codes\n64380016101,100,\n64380016101,50,HOLD\n")
    q = write(os.path.join(scratch, "empty_template.csv"), "NDC,Inventory,Hold Codes\n")
    raw = D.raw_head_rows(spark, [p, q])
    hr = {r["sheet"]: r for r in D.detect_header_rows(raw).collect()}
    assert hr["inventory_0730"]["header_idx"] == 2 and hr["inventory_0730"]["has_data"] is True
    assert hr["empty_template"]["has_data"] is False
    headers = [r["header"] for r in D.header_table(raw).filter("sheet = 'inventory_0730'").orderBy("position").collect()]
    assert headers == ["NDC", "Inventory", "Hold Codes"]
    df = RD.read_csv_table(spark, p, header_idx=2, headers=headers)
    assert df.columns == headers and df.count() == 2
    assert sorted(r["Inventory"] for r in df.collect()) == ["100", "50"]


def test_csv_header_repair(spark, scratch):
    p = write(os.path.join(scratch, "dups.csv"), "a,,a,b\n1,2,3,4\n")
    df = RD.read_csv_table(spark, p)
    assert df.columns == ["a", "Column 2", "b"] and tuple(df.collect()[0]) == ("1", "2", "4")


def test_repair_headers():
    assert D.repair_headers(["x", None, " ", "x"]) == (["x", "Column 2", "Column 3", "x"], [0, 1, 2])


def test_discovery_statuses(spark):
    headers = spark.createDataFrame([
        ("f1.csv", "orders", 0, "SO#", True), ("f1.csv", "orders", 1, "SKU", True),
        ("f2.csv", "inv_a", 0, "NDC", True), ("f2.csv", "inv_a", 1, "Inventory", True),
        ("f3.csv", "inv_b", 0, "NDC", True), ("f3.csv", "inv_b", 1, "Inventory", True),
        ("f4_template.csv", "tpl", 0, "Award Type", False),
    ], "workbook string, sheet string, position int, header string, has_data boolean")
    defs = [
        D.SourceDefinition("orders", ("SO#", "SKU")),
        D.SourceDefinition("inventory", ("NDC", "Inventory")),
        D.SourceDefinition("inventory_pref", ("NDC", "Inventory"), preferred_sheets=("inv_b",)),
        D.SourceDefinition("inventory_kw", ("NDC", "Inventory"), filename_keywords=("f2",)),
        D.SourceDefinition("awards", ("Award Type",), mandatory=False),
    ]
    got = {r["logical"]: r for r in D.discover(headers, defs).collect()}
    assert (got["orders"]["status"], got["orders"]["sheet"]) == ("RESOLVED", "orders")
    assert got["inventory"]["status"] == "AMBIGUOUS" and list(got["inventory"]["candidates"]) == ["f2.csv::inv_a", "f3.csv::inv_b"]
    assert got["inventory_pref"]["sheet"] == "inv_b" and got["inventory_kw"]["sheet"] == "inv_a"
    assert got["awards"]["status"] == "NOT_FOUND"
    with pytest.raises(D.AmbiguousSourceError):
        D.resolve(D.discover(headers, defs), defs)
    res = D.resolve(D.discover(headers, [defs[0], defs[4]]), [defs[0], defs[4]])
    assert res.resolved == {"orders": ("f1.csv", "orders")} and res.skipped == {"awards": "NOT_FOUND"}
    with pytest.raises(D.SourceNotFoundError):
        D.resolve(D.discover(headers, [D.SourceDefinition("x", ("nope",))]), [D.SourceDefinition("x", ("nope",))])


def test_normalized_discovery_and_registry_lint(spark):
    headers = spark.createDataFrame([("f.csv", "s", 0, "NDC_Code", True)], "workbook string, sheet string, position int, header string, has_data boolean")
    d = [D.SourceDefinition("a", ("ndc-code",))]
    assert D.discover(headers, d).collect()[0]["status"] == "NOT_FOUND"
    assert D.discover(headers, d, match="normalized").collect()[0]["status"] == "RESOLVED"
    assert D.headers_present(["NDC Code"], ["ndc_code "]) and not D.headers_present(["NDC"], ["NDC Code"])
    defs = [D.SourceDefinition("small", ("Customer",)), D.SourceDefinition("big", ("Customer", "Group")),
            D.SourceDefinition("other", ("SKU",))]
    assert D.signature_collisions(defs) == [("small", "big")]
    assert D.exclude_generated(["/run/Detail", "/in/orders.csv", "/run/summary.parquet", "/run/_manifest"]) == ["/in/orders.csv"]


def test_validation_issues(spark):
    t = spark.createDataFrame([("1", None), (None, None)], "a string, b string")
    defs = [D.SourceDefinition("t", ("a", "c"), ("z",)), D.SourceDefinition("gone", ("x",)),
            D.SourceDefinition("opt", ("x",), mandatory=False)]
    issues = {(r["table"], r["code"], r["detail"]) for r in V.validate_tables(spark, {"t": t}, defs).collect()}
    assert ("t", "MISSING_REQUIRED_COLUMN", "c") in issues and ("t", "MISSING_OPTIONAL_COLUMN", "z") in issues
    assert ("gone", "MISSING_WORKBOOK", "gone") in issues and ("opt", "MISSING_OPTIONAL_WORKBOOK", "opt") in issues
    assert ("t", "EMPTY_COLUMNS", "b") in issues and ("t", "EMPTY_ROWS", "1 empty rows") in issues
    assert V.has_errors(V.validate_tables(spark, {"t": t}, defs))
    with pytest.raises(ValueError):
        V.require_columns(t, ["a", "q"], "t")
    with pytest.raises(KeyError):
        RD.get_table({}, "x")
    assert RD.get_table({}, "x", required=False) is None


def test_write_and_read_run(spark, scratch):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    run = SK.write_run({"detail": df}, os.path.join(scratch, "run1"), fmt="csv")
    back = SK.read_run(spark, run)
    assert back["detail"].collect()[0]["x"] == "a"


def test_profiles(spark):
    df = spark.createDataFrame([("1", "a", 2.0), ("1", "a", 2.0), (None, " ", None), ("2", "nan", 3.0)], "k string, t string, v double")
    p = P.table_profile(df, "t").collect()[0]
    assert (p["rows"], p["columns"], p["empty_rows"], p["empty_columns"], p["duplicate_rows"]) == (4, 3, 1, 0, 1)
    cp = {r["column"]: r for r in P.column_profile(df, "t", order_by=["v"]).collect()}
    assert cp["k"]["null_count"] == 1 and cp["k"]["distinct_count"] == 2 and cp["t"]["sample"] == "a"
    types = spark.createDataFrame([("yes", "1,000", "(5)", "2026-01-02", "abc"), ("No", "2.5", "7", "2026-02-03", None)],
                                  "flag string, amount string, credit string, ship_date string, name string")
    got = {r["column"]: r["logical_type"] for r in P.infer_types(types, "t").collect()}
    assert got == {"flag": "Boolean", "amount": "Decimal", "credit": "Integer", "ship_date": "Date", "name": "Text"}


def test_join_key_candidates(spark):
    h = spark.createDataFrame([("w1", "s1", "NDC Code"), ("w2", "s2", "ndc  code"), ("w2", "s3", "Customer")], "workbook string, sheet string, header string")
    got = {r["key_name"]: r for r in P.join_key_candidates(h, {"ndc": ["NDC Code"], "cust": ["customer"], "none": ["zzz"]}).collect()}
    assert got["ndc"]["confidence_pct"] == round((1.0 * 0.7 + 2 / 3 * 0.3) * 100, 2) and got["cust"]["confidence_pct"] == round((0.5 * 0.7 + 1 / 3 * 0.3) * 100, 2)
    assert "none" not in got


def test_fingerprint_order_insensitive(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "i int, s string")
    assert P.fingerprint(a, "t").collect() == P.fingerprint(b, "t").collect()


def test_audit_helpers(spark):
    df = spark.createDataFrame([("a", "n1", "L1"), ("a", None, None), (None, None, None)], "c string, n string, l string")
    kh = A.key_health(df, "n", "c", "l").collect()[0]
    assert (kh["total_rows"], kh["rows_with_ndc"], kh["rows_with_lookup"], kh["rows_missing_lookup"]) == (3, 1, 1, 2)
    dup = df.agg(A.null_aware_duplicates("n").alias("d")).collect()[0]["d"]
    assert dup == 1  # [n1, None, None]: the second None repeats
    before = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    counts, dropped = A.grain_check(before, before.filter("a = 1"), ["a", "b"])
    assert [tuple(r) for r in dropped.collect()] == [(2, 5)] and counts.collect()[0]["dropped_keys"] == 1
    m = A.metrics_long(spark.createDataFrame([(1, "x")], "n long, s string")).collect()
    assert [(r["metric"], r["value"]) for r in m] == [("n", "1"), ("s", "x")]


def test_approx_statistics_close_to_exact(spark):
    df = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("o"), F.lit("c").alias("c"),
                                   (F.col("id") % 700).cast("string").alias("n"), F.col("id").cast("string").alias("l"),
                                   F.lit("x").alias("m"))
    kw = dict(order_col="o", customer_col="c", ndc_col="n", lookup_col="l", completion_cols=["m"])
    exact = A.master_statistics(df, df, **kw).collect()[0]
    approx = A.master_statistics(df, df, approx=True, **kw).collect()[0]
    assert exact["unique_sales_orders"] == 5000
    assert abs(approx["unique_sales_orders"] - 5000) / 5000 < 0.04


def test_header_offset_with_many_splits(spark, scratch):
    """A file cut into several splits: only the first split loses lines."""
    lines = ["title,,", "NDC,Inventory,Hold Codes"] + [f"{i:011d},{i},{'' if i % 2 else 'HOLD'}" for i in range(20000)]
    p = write(os.path.join(scratch, "big_inventory.csv"), "\n".join(lines) + "\n")
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = RD.read_csv_table(spark, p, header_idx=1, headers=["NDC", "Inventory", "Hold Codes"])
        assert df.rdd.getNumPartitions() > 2
        rows = df.collect()
        assert len(rows) == 20000 and sorted(int(r["Inventory"]) for r in rows) == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)


def test_column_profile_approx(spark):
    df = spark.createDataFrame([(str(i % 40), i) for i in range(400)], "k string, v int")
    cp = {r["column"]: r for r in P.column_profile(df, "t", order_by=["v"], approx=True).collect()}
    assert abs(cp["k"]["distinct_count"] - 40) <= 1 and cp["k"]["sample"] == "0"


def test_blank_lines_above_and_below_the_header_lose_no_row(spark, scratch):
    p = write(os.path.join(scratch, "blank_lines.csv"), "Title\n\nNDC,Qty\n1,10\n\n2,20\n3,30\n")
    raw = D.raw_head_rows(spark, p)
    assert [r["row_idx"] for r in D.detect_header_rows(raw).select(F.col("header_idx").alias("row_idx")).collect()] == [2]
    for multiline in (False, True):
        df = RD.read_csv_table(spark, p, header_idx=2, multiline=multiline)
        assert df.columns == ["NDC", "Qty"] and sorted(r["Qty"] for r in df.collect()) == ["10", "20", "30"]


def test_data_far_below_the_header_keeps_its_source(spark, scratch):
    late = write(os.path.join(scratch, "late.csv"), "NDC,Qty\n" + "\n" * 40 + ',""\n' + "7,8\n")
    none = write(os.path.join(scratch, "never.csv"), "NDC,Qty\n" + "\n" * 40 + ',""\n')
    got = {r["sheet"]: r["has_data"] for r in D.file_header_rows(spark, [late, none]).collect()}
    assert got == {"late": True, "never": False}
    headers = D.file_header_table(spark, [late, none])
    found = D.discover(headers, [D.SourceDefinition("stock", ("NDC", "Qty"))]).collect()[0]
    assert (found["status"], found["sheet"]) == ("RESOLVED", "late")
    assert [r["NDC"] for r in RD.read_csv_table(spark, found["workbook"]).filter("Qty = '8'").collect()] == ["7"]


def test_quoted_headers_literal_separators_and_spaces_in_names(spark, scratch):
    p = write(os.path.join(scratch, "Buying Groups 100%.csv"), '"Matl.\nCode","Name, full",x\n1,"a, b",c\n')
    headers = D.file_header_table(spark, p)
    rows = headers.orderBy("position").collect()
    assert [r["header"] for r in rows] == ["Matl.\nCode", "Name, full", "x"]
    assert rows[0]["workbook"].endswith("Buying Groups 100%.csv") and rows[0]["sheet"] == "Buying Groups 100%"
    df = RD.read_csv_table(spark, rows[0]["workbook"])
    assert df.columns == ["Matl.\nCode", "Name, full", "x"] and tuple(df.collect()[0]) == ("1", "a, b", "c")
    q = write(os.path.join(scratch, "pipe.csv"), "A|B\n1|2\n")
    assert [r["header"] for r in D.file_header_table(spark, q, sep="|").orderBy("position").collect()] == ["A", "B"]
    assert RD.read_csv_table(spark, q, sep="|").collect()[0]["B"] == "2"


def test_files_with_another_column_order_are_read_by_name(spark, scratch):
    folder = os.path.join(scratch, "orders")
    os.makedirs(folder)
    write(os.path.join(folder, "a.csv"), "A,B\n1,2\n")
    write(os.path.join(folder, "b.csv"), "B,A,C\n4,3,5\n")
    rows = RD.read_csv_table(spark, folder).orderBy("A").collect()
    assert [(r["A"], r["B"], r["C"]) for r in rows] == [("1", "2", None), ("3", "4", "5")]


def test_quoted_line_breaks_in_data(spark, scratch):
    p = write(os.path.join(scratch, "notes.csv"), 'Report\nid,note\n1,"two\nlines"\n2,"say ""hi"""\n')
    df = RD.read_csv_table(spark, p, header_idx=1, multiline=True)
    assert {r["id"]: r["note"] for r in df.collect()} == {"1": "two\nlines", "2": 'say "hi"'}


def test_a_failed_rerun_leaves_the_previous_run_whole(spark, scratch):
    base = os.path.join(scratch, "runs")
    SK.write_run({"a": spark.range(1), "b": spark.range(2)}, base)
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        SK.write_run({"a": spark.range(5), "b": bad}, base)
    back = SK.read_run(spark, base)
    assert (back["a"].count(), back["b"].count()) == (1, 2)


def test_null_positions_tell_rows_apart(spark):
    a = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    b = spark.createDataFrame([("a", None), ("a", None), ("a", None)], "x string, y string")
    assert P.table_profile(a, "t").collect()[0]["duplicate_rows"] == 1
    one, two = P.fingerprint(a, "t").collect()[0], P.fingerprint(b, "t").collect()[0]
    assert one["value_hash"] != two["value_hash"] and one["fill_hash"] != two["fill_hash"]


def test_plan_of_many_files_is_as_large_as_of_few(spark, scratch):
    """Files with one header are one scan; other heads are groups of their own."""
    folder = os.path.join(scratch, "many files+1")
    os.makedirs(folder)
    for i in range(40):
        write(os.path.join(folder, f"part {i}.csv"), f"A,B\n{i},x\n")
    few = RD.read_csv_table(spark, [os.path.join(folder, f"part {i}.csv") for i in range(3)])
    many = RD.read_csv_table(spark, folder)
    size = lambda df: len(df._jdf.queryExecution().executedPlan().toString().splitlines())
    assert size(few) == size(many) and sorted(int(r["A"]) for r in many.collect()) == list(range(40))
    heads = D.raw_head_rows(spark, folder, 2)
    assert heads._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r["workbook"].rsplit("/", 1)[-1]: list(r["cells"]) for r in heads.filter("row_idx = 1").collect()}
    assert got == {f"part {i}.csv": [str(i), "x"] for i in range(40)}
    write(os.path.join(folder, "report.csv"), "Report\n\nB,A,C\ny,100,z\n")
    write(os.path.join(folder, "short.csv"), "B\n")
    with pytest.raises(ValueError):
        RD.read_csv_table(spark, os.path.join(folder, "short.csv"), 5)
    report = RD.read_csv_table(spark, [os.path.join(folder, "report.csv")] * 1, 2).collect()
    assert [r.asDict() for r in report] == [{"B": "y", "A": "100", "C": "z"}]


def test_heads_of_files_of_many_splits(spark, scratch):
    """Large files are read at their start only; what follows their last whole split may hold other files."""
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        folder = os.path.join(scratch, "splits")
        os.makedirs(folder)
        for i in range(5):
            rows = "".join(f"{i}-{j},value {j}\n" for j in range(400 + 37 * i))
            write(os.path.join(folder, f"big{i}.csv"), f"title {i}\n\nKey,Value\n" + rows)
            write(os.path.join(folder, f"small{i}.csv"), f"title {i}\n\nKey,Value\nonly{i},1\n")
        heads = D.raw_head_rows(spark, folder, 4).collect()
        per = {}
        for r in heads:
            per.setdefault(r["sheet"], []).append((r["row_idx"], list(r["cells"])))
        assert len(per) == 10
        for i in range(5):
            assert sorted(per[f"big{i}"]) == [(0, [f"title {i}"]), (1, []), (2, ["Key", "Value"]), (3, [f"{i}-0", "value 0"])]
            assert sorted(per[f"small{i}"])[3] == (3, [f"only{i}", "1"])
        table = RD.read_csv_table(spark, folder, 2)
        assert table.count() == sum(400 + 37 * i for i in range(5)) + 5
        assert table.filter("Key = '3-300'").collect()[0]["Value"] == "value 300"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)


@pytest.mark.parametrize("head", ["", "title\n"])
@pytest.mark.parametrize("body", ['1,2\n"3\nz",4\n5,6\n', '1,2\n3,"4\nz"\n5,6\n'])
def test_open_quotes_raise_unless_multiline(spark, scratch, head, body):
    path = write(os.path.join(scratch, f"open{abs(hash((head, body)))}.csv"), head + "A,B\n" + body)
    idx = head.count("\n")
    with pytest.raises(Exception, match="quote is left open"):
        RD.read_csv_table(spark, path, idx).select("A").collect()
    got = [tuple(r) for r in RD.read_csv_table(spark, path, idx, multiline=True).collect()]
    assert len(got) == 3 and ("3\nz", "4") in got or ("3", "4\nz") in got


def test_open_quote_in_a_table_of_one_column(spark, scratch):
    path = write(os.path.join(scratch, "onecol.csv"), 'A\n1\n"2\nz"\n')
    with pytest.raises(Exception, match="quote is left open"):
        RD.read_csv_table(spark, path).collect()


def test_the_newest_complete_run_is_read_whatever_crashes(spark, scratch):
    base = os.path.join(scratch, "crashed runs")
    frame = lambda v: spark.createDataFrame([(v,)], "x string")
    with pytest.raises(FileNotFoundError):
        SK.read_run(spark, base)
    SK.write_run({"detail": frame("one")}, base)
    SK.write_run({"detail": frame("two")}, base)
    assert SK.manifests(spark, base) == [1, 2] and SK.read_run(spark, base)["detail"].first()["x"] == "two"
    assert SK.read_run(spark, base, 1)["detail"].first()["x"] == "one"
    # a crash while tables are written, while the manifest is staged, and a number taken without a complete manifest
    frame("three").write.parquet(os.path.join(base, "run-broken", "detail"))
    os.makedirs(os.path.join(base, SK.MANIFESTS, "_staged-broken"))
    os.makedirs(os.path.join(base, SK.MANIFESTS, "000000003"))
    assert SK.read_run(spark, base)["detail"].first()["x"] == "two"
    SK.write_run({"detail": frame("four")}, base)
    assert SK.manifests(spark, base) == [1, 2, 4] and SK.read_run(spark, base)["detail"].first()["x"] == "four"


def test_distinct_counts_and_profiles_without_expand(spark):
    from ledgerlake.operators import audit

    df = spark.createDataFrame([("a", 1.0, 1), ("a", 0.0, None), (None, -0.0, 2), ("b", None, 2)], "s string, d double, i int")
    counts = audit.distinct_counts(df, {"s": "s", "d": "d", "i": "i"})
    assert counts.first().asDict() == {"s": 2, "s_nulls": 1, "d": 2, "d_nulls": 1, "i": 2, "i_nulls": 1}
    profile = P.column_profile(df, "t", order_by=["i"])
    for plan in (counts, profile):
        assert "Expand" not in plan._jdf.queryExecution().toString()
    got = {r["column"]: (r["null_count"], r["distinct_count"], r["sample"]) for r in profile.collect()}
    assert got == {"s": (1, 2, "a"), "d": (1, 2, "0.0"), "i": (1, 2, "1")}
    approx = {r["column"]: r["distinct_count"] for r in P.column_profile(df, "t", order_by=["i"], approx=True).collect()}
    assert approx == {"s": 2, "d": 2, "i": 2}
    assert audit.distinct_counts(df.where("i > 9"), {"s": "s"}).first().asDict() == {"s": 0, "s_nulls": 0}


def test_grain_check_joins_only_when_keys_differ(spark):
    from ledgerlake.operators import audit

    before = spark.createDataFrame([(1, None), (None, 1), (2, 2), (2, 2)], "a int, b int")
    counts, dropped = audit.grain_check(before, before.orderBy(F.desc("a")), ["a", "b"])
    assert counts.first().asDict() == {"rows_before": 4, "rows_after": 4, "dropped_keys": 0} and dropped.collect() == []
    for df in (counts, dropped):
        assert "Join" not in df._jdf.queryExecution().toString()
    counts, dropped = audit.grain_check(before, before.where("a = 2"), ["a", "b"])
    assert counts.first()["dropped_keys"] == 2 and {tuple(r) for r in dropped.collect()} == {(1, None), (None, 1)}
    swapped = spark.createDataFrame([(None, 1), (None, 1), (2, 2), (2, 2)], "a int, b int")
    assert audit.grain_check(before, swapped, ["a", "b"])[0].first()["dropped_keys"] == 1


def test_sources_are_decided_once(spark, tmp_path, monkeypatch):
    """The outcomes of all sources read one written decision; the sheets are not searched again for each of them."""
    from ledgerlake.plans import extra
    from ledgerlake.sources import discovery

    spark.createDataFrame([("the and that", "en", "src19"), ("der die", "de", "src7"), (None, "en", "src1")], "text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    resolve, plans = discovery.resolve, []
    monkeypatch.setattr(discovery, "resolve", lambda d, defs: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or resolve(d, defs))
    got = {r.logical: r.outcome for r in extra.q_resolved_sources(spark, str(tmp_path)).collect()}
    assert got["english"] == got["german"] == "resolved" and got["missing_src"] == "skipped" and len(plans) == len(got)
    assert not any("Aggregate" in p or "Join" in p for p in plans)
