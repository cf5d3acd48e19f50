"""Audit, statistics and exception tables (B13, B14, G7, G8, G10, E11,
E14, E15, J1-J10).

Counters ride on one aggregate per frame; tables that the reference builds
as (Metric, Value) lists are produced by unpivoting that one aggregate row,
so no counter costs its own job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import col_of


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def null_aware_duplicates(c: str | Column, approx: bool = False) -> Column:
    """Pandas ``duplicated().sum()`` -- nulls are equal to each other:
    rows - distinct non-null values - (1 if any null)."""
    x = col_of(c)
    distinct = F.approx_count_distinct(x, 0.01) if approx else F.count_distinct(x)
    return F.count(F.lit(1)) - distinct - F.when(F.count_if(x.isNull()) > 0, 1).otherwise(0)


def metrics_long(one_row: DataFrame) -> DataFrame:
    """Unpivot a one-row counters frame into ``(metric, value)`` rows (value as
    text, as the reference's audit sheets hold mixed types)."""
    cols = one_row.columns
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), _q(c).cast("string").alias("value")) for c in cols
    ])).alias("m")).select("m.metric", "m.value")


def distinct_counts(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Exact distinct counts of several columns as one row: ``name`` and
    ``name_nulls`` (1 if any row is null) for each.

    Spark plans several exact distincts as an Expand of every row into rows
    that carry all columns. Here the columns become (column, value) pairs,
    which are combined per task before they shuffle, and counted per column.
    Values are compared as text; zeros of either sign are one value."""
    kinds = dict(df.select(*[col_of(c).alias(n) for n, c in columns.items()]).dtypes)

    def text(name: str, c: Column) -> Column:
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string")) if kinds[name] in ("double", "float") else c.cast("string")

    cells = [F.struct(F.lit(i).alias("c"), text(n, col_of(c)).alias("v")) for i, (n, c) in enumerate(columns.items())]
    pairs = df.select(F.explode(F.array(*cells)).alias("p")).select("p.c", "p.v").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    per = pairs.groupBy("c").agg(F.count("v").alias("d"), F.max(F.col("v").isNull().cast("int")).alias("z"))
    picked = lambda i, c: F.coalesce(F.max(F.when(F.col("c") == i, F.col(c))), F.lit(0))
    return per.agg(*[a for i, n in enumerate(columns) for a in (picked(i, "d").alias(n), picked(i, "z").cast("long").alias(f"{n}_nulls"))])


def key_health(df: DataFrame, ndc_col: str, customer_col: str, lookup_col: str) -> DataFrame:
    """Rows with an NDC, a customer, a lookup key, and rows missing it."""
    def cnt(c):
        return F.count(_q(c)) if c in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        cnt(ndc_col).alias("rows_with_ndc"),
        cnt(customer_col).alias("rows_with_customer"),
        cnt(lookup_col).alias("rows_with_lookup"),
    ).withColumn("rows_missing_lookup", F.col("total_rows") - F.col("rows_with_lookup"))


def master_statistics(
    master: DataFrame,
    original_rows: DataFrame,
    *,
    order_col: str,
    customer_col: str,
    ndc_col: str,
    lookup_col: str,
    completion_cols: Sequence[str],
    approx: bool = False,
) -> DataFrame:
    """One statistics row: rows before/after, distinct orders (order
    numbers, not quantities), customers and NDCs, null-aware duplicate NDCs
    and lookups, missing count per enrichment column (absent column -> every
    row), and completion % = rows with all enrichment columns present.

    Exact distinct counts come from ``distinct_counts``; ``approx=True`` uses
    HyperLogLog++ sketches instead (one pass, ~16 KB of state per column, 1%
    relative standard error) for very large masters."""
    from .lookup import one_row

    present = [c for c in completion_cols if c in master.columns]
    all_present = F.lit(True)
    for c in present:
        all_present = all_present & _q(c).isNotNull()
    aggs = [F.count(F.lit(1)).alias("rows_after_merge")]
    for i, c in enumerate(completion_cols):
        aggs.append((F.count_if(_q(c).isNull()) if c in master.columns else F.count(F.lit(1))).alias(f"missing_{i}"))
    aggs.append(
        (F.round(F.avg(F.when(all_present, 1.0).otherwise(0.0)) * 100, 2) if present else F.lit(0.0)).alias("completion_pct")
    )
    counted = {"unique_sales_orders": order_col, "unique_customers": customer_col, "unique_ndcs": ndc_col, "_lookups": lookup_col}
    orig = original_rows.agg(F.count(F.lit(1)).alias("original_rows"))
    if approx:
        sketches = [F.approx_count_distinct(_q(c), 0.01).alias(n) for n, c in counted.items()]
        sketches += [F.max(_q(c).isNull().cast("long")).alias(f"{n}_nulls") for n, c in counted.items()]
        one = one_row(orig, master.agg(*aggs, *sketches))
    else:
        one = one_row(orig, master.agg(*aggs), distinct_counts(master, {n: _q(c) for n, c in counted.items()}))

    def duplicates(n: str) -> Column:
        return (F.col("rows_after_merge") - F.col(n) - F.coalesce(F.col(f"{n}_nulls"), F.lit(0))).cast("bigint")

    return one.select(
        "original_rows", "rows_after_merge", "unique_sales_orders", "unique_customers", "unique_ndcs",
        duplicates("unique_ndcs").alias("duplicate_ndcs"), duplicates("_lookups").alias("duplicate_lookups"),
        *[f"missing_{i}" for i in range(len(completion_cols))], "completion_pct")


def fingerprint_aggs(keys: Sequence[str]) -> dict[str, Column]:
    """Row count and order-insensitive sums of two 64-bit hashes of the key
    tuples, nulls told from values, as plain aggregates that can be observed
    while a frame is written. Equal fingerprints mean equal bags of keys."""
    cols = [_q(k) for k in keys]
    marks = [c.isNull() for c in cols]
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return {
        "_rows": F.count(F.lit(1)), "_hash_a": total(F.xxhash64(*marks, *cols)), "_hash_b": total(F.xxhash64(F.lit(1), *cols, *marks)),
    }


def grain_check(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Compare the row grain before and after a step: counts, and the
    ``keys`` tuples present before but missing after (null-safe equality, so
    a null key part still matches itself)."""
    aggs = [c.alias(n) for n, c in fingerprint_aggs(keys).items()]
    return grain_between(before, after, keys, before.agg(*aggs).first().asDict(), after.agg(*aggs).first().asDict())


def grain_between(before: DataFrame, after: DataFrame, keys: Sequence[str], seen_before: Mapping, seen_after: Mapping) -> tuple[DataFrame, DataFrame]:
    """E11 from fingerprints that are known already. When they agree, as they
    do after steps that keep every row, no key is missing and no join is
    planned; only when they differ are the keys joined."""
    marks = list(fingerprint_aggs(keys))
    b = before.select(*[_q(k) for k in keys])
    spark = before.sparkSession
    counts = spark.range(1).select(
        F.lit(seen_before["_rows"]).cast("bigint").alias("rows_before"), F.lit(seen_after["_rows"]).cast("bigint").alias("rows_after"))
    if all(seen_before[m] == seen_after[m] for m in marks):
        return counts.withColumn("dropped_keys", F.lit(0).cast("bigint")), spark.createDataFrame([], b.schema)
    a = after.select(*[_q(k).alias(f"_a{i}") for i, k in enumerate(keys)]).distinct()
    cond = None
    for i, k in enumerate(keys):
        c = b[k].eqNullSafe(a[f"_a{i}"])
        cond = c if cond is None else cond & c
    dropped = b.distinct().join(a, cond, "left_anti")
    missing = dropped.agg(F.count(F.lit(1)).alias("dropped_keys"))
    return counts.withColumn("dropped_keys", missing.scalar()), dropped


def membership_count(keys: DataFrame, key: Column, reference: DataFrame, ref_key: Column) -> DataFrame:
    """How many rows of ``keys`` have their key in ``reference``
    (semi join), and how many do not."""
    k = keys.select(key.alias("_k"))
    r = reference.select(ref_key.alias("_k")).filter(F.col("_k").isNotNull())
    found = k.join(r, "_k", "left_semi").agg(F.count(F.lit(1)).alias("matched"))
    total = k.agg(F.count(F.lit(1)).alias("total"))
    from .lookup import one_row

    return one_row(total, found).select("total", "matched", (F.col("total") - F.col("matched")).alias("missing"))


def matches_by_source(frame: DataFrame, status_col: str, source_col: str) -> DataFrame:
    """Matched rows per winning source."""
    return frame.filter(F.col(status_col) == "MATCHED").groupBy(source_col).agg(F.count(F.lit(1)).alias("matched_rows"))


def row_count_invariant(before: DataFrame, after: DataFrame) -> DataFrame:
    """E14 as data: one row (rows_before, rows_after, preserved)."""
    from .lookup import one_row

    r = one_row(before.agg(F.count(F.lit(1)).alias("rows_before")), after.agg(F.count(F.lit(1)).alias("rows_after")))
    return r.withColumn("preserved", F.col("rows_before") == F.col("rows_after"))


def with_key_columns(df: DataFrame, ndc: Sequence[str], customer: Sequence[str], lookup: str = "lookup") -> DataFrame:
    """B12 on a table whose columns vary: the first of each list that the table
    has (C9) is used; a side that it lacks gives a partial key, both a null
    one. An existing ``lookup`` column is replaced."""
    from ..functions.keys import lookup_key
    from .clean import find_column
    from .lookup import dtype_of

    none = F.lit(None).cast("string")
    n, c = find_column(df, ndc), find_column(df, customer)
    key = lookup_key(_q(n) if n else none, _q(c) if c else none, dtype_of(df, n) if n else "string")
    return df.withColumn(lookup, key)


def lookup_key_table(df: DataFrame, ndc_col: str | Sequence[str], customer_col: str | Sequence[str], name_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """B13 + B14: project (lookup, ndc, customer[, name]) and count how many
    keys normalisation changed and how many lookups repeat. A list of columns
    is a primary one and its fallbacks; a column that is absent is null."""
    from ..functions.keys import changed_by_normalising, digits_key, lookup_key, text_key
    from .clean import find_column
    from .lookup import dtype_of

    wanted = {"ndc": ndc_col, "customer": customer_col}
    found = {k: find_column(df, [v] if isinstance(v, str) else list(v)) for k, v in wanted.items()}
    for side, column in found.items():
        if column is None:
            found[side] = f"_absent_{side}"
            df = df.withColumn(found[side], F.lit(None).cast("string"))
    ndc_col, customer_col = found["ndc"], found["customer"]
    dt = dtype_of(df, ndc_col)
    lk = lookup_key(ndc_col, customer_col, dt)
    cols = [lk.alias("lookup"), _q(ndc_col).alias("ndc"), _q(customer_col).alias("customer")]
    if name_col and name_col in df.columns:
        cols.append(_q(name_col).alias("customer_name"))
    proj = df.select(*cols)
    counters = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(changed_by_normalising(ndc_col, digits_key(ndc_col, dt), dt)).alias("ndc_changed"),
        F.count_if(changed_by_normalising(customer_col, text_key(customer_col))).alias("customer_changed"),
        (F.count(lk) - F.count_distinct(lk)).alias("duplicate_lookups"),
    )
    return proj, counters


def priority_audit(result, sources, master: DataFrame, master_customer: str,
                   value_col: str = "buying_group", source_col: str = "buying_group_source",
                   status_col: str = "buying_group_status") -> DataFrame:
    """J5 (+ I4, G10): the priority lookup's audit as ``(metric, value)``
    rows: master and source counters, per-source record and match counts,
    then one row per matched customer with its final source -- the
    per-customer part stays a distributed DataFrame (never collected).

    The frame and the sources' table are written first. The frame is then
    grouped once, to one row per customer text and outcome; counters and
    final sources are read off that grouping."""
    from ..functions.keys import text_key
    from ..plans.session import cut_lineage
    from .lookup import DUPLICATE_CONFLICT, MATCHED, NOT_FOUND, priority_disagreements, resolve_priority

    ranked = sorted(sources, key=lambda x: x.priority)
    table = cut_lineage(result.extras["table"])
    winners = resolve_priority(table)
    frame = result.frame
    outcome = cut_lineage(
        frame.groupBy(F.col(master_customer).cast("string").alias("c"), F.col(source_col).alias("s"), F.col(value_col).alias("v"), F.col(status_col).alias("st"))
        .agg(F.count(F.lit(1)).alias("n")))
    n, st = F.col("n"), F.col("st")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    total = rows_where(F.lit(True))
    counts = outcome.agg(
        total.alias("Total master rows"),
        total.alias("Master rows after merge"),
        rows_where(st == MATCHED).alias("Matched rows"),
        rows_where(st == NOT_FOUND).alias("NOT_FOUND rows"),
        rows_where(st == DUPLICATE_CONFLICT).alias("DUPLICATE_CONFLICT rows"),
        rows_where(F.col("v").isNotNull()).alias("Populated rows"),
        rows_where(F.col("v").isNull()).alias("Blank rows"),
        *[rows_where((st == MATCHED) & (F.col("s") == s.name)).alias(f"Master rows matched from {s.name}") for s in ranked],
    )
    customers = outcome.select(text_key("c").alias("k")).distinct().agg(F.count("k").alias("Unique master customers"))
    uniq_src = winners.agg(F.count(F.lit(1)).alias("Unique consolidated source customers"),
                           F.count_if(F.col("status") == DUPLICATE_CONFLICT).alias("Same-priority conflicting customers"))
    removed = table.agg(F.coalesce(F.sum(F.col("n_rows") - F.col("n_values")), F.lit(0)).alias("Exact duplicate source rows removed"))
    dis = priority_disagreements(table, winners).agg(F.count(F.lit(1)).alias("Lower-priority disagreements"))
    parts = [counts, customers, uniq_src, dis, removed]
    for s in ranked:
        records = f"Source record count - {s.name} (priority {s.priority})"
        usable = s.key_col in s.frame.columns and s.value_col in s.frame.columns
        parts.append(s.frame.agg(F.count(F.lit(1)).alias(records)) if usable else master.sparkSession.range(1).select(F.lit(0).alias(records)))
    long = metrics_long(parts[0])
    for part in parts[1:]:
        long = long.unionByName(metrics_long(part))
    finals = outcome.filter(st == MATCHED).select(
        F.concat(F.lit("Final source for customer '"), F.col("c"), F.lit("'")).alias("metric"),
        F.concat(F.col("s"), F.lit(" -> "), F.col("v")).alias("value"))
    return long.unionByName(finals)


def summary_audit(master: DataFrame, summary: DataFrame, period: DataFrame, history_keys: DataFrame,
                  master_key: Column, key_col: str = "Lookup") -> DataFrame:
    """One row -- master rows, aggregated rows, distinct and duplicate
    summary keys, reporting year/month, history matches / misses."""
    from .lookup import one_row

    k = F.col(f"`{key_col}`")
    mk = master.select(master_key.alias("_k"))
    hk = history_keys.select(F.col(history_keys.columns[0]).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    matched = mk.join(hk, "_k", "left_semi").agg(F.count(F.lit(1)).alias("historical_matches"))
    return one_row(
        master.agg(F.count(F.lit(1)).alias("total_master_rows")),
        summary.agg(F.count(F.lit(1)).alias("aggregated_rows"), F.count_distinct(k).alias("unique_lookup_values"),
                    (F.count(k) - F.count_distinct(k)).alias("duplicate_lookup_values")),
        period.select(F.col("year").alias("reporting_year"), F.col("month").alias("reporting_month")),
        matched,
    ).withColumn("historical_misses", F.col("total_master_rows") - F.col("historical_matches"))
