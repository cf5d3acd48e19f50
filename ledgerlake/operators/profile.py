"""Profiling and metadata discovery.

Per-table profiles are single aggregates over all columns (one scan). The
column profile reads (column, value) pairs, combined per task, in one pass. Distinct counts are exact by default;
``approx=True`` switches to HyperLogLog for 100 TB tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import clean_text, meaning_tag, py_strip


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _blank(c: str) -> Column:
    """B23 for profiling: null, whitespace-only or the text 'nan'."""
    t = clean_text(_q(c))
    return t.isNull() | (F.lower(t) == "nan")


def _size_of(df: DataFrame, c: str) -> Column:
    """Estimated bytes of a value: text length for strings, 8 otherwise."""
    if dict(df.dtypes)[c] == "string":
        return F.coalesce(F.length(_q(c)), F.lit(0))
    return F.when(_q(c).isNotNull(), 8).otherwise(0)


def row_text(df: DataFrame) -> Column:
    """All values of a row as one text in which no two different rows agree:
    every value carries its length, and a null is told from any text."""
    parts = []
    for c in df.columns:
        text = _q(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts) if parts else F.lit("")


def row_identity(df: DataFrame) -> Column:
    """A row's identity for counting duplicates: the MD5 of its values and nulls."""
    return F.md5(row_text(df))


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, empty rows, empty columns, duplicate rows, and an
    estimated size (sum of text lengths), in one aggregate."""
    cols = df.columns
    all_blank = F.lit(True)
    for c in cols:
        all_blank = all_blank & _blank(c)
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(all_blank).alias("empty_rows"),
        *[F.count_if(~_blank(c)).alias(f"_nb{i}") for i, c in enumerate(cols)],
        F.count_distinct(row_identity(df)).alias("_distinct"),
        F.sum(sum((_size_of(df, c) for c in cols), F.lit(0))).alias("text_bytes"),
    )
    empty_cols = sum((F.when(F.col(f"_nb{i}") == 0, 1).otherwise(0) for i in range(len(cols))), F.lit(0))
    return agg.select(
        F.lit(name).alias("table"), "rows", F.lit(len(cols)).alias("columns"), "empty_rows",
        empty_cols.alias("empty_columns"), (F.col("rows") - F.col("_distinct")).alias("duplicate_rows"),
        F.coalesce(F.col("text_bytes"), F.lit(0)).cast("bigint").alias("text_bytes"),
    )


def column_profile(df: DataFrame, name: str, order_by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Per column -- type, null count, distinct count, nullable flag
    and the first non-blank sample (first by ``order_by``, else the smallest).

    The cells become (column, value) pairs that each task combines before
    they shuffle; nulls, distinct values and samples are read off the pairs.
    ``approx=True`` keeps one HyperLogLog sketch per column instead."""
    cols = df.columns
    dtypes = dict(df.dtypes)

    def text(c: str) -> Column:
        x = _q(c)
        # zeros of either sign are one value
        return F.when(x == 0, x * 0 + F.lit(0.0)).otherwise(x).cast("string") if dtypes[c] in ("double", "float") else x.cast("string")

    order = F.struct(*[_q(c) for c in order_by]) if order_by else F.lit(0)
    cells = F.array(*[F.struct(F.lit(i).alias("position"), text(c).alias("v")) for i, c in enumerate(cols)])
    pairs = df.select(F.explode(cells).alias("p"), order.alias("o")).select("p.position", "p.v", "o")
    shown = F.when(~_blank("v"), F.col("v"))
    if approx:
        sample = F.min_by(shown, F.when(shown.isNotNull(), F.col("o"))) if order_by else F.min(shown)
        per = pairs.groupBy("position").agg(
            F.count_if(F.col("v").isNull()).alias("null_count"), F.approx_count_distinct("v", 0.01).alias("distinct_count"), sample.alias("sample"))
    else:
        values = pairs.groupBy("position", "v").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o"))
        sample = F.min_by(shown, F.when(shown.isNotNull(), F.col("o"))) if order_by else F.min(shown)
        per = values.groupBy("position").agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("v").alias("distinct_count"), sample.alias("sample"))
    known = df.sparkSession.createDataFrame([(i, c, dtypes[c]) for i, c in enumerate(cols)], "position int, column string, dtype string")
    out = known.join(per, "position", "left")
    nulls = F.coalesce(F.col("null_count"), F.lit(0)).cast("bigint")
    return out.select(
        F.lit(name).alias("table"), "position", "column", "dtype", nulls.alias("null_count"), (nulls > 0).alias("nullable"),
        F.coalesce(F.col("distinct_count"), F.lit(0)).cast("bigint").alias("distinct_count"), F.coalesce(F.col("sample"), F.lit("")).alias("sample"),
    )


# D4 type inference vocabulary.
BOOLEAN_WORDS = ("y", "n", "yes", "no", "true", "false", "0", "1")
DATE_NAME_HINTS = ("date", "eta", "time", "day")
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yy", "M/d/yyyy", "MM/dd/yyyy")


def infer_types(df: DataFrame, name: str, date_share: float = 0.7) -> DataFrame:
    """Logical type per column from its non-blank values: Boolean when all
    are boolean words, Integer / Decimal when all parse as numbers (commas
    removed, parentheses as a minus), Date when the name hints at a date and at
    least 70 % parse, else Text; no values -> Text. One aggregate, no unpivot
    of the data."""
    cols = df.columns
    aggs = []
    for i, c in enumerate(cols):
        t = py_strip(_q(c).cast("string"))
        present = ~_blank(c)
        num_text = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ",", ""), "^\\((.*)\\)$", "-$1"), "\\s", "")
        is_num = num_text.rlike("^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?$")
        is_int = num_text.rlike("^[+-]?\\d+(\\.0*)?$")
        is_bool = F.lower(t).isin(list(BOOLEAN_WORDS))
        parsed = F.coalesce(*[F.try_to_timestamp(t, F.lit(p)) for p in DATE_PATTERNS])
        aggs += [
            F.count_if(present).alias(f"p{i}"),
            F.count_if(present & ~is_bool).alias(f"nb{i}"),
            F.count_if(present & ~is_num).alias(f"nn{i}"),
            F.count_if(present & ~is_int).alias(f"ni{i}"),
            F.count_if(present & parsed.isNotNull()).alias(f"dt{i}"),
        ]
    one = df.agg(*aggs)
    entries = []
    for i, c in enumerate(cols):
        date_named = any(h in c.lower() for h in DATE_NAME_HINTS)
        p = F.col(f"p{i}")
        kind = (
            F.when(p == 0, F.lit("Text"))
            .when(F.col(f"nb{i}") == 0, F.lit("Boolean"))
            .when(F.col(f"ni{i}") == 0, F.lit("Integer"))
            .when(F.col(f"nn{i}") == 0, F.lit("Decimal"))
            .when(F.lit(date_named) & (F.col(f"dt{i}") >= p * F.lit(date_share)), F.lit("Date"))
            .otherwise(F.lit("Text"))
        )
        entries.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), kind.alias("logical_type")))
    return one.select(F.explode(F.array(*entries)).alias("e")).select(F.lit(name).alias("table"), "e.*")


def column_dictionary(profile: DataFrame, hints: Mapping[str, Sequence[str]]) -> DataFrame:
    """D3: column profile + join-key tag (exact lower-case hint match) +
    business-meaning tag (B22)."""
    low = F.lower(F.col("column"))
    tag = None
    for key_name, vals in hints.items():
        cond = low.isin([str(v).lower() for v in vals])
        tag = F.when(cond, F.lit(key_name)) if tag is None else tag.when(cond, F.lit(key_name))
    tag = tag.otherwise(F.lit("UNKNOWN")) if tag is not None else F.lit("UNKNOWN")
    return profile.withColumn("join_key", tag).withColumn("business_meaning", meaning_tag("column"))


def normalise_header(c: Column) -> Column:
    """Header comparison form: trimmed, lower case, whitespace runs -> one space."""
    return F.regexp_replace(F.lower(py_strip(c)), "\\s+", " ")


def join_key_candidates(headers: DataFrame, hints: Mapping[str, Sequence[str]]) -> DataFrame:
    """D6 + G12: ``headers`` is ``(workbook, sheet, header)``. For every key
    name with at least one hint found: workbooks / sheets containing it and
    confidence = round(100 * (0.7 * workbook coverage + 0.3 * sheet
    coverage), 2), highest first (I3: ties by key name)."""
    spark = headers.sparkSession
    hint_rows = [(k, h) for k, vs in hints.items() for h in vs]
    hint_df = spark.createDataFrame(hint_rows, "key_name string, hint string").select(
        "key_name", normalise_header(F.col("hint")).alias("h"))
    h = headers.select("workbook", "sheet", normalise_header(F.col("header")).alias("h"))
    totals = headers.agg(
        F.count_distinct("workbook").alias("tw"),
        F.count_distinct("workbook", "sheet").alias("ts"),
    )
    found = h.join(hint_df, "h").groupBy("key_name").agg(
        F.count_distinct("workbook").alias("workbook_count"),
        F.count_distinct("workbook", "sheet").alias("worksheet_count"),
    )
    # the two totals are scalar subqueries: lazy, no join
    tw = totals.select("tw").scalar()
    ts = totals.select("ts").scalar()
    conf = F.round(
        (F.try_divide(F.col("workbook_count"), tw) * 0.7 + F.try_divide(F.col("worksheet_count"), ts) * 0.3) * 100, 2
    )
    # Highest confidence first; the key name makes the order stable
    return found.select("key_name", "workbook_count", "worksheet_count", conf.alias("confidence_pct")).orderBy(
        F.col("confidence_pct").desc(), F.col("key_name"))


def recommended_keys(headers: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Per table, the key lists whose columns all exist in that table;
    ``rules`` is an ordered list of (key label, required headers)."""
    spark = headers.sparkSession
    wanted = [(n, label, r) for n, (label, req) in enumerate(rules) for r in set(req)]
    need = spark.createDataFrame([(n, len(set(req))) for n, (_, req) in enumerate(rules)], "rule int, need int")
    wanted = spark.createDataFrame(wanted, "rule int, label string, header string")
    has = headers.select("workbook", "header").join(wanted, "header").groupBy("workbook", "rule").agg(
        F.first("label").alias("label"), F.count_distinct("header").alias("got"))
    # one entry per rule that a table meets
    met = has.join(need, "rule").filter("got = need").groupBy("workbook").agg(
        F.array_sort(F.collect_list(F.struct("rule", "label"))).alias("met"))
    books = headers.select("workbook").distinct()
    none = F.array().cast("array<string>")
    return books.join(met, "workbook", "left").select(
        "workbook", F.coalesce(F.transform("met", lambda m: m["label"]), none).alias("recommended_keys"))


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Headers, column count, row count, an order-insensitive content hash
    and one of the null pattern. Each is the sum of 60 bits of every row's MD5
    as a decimal, so it cannot overflow and any engine can check it; rows have
    no physical order in Spark, so order is not part of it."""
    bits = lambda text: F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    nulls = F.concat(*[F.when(_q(c).isNull(), "0").otherwise("1") for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(bits(row_text(df))), F.lit(0)).cast("string").alias("value_hash"),
        F.coalesce(F.sum(bits(nulls)), F.lit(0)).cast("string").alias("fill_hash"),
    ).select(
        F.lit(name).alias("table"), F.lit("|".join(df.columns)).alias("headers"), F.lit(len(df.columns)).alias("columns"),
        "rows", "value_hash", "fill_hash",
    )
