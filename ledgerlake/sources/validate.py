"""Loaded-table validation.

Schema rules are checked on the driver from ``df.columns`` (no job). The two
data rules -- empty rows and empty columns -- come from ONE aggregate per
table. Issues are returned as a DataFrame ``(table, severity, code,
detail)``; an ERROR stops a run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import clean_text
from .discovery import SourceDefinition

ISSUE_SCHEMA = "table string, severity string, code string, detail string"


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> None:
    """Raise when a required column is missing (case-sensitive)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} is missing required columns: {', '.join(missing)}")


def _empty_counts(df: DataFrame, name: str) -> DataFrame:
    cols = df.columns
    blank = [clean_text(F.col(f"`{c}`")).isNull() for c in cols]
    all_blank = F.lit(True)
    for b in blank:
        all_blank = all_blank & b
    one = df.agg(F.count_if(all_blank).alias("empty_rows"), *[F.count_if(~b).alias(f"nb{i}") for i, b in enumerate(blank)])
    rows = [F.when(F.col("empty_rows") > 0, F.struct(
        F.lit("WARNING").alias("severity"), F.lit("EMPTY_ROWS").alias("code"),
        F.concat(F.col("empty_rows").cast("string"), F.lit(" empty rows")).alias("detail")))]
    for i, c in enumerate(cols):
        rows.append(F.when(F.col(f"nb{i}") == 0, F.struct(
            F.lit("WARNING").alias("severity"), F.lit("EMPTY_COLUMNS").alias("code"), F.lit(c).alias("detail"))))
    return one.select(F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("i")).select(
        F.lit(name).alias("table"), "i.severity", "i.code", "i.detail")


def validate_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    defs: Sequence[SourceDefinition],
    header_issues: DataFrame | None = None,
) -> DataFrame:
    """C4: MISSING_WORKBOOK / MISSING_OPTIONAL_WORKBOOK,
    MISSING_REQUIRED_COLUMN / MISSING_OPTIONAL_COLUMN (schema time), plus
    DUPLICATE_HEADERS / BLANK_HEADERS (from the header table, C5) and
    EMPTY_ROWS / EMPTY_COLUMNS (one aggregate per table)."""
    rows = []
    for d in defs:
        df = tables.get(d.name)
        if df is None:
            rows.append((d.name, "ERROR" if d.mandatory else "WARNING",
                         "MISSING_WORKBOOK" if d.mandatory else "MISSING_OPTIONAL_WORKBOOK", d.display_name or d.name))
            continue
        for c in d.required:
            if c not in df.columns:
                rows.append((d.name, "ERROR", "MISSING_REQUIRED_COLUMN", c))
        for c in d.optional:
            if c not in df.columns:
                rows.append((d.name, "WARNING", "MISSING_OPTIONAL_COLUMN", c))
    out = spark.createDataFrame(rows, ISSUE_SCHEMA)
    for name, df in tables.items():
        out = out.unionByName(_empty_counts(df, name))
    if header_issues is not None:
        out = out.unionByName(header_issues.select(
            F.col("sheet").alias("table"), F.lit("WARNING").alias("severity"), "code", "detail"))
    return out


def validate_listing(sheets: DataFrame) -> DataFrame:
    """C4 for what was found, from rows ``(workbook path, sheet)``, a null
    sheet standing for a workbook without one: DUPLICATE_WORKBOOK_NAME (two
    paths end in the same name), MISSING_WORKSHEET and
    DUPLICATE_WORKSHEET_NAME. All are errors; ``table`` is the workbook."""
    name = F.element_at(F.split("workbook", "/"), -1)

    def issues(rows: DataFrame, code: str, detail: str) -> DataFrame:
        return rows.select(F.col("book").alias("table"), F.lit("ERROR").alias("severity"), F.lit(code).alias("code"), F.col(detail).alias("detail"))

    twice = sheets.select("workbook").distinct().groupBy(name.alias("book")).agg(F.count(F.lit(1)).alias("n"))
    per_sheet = sheets.groupBy("workbook", "sheet").agg(F.count(F.lit(1)).alias("n")).withColumn("book", F.col("workbook"))
    per_book = sheets.groupBy("workbook").agg(F.count("sheet").alias("n")).withColumn("book", F.col("workbook"))
    out = issues(twice.filter("n > 1"), "DUPLICATE_WORKBOOK_NAME", "book")
    out = out.unionByName(issues(per_book.filter("n = 0"), "MISSING_WORKSHEET", "workbook"))
    return out.unionByName(issues(per_sheet.filter("sheet is not null and n > 1"), "DUPLICATE_WORKSHEET_NAME", "sheet"))


def has_errors(issues: DataFrame) -> bool:
    """Stop rule: any ERROR issue (an existence probe, reads one row)."""
    return len(issues.filter(F.col("severity") == "ERROR").limit(1).collect()) > 0
