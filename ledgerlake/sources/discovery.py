"""Input discovery by header signature.

Inputs are tables exported as CSV or Parquet (no spreadsheet container). A
"workbook" is a file, its "sheet" the file's table name. The work is split:

* data-sized work runs on Spark -- reading the head of every file (one pass
  over each file's first split, no shuffle, output bounded by ``max_rows``
  per file), scoring candidate header rows, building the header table and
  matching it against the registry with equi-joins;
* the decision per logical source is a registry-sized table (a handful of
  rows) that the driver reads to raise on missing mandatory sources.
"""

from __future__ import annotations

import csv
import os
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import clean_text

RESOLVED = "RESOLVED"
NOT_FOUND = "NOT_FOUND"
AMBIGUOUS = "AMBIGUOUS"


@dataclass(frozen=True)
class SourceDefinition:
    """A logical input: the headers that identify it and its tie-breakers."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    preferred_sheets: tuple[str, ...] = ()
    filename_keywords: tuple[str, ...] = ()
    mandatory: bool = True
    display_name: str = ""


class SourceNotFoundError(LookupError):
    def __init__(self, definition: SourceDefinition):
        super().__init__(
            f"Required source '{definition.display_name or definition.name}' not found; "
            f"expected headers: {', '.join(definition.required)}"
        )
        self.definition = definition


class AmbiguousSourceError(LookupError):
    def __init__(self, definition: SourceDefinition, candidates: Sequence[str]):
        super().__init__(
            f"Source '{definition.display_name or definition.name}' is ambiguous; candidates: {', '.join(candidates)}"
        )
        self.definition = definition
        self.candidates = tuple(candidates)


# --------------------------------------------------------------------------
# Header normalisation (A6) and registry lint
# --------------------------------------------------------------------------

def normalize_header(text: str) -> str:
    """``_``/``-`` -> space, whitespace collapsed, lower case."""
    return " ".join(re.sub(r"[_\-\s]+", " ", str(text)).split()).lower()


def normalize_header_col(c: Column) -> Column:
    """The same rule as a Column: one pattern for separators, with Unicode white space."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)[_\-\s]+", " ")))


def headers_present(required: Iterable[str], headers: Iterable[str]) -> bool:
    """Tolerant containment test."""
    have = {normalize_header(h) for h in headers}
    return all(normalize_header(r) in have for r in required)


def signature_collisions(defs: Sequence[SourceDefinition], normalized: bool = False) -> list[tuple[str, str]]:
    """Pairs (a, b) where a's required headers are a subset of b's full
    header set, so a file of b would also be discovered as a. Registry lint
    on driver-side config (a few entries), not data."""
    norm = normalize_header if normalized else (lambda x: x)
    out = []
    for a in defs:
        req = {norm(h) for h in a.required}
        for b in defs:
            if a.name == b.name:
                continue
            full = {norm(h) for h in (*b.required, *b.optional)}
            if req <= full:
                out.append((a.name, b.name))
    return out


# The result tables ``plans.flow.run`` writes (and the run manifest); never
# read back as inputs.
GENERATED_OUTPUTS: tuple[str, ...] = (
    "detail", "summary", "merge_audit", "statistics", "audit_counts",
    "exceptions_buying_group", "exceptions_award", "exceptions_sc_comments", "_manifest",
)


def exclude_generated(paths: Sequence[str], generated: Sequence[str] = GENERATED_OUTPUTS) -> list[str]:
    """Drop our own outputs from a candidate path list (stem compare,
    case-insensitive)."""
    gen = {g.strip().lower() for g in generated}
    keep = []
    for p in paths:
        stem = os.path.splitext(os.path.basename(p.rstrip("/")))[0].strip().lower()
        if stem not in gen:
            keep.append(p)
    return keep


# --------------------------------------------------------------------------
# Raw head rows (A1 helper) and header-row detection (A3, A4, A5)
# --------------------------------------------------------------------------

HEAD_ROWS = 25


def plain_path(c: Column) -> Column:
    """A path as file listings spell it, from the URL-encoded form of scans' metadata."""
    decoded = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Every file under ``paths``, as plain (not URL-encoded) paths, in order. Only the listing is read."""
    given = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.format("binaryFile").load(given)
    return sorted(r["path"] for r in found.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")).collect())  # one row per file


def file_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The text lines of all files as one scan: ``path, start, length, size, value``; ``start`` and ``length``
    are those of the split that a line is read with, ``size`` that of the file."""
    given = [paths] if isinstance(paths, str) else list(paths)
    meta = lambda c: F.col(f"_metadata.{c}")
    return spark.read.text(given).select(
        meta("file_path").alias("path"), meta("file_block_start").alias("start"), meta("file_block_length").alias("length"),
        meta("file_size").alias("size"), "value")


def parse_record(record: str, sep: str = ",") -> list[str]:
    """The cells of one CSV record, quotes removed; a blank line has none."""
    if not record.strip():
        return []
    if len(sep) > 1:
        return record.split(sep)
    return next(csv.reader([record], delimiter=sep), [])


def blank_line(sep: str) -> str:
    """Pattern of a line without anything but separators, quotes and white space."""
    return f'^[\\s"{re.escape(sep)}]*$'


class _Head:
    """The first records of one file, fed with its lines. A record goes on while a quote is open, so one may hold
    line breaks; blank lines are records."""

    def __init__(self, path: str, max_rows: int, sep: str):
        self.path, self.max_rows, self.sep = path, max_rows, sep
        self.rows: list[tuple] = []
        self.held, self.quotes, self.lines, self.filled = [], 0, 0, 0
        self.blank = re.compile(blank_line(sep), re.ASCII)

    @property
    def full(self) -> bool:
        return len(self.rows) == self.max_rows

    def feed(self, lines: Iterable[str]) -> None:
        for line in lines:
            if self.full:
                return
            self.lines += 1
            self.filled += not self.blank.match(line)
            self.held.append(line)
            self.quotes += line.count('"')
            if self.quotes % 2 == 0:
                self.end_record()

    def end_record(self) -> None:
        cells = parse_record("\n".join(self.held), self.sep)
        self.rows.append((self.path, len(self.rows), self.lines, self.filled, cells))
        self.held, self.quotes = [], 0

    def done(self) -> list[tuple]:
        if self.held and not self.full:
            self.end_record()
        return self.rows


def _heads(max_rows: int, sep: str):
    """The head of every file whose first split a task reads. A split that doesn't end its file fills a task of
    its own (Spark packs only what is left of a split's size), so the task stops as soon as it has the
    head, or at once where the split isn't the file's first."""
    def fn(batches):
        import pandas as pd

        head: _Head | None = None
        found: list[tuple] = []
        for pdf in batches:
            for path, part in pdf.groupby("path", sort=False):
                first = part.iloc[0]
                alone = first["start"] + first["length"] < first["size"]
                if first["start"] != 0:
                    if alone:
                        return
                    continue
                if head is None or head.path != path:
                    found += head.done() if head else []
                    head = _Head(path, max_rows, sep)
                head.feed(part["value"])
                if head.full and alone:
                    break
            else:
                continue
            break
        found += head.done() if head else []
        yield pd.DataFrame(found, columns=["path", "row_idx", "line_end", "filled_end", "cells"])
    return fn


def raw_head_rows(spark: SparkSession, paths: str | Sequence[str], max_rows: int = HEAD_ROWS, sep: str = ",") -> DataFrame:
    """The first ``max_rows`` records of every file as ``(workbook, sheet,
    row_idx, line_end, filled_end, cells)``; ``line_end`` counts the file's
    text lines up to the end of the record, ``filled_end`` those of them that
    aren't blank. One scan whatever the number of files; of a file
    of several splits, only the first lines of the first one are read, and
    the remainder behind the last whole split is passed over."""
    lines = file_lines(spark, paths)
    # a file's last split is of use only where it is its first, too
    lines = lines.filter("start = 0 or start + length < size")
    heads = lines.mapInPandas(_heads(max_rows, sep), "path string, row_idx long, line_end long, filled_end long, cells array<string>")
    heads = heads.withColumn("workbook", plain_path(F.col("path")))
    name = F.regexp_extract("workbook", r"([^/]+?)(\.[^./]*)?$", 1)
    return heads.select("workbook", name.alias("sheet"), "row_idx", "line_end", "filled_end", "cells")


_NUMERIC = "^\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*$"
_DATE_SHAPE = "^\\d{1,4}[-/]\\d{1,2}[-/]\\d{1,4}([ T]\\d{1,2}:\\d{2}(:\\d{2})?)?$"
_DATE_PATTERNS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M/d/yy", "yyyy-MM-dd'T'HH:mm:ss")


def cell_kind(c: Column) -> Column:
    """Type of a text cell: blank, numeric, date or string. Dates are only
    parsed when the text has a date shape (parsing is the expensive part)."""
    t = F.trim(c)
    parsed = F.coalesce(*[F.try_to_timestamp(t, F.lit(p)) for p in _DATE_PATTERNS])
    return (
        F.when(clean_text(c).isNull(), F.lit("blank"))
        .when(t.rlike(_NUMERIC), F.lit("numeric"))
        .when(t.rlike(_DATE_SHAPE) & parsed.isNotNull(), F.lit("date"))
        .otherwise(F.lit("string"))
    )


def row_scores(raw: DataFrame) -> DataFrame:
    """A3 score per raw row: 3 x strings + 2 x dates + non-blank cells -
    numerics; a row with no non-blank cell scores -1e9. Cells are exploded
    into rows so classification runs in generated code, then counted back
    per row. -> (workbook, sheet, row_idx, score, non_blank)"""
    cells = raw.select("workbook", "sheet", "row_idx", F.explode_outer("cells").alias("c"))
    k = cells.select("workbook", "sheet", "row_idx", cell_kind(F.col("c")).alias("k"))
    cnt = k.groupBy("workbook", "sheet", "row_idx").agg(
        F.count_if(F.col("k").isNotNull() & (F.col("k") != "blank")).alias("n"),
        F.count_if(F.col("k") == "string").alias("s"),
        F.count_if(F.col("k") == "date").alias("d"),
        F.count_if(F.col("k") == "numeric").alias("num"),
    )
    score = F.when(F.col("n") == 0, F.lit(-(10**9))).otherwise(F.col("s") * 3 + F.col("d") * 2 + F.col("n") - F.col("num"))
    return cnt.select("workbook", "sheet", "row_idx", score.cast("int").alias("score"), (F.col("n") > 0).alias("non_blank"))


def detect_header_rows(raw: DataFrame, window: int = HEAD_ROWS) -> DataFrame:
    """A3 + A5: per (workbook, sheet), the header row = the first row with the
    highest score among the first ``window`` rows; ``has_data`` = some
    non-blank row below it among *all* rows given, however far down.
    -> (workbook, sheet, header_idx, score, has_data)"""
    scored = row_scores(raw)
    near = F.col("row_idx") < window
    best = scored.groupBy("workbook", "sheet").agg(
        F.min_by("row_idx", F.when(near, F.struct((-F.col("score")).alias("s"), F.col("row_idx")))).alias("header_idx"),
        F.max(F.when(near, F.col("score"))).alias("score"),
        F.max(F.when(F.col("non_blank"), F.col("row_idx"))).alias("_last_nb"),
    )
    return best.select(
        "workbook", "sheet", "header_idx", "score",
        F.coalesce(F.col("_last_nb") > F.col("header_idx"), F.lit(False)).alias("has_data"),
    )


def file_header_rows(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", window: int = HEAD_ROWS) -> DataFrame:
    """A3 + A5 for files. The head scores the header row; a file whose head
    shows no data below it is searched whole: it has data when it holds more
    non-blank lines than those up to its header."""
    raw = raw_head_rows(spark, paths, window, sep)
    rows = detect_header_rows(raw, window)
    at_header = raw.join(rows, ["workbook", "sheet"]).filter("row_idx = header_idx and not has_data")
    open_files = [r["workbook"] for r in at_header.select("workbook").collect()]  # one row per file
    if not open_files:
        return rows
    # filled lines over all splits of these files, against those that the head accounts for
    filled = ~F.col("value").rlike(blank_line(sep))
    counts = file_lines(spark, open_files).groupBy("path").agg(F.count_if(filled).alias("lines"))
    counts = counts.select(plain_path(F.col("path")).alias("workbook"), "lines")
    late = counts.join(at_header.select("workbook", "filled_end"), "workbook").select("workbook", (F.col("lines") > F.col("filled_end")).alias("late"))
    joined = rows.join(late, "workbook", "left")
    return joined.select("workbook", "sheet", "header_idx", "score", (F.col("has_data") | F.coalesce("late", F.lit(False))).alias("has_data"))


def file_header_table(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", window: int = HEAD_ROWS) -> DataFrame:
    """A4 for files: the verbatim header texts, with whole-file ``has_data``."""
    return header_table(raw_head_rows(spark, paths, window, sep), file_header_rows(spark, paths, sep, window))


def header_table(raw: DataFrame, header_rows: DataFrame | None = None) -> DataFrame:
    """A4: the verbatim header texts of each file's header row, one row per
    position. -> (workbook, sheet, position, header, has_data)"""
    hr = header_rows if header_rows is not None else detect_header_rows(raw)
    j = raw.join(hr, ["workbook", "sheet"]).filter(F.col("row_idx") == F.col("header_idx"))
    return j.select("workbook", "sheet", "has_data", F.posexplode("cells").alias("position", "header"))


def header_table_from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Header table of already-typed tables (Parquet): their schemas are the
    header rows. Schema metadata only; no data is read."""
    rows = [(name, name, i, c) for name, df in frames.items() for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "workbook string, sheet string, position int, header string").withColumn(
        "has_data", F.lit(True))


def header_issues(headers: DataFrame) -> DataFrame:
    """Duplicate and blank headers per sheet. -> (workbook, sheet, code, detail)"""
    dup = (
        headers.filter(clean_text("header").isNotNull())
        .groupBy("workbook", "sheet", "header").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("workbook", "sheet", F.lit("DUPLICATE_HEADERS").alias("code"), F.col("header").alias("detail"))
    )
    blank = headers.filter(clean_text("header").isNull()).select(
        "workbook", "sheet", F.lit("BLANK_HEADERS").alias("code"), F.concat(F.lit("position "), F.col("position").cast("string")).alias("detail"))
    return dup.unionByName(blank)


def repair_headers(headers: Sequence[str | None]) -> tuple[list[str], list[int]]:
    """Blank header -> ``Column n`` (1-based); of duplicate names the first
    is kept. Returns (new names, positions to keep)."""
    names, keep, seen = [], [], set()
    for i, h in enumerate(headers):
        name = h if h is not None and str(h).strip() else f"Column {i + 1}"
        names.append(str(name))
        if name not in seen:
            seen.add(name)
            keep.append(i)
    return names, keep


# --------------------------------------------------------------------------
# Discovery
# --------------------------------------------------------------------------

def registry_frame(spark: SparkSession, defs: Sequence[SourceDefinition]) -> DataFrame:
    rows = [(d.name, h) for d in defs for h in d.required]
    return spark.createDataFrame(rows, "logical string, header string")


def discover(headers: DataFrame, defs: Sequence[SourceDefinition], match: str = "exact") -> DataFrame:
    """A2 + A13: resolve each logical source to one (workbook, sheet).

    Candidates are sheets with data rows whose headers contain every required
    header (``match='normalized'`` compares A6 forms). The required headers
    are exploded and equi-joined to the header table; a sheet is a candidate
    when the number of distinct matched headers equals the requirement size.
    Ties: exactly one candidate on a preferred sheet wins; across several
    files, exactly one file whose name contains a filename keyword wins;
    otherwise AMBIGUOUS. No candidate -> NOT_FOUND.
    -> (logical, status, workbook, sheet, candidates, mandatory)"""
    spark = headers.sparkSession
    reg = registry_frame(spark, defs)
    h = headers.filter("has_data")
    if match == "normalized":
        reg = reg.withColumn("hk", normalize_header_col(F.col("header")))
        h = h.withColumn("hk", normalize_header_col(F.col("header")))
    else:
        reg = reg.withColumn("hk", F.col("header"))
        h = h.withColumn("hk", F.col("header"))
    need = reg.groupBy("logical").agg(F.count_distinct("hk").alias("need"))
    hits = reg.select("logical", "hk").distinct().join(h.select("workbook", "sheet", "hk").distinct(), "hk")
    per = hits.groupBy("logical", "workbook", "sheet").agg(F.count(F.lit(1)).alias("got"))
    cands = per.join(need, "logical").filter(F.col("got") == F.col("need"))
    meta = spark.createDataFrame(
        [(d.name, list(d.preferred_sheets), [k.lower() for k in d.filename_keywords], d.mandatory) for d in defs],
        "logical string, preferred array<string>, keywords array<string>, mandatory boolean",
    )
    stem = F.lower(F.regexp_extract(F.col("workbook"), "([^/]+?)(\\.[^./]*)?$", 1))
    c = cands.join(meta, "logical").select(
        "logical", "workbook", "sheet", "mandatory", "keywords",
        F.array_contains("preferred", F.col("sheet")).alias("pref"),
        F.exists("keywords", lambda k: F.contains(stem, k)).alias("kw"),
    )
    agg = c.groupBy("logical").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("workbook").alias("files"),
        F.count_if("pref").alias("n_pref"),
        F.count_if("kw").alias("n_kw"),
        F.max(F.size("keywords") > 0).alias("has_kw"),
        F.min(F.struct("workbook", "sheet")).alias("only"),
        F.min(F.when(F.col("pref"), F.struct("workbook", "sheet"))).alias("pref_one"),
        F.min(F.when(F.col("kw"), F.struct("workbook", "sheet"))).alias("kw_one"),
        F.array_sort(F.collect_list(F.concat_ws("::", "workbook", "sheet"))).alias("candidates"),  # candidates per source: few
    )
    choice = (
        F.when(F.col("n") == 1, F.col("only"))
        .when(F.col("n_pref") == 1, F.col("pref_one"))
        .when((F.col("files") > 1) & F.col("has_kw") & (F.col("n_kw") == 1), F.col("kw_one"))
    )
    decided = agg.select("logical", choice.alias("pick"), "candidates")
    out = meta.select("logical", "mandatory").join(decided, "logical", "left")
    status = (
        F.when(F.col("candidates").isNull(), F.lit(NOT_FOUND))
        .when(F.col("pick").isNotNull(), F.lit(RESOLVED))
        .otherwise(F.lit(AMBIGUOUS))
    )
    return out.select(
        "logical", status.alias("status"), F.col("pick.workbook").alias("workbook"), F.col("pick.sheet").alias("sheet"),
        F.coalesce(F.col("candidates"), F.array().cast("array<string>")).alias("candidates"), "mandatory",
    )


@dataclass
class Resolution:
    resolved: dict[str, tuple[str, str]] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


def resolve(decisions: DataFrame, defs: Sequence[SourceDefinition]) -> Resolution:
    """Read the registry-sized decision table on the driver; raise for a
    mandatory source that is missing or ambiguous, skip optional ones."""
    by_name = {d.name: d for d in defs}
    res = Resolution()
    for r in decisions.collect():  # one row per registry entry
        d = by_name[r["logical"]]
        if r["status"] == RESOLVED:
            res.resolved[d.name] = (r["workbook"], r["sheet"])
        elif d.mandatory:
            if r["status"] == NOT_FOUND:
                raise SourceNotFoundError(d)
            raise AmbiguousSourceError(d, list(r["candidates"]))
        else:
            res.skipped[d.name] = r["status"]
    return res
