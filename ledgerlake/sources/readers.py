"""Table loading.

Operational exports are read as text (every column ``string``) and typed by
rule afterwards, because their headers and cell formats are not a contract.
Parquet is read as is. Files are grouped by their header record, and each
group is one scan, whatever the number of its files. The lines above a header
that is not on the first line are counted and dropped in each file's first
split (the only one that can hold them), before anything is parsed -- no
shuffle, no numbering of whole files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .discovery import file_lines, raw_head_rows, repair_headers

OPEN_QUOTE = "a quote is left open at the end of a line: read the file with multiline=True"


def _drop_first(count: int, path: str):
    """Drops the first ``count`` rows of every file whose rows begin in a task, told apart by column ``path``."""
    def fn(batches):
        current, left = None, 0
        for pdf in batches:
            kept = []
            for p, part in pdf.groupby(path, sort=False):
                if p != current:
                    current, left = p, count
                cut = min(left, len(part))
                left -= cut
                kept.append(part.iloc[cut:])
            for part in kept:
                if not part.empty:
                    yield part
    return fn


def _even_quotes(text: Column) -> Column:
    """True, or an error where the text holds an odd number of quotes. A filter, so that no query prunes it."""
    odd = F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 1
    return F.when(odd, F.raise_error(F.lit(OPEN_QUOTE)).cast("boolean")).otherwise(F.lit(True))


#: Where a row stands: its file, the split that it is read with, and a number that grows within the split.
PLACE = "struct<path:string,start:bigint,seq:bigint>"


def _place(path: Column | str, start: Column | str) -> Column:
    return F.struct(F.col(path).alias("path"), F.col(start).alias("start"), F.monotonically_increasing_id().alias("seq")).cast(PLACE).alias("_place")


def _below(spark: SparkSession, paths: Sequence[str], width: int, sep: str, line_end: int, records: int, multiline: bool) -> DataFrame:
    """The rows under the header of files with one kind of head, as text columns ``_c0``, ``_c1``, ... and ``_place``."""
    names = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in names)
    reader = spark.read.option("sep", sep).option("multiLine", multiline).option("escape", '"')
    paths, place = list(paths), _place("_metadata.file_path", "_metadata.file_block_start")
    if multiline and line_end == 1:
        return reader.schema(schema).option("header", True).csv(paths).select("*", place)
    if multiline:
        # one task per file, blank lines gone: drop the records that are left of the head
        rows = reader.schema(schema).option("header", False).csv(paths).select("*", place, F.col("_metadata.file_path").alias("_path"))
        return rows.mapInPandas(_drop_first(records, "_path"), rows.schema).drop("_path")
    if line_end == 1:
        # a cut record has fewer cells than its file, so its text is kept and tested; with one column, the cell is
        # (without column pruning in the parser, which would not see that cells are missing)
        marked = reader.schema(f"{schema}, _cut string").option("columnNameOfCorruptRecord", "_cut").option("columnPruning", False)
        rows = marked.option("header", True).csv(paths).select("*", place)
        return rows.filter(_even_quotes(F.coalesce("_cut", F.lit("")) if width > 1 else F.coalesce("_cut", "_c0", F.lit("")))).drop("_cut")
    # the head is counted in text lines and dropped in the first split before anything is parsed
    lines = file_lines(spark, paths).select("path", "start", "value", F.monotonically_increasing_id().alias("seq"))
    head = lines.filter("start = 0").mapInPandas(_drop_first(line_end, "path"), lines.schema)
    body = head.unionByName(lines.filter("start > 0")).filter(F.trim("value") != "").filter(_even_quotes(F.col("value")))
    parsed = body.select(F.from_csv("value", schema, {"sep": sep, "escape": '"'}).alias("r"), F.struct("path", "start", "seq").cast(PLACE).alias("_place"))
    return parsed.select("r.*", "_place")


def read_csv_table(
    spark: SparkSession,
    path: str | Sequence[str],
    header_idx: int = 0,
    headers: Sequence[str] | None = None,
    sep: str = ",",
    multiline: bool = False,
    order: str | None = None,
) -> DataFrame:
    """A1 for CSV: all-string columns named by the header record (C15 repair:
    blank names become ``Column n``, a repeated name keeps its first column).

    ``header_idx`` counts records from the top, blank lines included. Every
    file's own header is read; files with the same one are read by one scan,
    files with another column order are matched by name, and a column that a
    file lacks is null there. ``headers`` replaces the header texts by
    position. ``multiline`` allows line breaks inside quoted cells of the
    data, at the price of one task per file; without it, a line that leaves
    a quote open raises when it is read, as it would give wrong rows.
    ``order`` adds a column of that name by which rows sort as they stand in
    their files (for "first row" rules, S1)."""
    rows = raw_head_rows(spark, path, header_idx + 1, sep)
    # one row per file: its header's cells and where the header ends
    per_file = rows.groupBy("workbook").agg(
        F.max(F.when(F.col("row_idx") == header_idx, F.struct("cells", "line_end"))).alias("head"),
        F.count_if(F.size("cells") > 0).cast("int").alias("records"))
    groups: dict[tuple, list[str]] = {}
    for r in per_file.filter("head is not null").collect():
        groups.setdefault((tuple(r["head"]["cells"]), r["head"]["line_end"], r["records"]), []).append(r["workbook"])
    out = None
    for (cells, line_end, records), files in sorted(groups.items(), key=lambda g: min(g[1])):
        names, keep = repair_headers(headers if headers is not None else cells)
        width = max(len(cells), len(names), 1)
        body = _below(spark, sorted(files), width, sep, line_end, records, multiline)
        placed = [F.col("_place").alias(order)] if order else []
        one = body.select(*[F.col(f"_c{i}").alias(names[i]) for i in keep], *placed)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no file under {path} has a record {header_idx}")
    return out


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **kw) -> DataFrame:
    """A1: one logical table from a path; format from the extension when not
    given. Parquet keeps its types; CSV is all-string."""
    fmt = fmt or path.rsplit(".", 1)[-1].lower()
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt in ("csv", "txt"):
        return read_csv_table(spark, path, **kw)
    if fmt == "json":
        return spark.read.json(path)
    raise ValueError(f"unsupported input format: {fmt}")


def load_tables(spark: SparkSession, resolved: Mapping[str, tuple[str, str]], header_rows: Mapping[str, int] | None = None,
                header_texts: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """A1: every resolved source as a named lazy DataFrame."""
    out = {}
    for name, (path, _sheet) in resolved.items():
        idx = (header_rows or {}).get(name, 0)
        if path.lower().endswith(".csv"):
            out[name] = read_csv_table(spark, path, idx, (header_texts or {}).get(name) if idx else None)
        else:
            out[name] = read_table(spark, path)
    return out


def get_table(tables: Mapping[str, DataFrame], name: str, required: bool = True) -> DataFrame | None:
    """A missing optional table is ``None``; a missing required one raises."""
    df = tables.get(name)
    if df is None and required:
        raise KeyError(f"required table '{name}' is not loaded")
    return df


def preview(df: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` rows (a sampling feature, the limit is the point)."""
    return df.limit(n)
