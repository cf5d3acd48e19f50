"""Heavy join keys: found by a bounded summary, split over several tasks.

A lookup joins the master to a table with one row per key. Several lookups on
one key share one partitioning of the master, so a key that holds a third of
all rows would put them into one task of every join. Such keys are found
beforehand by a frequent-items sketch (mergeable, of bounded size in each task
and on the driver); the master's rows of a heavy key are dealt to numbered
copies of it, and the table's one row of that key is repeated once per copy.
All other keys, and the joins themselves, stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import col_of

#: Keys that a sketch tracks; a key with more than 1/TRACKED of the rows is never missed.
TRACKED = 10_000
#: A key is heavy from this many even shares of the rows per task.
FACTOR = 2

_COPY = "\u0002"  # a control char: never survives key normalisation


class JoinKey(str):
    """Name of a prepared key column, with the copies that its heavy keys are dealt to. ``merge``: its tables have
    about as many keys as the master, so they are joined by sorting and never gathered on the driver to be broadcast."""

    copies: dict[str, int]
    merge: bool

    def __new__(cls, name: str, copies: Mapping[str, int] | None = None, merge: bool = False) -> JoinKey:
        out = super().__new__(cls, name)
        out.copies, out.merge = dict(copies or {}), merge
        return out


def heavy_keys(df: DataFrame, keys: Mapping[str, Column | str], tasks: int | None = None, factor: float = FACTOR) -> dict[str, dict[str, int]]:
    """Per key expression, its heavy keys and the number of copies that makes each copy an even share.

    ``tasks`` (the session's shuffle partitions) says what an even share is. One pass without a shuffle of
    rows; at most ``tasks / factor`` keys of each kind come to the driver."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, min(TRACKED // 2, math.ceil(tasks / factor)))
    keyed = df.select(*[col_of(c).alias(f"k{i}") for i, c in enumerate(keys.values())])
    tops = [F.expr(f"approx_top_k(k{i}, {most}, {TRACKED})").alias(f"t{i}") for i in range(len(keys))]
    row = keyed.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    share = max(1.0, row["n"] / tasks)
    out = {}
    for i, name in enumerate(keys):
        found = [t for t in row[f"t{i}"] or [] if t["item"] is not None and t["count"] > factor * share]
        out[name] = {t["item"]: math.ceil(t["count"] / share) for t in found}
    return out


def dealt_key(key: Column, copies: Mapping[str, int], salt: Column) -> Column:
    """The key, or for heavy ones a copy of it that ``salt`` (a number per row) picks."""
    if not copies:
        return key
    number = F.create_map(*[x for k, n in copies.items() for x in (F.lit(k), F.lit(n).cast("long"))])
    return F.when(key.isin(list(copies)), F.concat(key, F.lit(_COPY), F.pmod(salt, number[key]).cast("string"))).otherwise(key)


def copied_rows(table: DataFrame, key: str, copies: Mapping[str, int]) -> DataFrame:
    """A table with one row per ``key``, in which a heavy key's row is there once per copy."""
    if not copies:
        return table
    number = F.create_map(*[x for k, n in copies.items() for x in (F.lit(k), F.lit(n))])
    k = F.col(key)
    names = F.when(k.isin(list(copies)), F.transform(F.sequence(F.lit(0), number[k] - 1), lambda i: F.concat(k, F.lit(_COPY), i.cast("string"))))
    return table.withColumn(key, F.explode(F.coalesce(names, F.array(k))))
