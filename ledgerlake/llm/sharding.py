"""Shards by a hierarchical weighted hash tree (region, rack, shard).

At every level a row draws a number for each child from a hash of its id and the child's path, divides
by the child's weight (the weight of its whole subtree) and goes to the smallest: a weighted
rendezvous. The draw of a child depends on no other child, so when weights change, rows move only into
subtrees whose weight grew and out of subtrees whose weight shrank. A new shard that is hung in as a
region of its own therefore takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import before, cut, table, whole_text

REGIONS, RACKS, SHARDS = 2, 3, 4
SEED = "shard"
#: Expected rows of the buckets that slots are counted in.
BUCKET_ROWS = 4096

#: region -> rack -> shard weights
Tree = Sequence[Sequence[Sequence[float]]]


def even_tree(regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS) -> Tree:
    return [[[1.0] * shards for _ in range(racks)] for _ in range(regions)]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, the only leaf of a new region."""
    return [*tree, [[weight]]]


def _weight(node) -> float:
    return float(node) if isinstance(node, (int, float)) else sum(map(_weight, node))


def _children(node, path: str = "") -> dict[str, list[float]]:
    """Path of every inner node -> its children's weights."""
    if isinstance(node, (int, float)):
        return {}
    out = {path: [_weight(child) for child in node]}
    for i, child in enumerate(node):
        out |= _children(child, f"{path}/{i}")
    return out


def _leaves(node, path: str = "") -> list[str]:
    if isinstance(node, (int, float)):
        return [path]
    return [leaf for i, child in enumerate(node) for leaf in _leaves(child, f"{path}/{i}")]


def _lookup(known: dict[str, Column], key: Column) -> Column:
    return F.create_map(*[x for k, v in known.items() for x in (F.lit(k), v)])[key]


def with_tree_shard(df: DataFrame, key: str, tree: Tree, out: str, seed: str = SEED) -> DataFrame:
    """Adds ``out``: the shard, numbered over the leaves from 0, that the id in ``key`` descends to."""
    if not tree or any(not rack for region in tree for rack in region) or _weight(tree) <= 0:
        raise ValueError("the tree needs leaves of positive weight")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"))
    children, path = _children(tree), f"_{out}_path"

    def draw(weight: Column, i: Column) -> Column:
        """An exponential draw with the rate ``weight``, from 52 bits of an MD5; the least one wins."""
        md5 = F.md5(F.concat(text, F.col(path), F.lit("/"), i.cast("string")))
        bits = F.conv(F.substring(md5, 1, 13), 16, 10).cast("double")
        return F.struct((F.log((bits + 0.5) / F.lit(float(1 << 52))) / -weight).alias("draw"), i.alias("child"))

    df = df.withColumn(path, F.lit(""))
    for level in range(3):
        weights = {k: F.array(*map(F.lit, v)) for k, v in children.items() if k.count("/") == level}
        least = F.array_min(F.transform(_lookup(weights, F.col(path)), draw))
        df = df.withColumn(path, F.concat(F.col(path), F.lit("/"), least["child"].cast("string")))
    numbers = {leaf: F.lit(n) for n, leaf in enumerate(_leaves(tree))}
    return df.withColumn(out, _lookup(numbers, F.col(path))).drop(path)


def shard_documents(docs: DataFrame, tree: Tree | None = None, seed: str = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``key``: the id and the tree alone decide; rows with the same id, and rows with a null id, share
    a shard. ``slot`` counts the rows of a shard from 0 without gaps, by a hash of the id. A null text
    has size 8 and the checksum of no bytes. Other columns are ignored; an empty table gives an empty
    result.
    """
    tree = tree or even_tree()
    key = F.col("doc_id")
    text = whole_text("text")
    placed = cut(
        docs.select(
            key.cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(F.md5(F.concat(F.lit("slot:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("long").alias("at"),
        )
    )
    # the top part of the hash that orders a shard's rows
    width = (1 << 32) // max(1, placed.count() // (BUCKET_ROWS * sum(len(rack) for region in tree for rack in region)))
    placed = with_tree_shard(placed, "doc_id", tree, "shard", seed)
    placed = with_tree_shard(placed, "doc_id", grown(tree), "grown_shard", seed)
    placed = cut(placed.withColumn("bucket", F.floor(F.col("at") / width)))
    slots = before(placed, ["shard"], "bucket", ["at", "doc_id", "text_crc32", "size"], F.lit(1).cast("long"), "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _sql_child(path: str, weights: list[float]) -> str:
    """The winning child of ``path`` for the id in column doc_id."""
    draws = [f"ln((('0x' || substr(md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, 'null'), ':{path}/{i}')), 1, 13))::BIGINT + 0.5) / {float(1 << 52)}) / -{w}" for i, w in enumerate(weights)]
    return f"(list_position([{', '.join(draws)}], list_min([{', '.join(draws)}])) - 1)" if len(draws) > 1 else "0"


def _sql_shard(tree: Tree) -> str:
    """The same descent as one SQL expression."""
    children, number = _children(tree), {leaf: n for n, leaf in enumerate(_leaves(tree))}

    def below(path: str) -> str:
        if path in number:
            return str(number[path])
        cases = " ".join(f"WHEN {i} THEN {below(f'{path}/{i}')}" for i in range(len(children[path])))
        return f"CASE {_sql_child(path, children[path])} {cases} END"

    return below("")


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


SQL = f"""
WITH bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
  FROM documents
),
placed AS (
  SELECT doc_id, size,
    xor(4294967295, list_reduce(bytes, lambda crc, b: xor(crc >> 8, ({_crc_table()}::BIGINT[])[(xor(crc, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32,
    ({_sql_shard(even_tree())})::INT AS shard, ({_sql_shard(grown(even_tree()))})::INT AS grown_shard,
    substr(md5(concat('slot:', coalesce(doc_id::VARCHAR, 'null'))), 1, 8) AS spot
  FROM bytes
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY spot, doc_id) - 1 AS slot, grown_shard
FROM placed
"""


def op7_hash_tree_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
