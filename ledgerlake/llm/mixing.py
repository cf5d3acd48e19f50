"""Mix sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Golden-ratio points, mapped through the cumulative target shares, name a source for every slot of the
mix; slots are ranked per source. Each source's documents, in a shuffled order, form a stream that is
read up to three times and cut into blocks of equal token counts; slot rank r takes block r.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW_KEY, before, cut, numbered, pick, table, with_row_key

SEED = 7
MAX_EPOCHS = 3
#: A block holds 1/MIN_SLOTS of the corpus, BLOCK_TOKENS tokens at most.
MIN_SLOTS = 20_000
BLOCK_TOKENS = 2048
BUCKET_ROWS = 1024
#: 2**31 / golden ratio, made odd: multiples modulo 2**31 are golden-ratio points and visit every value once.
GOLDEN = 1327217885
RING = 1 << 31
#: The cells of the ring by which points find their source.
CELLS = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """rid, row key, doc_id, source, size: the number of words that white space parts."""
    docs = with_row_key(docs.select("doc_id", "source", "text"))
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    source = F.col("source").cast("string")
    return numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), words.alias("size"), *ROW_KEY))


def source_targets(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, k (its place), source_size, target, quota (target in whole words).

    Weights are 1, 2, 3, repeating by code point of the source, null last. A target stops at
    ``max_epochs`` times the source's size; filling sources in the order of cap / weight until one is not
    filled gives what resharing the excess ends in. The windows order one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("w", (F.col("k") % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    fill = Window.orderBy(F.col("cap") / F.col("w"), "k")
    filled = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(every))
    left = F.col("total") - F.coalesce(F.sum("cap").over(filled), F.lit(0))
    per = per.withColumn("full", F.col("cap") <= left / F.sum("w").over(rest) * F.col("w"))
    caps = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(every)
    open_w = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(every)
    per = per.withColumn("level", (F.col("total") - caps) / F.when(open_w > 0, open_w))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("w"))
    return per.withColumn("target", target).select(
        "source", "k", "source_size", "target", F.least("cap", F.floor(F.col("target") + 0.5)).alias("quota")
    )


def schedule(per: DataFrame, slots: int, block: int) -> DataFrame:
    """k, rank, slot: the slots of the mix and their rank among the slots of their source.

    Point i, the golden ratio's multiple modulo the ring, falls into one source's interval of cumulative
    quotas; points find it by an equality on the ring's cells. A source whose points end a little short
    of its blocks gets the missing ones after the last point.
    """
    upto = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ring = per.withColumn("sum", F.sum("quota").over(upto)).withColumn("all", F.sum("quota").over(Window.partitionBy()))
    edge = lambda c: F.floor(c / F.col("all") * F.lit(float(RING))).cast("long")
    ring = ring.where("quota > 0").select(
        "k", edge(F.col("sum") - F.col("quota")).alias("lo"), edge(F.col("sum")).alias("hi"), F.ceil(F.col("quota") / F.lit(block)).cast("long").alias("blocks")
    )
    width = RING // CELLS
    cells = ring.where("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    points = ring.sparkSession.range(slots).select(
        F.col("id").alias("slot"), (F.col("id") % RING * GOLDEN % RING).alias("u")
    ).withColumn("cell", F.floor(F.col("u") / width))
    named = cut(points.join(cells, "cell").where("u >= lo and u < hi").select("k", "slot", F.floor(F.col("slot") / BUCKET_ROWS).alias("bucket")))
    ranked = before(named, ["k"], "bucket", ["slot"], F.lit(1).cast("long"), "rank")
    ranked = ranked.join(ring.select("k", "blocks"), "k").where("rank < blocks").select("k", "rank", "slot")
    had = named.groupBy("k").agg(F.count(F.lit(1)).alias("had"))
    short = ring.join(had, "k", "left").withColumn("had", F.coalesce("had", F.lit(0).cast("long"))).where("had < blocks")
    late = short.select("k", F.explode(F.sequence("had", F.col("blocks") - 1)).alias("rank"))
    return ranked.unionByName(late.withColumn("slot", F.col("rank") + slots))


def mix(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, row key, size, source_size, target, taken, first_slot for every row of ``docs``.

    ``taken``: the words of the document that the mix takes, repeats counted, ``max_epochs`` times its
    size at most; a source's taken words sum to its target, rounded. ``first_slot``: where the mix takes
    it first, null if never. A null or empty text has size 0 and is never taken; a null source is a
    source. Repeated rows are rows of their own. Other columns are ignored; an empty table gives an
    empty result.
    """
    sized = cut(sizes(docs))
    per = cut(source_targets(sized, max_epochs))
    rows, tokens = sized.count(), per.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, min(BLOCK_TOKENS, tokens // MIN_SLOTS))
    slots = -(-tokens // block)
    # 32 bits of an MD5 order the documents; their top part is the bucket
    at = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("long")
    width = (1 << 32) // max(1, rows // BUCKET_ROWS)
    placed = cut(
        sized.join(per, sized["source"].eqNullSafe(per["source"]))
        .select("rid", "doc_id", *ROW_KEY, "size", "k", "source_size", "target", "quota")
        .withColumn("at", at)
        .withColumn("bucket", F.floor(F.col("at") / width))
    )
    stream = before(placed, ["k"], "bucket", ["at", "doc_id", "rid"], F.col("size"), "start")
    reads = stream.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    reads = reads.withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("start"))
    reads = reads.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota"))).where("lo < hi")
    pieces = reads.select(
        "rid", "k", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("rank")
    )
    part = F.least(F.col("hi"), (F.col("rank") + 1) * block) - F.greatest(F.col("lo"), F.col("rank") * block)
    used = (
        pieces.join(schedule(per, slots, block), ["k", "rank"])
        .groupBy("rid")
        .agg(F.sum(part).alias("taken"), F.min("slot").alias("first_slot"))
    )
    return placed.join(used, "rid", "left").select(
        "doc_id", *ROW_KEY, "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row as often as it is read, to the nearest whole number.

    Columns stay as they are, whatever their names. A null or empty text has no words and is not taken; a null
    source is a source, and a null id sorts like any other. Rows equal in id, source and text are read together: as
    often as their reads add up to. An empty table gives an empty one.
    """
    reads = mix(docs).where("taken > 0").withColumn("times", F.round(F.col("taken") / F.col("size")).cast("int"))
    wanted = reads.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("_rows"), F.sum("times").cast("int").alias("_times"))
    return pick(docs, cut(wanted.where("_times > 0")), "_times")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
),
per0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
per1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM per0),
per2 AS (SELECT *, k % 3 + 1 AS w, source_size * {MAX_EPOCHS} AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM per1),
per3 AS (
  SELECT *, cap <= (total - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE * w AS "full" FROM per2
),
per4 AS (
  SELECT *, (total - sum(CASE WHEN "full" THEN cap ELSE 0 END) OVER ())::DOUBLE
    / nullif(sum(CASE WHEN "full" THEN 0 ELSE w END) OVER (), 0)::DOUBLE AS level FROM per3
),
per5 AS (SELECT *, CASE WHEN "full" THEN cap::DOUBLE ELSE level * w END AS target FROM per4),
per AS (SELECT *, least(cap, floor(target + 0.5)::BIGINT) AS quota FROM per5),
size_of AS (
  SELECT greatest(1, least({BLOCK_TOKENS}, t // {MIN_SLOTS})) AS block, (t + greatest(1, least({BLOCK_TOKENS}, t // {MIN_SLOTS})) - 1) // greatest(1, least({BLOCK_TOKENS}, t // {MIN_SLOTS})) AS slots
  FROM (SELECT coalesce(sum(source_size), 0)::BIGINT AS t FROM per0)
),
ring0 AS (SELECT *, (sum(quota) OVER (ORDER BY k))::BIGINT AS upto, (sum(quota) OVER ())::BIGINT AS every FROM per),
ring AS (
  SELECT k, floor((upto - quota)::DOUBLE / every::DOUBLE * {float(RING)})::BIGINT AS lo, floor(upto::DOUBLE / every::DOUBLE * {float(RING)})::BIGINT AS hi,
    (quota + block - 1) // block AS blocks FROM ring0, size_of WHERE quota > 0
),
points AS (
  SELECT slot, slot % {RING} * {GOLDEN} % {RING} AS u FROM (SELECT unnest(range(0, slots)) AS slot FROM size_of)
),
named AS (
  SELECT k, blocks, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS rank FROM points JOIN ring ON u >= lo AND u < hi
),
had AS (SELECT k, count(*) AS n FROM named GROUP BY k),
plan AS (
  SELECT k, rank, slot FROM named WHERE rank < blocks
  UNION ALL
  SELECT k, rank, rank + slots AS slot
  FROM (SELECT ring.k, unnest(range(coalesce(n, 0), blocks)) AS rank FROM ring LEFT JOIN had ON had.k = ring.k), size_of
),
streams AS (
  SELECT sized.doc_id, sized.size, per.k, source_size, target, quota, row_number() OVER () AS rid,
    coalesce(sum(sized.size) OVER (PARTITION BY per.k ORDER BY substr(md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, 'null'))), 1, 8), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN per ON sized.source IS NOT DISTINCT FROM per.source
),
reads AS (
  SELECT rid, k, epoch * source_size + start AS lo, least(epoch * source_size + start + size, quota) AS hi
  FROM streams, (SELECT unnest(range(0, {MAX_EPOCHS})) AS epoch) WHERE size > 0 AND epoch * source_size + start < quota
),
pieces AS (SELECT rid, k, lo, hi, block, unnest(range(lo // block, (hi - 1) // block + 1)) AS rank FROM reads, size_of),
used AS (
  SELECT rid, sum(least(hi, (pieces.rank + 1) * block) - greatest(lo, pieces.rank * block))::BIGINT AS taken, min(slot) AS first_slot
  FROM pieces JOIN plan ON plan.k = pieces.k AND plan.rank = pieces.rank GROUP BY rid
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot FROM streams LEFT JOIN used ON used.rid = streams.rid
"""


def op9_source_schedule(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop(*ROW_KEY)
