from pyspark.sql import functions as F

from ledgerlake.llm.common import smallest_hashes


def test_smallest_hashes_do_not_depend_on_how_they_are_found(spark):
    rows = spark.range(5000).withColumn("at", F.xxhash64("id"))
    want = sorted((r.at, r.id) for r in rows.collect())
    assert sorted((r.at, r.id) for r in smallest_hashes(rows, "at", 40).collect()) == want[:40]
    skewed = rows.withColumn("at", F.col("id"))  # none in the lower half of the range
    assert sorted(r.id for r in smallest_hashes(skewed, "at", 40).collect()) == list(range(40))
    assert smallest_hashes(rows.where("id < 0"), "at", 40).count() == 0 and smallest_hashes(rows, "at", 9000).count() == 5000
