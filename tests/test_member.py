"""The membership filter and the existence test that uses it."""

from pyspark.sql import functions as F

from labelgraph.operators import samples as S
from labelgraph.operators.member import may_contain, member_filter


def test_filter_never_misses_and_rarely_passes_others(spark):
    values = spark.range(0, 20_000).select(F.concat(F.lit("img/ü"), "id").alias("path"))
    held = member_filter(values.unionByName(values), "path", block_bits=4)
    assert held.count() == 16 and held.select(F.max(F.octet_length("bits"))).first()[0] == 4096
    probe = spark.range(0, 60_000).select("id", F.concat(F.lit("img/ü"), "id").alias("path"))
    flagged = may_contain(probe, "path", held, "may", block_bits=4)
    assert flagged.columns == ["id", "path", "may"] and flagged.count() == 60_000
    assert flagged.where("id < 20000 and not may").count() == 0
    assert flagged.where("id >= 20000 and may").count() < 2_000  # 60,000 of 524,288 bits: about 0.0013 of 40,000


def test_filter_of_nothing_and_of_nulls(spark):
    nulls = spark.createDataFrame([(None,), (None,)], "path string")
    assert member_filter(nulls, "path").count() == 0
    probe = spark.createDataFrame([("a",), (None,)], "path string")
    assert [r.may for r in may_contain(probe, "path", member_filter(nulls, "path"), "may").collect()] == [False, False]
    held = member_filter(probe, "path")
    assert {(r.path, r.may) for r in may_contain(probe, "path", held, "may").collect()} == {("a", True), (None, False)}


def test_filtered_existence_equals_the_plain_join(spark):
    checked = spark.range(0, 3_000).select(
        "id", F.when(F.col("id") % 50 != 0, F.concat(F.lit("d/"), F.col("id") % 700, F.lit(".png"))).alias("image_path"), F.lit(1).alias("_at0")
    )
    images = spark.range(0, 400).select(F.concat(F.lit("d/./x/../"), F.col("id") % 300, F.lit(".png")).alias("path"))
    for listing in (images, images.limit(0)):
        for keep in (True, False):
            plain, fast = (f(checked, listing, keep).select("id", "image_path") for f in (S.image_exists, S.image_exists_filtered))
            assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, plain.collect()))


def test_missing_rows_stay_out_of_the_shuffle(spark):
    checked = spark.range(0, 50_000).select("id", F.concat(F.lit("p"), "id").alias("image_path"))
    images = spark.range(0, 100).select(F.concat(F.lit("p"), "id").alias("path"))
    held = member_filter(images, "path")
    assert may_contain(checked, "image_path", held, "may").where("may").count() < 200
    plan = S.image_exists_filtered(checked, images)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "bitmap_construct_agg" in plan
