from pyspark.sql import functions as F

from strata.operators.joins import checked_broadcast


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_marks_only_small_sides(spark):
    big = spark.range(0, 50_000).withColumn("k", F.col("id") % 1000)
    small = spark.range(0, 1000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    joined = big.join(checked_broadcast(small, max_bytes=100_000), "k")
    assert joined.count() == 50_000
    assert "BroadcastHashJoin" in _plan(joined)
    unmarked = checked_broadcast(small, max_bytes=10)
    assert unmarked.count() == 1000  # too large: returned without the broadcast mark
    plan = _plan(big.hint("shuffle_merge").join(unmarked, "k"))
    assert "SortMergeJoin" in plan


def test_spread_repartitions_only_few_split_inputs(spark, tmp_path):
    from strata.operators.parallel import spread

    one = spark.range(0, 1000).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    few = spark.read.parquet(str(tmp_path / "one"))
    assert few.rdd.getNumPartitions() == 1
    assert spread(few, 4).rdd.getNumPartitions() == 4
    assert spread(few, 4).count() == 1000
    many = spark.range(0, 1000, numPartitions=6)
    assert spread(many, 4) is many  # already parallel: returned unchanged, no shuffle added
