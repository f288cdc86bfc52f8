"""Hot keys: one key holding a third of the rows must be split, never one task's job."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefeed.operators.joins import join_dimension
from linefeed.operators.merge import last_per_key


def _hot_fact(spark, n=300_000):
    # a third of all rows share key 0, the rest spread over 5000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_hot_key_join_is_split_by_aqe(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = _hot_fact(spark)
        dim = spark.range(0, 5001).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = join_dimension(fact, dim, "k", max_rows=100)   # too big to broadcast
        assert len(joined.collect()) == 300_000     # runs this plan; AQE re-plans it
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_dedup_combines_map_side(spark):
    fact = _hot_fact(spark)
    picked = last_per_key(fact.withColumn("ts", F.col("v") % 97), ["k"], ["ts", "v"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate runs before the shuffle: the hot key leaves each task as one row
    assert plan.count("Aggregate") >= 2
    assert picked.filter(F.col("k") == 0).count() == 1
