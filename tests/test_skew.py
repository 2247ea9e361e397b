"""Hot keys: one key holding a third of all rows."""

import os
from collections import defaultdict

from pyspark.sql import functions as F

from metricfold.operators import fold
from metricfold.operators import state as st
from metricfold.sinks import state_table as tbl
from metricfold.sources import fixtures as fx
from tests.conftest import SF_MID


def _hot(spark):
    # Every third update is re-keyed to one id of the same kind.
    u = fx.updates(spark, SF_MID)
    return u.withColumn("id", F.when((F.col("seq") % 3 == 0) & (F.col("type") == "counter"),
                                     F.lit("hot")).otherwise(F.col("id")))


def test_hot_key_fold_is_exact_and_pre_aggregated(spark):
    u = _hot(spark)
    got = {(r.id, r.mtype): (r.delta, r.value) for r in fold.fold_state(u).collect()}
    sums, last = defaultdict(int), {}
    for r in u.orderBy("seq").collect():
        if r.type == "counter" and r.delta is not None:
            sums[r.id] += r.delta
        elif r.type == "gauge" and r.value is not None:
            last[r.id] = r.value
    assert got[("hot", "counter")] == (sums["hot"], None)
    assert got == {**{(k, "counter"): (v, None) for k, v in sums.items()},
                   **{(k, "gauge"): (None, v) for k, v in last.items()}}
    plan = fold.fold_state(u)._jdf.queryExecution().executedPlan().toString()
    # Map-side partial aggregation happens before the only shuffle.
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_hot_key_strict_fold(spark):
    u = _hot(spark)
    r = fold.fold_state_strict(u).where("id = 'hot'").collect()[0]
    expect = u.where("id = 'hot' AND lower(type) = 'counter' AND delta IS NOT NULL") \
        .agg(F.sum("delta")).collect()[0][0]
    assert (r.mtype, r.delta) == ("counter", expect)


def test_hot_lookup_key_is_split_by_aqe(spark, scratch):
    # Lookups run against the stored state table (the read path): both join
    # sides are shuffled, so AQE can split the hot request partition.
    u = fx.updates(spark, SF_MID)
    root = os.path.join(scratch, "state")
    tbl.apply_set(spark, root, fold.fold_state(u), 0)
    state = tbl.read_state(spark, root)
    hot = u.select("seq", F.when(F.col("seq") % 3 == 0, F.lit("click.u7")).otherwise(F.col("id")).alias("id"),
                   F.when(F.col("seq") % 3 == 0, F.lit("counter")).otherwise(F.col("type")).alias("type"))
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = st.lookup(hot.repartition(8), state)
        n = df.count()
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert n == len(rows) and sum(1 for r in rows if r.id == "click.u7") >= u.count() // 3


def test_hot_lookup_key_spreads_without_a_flag(spark, tmp_path):
    """A key with a third of the requests is answered by several tasks, for a
    state folded in the query and for a stored table; misses too."""
    from metricfold.sinks import state_table as tbl
    u = fx.updates(spark, SF_MID)
    folded = fold.fold_state(u)
    root = str(tmp_path / "state")
    tbl.apply_batch(spark, root, u.where("seq % 2 = 0"), 0)
    tbl.apply_batch(spark, root, u.where("seq % 2 = 1"), 1)
    hot = u.select("seq", F.when(F.col("seq") % 3 == 0, F.lit("click.u7")).otherwise(F.col("id")).alias("id"),
                   F.when(F.col("seq") % 3 == 0, F.lit("counter")).otherwise(F.col("type")).alias("type"))
    plain = sorted(map(tuple, st.lookup(hot, folded, hot_requests=10 ** 9).collect()))
    lost = hot.withColumn("id", F.when(F.col("id") == "click.u7", "gone").otherwise(F.col("id")))
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for state in (folded, tbl.read_state(spark, root)):
            found = st.lookup(hot, state, hot_requests=1000)
            assert len(found.where("id = 'click.u7'").groupBy(F.spark_partition_id()).count().collect()) > 3
            if state is folded:
                assert sorted(map(tuple, found.collect())) == plain
            by_task = st.lookup_missing(lost, state, hot_requests=1000) \
                .groupBy("id", F.spark_partition_id().alias("p")).count().collect()
            gone = [r["count"] for r in by_task if r.id == "gone"]
            assert len(gone) > 3 and sum(gone) == hot.where("id = 'click.u7' and type = 'counter'").count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
