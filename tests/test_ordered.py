"""The chunked two-level scans equal plain per-entity windows (random data, ties, NULLs, hot entity)."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histora.plans.ordered import HOT_ROWS_CONF, MIN_BYTES_CONF, chunked_lead, chunked_running


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    base = datetime(2024, 1, 1)
    for i in range(600):
        key = 0 if rnd.random() < 0.4 else rnd.choice([1, 2, 3, None])   # entity 0 is hot
        t = None if rnd.random() < 0.03 else base + timedelta(hours=rnd.randrange(0, 24 * 20))
        v = None if rnd.random() < 0.1 else rnd.randrange(100)
        rows.append((key, t, f"id{i:04d}", v))
    return spark.createDataFrame(rows, "k int, t timestamp_ntz, id string, v int")


@pytest.fixture
def all_hot(spark):
    """Every entity is split by time, whatever its size."""
    spark.conf.set(HOT_ROWS_CONF, "0")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.mark.parametrize("seed,minutes,hot", [(1, 60, True), (2, 1440, True), (3, 420, True), (4, 60, False)])
def test_lead_lag_rownumber(spark, seed, minutes, hot):
    spark.conf.set(MIN_BYTES_CONF, "0")
    if hot:
        spark.conf.set(HOT_ROWS_CONF, "0")
    else:
        spark.conf.set(HOT_ROWS_CONF, "100")   # only the big entity 0 is split

    df = _data(spark, seed)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    want = df.select("id", F.lead("id").over(w).alias("nxt"), F.lag("id").over(w).alias("prv"),
                     F.row_number().over(w).alias("rn"))
    a = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "n", row_number="rn")
    b = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "p", descending=True)
    got = a.select("id", F.col("n.id").alias("nxt"), "rn").join(b.select("id", F.col("p.id").alias("prv")), "id")
    assert sorted(map(tuple, got.select("id", "nxt", "prv", "rn").collect())) == \
        sorted(map(tuple, want.select("id", "nxt", "prv", "rn").collect()))
    spark.conf.unset(HOT_ROWS_CONF)
    spark.conf.unset(MIN_BYTES_CONF)


def test_small_inputs_take_the_plain_window(spark, tmp_path):
    _data(spark, 5).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))   # a file scan has a size estimate; an RDD has none
    a = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "n", row_number="rn")
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" not in plan
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    want = df.select("id", F.lead("id").over(w).alias("nxt"), F.row_number().over(w).alias("rn"))
    assert sorted(map(tuple, a.select("id", F.col("n.id"), "rn").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("how", ["max", "min", "last"])
@pytest.mark.parametrize("descending,include", [(False, False), (True, False), (False, True)])
def test_running(spark, all_hot, how, descending, include):
    df = _data(spark, 11)
    order = [F.col("t").desc_nulls_first(), F.col("id").desc_nulls_first()] if descending else \
        [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    fn = {"max": F.max("v"), "min": F.min("v"), "last": F.last("v", ignorenulls=True)}[how]
    want = sorted(map(tuple, df.select("id", fn.over(w).alias("r")).collect()))
    got = chunked_running(df, ["k"], ["t", "id"], F.col("v"), "r", how, descending=descending,
                          include_current=include)
    assert sorted(map(tuple, got.select("id", "r").collect())) == want


@pytest.mark.parametrize("seed", [7, 8])
def test_adaptive_chunks_for_heavy_entities(spark, seed):
    """Only the heavy entity is split, into chunks sized by its own row count and time span."""
    from histora.plans.ordered import CHUNK_ROWS_CONF
    spark.conf.set(MIN_BYTES_CONF, "0")
    spark.conf.set(HOT_ROWS_CONF, "100")
    spark.conf.set(CHUNK_ROWS_CONF, "15")
    try:
        df = _data(spark, seed)
        w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
        want = df.select("id", F.lead("id").over(w).alias("nxt"), F.row_number().over(w).alias("rn"),
                         F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"))
        a = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "n", row_number="rn")
        b = chunked_running(df, ["k"], ["t", "id"], F.col("v"), "mx", "max")
        got = a.select("id", F.col("n.id").alias("nxt"), "rn").join(b.select("id", "mx"), "id")
        assert sorted(map(tuple, got.select("id", "nxt", "rn", "mx").collect())) == \
            sorted(map(tuple, want.collect()))
        plan = a._jdf.queryExecution().optimizedPlan().toString()
        assert "_chunk" in plan
    finally:
        for c in (MIN_BYTES_CONF, HOT_ROWS_CONF, CHUNK_ROWS_CONF):
            spark.conf.unset(c)


def test_hot_entity_is_spread_over_several_tasks(spark):
    """After the split scan the heavy entity's rows sit in many partitions; a plain window uses one."""
    from histora.plans.ordered import CHUNK_ROWS_CONF
    confs = {MIN_BYTES_CONF: "0", HOT_ROWS_CONF: "100", CHUNK_ROWS_CONF: "20",
             "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = _data(spark, 9)
        out = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "n")
        # the partition id is taken before the filter (a non-deterministic projection is not pushed
        # through) and the window output stays referenced -- also by the final action, so collect rather
        # than count -- else the unused window would be pruned away
        hot = len(out.select("k", "n", F.spark_partition_id().alias("p")).where("k = 0")
                  .groupBy("p").agg(F.count("n")).collect())
        w = Window.partitionBy("k").orderBy("t", "id")
        plain = len(df.withColumn("n", F.lead("id").over(w)).select("k", "n", F.spark_partition_id().alias("p"))
                    .where("k = 0").groupBy("p").agg(F.count("n")).collect())
        assert plain == 1
        assert hot > 4
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _windowed(df, order):
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.select("id", F.lead("id").over(w).alias("nxt"), F.row_number().over(w).alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"))


@pytest.mark.parametrize("case", ["outlier", "one_instant", "zoned", "string", "number", "date"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_borders_follow_the_rows_for_every_order_type(spark, case, zone):
    """Equal to the plain window, and the largest chunk stays near the target."""
    from histora.plans import ordered
    confs = {MIN_BYTES_CONF: "0", HOT_ROWS_CONF: "200", ordered.CHUNK_ROWS_CONF: "50", "spark.sql.session.timeZone": zone}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        n = 1200
        t = {"outlier": F.expr("if(i = 5, timestamp_ntz'1970-01-01', timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, i))"),
             "one_instant": F.expr("timestamp_ntz'2024-01-01 00:00:00'"),
             "zoned": F.expr("timestamp_micros(1730606400000000 + (i * 7919 % 1200) * 15000000)"),   # over the autumn change
             "string": F.expr("concat('x', hex(i * 31 % 1000))"), "number": F.expr("cast(i * 37 % 500 AS double)"),
             "date": F.expr("date_add(date'2024-01-01', cast(i % 3 AS int))")}[case]
        df = spark.range(n).withColumnRenamed("id", "i").select(
            F.when(F.col("i") % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("k"), t.alias("t"),
            F.format_string("id%06d", F.col("i")).alias("id"), (F.col("i") % 17).alias("v"))
        lead = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "n", row_number="rn")
        total = chunked_running(df, ["k"], ["t", "id"], F.col("v"), "total", "sum", include_current=True)
        got = lead.select("id", F.col("n.id").alias("nxt"), "rn").join(total.select("id", "total"), "id")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _windowed(df, ["t", "id"]).collect()))
        x, part, hot = ordered._prepare(df, ["k"], ["t", "id"])
        sizes = x.where("k = 1").groupBy(*part).count().collect()
        assert len(sizes) >= 10 and max(r["count"] for r in sizes) <= 150
        assert x.where("k = 2").select(*part).distinct().count() == 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("split", ["plain", "every", "adaptive"])
def test_peers_of_an_instant_hold_across_chunks(spark, split):
    """One instant holds ten chunks' rows, others lie on borders, one is NULL: equal to the plain peer window."""
    from histora.plans import ordered
    confs = {"plain": {}, "every": {HOT_ROWS_CONF: "0"},
             "adaptive": {MIN_BYTES_CONF: "0", HOT_ROWS_CONF: "100", ordered.CHUNK_ROWS_CONF: "20"}}[split]
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        i = F.col("i")
        t = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(i % 40 AS int))")
        df = spark.range(900).withColumnRenamed("id", "i").select(
            F.when(i % 9 == 0, F.lit(2)).when(i % 50 == 1, F.lit(None)).otherwise(F.lit(1)).alias("k"),
            F.when(i % 3 == 1, F.expr("timestamp_ntz'2024-01-02'")).when(i % 17 == 2, F.lit(None)).otherwise(t).alias("t"),
            F.format_string("id%06d", (i * 7919) % 900).alias("id"), F.when(i % 5 > 0, i % 23).alias("v"))
        assert df.where("k = 1 AND t = timestamp_ntz'2024-01-02'").count() > 200
        w = Window.partitionBy("k", "t")
        want = df.select("id", "k", "t", F.count(F.lit(1)).over(w).alias("n"), F.min("v").over(w).alias("lo"),
                         F.max("v").over(w).alias("hi"))
        got = chunked_lead(df, ["k"], ["t", "id"], {"id": F.col("id")}, "nxt", row_number="rn",
                           peers={"n": F.count(F.lit(1)), "lo": F.min("v"), "hi": F.max("v")})
        assert not [c for c in got.columns if c.startswith("_")]
        if split != "plain":
            x, part, _ = ordered._prepare(df, ["k"], ["t", "id"], mark_parted=True)
            inside = x.where("k = 1 AND t = timestamp_ntz'2024-01-02'").select(*part).distinct().count()
            assert inside >= 10 and x.where(ordered._PARTED).select("k", "t").distinct().count() > 3
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == \
            sorted(map(tuple, want.collect()), key=repr)
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_peer_aggregates_do_not_compute_the_input_again(spark):
    """The aggregates across borders read the scan's own exchange."""
    from histora.plans import ordered
    confs = {MIN_BYTES_CONF: "0", HOT_ROWS_CONF: "100", ordered.CHUNK_ROWS_CONF: "20",
             "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = chunked_lead(_data(spark, 9).repartition(3), ["k"], ["t", "id"], {"id": F.col("id")}, "nxt",
                           row_number="rn", peers={"n": F.count(F.lit(1))})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("RoundRobinPartitioning") == 1 and "ReusedExchange" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
