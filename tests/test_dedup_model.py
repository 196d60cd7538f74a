"""Random logs against a plain model with two keys, on both dedup paths, with and without memory."""

import random

import pytest
from conftest import envelope, log_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators import dedup, skew
from keyflow.operators.classify import valid_rows, with_dedup_key
from keyflow.plans.outcomes import build_outcomes

TTL = 7.0


def two_key_model(rows):
    """Accept unless the offset or the header was accepted less than one TTL ago; then mark both."""
    marks, accepted = {}, []
    for arrival, partition, offset, key in sorted(rows, key=lambda r: r[:3]):
        names = [("offset", partition, offset)] + ([("header", key)] if key else [])
        live = any(name in marks and arrival - marks[name] < TTL for name in names)
        if not live:
            accepted.append((arrival, partition, offset))
            marks.update({name: arrival for name in names})
    return sorted(accepted)


def random_log(seed, hot_share=0.0, size=300):
    """Offsets with fixed headers, delivered one to three times at distinct quarter-hours."""
    rng = random.Random(seed)
    rows, times = [], iter(rng.sample(range(60 * 96), size * 4))
    for offset in range(size):
        key = "hot" if rng.random() < hot_share else rng.choice([None, None, *"abcdef"])
        partition = rng.randrange(3)
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            rows.append((next(times) / 96, partition, offset, key))
    return rows


def accepted_of(frame):
    done = frame.filter(F.col("outcome") == S.PROCESSED)
    epoch = F.unix_micros("arrival_ts") - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    got = done.select((epoch / 86_400_000_000).alias("d"), "partition", "offset").collect()
    return sorted((round(r.d * 96) / 96, r.partition, r.offset) for r in got)


def to_log(spark, rows):
    return log_of(spark, [envelope(offset=o, arrival=a, partition=p, key=k) for a, p, o, k in rows])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("floor", [5, 100_000])
def test_single_key_equals_two_key_model(spark, seed, floor):
    rows = random_log(seed, hot_share=0.34)
    assert accepted_of(build_outcomes(to_log(spark, rows), floor=floor)) == two_key_model(rows)


@pytest.mark.parametrize("floor", [5, 100_000])
def test_two_runs_equal_one(spark, floor):
    rows = random_log(11, hot_share=0.34)
    cut = 25.3
    first = build_outcomes(to_log(spark, [r for r in rows if r[0] < cut]), floor=floor)
    seen = dedup.seen_keys(first.filter(F.col("outcome") == S.PROCESSED))
    second = build_outcomes(to_log(spark, [r for r in rows if r[0] >= cut]), seen=seen, floor=floor)
    assert accepted_of(first.unionByName(second)) == two_key_model(rows)


def test_both_paths_give_the_same_reasons(spark):
    log = to_log(spark, random_log(5, hot_share=0.5))
    columns = ["partition", "offset", "arrival_ts", "outcome", "reason", "dedup_reason", "dedup_key"]
    fold, walk = build_outcomes(log).select(columns), build_outcomes(log, floor=3).select(columns)
    assert fold.exceptAll(walk).isEmpty() and walk.exceptAll(fold).isEmpty()


def test_gap_free_chains_are_not_mistaken_for_gaps(spark):
    """A record every day for a month: each seventh is accepted, though no gap is ever a TTL long."""
    rows = [(float(n), 0, n, "k") for n in range(30)]
    got = accepted_of(build_outcomes(to_log(spark, rows)))
    assert [offset for _, _, offset in got] == [0, 7, 14, 21, 28]


def test_first_wins(spark):
    rows = random_log(2)
    keyed = valid_rows(with_dedup_key(to_log(spark, rows)))
    got = {r.dedup_key: (r.partition, r.offset, r.deliveries) for r in dedup.first_wins(keyed).collect()}
    want = {}
    for arrival, partition, offset, key in sorted(rows, key=lambda r: r[:3]):
        name = f"dedup:idemp:{key}" if key else f"dedup:offset:inbound:{partition}:{offset}"
        first = want.setdefault(name, [partition, offset, 0])
        first[2] += 1
    assert got == {name: tuple(value) for name, value in want.items()}


def test_heavy_keys_are_bounded(spark):
    frame = spark.range(1000).select(F.when(F.col("id") < 334, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    assert [r.k for r in skew.heavy_keys(frame, "k", floor=20).collect()] == ["hot"]
    assert skew.heavy_keys(frame, "k", floor=500) is None
    # every key passes this floor, but at most three may be heavy: more than a third of all rows each
    assert [r.k for r in skew.heavy_keys(frame, "k", floor=1, max_keys=3).collect()] == ["hot"]


@pytest.mark.parametrize("floor", [10, 100_000])
def test_lookup_join_equals_left_join(spark, floor):
    frame = spark.range(600).select(
        "id",
        F.when(F.col("id") < 200, "hot")
        .when(F.col("id") < 400, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 70))
        .alias("k"),
    )
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", 3), ("other", 4)], "k string, v int")
    got = skew.lookup_join(frame, lookup, "k", floor).select("id", "k", "v")
    want = frame.join(lookup, "k", "left").select("id", "k", "v")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_frequent_keys_are_counted_exactly(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").when(F.col("id") < 1101, "warm").when(F.col("id") < 1201, "just").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k")
    )
    assert sorted(r.k for r in skew.frequent_keys(frame, "k", floor=100).collect()) == ["hot", "warm"]
    assert skew.frequent_keys(frame, "k", floor=1000) is None
    assert skew.frequent_keys(frame.limit(0), "k", floor=0) is None
    assert skew.frequent_keys(frame.select(F.lit(None).cast("string").alias("k")), "k", floor=0) is None


def minutes_log(spark, minutes, per_minute=1):
    """One key, a record every minute or more often, each at a place of its own."""
    step = 60 // per_minute
    start = F.lit("2024-01-01").cast("timestamp")
    return spark.range(minutes * per_minute).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.timestamp_micros(F.unix_micros(start) + F.col("id") * step * 1_000_000).alias("arrival_ts"), F.lit("k").alias("dedup_key"), F.lit("x").alias("payload"),
    )


def test_a_ttl_of_a_minute_over_thirty_days(spark):
    """43,200 accepted rows in a chain: the rounds grow with the logarithm, not with the chain."""
    minutes = 30 * 24 * 60
    marked = dedup.ttl_dedup(minutes_log(spark, minutes, 2), "1 minute", floor=1000).cache()
    row = marked.agg(F.count("*"), F.sum(F.col("accepted").cast("int")), F.min(F.when(F.col("accepted"), F.col("offset") % 2 == 0))).first()
    assert tuple(row) == (2 * minutes, minutes, True)
    assert marked.filter("NOT accepted AND dedup_reason <> 'idempotency-key'").isEmpty()


@pytest.mark.parametrize("ttl, marks, remembered", [("1 minute", 0, True), ("7 minutes", 200_000, False), ("90 minutes", 0, True)])
def test_jumps_and_fold_agree_at_any_ttl(spark, monkeypatch, ttl, marks, remembered):
    rng = random.Random(ttl)
    rows = [(rng.randrange(4), rng.randrange(30), rng.randrange(0, 7200), rng.choice("abc")) for _ in range(600)]
    rows += [(0, 7, 600, "a")] * 40
    frame = spark.createDataFrame([("t", p, o, t, k) for p, o, t, k in rows], "topic string, partition int, offset bigint, t bigint, dedup_key string")
    frame = frame.select("topic", "partition", "offset", F.timestamp_seconds(F.col("t") + 1_704_067_200).alias("arrival_ts"), "dedup_key")
    seen = frame.filter("offset = 3").groupBy("dedup_key").agg(*[F.first(c).alias(c) for c in ("arrival_ts", "partition", "offset", "topic")])
    memory = seen if remembered else None
    monkeypatch.setattr(dedup, "MAX_BROADCAST_MARKS", marks)
    fold, jump = dedup.ttl_dedup(frame, ttl, memory), dedup.ttl_dedup(frame, ttl, memory, floor=50)
    assert fold.exceptAll(jump).isEmpty() and fold.count() == jump.count() == len(rows)


def test_fold_carries_state_across_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    frame = minutes_log(spark, 300)
    whole = dedup.ttl_dedup(frame, "7 minutes")
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7")
    try:
        assert [r.offset for r in dedup.ttl_dedup(frame, "7 minutes").filter("accepted").orderBy("offset").collect()] == list(range(0, 300, 7))
    finally:
        spark.conf.set(setting, before)
    assert [r.offset for r in whole.filter("accepted").orderBy("offset").collect()] == list(range(0, 300, 7))


def test_filters_do_not_move_below_the_fold(spark):
    marked = dedup.ttl_dedup(minutes_log(spark, 60), "7 minutes")
    assert [r.offset for r in marked.filter("offset > 9 AND accepted").orderBy("offset").collect()][:2] == [14, 21]


def test_one_shuffle_carries_the_payload(spark, tmp_path):
    """Two scans (one of them the key sketch), one exchange, one sort."""
    minutes_log(spark, 60).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = dedup.ttl_dedup(log)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    narrow = dedup.ttl_dedup(log).select("offset", "accepted")._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in narrow
    assert "accepted" in log.transform(dedup.ttl_dedup).columns


def test_ttl_text():
    assert dedup.ttl_micros("7 days") == 604_800_000_000
    assert dedup.ttl_micros("1 hour") == 3_600_000_000
    with pytest.raises(ValueError):
        dedup.ttl_micros("0 days")
