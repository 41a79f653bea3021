"""Activity bits against distinct counts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from abx.config import Experiment
from abx.operators import rates as R
from abx.operators.assign import assign
from abx.plans.analysis import ExperimentAnalysis
from abx.sources import fixtures as FX

from conftest import SF01

DAY = dt.date(2023, 11, 20)
EXPERIMENTS = [Experiment("long", 0.5, "true", DAY + dt.timedelta(days=30), DAY + dt.timedelta(days=199), 30),
               Experiment("short", 0.3, "user_id % 3 = 0", DAY + dt.timedelta(days=60), DAY + dt.timedelta(days=64), 2)]


def _start(period, d):
    return {"day": d, "week": d - dt.timedelta(days=d.weekday()), "month": d.replace(day=1)}[period]


def test_rates_over_many_words_equal_distinct_counts(spark):
    rng = random.Random(2)
    rows = [(u, DAY + dt.timedelta(days=rng.choice([0, 61, 62, 63, 123, 124, rng.randrange(-5, 210)]))) for u in range(60) for _ in range(rng.randrange(6))]
    log = spark.createDataFrame(rows, "user_id long, date date")
    users = spark.range(80).withColumnRenamed("id", "user_id")
    a = assign(users, EXPERIMENTS)
    first, last = DAY, DAY + dt.timedelta(days=199)
    bits = R.activity_bits(log, first, last)
    assert len(bits.first().days) == R.words(first, last) == 4
    got = {(r.experiment_id, r.group, r.period, r.period_start): (r.active_users, r.total_users)
           for r in R.active_rate(bits, a, R.period_bits(spark, EXPERIMENTS, first, last)).collect()}
    group = {(r.user_id, r.experiment_id): r.group for r in a.collect()}
    total = {}
    for (_, e), g in group.items():
        total[e, g] = total.get((e, g), 0) + 1
    want = {}
    for e in EXPERIMENTS:
        for g in ("control", "treatment"):
            day = e.start_date - dt.timedelta(days=e.pre_days)
            while day <= e.end_date:
                for p in R.PERIODS:
                    users_in = want.setdefault((e.experiment_id, g, p, _start(p, day)), set())
                    users_in |= {u for u, d in rows if d == day and group.get((u, e.experiment_id)) == g}
                day += dt.timedelta(days=1)
    assert got == {k: (len(v), total[k[0], k[1]]) for k, v in want.items()}


def test_bits_of_parts_merge(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), DAY + dt.timedelta(days=rng.randrange(100))) for _ in range(60)]
    last = DAY + dt.timedelta(days=99)
    whole = {r.user_id: r.days for r in R.activity_bits(spark.createDataFrame(rows, "user_id long, date date"), DAY, last).collect()}
    parts = [R.activity_bits(spark.createDataFrame(rows[i::3], "user_id long, date date"), DAY, last) for i in range(3)]
    merged = R.merge_bits(parts[0].unionByName(parts[1]).unionByName(parts[2]), R.words(DAY, last))
    assert {r.user_id: r.days for r in merged.collect()} == whole


def test_rate_plan_folds_users_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        a = ExperimentAnalysis(spark, FX.userlog(spark, SF01), FX.users(spark, SF01), EXPERIMENTS[:1])
        plan = a.active_rate()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_bit_or" in plan and "Expand" not in plan and "ExistingRDD" not in plan
    assert plan.count("Exchange hashpartitioning(user_id") == 1      # nothing but the fold of the log moves by user


def test_materialized_ids_keep_their_type(spark):
    exps = [Experiment(i, 0.5, "true", dt.date(2024, 1, 5), dt.date(2024, 1, 20), 2) for i in ("1", "01", "2024-01-01", "a b")]
    a = ExperimentAnalysis(spark, FX.userlog(spark, SF01), FX.users(spark, SF01), exps)
    before = a.exposed
    want = sorted(tuple(r) for r in a.group_day_totals().select("date", "group", "experiment_id", "user_days").collect())
    a.materialize()
    assert a.exposed.dtypes == before.dtypes
    assert {r.experiment_id for r in a.exposed.select("experiment_id").distinct().collect()} == {"1", "01", "2024-01-01", "a b"}
    assert sorted(tuple(r) for r in a.group_day_totals().select("date", "group", "experiment_id", "user_days").collect()) == want
    assert a.exposed.agg(F.count("*")).first()[0] == before.count()
