import datetime as dt

import pytest
from pyspark.sql import functions as F

from abx.operators import metrics as M
from abx.schemas import USERLOG


def _log(spark, rows):
    return spark.createDataFrame(rows, USERLOG)


def test_midnight_goes_to_new_day(spark):
    rows = [(1, "00000001", dt.datetime(2024, 1, 1, 23, 59, 59, 999999), "view", None),
            (1, "00000001", dt.datetime(2024, 1, 2, 0, 0, 0), "purchase", 10.0)]
    out = {r.date: r for r in M.user_day_metrics(_log(spark, rows)).collect()}
    assert set(out) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert out[dt.date(2024, 1, 2)].total_purchase_amount == 10.0
    assert out[dt.date(2024, 1, 1)].total_views == 1


def test_user_day_counts_and_nulls(spark):
    t = dt.datetime(2024, 1, 5, 12)
    rows = [(7, "a", t, "view", None), (7, "a", t, "click", None), (7, "b", t, "purchase", None),
            (7, "c", t, "purchase", 2.5), (7, None, t, "signup", None)]
    r = M.user_day_metrics(_log(spark, rows), activities=("view", "click", "purchase", "signup")).first()
    assert r.total_listings == 3  # null listing not counted
    assert (r.total_views, r.total_clicks, r.total_purchases, r.total_signups, r.total_events) == (1, 1, 2, 1, 5)
    assert r.total_purchase_amount == 2.5  # null amount counts as 0


def test_day_bucket_independent_of_session_zone(spark):
    rows = [(1, "x", dt.datetime(2024, 7, 11, 5, 0), "view", None)]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        d = M.user_day_metrics(_log(spark, rows)).first().date
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert d == dt.date(2024, 7, 11)


def test_merge_zeros_equals_explicit_zeros(spark):
    vals = [3.0, 5.5, 10.25, 0.5]
    n_total = 9
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    agg = df.agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.var_samp("v").alias("var"))
    mean, var = M.merge_zeros(F.col("n"), F.col("s"), F.col("var"), F.lit(n_total))
    r = agg.select(mean.alias("m"), var.alias("v")).first()
    full = vals + [0.0] * (n_total - len(vals))
    import statistics
    assert r.m == pytest.approx(statistics.fmean(full), rel=1e-12)
    assert r.v == pytest.approx(statistics.variance(full), rel=1e-12)


def test_moments_invariant_to_repartition(spark):
    from conftest import SF01
    from abx.sources import fixtures as FX
    log = FX.userlog(spark, SF01)
    a = M.user_day_metrics(log).agg(F.sum("total_purchase_amount"), F.var_samp("total_purchase_amount")).first()
    b = M.user_day_metrics(log.repartition(13)).agg(F.sum("total_purchase_amount"),
                                                    F.var_samp("total_purchase_amount")).first()
    assert a[0] == pytest.approx(b[0], rel=1e-9) and a[1] == pytest.approx(b[1], rel=1e-9)


def test_user_day_filled_zero_rows(spark):
    import datetime as dt
    from abx.config import Experiment
    from abx.sources.tables import experiments_frame
    rows = [(1, "x", dt.datetime(2024, 1, 2, 3), "purchase", 4.0)]
    ud = M.user_day_metrics(_log(spark, rows))
    a = spark.createDataFrame([(1, "control", "e", 0.5), (2, "treatment", "e", 0.5)],
                              "user_id long, group string, experiment_id string, experiment_ratio double")
    e = experiments_frame(spark, [Experiment("e", 0.5, "true", dt.date(2024, 1, 1), dt.date(2024, 1, 3), 0)])
    out = M.user_day_filled(ud, a, e).collect()
    assert len(out) == 6
    assert sum(r.total_purchase_amount for r in out) == 4.0


def test_log_longer_than_the_experiment(spark):
    """All results keep to one period: the pre-days and the treatment days."""
    import datetime as dt
    from abx.config import Experiment
    from abx.plans.analysis import ExperimentAnalysis
    e = Experiment("e", 0.5, "true", dt.date(2024, 3, 10), dt.date(2024, 3, 12), 2)
    log = spark.createDataFrame(
        [(u, "1", dt.datetime(2024, 3, d, 12), "purchase", 10.0) for u in range(40) for d in range(1, 25)],
        "user_id long, listing_id string, event_time timestamp, activity string, purchase_amount double")
    users = spark.createDataFrame([(u,) for u in range(40)] + [(None,)], "user_id long")
    a = ExperimentAnalysis(spark, log, users, [e])
    assert a.assignments.count() == 40      # a null id is no user
    assert {r.date.day for r in a.exposed.select("date").distinct().collect()} == {8, 9, 10, 11, 12}
    totals = {r.phase: r.total_amount for r in a.pre_post_totals().groupBy("phase").sum("total_amount")
              .withColumnRenamed("sum(total_amount)", "total_amount").collect()}
    assert totals == {"pre": 800.0, "post": 1200.0}
    assert a.experiment_results().count() == 10
    assert a.sample_progress().count() == 6
    r = a.overall_ttest().first()
    assert r.sum_control + r.sum_treatment == 1200.0


def test_days_without_activity_have_rows(spark):
    import datetime as dt
    from abx.config import Experiment
    from abx.plans.analysis import ExperimentAnalysis
    e = Experiment("e", 0.5, "true", dt.date(2024, 3, 10), dt.date(2024, 3, 14), 1)
    log = spark.createDataFrame([(1, "1", dt.datetime(2024, 3, 12, 12), "purchase", 10.0)],
                                "user_id long, listing_id string, event_time timestamp, activity string, purchase_amount double")
    a = ExperimentAnalysis(spark, log, spark.createDataFrame([(u,) for u in range(9)], "user_id long"), [e])
    rows = a.cumulative().where("total_amount > 0 or daily_cumulative_sum > 0").count()
    assert a.group_day_totals().count() == 12 and rows == 3
    assert a.active_rate().where("period = 'day'").count() == 12
    assert a.average_duration().where("period = 'day' and sessions = 0").count() == 11
    days = {(r.group, r.date.day): r.experiment_duration for r in a.experiment_results().collect()}
    assert all(v == d - 9 for (_, d), v in days.items())
