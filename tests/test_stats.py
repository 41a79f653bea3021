import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.functions.tails import student_sf2_np
from abx.operators import metrics as M
from abx.operators import stats as S

SCHEMA = "experiment_id string, date date, user_id long, group string, total_purchase_amount double"


def _pooled_reference(x, y):
    nx, ny = len(x), len(y)
    sp2 = ((nx - 1) * statistics.variance(x) + (ny - 1) * statistics.variance(y)) / (nx + ny - 2)
    t = (statistics.fmean(x) - statistics.fmean(y)) / math.sqrt(sp2 * (1 / nx + 1 / ny))
    return t, float(student_sf2_np([t], [nx + ny - 2])[0])


def _frame(spark, control, treatment, exp="e"):
    import datetime as dt
    d = dt.date(2024, 1, 1)
    rows = [(exp, d, i, "control", v) for i, v in enumerate(control)]
    rows += [(exp, d, 10_000 + i, "treatment", v) for i, v in enumerate(treatment)]
    return spark.createDataFrame(rows, SCHEMA)


def test_daily_ttest_matches_formula(spark):
    rng = np.random.default_rng(1)
    c, t = [float(v) for v in rng.normal(10, 3, 40)], [float(v) for v in rng.normal(11, 3, 55)]
    r = S.daily_ttest(M.group_day_moments(_frame(spark, c, t))).first()
    want_t, want_p = _pooled_reference(c, t)
    assert r.t_stat == pytest.approx(want_t, rel=1e-10)
    assert r.p_value == pytest.approx(want_p, abs=1e-12)
    assert r.df == 93


def test_zero_values_left_out_of_daily_test(spark):
    c, t = [1.0, 2.0, 0.0, 3.0], [2.0, 0.0, 5.0]
    r = S.daily_ttest(M.group_day_moments(_frame(spark, c, t))).first()
    assert (r.n_control, r.n_treatment) == (3, 2)


@pytest.mark.parametrize("c,t", [([5.0], [1.0, 2.0]),       # one observation on a side
                                 ([2.0, 2.0], [2.0, 2.0]),  # constant values: zero variance
                                 ([1.0, 2.0], [])])         # one group only
def test_degenerate_gives_null(spark, c, t):
    r = S.daily_ttest(M.group_day_moments(_frame(spark, c, t))).first()
    assert r.t_stat is None and r.p_value is None


def test_known_shift_is_found(spark):
    rng = np.random.default_rng(7)
    c, t = [float(v) for v in rng.normal(100, 10, 300)], [float(v) for v in rng.normal(104, 10, 300)]
    r = S.daily_ttest(M.group_day_moments(_frame(spark, c, t))).first()
    assert r.p_value < 0.01 and r.t_stat < 0  # control - treatment


def _assign_rows(spark, rows):
    return spark.createDataFrame(rows, "user_id long, group string, experiment_id string, experiment_ratio double")


def test_ratio_test_values(spark):
    rows = [(i, "control", "e", 0.5) for i in range(48)] + [(100 + i, "treatment", "e", 0.5) for i in range(52)]
    r = S.ratio_test(_assign_rows(spark, rows)).first()
    assert (r.control_expected, r.treatment_expected) == (50, 50)
    assert r.test_stat == pytest.approx(0.16) and r.p_value == pytest.approx(0.689157, abs=1e-6)


def test_ratio_test_flags_bad_groups(spark):
    rows = [(1, "control", "a", 0.5), (2, "control", "a", 0.5),
            (3, "control", "b", 0.5), (4, "treatment", "b", 0.5), (5, "holdout", "b", 0.5)]
    out = {r.experiment_id: r for r in S.ratio_test(_assign_rows(spark, rows)).collect()}
    assert out["a"].test_stat is None and out["a"].treatment_observed == 0
    assert out["b"].test_stat is None and out["b"].other_observed == 1


def test_pooled_z(spark):
    df = spark.createDataFrame([(120, 1000, 150, 1000)], "xc long, nc long, xt long, nt long")
    z = df.select(S.pooled_z(F.col("xc"), F.col("nc"), F.col("xt"), F.col("nt"))).first()[0]
    p = 270 / 2000
    want = (0.12 - 0.15) / math.sqrt(p * (1 - p) * (2 / 1000))
    assert z == pytest.approx(want, rel=1e-12)


def test_overall_ttest_counts_zero_users(spark):
    import datetime as dt
    from abx.config import Experiment
    from abx.sources.tables import experiments_frame
    e = experiments_frame(spark, [Experiment("e", 0.5, "true", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 0)])
    exposed = spark.createDataFrame(
        [("e", dt.date(2024, 1, 2), 1, "control", 5.0), ("e", dt.date(2024, 1, 3), 1, "control", 1.0),
         ("e", dt.date(2024, 1, 2), 2, "control", 2.0), ("e", dt.date(2024, 1, 4), 11, "treatment", 9.0),
         ("e", dt.date(2024, 1, 4), 12, "treatment", 0.0)], SCHEMA)
    assign = _assign_rows(spark, [(1, "control", "e", .5), (2, "control", "e", .5), (3, "control", "e", .5),
                                  (11, "treatment", "e", .5), (12, "treatment", "e", .5), (13, "treatment", "e", .5),
                                  (14, "treatment", "e", .5)])
    r = S.overall_ttest(exposed, assign, e).first()
    want_t, want_p = _pooled_reference([6.0, 2.0, 0.0], [9.0, 0.0, 0.0, 0.0])
    assert (r.n_control, r.n_treatment) == (3, 4)
    assert r.t_stat == pytest.approx(want_t, rel=1e-10) and r.p_value == pytest.approx(want_p, abs=1e-12)


def _experiment(spark, ratio=0.5):
    import datetime as dt
    from abx.config import Experiment
    from abx.sources.tables import experiments_frame
    return experiments_frame(spark, [Experiment("e", ratio, "true", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 0)])


def test_aa_splits_at_the_experiments_ratio(spark):
    assign = spark.range(4000).select(F.col("id").alias("user_id"), F.lit("e").alias("experiment_id"),
                                      F.lit(0.2).alias("experiment_ratio"))
    days = spark.createDataFrame([(1, 5.0)], "user_id long, total_purchase_amount double").withColumn(
        "date", F.lit("2024-01-05").cast("date"))
    rows = S.aa_test(days, assign, _experiment(spark, 0.2), salts=10).collect()
    assert len(rows) == 10 and all(r.n_control + r.n_treatment == 4000 for r in rows)
    assert all(abs(r.n_treatment - 800) < 130 for r in rows) and len({r.n_treatment for r in rows}) > 3


def test_aa_reject_share_near_alpha(spark):
    rng = np.random.default_rng(3)
    n = 4000
    vals = rng.exponential(20, n)
    per_user = spark.createDataFrame([("e", i, "control", float(v)) for i, v in enumerate(vals)],
                                     "experiment_id string, user_id long, group string, value double")
    assign = per_user.select("user_id", "group", "experiment_id", F.lit(0.5).alias("experiment_ratio"))
    days = per_user.select("user_id", F.lit("2024-01-05").cast("date").alias("date"),
                           F.col("value").alias("total_purchase_amount"))
    s = S.aa_summary(S.aa_test(days, assign, _experiment(spark), salts=400)).first()
    assert s.n_splits == 400
    assert 0.02 <= s.reject_share <= 0.09


def test_overlap_independent_hashes(spark):
    from abx.config import Experiment
    from abx.operators.assign import assign
    u = spark.range(0, 20000).select(F.col("id").alias("user_id"))
    a = assign(u, [Experiment("x", 0.5), Experiment("y", 0.5)])
    r = S.experiment_overlap(a, ["x", "y"]).first()
    assert r.n_cc + r.n_ct + r.n_tc + r.n_tt == 20000
    assert r.p_value > 0.001
