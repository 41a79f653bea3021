"""Statistical tests over summary rows.

Every test is: one aggregation to moments (partial, constant state per key),
column arithmetic for the statistic, and a pandas UDF for the tail
probability on the few summary rows. Degenerate input (fewer than two
observations on a side, zero variance, empty side) gives null, not an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.functions.columns import TWO_POW_32
from abx.functions.tails import chi2_1df_sf, normal_sf2, student_sf2
from abx.operators.metrics import CONTROL, TREATMENT, conditional_moments, merge_zeros
from abx.operators.windows import complete_days, group_calendar
from abx.sources.tables import rows_to_frame


# ---------------------------------------------------------------- sample ratio

def ratio_test(assignments: DataFrame) -> DataFrame:
    """Sample-ratio chi-square per experiment, all experiments in one pass.

    Expected treatment = floor(n * ratio), control = the rest. A row whose
    groups are not exactly control and treatment (one missing, or another
    label present) keeps its counts with a null statistic.
    """
    c = F.col("group")
    g = assignments.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(c == CONTROL).alias("control_observed"),
        F.count_if(c == TREATMENT).alias("treatment_observed"),
        F.max("experiment_ratio").alias("_ratio"),
    )
    te = F.floor(F.col("_n") * F.col("_ratio")).cast("bigint")
    g = g.withColumn("treatment_expected", te).withColumn("control_expected", F.col("_n") - te)
    g = g.withColumn("other_observed", F.col("_n") - F.col("control_observed") - F.col("treatment_observed"))
    valid = (F.col("other_observed") == 0) & (F.col("control_observed") > 0) & (F.col("treatment_observed") > 0)

    def term(o, e):
        d = (F.col(o) - F.col(e)).cast("double")
        return F.try_divide(d * d, F.col(e).cast("double"))

    stat = F.when(valid, term("control_observed", "control_expected") + term("treatment_observed", "treatment_expected"))
    g = g.withColumn("test_stat", stat).withColumn("p_value", chi2_1df_sf(F.col("test_stat")))
    return g.select("experiment_id", "control_observed", "control_expected", "treatment_observed",
                    "treatment_expected", "other_observed", "test_stat", "p_value")


# ---------------------------------------------------------------- t-tests

def pooled_t(nc: Column, mc: Column, vc: Column, nt: Column, mt: Column, vt: Column):
    """Student two-sample t with pooled variance; sign is control - treatment.

    Returns (t, df). Null when a side has < 2 observations or the pooled
    variance is 0.
    """
    ncd, ntd = nc.cast("double"), nt.cast("double")
    dof = ncd + ntd - F.lit(2.0)
    ok = (nc >= 2) & (nt >= 2)
    sp2 = F.try_divide((ncd - 1.0) * vc + (ntd - 1.0) * vt, dof)
    se = F.sqrt(sp2 * (F.try_divide(F.lit(1.0), ncd) + F.try_divide(F.lit(1.0), ntd)))
    t = F.when(ok, F.try_divide(mc - mt, se))
    return t, F.when(ok, dof)


def with_ttest(moments: DataFrame) -> DataFrame:
    """Add t_stat, df, p_value to a frame of control/treatment moments."""
    t, dof = pooled_t(F.col("n_control"), F.col("mean_control"), F.col("var_control"),
                      F.col("n_treatment"), F.col("mean_treatment"), F.col("var_treatment"))
    out = moments.withColumn("t_stat", t).withColumn("df", dof)
    return out.withColumn("p_value", student_sf2(F.col("t_stat"), F.col("df")))


def daily_ttest(day_moments: DataFrame) -> DataFrame:
    """Per (experiment_id, date): pooled t-test of the day's non-zero user-day values."""
    return with_ttest(day_moments)


def user_totals(exposed: DataFrame, experiments: DataFrame, metric: str = "total_purchase_amount",
                phase: str = "post") -> DataFrame:
    """Per (experiment_id, user_id, group): the metric summed over the phase.

    post = start_date..end_date, pre = the pre_days before start_date.
    """
    e = F.broadcast(experiments.select("experiment_id", "start_date", "end_date", "pre_days"))
    x = exposed.join(e, "experiment_id")
    if phase == "post":
        cond = (F.col("date") >= F.col("start_date")) & (F.col("date") <= F.col("end_date"))
    elif phase == "pre":
        cond = (F.col("date") < F.col("start_date")) & (
            F.col("date") >= F.date_sub(F.col("start_date"), F.col("pre_days")))
    else:
        raise ValueError(f"phase must be 'pre' or 'post', got {phase!r}")
    return x.filter(cond).groupBy("experiment_id", "user_id", "group").agg(F.sum(metric).alias("value"))


def overall_ttest(exposed: DataFrame, assignments: DataFrame, experiments: DataFrame,
                  metric: str = "total_purchase_amount") -> DataFrame:
    """Per experiment: pooled t-test of the per-user total over the treatment
    period, over **all** assigned users (users without activity count as 0).

    Active users' moments come from one aggregation; the zeros are merged in
    analytically from the assigned counts.
    """
    per_user = user_totals(exposed, experiments, metric, "post")
    m = conditional_moments(per_user, ["experiment_id"], "value")
    n = assignments.groupBy("experiment_id").agg(
        F.count_if(F.col("group") == CONTROL).alias("users_control"),
        F.count_if(F.col("group") == TREATMENT).alias("users_treatment"))
    x = n.join(m, "experiment_id", "left")
    cols = {}
    for tag in ("control", "treatment"):
        mean, var = merge_zeros(F.col(f"n_{tag}"), F.col(f"sum_{tag}"), F.col(f"var_{tag}"),
                                F.col(f"users_{tag}"))
        cols[tag] = (mean, var)
    x = x.select(
        "experiment_id",
        F.col("users_control").alias("n_control"), F.col("users_treatment").alias("n_treatment"),
        F.coalesce(F.col("n_control"), F.lit(0)).alias("active_control"),
        F.coalesce(F.col("n_treatment"), F.lit(0)).alias("active_treatment"),
        F.coalesce(F.col("sum_control"), F.lit(0.0)).alias("sum_control"),
        F.coalesce(F.col("sum_treatment"), F.lit(0.0)).alias("sum_treatment"),
        cols["control"][0].alias("mean_control"), cols["control"][1].alias("var_control"),
        cols["treatment"][0].alias("mean_treatment"), cols["treatment"][1].alias("var_treatment"),
    )
    return with_ttest(x)


# ---------------------------------------------------------------- proportions

def pooled_z(xc: Column, nc: Column, xt: Column, nt: Column) -> Column:
    """Two-proportion z with pooled proportion; sign is control - treatment."""
    ncd, ntd = nc.cast("double"), nt.cast("double")
    pc, pt = F.try_divide(xc.cast("double"), ncd), F.try_divide(xt.cast("double"), ntd)
    p = F.try_divide((xc + xt).cast("double"), ncd + ntd)
    se = F.sqrt(p * (F.lit(1.0) - p) * (F.try_divide(F.lit(1.0), ncd) + F.try_divide(F.lit(1.0), ntd)))
    return F.try_divide(pc - pt, se)


def active_rate_ztest(exposed: DataFrame, assignments: DataFrame, experiments: DataFrame) -> DataFrame:
    """Per experiment: share of assigned users active at least once in the
    treatment period, compared by a pooled two-proportion z-test."""
    return with_ztest(overall_ttest(exposed, assignments, experiments)).select(
        "experiment_id", "n_control", "n_treatment", "active_control", "active_treatment",
        "rate_control", "rate_treatment", "z_stat", F.col("z_p_value").alias("p_value"))


def with_ztest(overall: DataFrame) -> DataFrame:
    """Add the active-rate z-test to rows of ``overall_ttest``: users with a
    treatment-period total are exactly the active users, so both tests come
    from one per-user aggregation."""
    x = overall.withColumn("rate_control", F.try_divide(F.col("active_control").cast("double"), F.col("n_control")))
    x = x.withColumn("rate_treatment", F.try_divide(F.col("active_treatment").cast("double"), F.col("n_treatment")))
    x = x.withColumn("z_stat", pooled_z(F.col("active_control"), F.col("n_control"),
                                        F.col("active_treatment"), F.col("n_treatment")))
    return x.withColumn("z_p_value", normal_sf2(F.col("z_stat")))


# ---------------------------------------------------------------- design checks

def aa_test(user_days: DataFrame, assignments: DataFrame, experiments: DataFrame, salts: int = 100,
            metric: str = "total_purchase_amount") -> DataFrame:
    """A/A check: re-split each experiment's users ``salts`` times by a salted hash at the
    experiment's own ratio (groups ignored) and t-test each split over all assigned
    users; users without a value in the treatment period count as 0.

    Assignments are joined with the user-days once, folded to one value per user and
    experiment, and fan out in place. One md5 has the bits of four splits.
    """
    e = F.broadcast(experiments.select("experiment_id", "start_date", "end_date"))
    days = assignments.select("user_id", "experiment_id", "experiment_ratio").join(e, "experiment_id").join(
        user_days.select("user_id", "date", metric), "user_id", "left")
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    per_user = days.groupBy("user_id", "experiment_id", "experiment_ratio").agg(
        F.coalesce(F.sum(F.when(inside, F.col(metric))), F.lit(0.0)).alias("value"))
    blocks = per_user.select("*", F.explode(F.sequence(F.lit(0), F.lit((salts - 1) // 4))).alias("_block"))
    digest = F.md5(F.concat_ws("|", "experiment_id", F.lit("aa"), "_block", "user_id"))
    fourth = F.posexplode(F.array(*[F.conv(F.substring(F.col("_md5"), 1 + 8 * k, 8), 16, 10).cast("bigint")
                                    for k in range(4)])).alias("_k", "_unit")
    drawn = (blocks.select("experiment_id", "experiment_ratio", "value", "_block", digest.alias("_md5"))
             .select("experiment_id", "experiment_ratio", "value", "_block", fourth)
             .withColumn("salt", F.col("_block") * 4 + F.col("_k")).where(F.col("salt") < salts)
             .withColumn("group", F.when(F.col("_unit") < F.col("experiment_ratio") * F.lit(TWO_POW_32), F.lit(TREATMENT))
                         .otherwise(F.lit(CONTROL))))
    return with_ttest(conditional_moments(drawn, ["experiment_id", "salt"], "value"))


def aa_summary(aa: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Per experiment: number of A/A splits, rejections at alpha, reject share."""
    return aa.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("n_splits"),
        F.count_if(F.col("p_value") < F.lit(alpha)).alias("n_reject"),
    ).withColumn("reject_share", F.col("n_reject") / F.col("n_splits"))


def z_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def sample_size(pre_user: DataFrame, assignments: DataFrame, mde_rel: float = 0.1,
                alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Minimum users per group from pre-period moments:
    n = 2 var (z_{1-alpha/2} + z_{power})^2 / delta^2, delta = mde_rel * pre mean.

    Both groups pooled (nothing is treated yet); assigned users without pre
    activity count as 0.
    """
    zsum = z_quantile(1 - alpha / 2) + z_quantile(power)
    m = pre_user.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("_n1"), F.sum("value").alias("pre_sum"), F.var_samp("value").alias("_v1"))
    n = assignments.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("n_users"))
    x = n.join(m, "experiment_id", "left").withColumn("pre_sum", F.coalesce(F.col("pre_sum"), F.lit(0.0)))
    mean, var = merge_zeros(F.col("_n1"), F.col("pre_sum"), F.col("_v1"), F.col("n_users"))
    x = x.withColumn("pre_mean", mean).withColumn("pre_var", var)
    x = x.withColumn("delta", F.col("pre_mean") * F.lit(float(mde_rel)))
    need = F.try_divide(F.lit(2.0 * zsum * zsum) * F.col("pre_var"), F.col("delta") * F.col("delta"))
    x = x.withColumn("required_per_group", F.ceil(need))
    return x.select("experiment_id", "n_users", "pre_sum", "pre_mean", "pre_var", "delta", "required_per_group")


def sample_progress(exposed: DataFrame, experiments: DataFrame, assignments: DataFrame,
                    mde_rel: float = 0.1, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Per (experiment_id, group, date) in the treatment period: users seen so far
    (first active day counted once; every day has a row) against the minimum size per group from
    ``sample_size``; ``reached`` flags the days from which the test may be read.

    One pass over the log: a per-user aggregation gives both the pre-period
    value and the first treatment-period day; it folds to (experiment, group,
    first day) rows carrying pre-period moments, which are combined per
    experiment by Chan's formula on those few rows.
    """
    from pyspark.sql import Window
    zsum = z_quantile(1 - alpha / 2) + z_quantile(power)
    e = F.broadcast(experiments.select("experiment_id", "start_date", "end_date", "pre_days"))
    x = exposed.join(e, "experiment_id")
    post = (F.col("date") >= F.col("start_date")) & (F.col("date") <= F.col("end_date"))
    pre = (F.col("date") < F.col("start_date")) & (F.col("date") >= F.date_sub(F.col("start_date"), F.col("pre_days")))
    per_user = x.groupBy("experiment_id", "group", "user_id").agg(
        F.min(F.when(post, F.col("date"))).alias("first_day"),
        F.sum(F.when(pre, F.col("total_purchase_amount"))).alias("pre_value"))
    cells = per_user.groupBy("experiment_id", "group", "first_day").agg(
        F.count(F.lit(1)).alias("new_users"),
        F.count("pre_value").alias("_n"), F.sum("pre_value").alias("_s"), F.var_samp("pre_value").alias("_v"))
    whole = Window.partitionBy("experiment_id")
    cells = cells.withColumn("_m", F.try_divide(F.col("_s"), F.col("_n")))
    cells = cells.withColumn("_n_all", F.sum("_n").over(whole)).withColumn("pre_sum", F.coalesce(F.sum("_s").over(whole), F.lit(0.0)))
    cells = cells.withColumn("_mean_all", F.try_divide(F.col("pre_sum"), F.col("_n_all")))
    within = F.coalesce(F.col("_v"), F.lit(0.0)) * F.greatest(F.col("_n") - F.lit(1), F.lit(0))
    between = F.coalesce(F.col("_n") * (F.col("_m") - F.col("_mean_all")) * (F.col("_m") - F.col("_mean_all")), F.lit(0.0))
    cells = cells.withColumn("_m2_all", F.sum(within + between).over(whole))
    n = F.broadcast(assignments.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("n_users")))
    cells = cells.join(n, "experiment_id")
    var_active = F.try_divide(F.col("_m2_all"), F.col("_n_all") - F.lit(1))
    mean, var = merge_zeros(F.col("_n_all"), F.col("pre_sum"), var_active, F.col("n_users"))
    delta = mean * F.lit(float(mde_rel))
    need = F.ceil(F.try_divide(F.lit(2.0 * zsum * zsum) * var, delta * delta))
    cells = cells.withColumn("required_per_group", need)
    # Users without a day in the period carry the requirement, and count 0, on the last day:
    # the calendar meets one frame, so the log is read once. Days x 2 rows per experiment.
    news = cells.join(F.broadcast(experiments.select("experiment_id", "end_date")), "experiment_id").groupBy(
        "experiment_id", "group", F.coalesce("first_day", "end_date").alias("date")).agg(
        F.sum(F.when(F.col("first_day").isNotNull(), F.col("new_users")).otherwise(0)).alias("new_users"),
        F.max("required_per_group").alias("required_per_group"))
    daily = complete_days(news, group_calendar(experiments, pre=False), ["new_users"]).withColumn(
        "required_per_group", F.max("required_per_group").over(whole))
    w = Window.partitionBy("experiment_id", "group").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    daily = daily.withColumn("users_so_far", F.sum("new_users").over(w))
    daily = daily.withColumn("reached", F.coalesce(F.col("users_so_far") >= F.col("required_per_group"), F.lit(False)))
    return daily.select("experiment_id", "group", "date", "new_users", "users_so_far", "required_per_group", "reached")


PAIRS = T.StructType([T.StructField("experiment_a", T.StringType()), T.StructField("experiment_b", T.StringType())])


def experiment_overlap(assignments: DataFrame, experiment_ids: Sequence[str]) -> DataFrame:
    """Interference check between experiments: for each pair (a < b), the 2x2
    table of groups among users in both, and a chi-square test of independence.

    One row per user with its experiments, whose pairs (bounded by the parameter
    list) are counted per pair of experiments. No pairs of users are formed.
    """
    ids = sorted(set(experiment_ids))
    if len(ids) < 2:
        raise ValueError("need at least two experiments")
    spark = assignments.sparkSession
    # Each user's experiments in one array (as long as the parameter list at most), then
    # its ordered pairs in place: the plan does not grow with the experiments.
    mine = (assignments.where(F.col("experiment_id").isin(ids)).groupBy("user_id")
            .agg(F.collect_set(F.struct("experiment_id", "group")).alias("_e")))
    pairs = mine.select(F.explode("_e").alias("x"), "_e").select("x", F.explode("_e").alias("y")).where(
        F.col("x.experiment_id") < F.col("y.experiment_id"))
    gx, gy = F.col("x.group"), F.col("y.group")
    seen = pairs.groupBy(F.col("x.experiment_id").alias("experiment_a"), F.col("y.experiment_id").alias("experiment_b")).agg(
        F.count_if((gx == CONTROL) & (gy == CONTROL)).alias("n_cc"),
        F.count_if((gx == CONTROL) & (gy == TREATMENT)).alias("n_ct"),
        F.count_if((gx == TREATMENT) & (gy == CONTROL)).alias("n_tc"),
        F.count_if((gx == TREATMENT) & (gy == TREATMENT)).alias("n_tt"))
    every = rows_to_frame(spark, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]], PAIRS)
    x = complete_days(seen, every, ["n_cc", "n_ct", "n_tc", "n_tt"])
    a_, b_, c_, d_ = (F.col(n).cast("double") for n in ("n_cc", "n_ct", "n_tc", "n_tt"))
    n = a_ + b_ + c_ + d_
    chi2 = F.try_divide(n * (a_ * d_ - b_ * c_) * (a_ * d_ - b_ * c_),
                        (a_ + b_) * (c_ + d_) * (a_ + c_) * (b_ + d_))
    return x.withColumn("chi2", chi2).withColumn("p_value", chi2_1df_sf(F.col("chi2")))
