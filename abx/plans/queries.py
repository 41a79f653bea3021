"""Registered queries over the driver's test tables.

Each takes (spark, sf_dir) and returns a DataFrame over whole tables. Output
is presented for cross-engine comparison: days as 'yyyy-MM-dd' strings and
doubles rounded at 1e-6 (``round6``); spread is shown as the standard
deviation (exact variances of cent data often end in a 5 at the rounding digit,
square roots practically never); means of money are shown as
whole-cent sums over counts, so summation order cannot move a printed digit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.config import FIXTURE_EXPERIMENTS
from abx.functions.columns import date_label, round6, to_cents
from abx.operators import assign as A
from abx.operators import audits as AU
from abx.operators import features as FE
from abx.operators import gram as G
from abx.operators import metrics as M
from abx.operators import models as MD
from abx.operators import windows as W
from abx.plans.analysis import ExperimentAnalysis
from abx.sources import fixtures as FX

FLAGSHIP_EXPERIMENT = "exp_all"

# The levels of the fixtures' listing columns.
LISTING_LEVELS = {
    "neighbourhood_cleansed": [f"Brand#{i}" for i in range(1, 26)],
    "room_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
}


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(date_label(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def cents_mean(sum_col: str, n_col: str):
    return F.try_divide(to_cents(F.col(sum_col)), F.col(n_col).cast("double"))


def analysis(spark: SparkSession, sf_dir: str, assignment: str = "hash") -> ExperimentAnalysis:
    return ExperimentAnalysis(spark, FX.userlog(spark, sf_dir), FX.users(spark, sf_dir),
                              FIXTURE_EXPERIMENTS, assignment=assignment)


# ------------------------------------------------------------------ slice 1

def q_user_day_metrics(spark, sf_dir):
    return present(M.user_day_metrics(FX.userlog(spark, sf_dir)))


def q_assign_hash(spark, sf_dir):
    exps = [e for e in FIXTURE_EXPERIMENTS if e.experiment_id == FLAGSHIP_EXPERIMENT]
    return A.assign(FX.users(spark, sf_dir), exps)


def q_assign_multi(spark, sf_dir):
    return analysis(spark, sf_dir).assignments


def q_exposed_user_days(spark, sf_dir):
    return present(analysis(spark, sf_dir).exposed)


def _moments(df: DataFrame, keys) -> DataFrame:
    return present(df.select(
        *keys,
        "n_control", to_cents(F.col("sum_control")).alias("sum_control"),
        cents_mean("sum_control", "n_control").alias("mean_control"), F.sqrt("var_control").alias("sd_control"),
        "n_treatment", to_cents(F.col("sum_treatment")).alias("sum_treatment"),
        cents_mean("sum_treatment", "n_treatment").alias("mean_treatment"),
        F.sqrt("var_treatment").alias("sd_treatment")))


def q_group_day_moments(spark, sf_dir):
    return _moments(analysis(spark, sf_dir).group_day_moments(), ["experiment_id", "date"])


def q_daily_ttest(spark, sf_dir):
    d = analysis(spark, sf_dir).daily_ttest()
    return present(d.select(
        "experiment_id", "date", "n_control", "n_treatment",
        cents_mean("sum_control", "n_control").alias("mean_control"),
        cents_mean("sum_treatment", "n_treatment").alias("mean_treatment"),
        "t_stat", "df", "p_value"))


# ------------------------------------------------------------------ ratio test

def q_group_counts(spark, sf_dir):
    return analysis(spark, sf_dir).group_counts()


def q_ratio_test(spark, sf_dir):
    return present(analysis(spark, sf_dir).ratio_test())


# ------------------------------------------------------------------ result tables

def q_group_day_totals(spark, sf_dir):
    return present(analysis(spark, sf_dir).group_day_totals())


def q_cumulative_by_group(spark, sf_dir):
    return present(analysis(spark, sf_dir).cumulative())


def q_experiment_day(spark, sf_dir):
    a = analysis(spark, sf_dir)
    return present(W.experiment_day(a.group_day_totals(), a.experiments_df)
                   .select("date", "group", "experiment_id", "experiment_duration", "experiment_day"))


def q_experiment_results(spark, sf_dir):
    return present(analysis(spark, sf_dir).experiment_results())


def q_date_spine(spark, sf_dir):
    return present(W.date_spine(FX.userlog(spark, sf_dir)))


def q_pre_post_totals(spark, sf_dir):
    return present(analysis(spark, sf_dir).pre_post_totals())


# ------------------------------------------------------------------ written-only metrics

def q_overall_ttest(spark, sf_dir):
    d = analysis(spark, sf_dir).overall_ttest()
    return present(d.select(
        "experiment_id", "n_control", "n_treatment", "active_control", "active_treatment",
        cents_mean("sum_control", "n_control").alias("mean_control"),
        cents_mean("sum_treatment", "n_treatment").alias("mean_treatment"),
        F.sqrt("var_control").alias("sd_control"), F.sqrt("var_treatment").alias("sd_treatment"),
        "t_stat", "df", "p_value"))


def q_duration_ttest(spark, sf_dir):
    d = analysis(spark, sf_dir).duration_ttest()
    return present(d.select("experiment_id", "n_control", "n_treatment", "active_control", "active_treatment",
                            "mean_control", "mean_treatment", "t_stat", "df", "p_value"))


def q_active_rate_ztest(spark, sf_dir):
    return present(analysis(spark, sf_dir).active_rate_ztest())


def q_active_rate(spark, sf_dir):
    return present(analysis(spark, sf_dir).active_rate())


def q_average_duration(spark, sf_dir):
    return present(analysis(spark, sf_dir).average_duration())


def q_user_day_filled(spark, sf_dir):
    return present(analysis(spark, sf_dir).user_day_filled())


def q_all_test_results(spark, sf_dir):
    """Long layout of the per-experiment tests. The overall t-test and the
    active-rate z-test share one per-user aggregation (one log scan)."""
    from abx.operators.stats import with_ztest
    a = analysis(spark, sf_dir)
    r = a.ratio_test().select("experiment_id", F.lit("sample_ratio_chi2").alias("test"),
                              F.col("test_stat").alias("statistic"), "p_value")
    both = with_ztest(a.overall_ttest())
    tests = F.array(
        F.struct(F.lit("overall_mean_t").alias("test"), F.col("t_stat").alias("statistic"), F.col("p_value")),
        F.struct(F.lit("active_rate_z").alias("test"), F.col("z_stat").alias("statistic"),
                 F.col("z_p_value").alias("p_value")))
    o = both.select("experiment_id", F.explode(tests).alias("r")).select("experiment_id", "r.*")
    return present(r.unionByName(o))


# ------------------------------------------------------------------ design checks

def q_assign_quota(spark, sf_dir):
    return analysis(spark, sf_dir, assignment="quota").assignments


def q_assignment_conflicts(spark, sf_dir):
    return present(AU.assignment_conflicts(analysis(spark, sf_dir).assignments))


def q_experiment_overlap(spark, sf_dir):
    return present(analysis(spark, sf_dir).experiment_overlap())


def q_aa_test(spark, sf_dir):
    from abx.operators.stats import aa_summary
    return present(aa_summary(analysis(spark, sf_dir).aa_test(salts=100)))


def q_sample_size(spark, sf_dir):
    s = analysis(spark, sf_dir).sample_size(mde_rel=0.1)
    return present(s.select("experiment_id", "n_users", to_cents(F.col("pre_sum")).alias("pre_sum"),
                            cents_mean("pre_sum", "n_users").alias("pre_mean"), F.sqrt("pre_var").alias("pre_sd"),
                            "required_per_group"))


def q_sample_progress(spark, sf_dir):
    return present(analysis(spark, sf_dir).sample_progress(mde_rel=0.1))


# ------------------------------------------------------------------ scans and scalars

def q_host_users(spark, sf_dir):
    return FX.users(spark, sf_dir).filter("is_host").select("user_id", "email", "segment")


def q_scan_listings(spark, sf_dir):
    return present(FX.listings(spark, sf_dir))


def q_userlog(spark, sf_dir):
    log = FX.userlog(spark, sf_dir)
    return present(log.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def q_distinct_listings(spark, sf_dir):
    return FX.userlog(spark, sf_dir).select("listing_id").distinct()


def q_activity_summary(spark, sf_dir):
    return present(AU.column_summary(FX.userlog(spark, sf_dir), ["user_id", "purchase_amount"],
                                     cents=["purchase_amount"]))


def q_user_key_unique(spark, sf_dir):
    u = FX.users(spark, sf_dir).select("user_id", "email")
    return AU.dense_key(u, ["email", "user_id"], "user_key")


def q_one_hot(spark, sf_dir):
    return present(FE.one_hot(FX.listings(spark, sf_dir), LISTING_LEVELS))


def q_one_hot_long(spark, sf_dir):
    return FE.one_hot_long(FX.listings(spark, sf_dir), "listing_id", list(LISTING_LEVELS))


def q_listing_features(spark, sf_dir):
    """The listing feature path: drop columns if present, one-hot, key check, keyed write."""
    from abx.operators.audits import assert_unique_key
    from abx.session import scratch_path
    kept = FE.drop_if_present(FX.listings(spark, sf_dir), ["accommodates", "host_id", "review_scores_rating"])
    feats = FE.one_hot(kept, LISTING_LEVELS)
    assert_unique_key(feats, "listing_id")
    path = scratch_path(spark, "listing-features")
    FE.write_feature_table(feats, "listing_id", path)
    return present(spark.read.schema(feats.schema).parquet(path))


def q_feature_key_check(spark, sf_dir):
    feats = FE.one_hot(FX.listings(spark, sf_dir), LISTING_LEVELS)
    return AU.key_check(feats, "listing_id")


# ------------------------------------------------------------------ models

def _penalty(alpha: float, l1_ratio: float) -> MD.ElasticNet:
    return MD.ElasticNet(alpha, l1_ratio, max_iter=20_000, tol=1e-13)


PRICE_PENALTIES = {"mild": _penalty(0.05, 0.05), "strong": _penalty(0.5, 0.5)}
GROUP_PENALTIES = {"control": _penalty(0.05, 0.05), "treatment": _penalty(0.5, 0.5)}


def round4(x):
    return F.rint(x * F.lit(1e4)) / F.lit(1e4)


def price_rows(spark, sf_dir):
    """Listings with their price as label and their other columns as sparse features."""
    return FX.listings(spark, sf_dir).select(
        "listing_id", F.col("price").alias("label"), G.sparse_features(["accommodates"], list(LISTING_LEVELS)).alias("features"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the checkpoint folder: what follows reads rows, not the plan behind them."""
    from abx.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_price_model(spark, sf_dir):
    """Elastic nets of the price on listing features, two penalties from one pass."""
    return present(G.fit(price_rows(spark, sf_dir), PRICE_PENALTIES))


def q_price_model_optimality(spark, sf_dir):
    """The optimality condition of each coefficient, judged on the listings."""
    rows = price_rows(spark, sf_dir)
    models = kept(G.fit(rows, PRICE_PENALTIES), "price-model")
    found = G.optimality(rows, models, PRICE_PENALTIES, ["listing_id"])
    return present(found.select("model", "feature", "rows", "violation"))


def q_price_model_metrics(spark, sf_dir):
    rows = price_rows(spark, sf_dir)
    models = kept(G.fit(rows, PRICE_PENALTIES), "price-model")
    each = G.dealt(rows, ["listing_id"]).select("*", F.explode(F.array(*map(F.lit, PRICE_PENALTIES))).alias("model"))
    return present(G.metrics_by_model(G.score(each, models, ["listing_id"], "model", carry=["label"])))


def group_models(spark, sf_dir):
    """User-day rows, and a model for each group: two penalties over the sums of one pass."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    rows = kept(G.user_day_rows(events, FX.users(spark, sf_dir), MD.EVENT_TYPES), "user-day-rows")
    return rows, kept(G.fit(rows, GROUP_PENALTIES), "group-models")


def q_score_by_group(spark, sf_dir):
    """exp_all users' days scored by the model of their group (two parameter sets)."""
    rows, models = group_models(spark, sf_dir)
    exps = [e for e in FIXTURE_EXPERIMENTS if e.experiment_id == FLAGSHIP_EXPERIMENT]
    a = A.assign(FX.users(spark, sf_dir), exps).select("user_id", "group")
    scored = G.score(rows.join(a, "user_id"), models, ["user_id", "date"], "group", carry=["label"])
    return present(scored.withColumn("prediction", round4(F.col("prediction"))))


def q_score_metrics(spark, sf_dir):
    """Fit quality of each group's model on its own users' days."""
    rows, models = group_models(spark, sf_dir)
    exps = [e for e in FIXTURE_EXPERIMENTS if e.experiment_id == FLAGSHIP_EXPERIMENT]
    a = A.assign(FX.users(spark, sf_dir), exps).select("user_id", "group")
    scored = G.score(rows.join(a, "user_id"), models, ["user_id", "date"], "group", carry=["label"])
    return present(G.metrics_by_model(scored, "group"))


def q_score_rejects(spark, sf_dir):
    """User-days that exp1 cannot score: users outside its population have no group, so no model."""
    rows, models = group_models(spark, sf_dir)
    exps = [e for e in FIXTURE_EXPERIMENTS if e.experiment_id == "exp1"]
    a = A.assign(FX.users(spark, sf_dir), exps).select("user_id", "group")
    return present(G.rejects(rows.join(a, "user_id", "left"), models, "group").select("user_id", "date", "group", "label"))


# ------------------------------------------------------------------ streaming

STREAM_WATERMARK = "1 hour"


def q_stream_user_day_metrics(spark, sf_dir):
    """User-day metrics from the log read as a stream; days closed by the watermark."""
    from abx.streaming import stream as ST
    log = ST.stream_userlog(spark, sf_dir)
    return present(ST.run_available(ST.stream_user_day_metrics(log, watermark=STREAM_WATERMARK), "udm"))



def q_stream_distinct_listings(spark, sf_dir):
    """Distinct listings of each user over all closed days, from sketches made on the stream day by day."""
    from abx.streaming import stream as ST
    log = ST.stream_userlog(spark, sf_dir)
    days = ST.run_available(ST.stream_listing_sketches(log, watermark=STREAM_WATERMARK), "sketches")
    return ST.merge_sketches(days, ["user_id"]).select("user_id", "total_events", "distinct_listings")


def q_stream_assign(spark, sf_dir):
    """Groups of active users as assigned on the stream (must equal batch), one row each in the sink."""
    from abx.streaming import stream as ST
    log = ST.stream_userlog(spark, sf_dir)
    return ST.run_available(ST.stream_exposures(log, FX.users(spark, sf_dir), FIXTURE_EXPERIMENTS), "assign")


# ------------------------------------------------------------------ increments

#: A moment inside a day, at which the log is cut into two stretches.
CUT = "2024-01-16 13:20:00"


def _stretches(spark, sf_dir):
    log = FX.userlog(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return log.where(F.col("event_time") < cut), log.where(F.col("event_time") >= cut)


def q_daily_log_counts(spark, sf_dir):
    """Events and users per treatment day of exp1, from the log stored by day and the stored experiment table."""
    from abx.schemas import USERLOG
    from abx.session import scratch_path
    from abx.sources import daily
    path = scratch_path(spark, "daily-log")
    daily.write_daily(FX.userlog(spark, sf_dir), path)
    experiments = kept(analysis(spark, sf_dir).experiments_df, "experiments").where("experiment_id = 'exp1'")
    log = daily.read_daily(spark, path, USERLOG, experiments, pre=False)
    return present(log.groupBy(F.to_date("event_time").alias("date")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")))


def q_duration_increments(spark, sf_dir):
    """Sessions and engaged time per user and day, from summaries of two stretches of the log, each
    stored by itself; sessions that span the cut are whole."""
    from abx.operators import sessions as SE
    early, late = (kept(SE.day_summaries(part), "session-days") for part in _stretches(spark, sf_dir))
    return present(SE.finish_days(early.unionByName(late)))


def q_activity_increments(spark, sf_dir):
    """Active days per user, from the bits of two stretches of the log, merged."""
    from abx.operators import rates as R
    first, last = analysis(spark, sf_dir).span
    early, late = (kept(R.activity_bits(part.select("user_id", F.to_date("event_time").alias("date")), first, last), "bits")
                   for part in _stretches(spark, sf_dir))
    bits = R.merge_bits(early.unionByName(late), R.words(first, last))
    return bits.select("user_id", F.aggregate("days", F.lit(0), lambda n, w: n + F.bit_count(w)).alias("active_days"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "user_day_metrics": q_user_day_metrics,
    "assign_hash": q_assign_hash,
    "assign_multi": q_assign_multi,
    "exposed_user_days": q_exposed_user_days,
    "group_day_moments": q_group_day_moments,
    "daily_ttest": q_daily_ttest,
    "group_counts": q_group_counts,
    "ratio_test": q_ratio_test,
    "group_day_totals": q_group_day_totals,
    "cumulative_by_group": q_cumulative_by_group,
    "experiment_day": q_experiment_day,
    "experiment_results": q_experiment_results,
    "date_spine": q_date_spine,
    "pre_post_totals": q_pre_post_totals,
    "overall_ttest": q_overall_ttest,
    "active_rate_ztest": q_active_rate_ztest,
    "active_rate": q_active_rate,
    "average_duration": q_average_duration,
    "user_day_filled": q_user_day_filled,
    "all_test_results": q_all_test_results,
    "assign_quota": q_assign_quota,
    "assignment_conflicts": q_assignment_conflicts,
    "experiment_overlap": q_experiment_overlap,
    "aa_test": q_aa_test,
    "sample_size": q_sample_size,
    "sample_progress": q_sample_progress,
    "host_users": q_host_users,
    "scan_listings": q_scan_listings,
    "userlog": q_userlog,
    "distinct_listings": q_distinct_listings,
    "activity_summary": q_activity_summary,
    "user_key_unique": q_user_key_unique,
    "one_hot": q_one_hot,
    "one_hot_long": q_one_hot_long,
    "listing_features": q_listing_features,
    "feature_key_check": q_feature_key_check,
    "duration_ttest": q_duration_ttest,
    "price_model": q_price_model,
    "price_model_metrics": q_price_model_metrics,
    "price_model_optimality": q_price_model_optimality,
    "score_by_group": q_score_by_group,
    "score_metrics": q_score_metrics,
    "score_rejects": q_score_rejects,
    "stream_user_day_metrics": q_stream_user_day_metrics,
    "stream_distinct_listings": q_stream_distinct_listings,
    "stream_assign": q_stream_assign,
    "daily_log_counts": q_daily_log_counts,
    "duration_increments": q_duration_increments,
    "activity_increments": q_activity_increments,
}
