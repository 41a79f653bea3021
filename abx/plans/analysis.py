"""One experiment analysis over a log, a user table and experiment parameters.

Frames are built lazily and shared; every result reads the log once through
``user_days`` (or ``sessions`` for duration). ``materialize`` cuts lineage by
writing the exposed user-days under the session's checkpoint folder, so a
job writing many results survives lost executors without re-reading the log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT_ACTIVITIES, Experiment
from abx.operators import assign as A
from abx.operators import metrics as M
from abx.operators import rates as R
from abx.operators import stats as S
from abx.operators import windows as W
from abx.operators.sessions import day_summaries, finish_days
from abx.session import scratch_path
from abx.sources import sinks
from abx.sources.tables import experiments_frame


# The labels of the long result layout.
STAT_LABEL, P_LABEL = "Stats", "P_value"


class ExperimentAnalysis:
    def __init__(self, spark: SparkSession, log: DataFrame, users: DataFrame,
                 experiments: Sequence[Experiment], activities: Sequence[str] = DEFAULT_ACTIVITIES,
                 assignment: str = "hash"):
        if assignment not in ("hash", "quota"):
            raise ValueError("assignment must be 'hash' or 'quota'")
        self.spark = spark
        # One period for all results: from the first pre-period day to the last treatment
        # day. The outer bounds are literals, so they prune the scan of the log; each
        # experiment's own bounds apply after the join with its users.
        lo = min((e.start_date - dt.timedelta(days=e.pre_days) for e in experiments), default=None)
        hi = max((e.end_date + dt.timedelta(days=1) for e in experiments), default=None)
        if lo is not None:
            kind = log.schema["event_time"].dataType
            log = log.where((F.col("event_time") >= F.lit(lo).cast(kind)) & (F.col("event_time") < F.lit(hi).cast(kind)))
        self.log = log
        self.users = users
        self.experiments = tuple(experiments)
        self.activities = tuple(activities)
        self.assignment = assignment
        self._exposed = None

    # ------------------------------------------------------------ inputs
    @cached_property
    def experiments_df(self) -> DataFrame:
        return experiments_frame(self.spark, self.experiments)

    @cached_property
    def assignments(self) -> DataFrame:
        if self.assignment == "quota":
            return A.assign_quota(self.users, self.experiments)
        return A.assign(self.users, self.experiments)

    @cached_property
    def user_days(self) -> DataFrame:
        return M.user_day_metrics(self.log, self.activities)

    @property
    def exposed(self) -> DataFrame:
        if self._exposed is None:
            self._exposed = self.in_period(M.exposed_user_days(self.user_days, self.assignments))
        return self._exposed

    def in_period(self, rows: DataFrame) -> DataFrame:
        """Rows (experiment_id, date) that lie in their experiment's pre-period or treatment period."""
        e = F.broadcast(self.experiments_df.select(
            "experiment_id", F.date_sub("start_date", F.col("pre_days")).alias("_from"), F.col("end_date").alias("_to")))
        return (rows.join(e, "experiment_id").where(F.col("date").between(F.col("_from"), F.col("_to")))
                .select(*rows.columns))

    @cached_property
    def calendar(self) -> DataFrame:
        return W.group_calendar(self.experiments_df)

    def materialize(self) -> "ExperimentAnalysis":
        """Write exposed user-days to the checkpoint folder and read them back."""
        path = scratch_path(self.spark, "exposed")
        schema = self.exposed.schema
        # Rebalanced by experiment: large experiments get many tasks, and no task writes a
        # file for each experiment.
        (self.exposed.hint("rebalance", "experiment_id").write.mode("overwrite")
         .partitionBy("experiment_id").parquet(path))
        # With its schema: the folder names of experiment ids would be read as numbers or dates.
        self._exposed = self.spark.read.schema(schema).parquet(path).select(*schema.names)
        return self

    def store(self, database: str, buckets: int) -> "ExperimentAnalysis":
        """Write user-days and assignments as tables bucketed by user and go on from them: the
        exposure join, the zero-filled table and every fold by user then move no row of either."""
        for name, frame in (("user_days", self.user_days), ("assignments_by_user", self.assignments)):
            sinks.write_bucketed(frame, f"{database}.{name}", "user_id", buckets)
        self.user_days = self.spark.table(f"{database}.user_days")
        self.assignments = self.spark.table(f"{database}.assignments_by_user")
        self._exposed = None
        return self

    # ------------------------------------------------------------ results
    def group_counts(self) -> DataFrame:
        return M.group_counts(self.assignments)

    def ratio_test(self) -> DataFrame:
        return S.ratio_test(self.assignments)

    def group_day_totals(self) -> DataFrame:
        return W.complete_days(M.group_day_totals(self.exposed), self.calendar, ["total_amount", "user_days"])

    def group_day_moments(self, nonzero: bool = True) -> DataFrame:
        return M.group_day_moments(self.exposed, nonzero=nonzero)

    def daily_ttest(self) -> DataFrame:
        return S.daily_ttest(self.group_day_moments())

    def cumulative(self) -> DataFrame:
        return W.cumulative_by_group(self.group_day_totals())

    def group_day_stats(self, metric: str = "total_purchase_amount") -> DataFrame:
        """One aggregation of exposed user-days per (date, group, experiment):
        totals over all user-days and the moments of the non-zero ones."""
        m = F.col(metric)
        nz = m != 0
        rows = self.exposed.groupBy("date", "group", "experiment_id").agg(
            F.sum(m).alias("total_amount"), F.count(F.lit(1)).alias("user_days"),
            F.count_if(nz).alias("_n"), F.sum(F.when(nz, m)).alias("_s"), F.var_samp(F.when(nz, m)).alias("_v"))
        return W.complete_days(rows, self.calendar, ["total_amount", "user_days", "_n"])

    def experiment_results(self) -> DataFrame:
        """Long layout: one row per (date, group, experiment) with totals,
        running sum, day index; the control row carries the t statistic
        ('Stats'), the treatment row the p-value ('P_value').

        The log is read and aggregated once; everything after the group-day
        aggregation runs on experiments x days x 2 rows.
        """
        gd = self.group_day_stats()
        # Both sides' moments onto each group-day row by a window over
        # (experiment, date): one linear plan, so the log is scanned once.
        day = Window.partitionBy("experiment_id", "date")
        x = gd
        for tag in ("control", "treatment"):
            on = F.col("group") == tag
            x = x.withColumn(f"n_{tag}", F.coalesce(F.max(F.when(on, F.col("_n"))).over(day), F.lit(0)))
            x = x.withColumn(f"sum_{tag}", F.max(F.when(on, F.col("_s"))).over(day))
            x = x.withColumn(f"var_{tag}", F.max(F.when(on, F.col("_v"))).over(day))
            x = x.withColumn(f"mean_{tag}", F.try_divide(F.col(f"sum_{tag}"), F.col(f"n_{tag}")))
        x = S.daily_ttest(x)
        x = W.experiment_day(W.cumulative_by_group(x), self.experiments_df)
        is_c, is_t = F.col("group") == A.CONTROL, F.col("group") == A.TREATMENT
        x = x.withColumn("ab_description", F.when(is_c, F.lit(STAT_LABEL)).when(is_t, F.lit(P_LABEL)))
        x = x.withColumn("ab_value", F.when(is_c, F.col("t_stat")).when(is_t, F.col("p_value")))
        return x.select("date", "group", "experiment_id", "total_amount", "daily_cumulative_sum",
                        "experiment_duration", "experiment_day", "ab_description", "ab_value")

    def overall_ttest(self) -> DataFrame:
        return S.overall_ttest(self.exposed, self.assignments, self.experiments_df)

    def active_rate_ztest(self) -> DataFrame:
        return S.active_rate_ztest(self.exposed, self.assignments, self.experiments_df)

    @cached_property
    def span(self) -> tuple[dt.date, dt.date]:
        """First and last day of all experiments' periods."""
        return (min(e.start_date - dt.timedelta(days=e.pre_days) for e in self.experiments), max(e.end_date for e in self.experiments))

    @cached_property
    def activity(self) -> DataFrame:
        """Active days of each user, one row a user: the log is folded to it before anything is joined."""
        return R.activity_bits(self.log.select("user_id", F.to_date("event_time").alias("date")), *self.span)

    def active_rate(self, periods=R.PERIODS) -> DataFrame:
        return R.active_rate(self.activity, self.assignments, R.period_bits(self.spark, self.experiments, *self.span, periods))

    def average_duration(self, periods=R.PERIODS, gap_seconds: int = 1800) -> DataFrame:
        return R.average_duration(self.duration_days(gap_seconds), self.assignments,
                                  R.period_bits(self.spark, self.experiments, *self.span, periods))

    def duration_days(self, gap_seconds: int = 1800) -> DataFrame:
        """Sessions and engaged microseconds per (experiment, group, user, date of session start)."""
        days = finish_days(day_summaries(self.log, gap_seconds), gap_seconds)
        return self.in_period(days.join(self.assignments.select("user_id", "experiment_id", "group"), "user_id"))

    def duration_ttest(self, gap_seconds: int = 1800) -> DataFrame:
        """The overall t-test on engaged seconds per assigned user in the treatment period."""
        days = self.duration_days(gap_seconds).withColumn("seconds", F.col("duration_us") / F.lit(1e6))
        return S.overall_ttest(days, self.assignments, self.experiments_df, metric="seconds")

    def user_day_filled(self) -> DataFrame:
        return M.user_day_filled(self.user_days, self.assignments, self.experiments_df)

    def aa_test(self, salts: int = 100) -> DataFrame:
        return S.aa_test(self.user_days, self.assignments, self.experiments_df, salts)

    def sample_size(self, mde_rel: float = 0.1, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
        pre = S.user_totals(self.exposed, self.experiments_df, phase="pre")
        return S.sample_size(pre, self.assignments, mde_rel, alpha, power)

    def sample_progress(self, mde_rel: float = 0.1, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
        return S.sample_progress(self.exposed, self.experiments_df, self.assignments, mde_rel, alpha, power)

    def experiment_overlap(self) -> DataFrame:
        return S.experiment_overlap(self.assignments, [e.experiment_id for e in self.experiments])

    def pre_post_totals(self) -> DataFrame:
        e = F.broadcast(self.experiments_df.select("experiment_id", "start_date"))
        x = self.exposed.join(e, "experiment_id").withColumn(
            "phase", F.when(F.col("date") < F.col("start_date"), F.lit("pre")).otherwise(F.lit("post")))
        return x.groupBy("experiment_id", "group", "phase").agg(
            F.sum("total_purchase_amount").alias("total_amount"),
            F.count(F.lit(1)).alias("user_days"),
            F.count_distinct("user_id").alias("users"))
