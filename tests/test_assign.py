import datetime as dt
import math

from pyspark.sql import functions as F

from abx.config import FIXTURE_EXPERIMENTS, Experiment
from abx.operators import assign as A
from abx.operators.audits import assignment_conflicts
from abx.operators.stats import ratio_test
from abx.sources import fixtures as FX

from conftest import SF01


def _users(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("user_id"), ((F.col("id") % 5) == 0).alias("is_host"))


def test_same_group_any_partitioning(spark):
    u = _users(spark, 5000)
    exps = [Experiment("e", 0.3)]
    a = {(r.user_id, r.group) for r in A.assign(u, exps).collect()}
    b = {(r.user_id, r.group) for r in A.assign(u.repartition(7).orderBy(F.rand(3)), exps).collect()}
    assert a == b


def test_share_within_four_sigma(spark):
    n, ratio = 20000, 0.2
    a = A.assign(_users(spark, n), [Experiment("share", ratio)])
    t = a.filter(F.col("group") == "treatment").count()
    assert abs(t - n * ratio) < 4 * math.sqrt(n * ratio * (1 - ratio))


def test_population_predicate_and_multi(spark):
    u = _users(spark, 1000)
    exps = [Experiment("hosts", 0.5, "is_host"), Experiment("all", 0.5)]
    a = A.assign(u, exps)
    counts = {r.experiment_id: r["count"] for r in a.groupBy("experiment_id").count().collect()}
    assert counts == {"hosts": 200, "all": 1000}


def test_quota_exact_029(spark):
    # int(100 * 0.29) == 28: truncation after the float multiply.
    a = A.assign_quota(_users(spark, 100), [Experiment("q", 0.29)])
    assert a.filter(F.col("group") == "treatment").count() == 28
    assert a.count() == 100


def test_quota_exact_many_buckets(spark):
    exps = [Experiment("q1", 0.2), Experiment("q2", 0.5), Experiment("q3", 0.0), Experiment("q4", 1.0)]
    a = A.assign_quota(_users(spark, 5003), exps, bucket_bits=6)
    got = {r.experiment_id: r.n for r in a.filter(F.col("group") == "treatment")
           .groupBy("experiment_id").agg(F.count("*").alias("n")).collect()}
    assert got.get("q1") == int(5003 * 0.2) and got.get("q2") == int(5003 * 0.5)
    assert got.get("q3", 0) == 0 and got.get("q4") == 5003
    # The treated users are those first in (hash, user_id), as a global ranking would pick.
    rows = (a.filter(F.col("experiment_id") == "q1")
            .withColumn("h", A.hash_unit(F.col("experiment_id"), F.col("user_id"))).collect())
    ranked = sorted(rows, key=lambda r: (r.h, r.user_id))
    assert all(r.group == "treatment" for r in ranked[:1000]) and all(r.group == "control" for r in ranked[1000:])


def test_ratio_split_passes_at_02(spark):
    """The 0.2 split keeps everybody and passes the sample-ratio test."""
    u = FX.users(spark, SF01)
    a = A.assign(u, [Experiment("exp2", 0.2)])
    r = ratio_test(a).first()
    assert r.control_observed + r.treatment_observed == 1500
    assert r.p_value > 0.05


def test_conflict_audit(spark):
    rows = [(1, "control", "e", 0.5), (1, "treatment", "e", 0.5), (2, "control", "e", 0.5),
            (2, "control", "e", 0.5), (3, "treatment", "e", 0.5)]
    a = spark.createDataFrame(rows, "user_id long, group string, experiment_id string, experiment_ratio double")
    r = assignment_conflicts(a).first()
    assert (r.n_rows, r.n_users, r.users_in_both_groups, r.duplicate_users) == (5, 3, 1, 2)


def test_fixture_counts_match_fixtures_md(spark):
    a = A.assign(FX.users(spark, SF01), FIXTURE_EXPERIMENTS)
    got = {(r.experiment_id, r.group): r["count"] for r in a.groupBy("experiment_id", "group").count().collect()}
    assert got[("exp1", "control")] == 150 and got[("exp1", "treatment")] == 150
    assert got[("exp2", "control")] == 1199 and got[("exp2", "treatment")] == 301
    assert got[("exp_all", "control")] == 750 and got[("exp_all", "treatment")] == 750
