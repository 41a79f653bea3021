import datetime as dt

from pyspark.sql import functions as F

from abx.config import FIXTURE_EXPERIMENTS, Experiment
from abx.plans import job
from abx.sources import fixtures as FX

from conftest import SF001


def test_rerun_of_one_experiment_leaves_others(spark):
    log, users = FX.userlog(spark, SF001), FX.users(spark, SF001)
    job.run(spark, log, users, FIXTURE_EXPERIMENTS, "abx_job", names=("ratio_test", "experiment_results"))
    before = {r.experiment_id: r["count"] for r in spark.table("abx_job.experiment_results")
              .groupBy("experiment_id").count().collect()}
    assert set(before) == {"exp1", "exp2", "exp_all"}
    # Re-run exp2 alone with a later start: only its partition changes.
    exp2b = Experiment("exp2", 0.2, "true", dt.date(2024, 1, 5), dt.date(2024, 1, 30), 4)
    job.run(spark, log, users, [exp2b], "abx_job", names=("ratio_test", "experiment_results"), materialize=False)
    t = spark.table("abx_job.experiment_results")
    after = {r.experiment_id: r["count"] for r in t.groupBy("experiment_id").count().collect()}
    assert after == before
    d = t.filter((F.col("experiment_id") == "exp2") & (F.col("date") == dt.date(2024, 1, 5))).first()
    assert d.experiment_day == 1
    other = t.filter((F.col("experiment_id") == "exp_all") & (F.col("date") == dt.date(2024, 1, 11))).first()
    assert other.experiment_day == 1
    assert spark.table("abx_job.ratio_test").count() == 3


def test_job_reads_tables_and_paths(spark, scratch):
    from abx.plans.job import load
    from abx.schemas import USERLOG
    df = spark.createDataFrame([(1, "2", None, "view", None)], USERLOG)
    df.write.parquet(f"{scratch}/log")
    df.write.mode("overwrite").saveAsTable("job_input_log")
    assert load(spark, f"{scratch}/log", USERLOG).schema == USERLOG
    assert load(spark, "job_input_log").count() == 1
