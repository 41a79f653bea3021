"""Batch job: all experiment results written as tables, one partition per experiment.

    python -m abx.plans.job --log PATH --users PATH --experiments FILE.json --database NAME

The exposed user-days are written once under the checkpoint folder (lineage
cut, so lost executors do not re-read the log), then every result reads that
compact table. Tables are partitioned by experiment_id: running some experiments
again replaces their partitions wholly, emptied where nothing came out, and no others.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from abx.config import Experiment
from abx.plans.analysis import ExperimentAnalysis
from abx.schemas import USERLOG
from abx.sources import catalog, sinks
from abx.sources.tables import read_parquet, read_table

RESULTS = ("assignments", "ratio_test", "experiment_results", "daily_ttest", "overall_ttest",
           "active_rate_ztest", "active_rate", "average_duration", "sample_progress")


def results(a: ExperimentAnalysis) -> dict:
    return {
        "assignments": a.assignments,
        "ratio_test": a.ratio_test(),
        "experiment_results": a.experiment_results(),
        "daily_ttest": a.daily_ttest(),
        "overall_ttest": a.overall_ttest(),
        "active_rate_ztest": a.active_rate_ztest(),
        "active_rate": a.active_rate(),
        "average_duration": a.average_duration(),
        "sample_progress": a.sample_progress(),
    }


def run(spark: SparkSession, log, users, experiments: Sequence[Experiment], database: str,
        names: Sequence[str] = RESULTS, materialize: bool = True, buckets: int | None = None) -> list[str]:
    """Write the results named. With ``buckets``, user-days and assignments are stored as tables bucketed by user."""
    catalog.create_database(spark, database)
    a = ExperimentAnalysis(spark, log, users, experiments)
    if buckets:
        a.store(database, buckets)
    if materialize:
        a.materialize()
    out = results(a)
    written = []
    for name in names:
        sinks.replace_partitions(out[name], f"{database}.{name}", ["experiment_id"], [e.experiment_id for e in experiments])
        written.append(f"{database}.{name}")
    return written


def load_experiments(path: str) -> list[Experiment]:
    with open(path) as f:
        rows = json.load(f)
    return [Experiment(r["experiment_id"], float(r["ratio"]), r.get("population", "true"),
                       dt.date.fromisoformat(r["start_date"]), dt.date.fromisoformat(r["end_date"]),
                       int(r.get("pre_days", 0))) for r in rows]


def load(spark: SparkSession, name: str, schema=None):
    """A job input: a managed table (``db.table``) or a parquet path, read with its declared schema."""
    if "/" not in name and spark.catalog.tableExists(name):
        return read_table(spark, name)
    return read_parquet(spark, name, schema)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--log", required=True, help="table or parquet path: user_id, listing_id, event_time, activity, purchase_amount")
    p.add_argument("--users", required=True, help="table or parquet path: user_id plus columns used by population predicates")
    p.add_argument("--experiments", required=True, help="JSON list of experiment parameters")
    p.add_argument("--database", required=True)
    p.add_argument("--buckets", type=int, help="store user-days and assignments bucketed by user, in so many buckets")
    args = p.parse_args(argv)
    from abx.session import build_session
    spark = build_session()
    run(spark, load(spark, args.log, USERLOG), load(spark, args.users),
        load_experiments(args.experiments), args.database, buckets=args.buckets)


if __name__ == "__main__":
    main()
