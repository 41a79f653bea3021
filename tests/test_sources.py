import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.schemas import USERS
from abx.sources import catalog, sinks
from abx.sources.tables import read_csv, read_parquet, rows_to_frame


def test_csv_quoted_newline(spark, scratch):
    p = os.path.join(scratch, "users.csv")
    with open(p, "w") as f:
        f.write('user_id,is_host,firstname,lastname,email,country,creation_date\n')
        f.write('1,true,"Ann\nMarie",Lee,a@x.org,UK,2020-01-01\n')
        f.write('2,false,Bo,"Smith, Jr.",b@x.org,FR,2021-05-06\n')
    df = read_csv(spark, p, USERS)
    rows = sorted(df.collect(), key=lambda r: r.user_id)
    assert len(rows) == 2 and rows[0].firstname == "Ann\nMarie" and rows[1].lastname == "Smith, Jr."
    assert rows[0].is_host is True


def test_parquet_scan_prunes_columns(spark):
    from conftest import SF01
    df = read_parquet(spark, f"{SF01}/events.parquet", columns=["user_id", "ts"]).filter(F.col("user_id") < 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan or "ReadSchema: struct<user_id:bigint,ts:timestamp_ntz>" in plan
    assert "PushedFilters" in plan and "LessThan(user_id,10)" in plan


def test_rows_to_frame_declared_types(spark):
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    df = rows_to_frame(spark, [(1, 2.0)], s)
    assert df.schema == s


def test_tables_overwrite_append_partition_replace(spark):
    catalog.create_database(spark, "abx_t")
    assert catalog.list_tables(spark, "abx_t") == []
    a = spark.createDataFrame([("e1", 1, 1.0), ("e2", 2, 2.0)], "experiment_id string, k int, v double")
    sinks.overwrite_table(a, "abx_t.res", partition_by=["experiment_id"])
    # re-run of e1 replaces only its partition
    sinks.replace_partitions(spark.createDataFrame([("e1", 9, 9.0)], "experiment_id string, k int, v double"),
                             "abx_t.res")
    got = sorted((r.experiment_id, r.k) for r in spark.table("abx_t.res").collect())
    assert got == [("e1", 9), ("e2", 2)]
    sinks.append_table(spark.createDataFrame([(3, 3.0, "e3")], "k int, v double, experiment_id string"), "abx_t.res")
    assert spark.table("abx_t.res").count() == 3
    with pytest.raises(ValueError):
        sinks.append_table(spark.createDataFrame([(1,)], "k int"), "abx_t.res")
    # overwrite takes a new schema
    sinks.overwrite_table(spark.createDataFrame([(1, "x")], "k int, label string"), "abx_t.res")
    assert spark.table("abx_t.res").columns == ["k", "label"]
    assert catalog.list_tables(spark, "abx_t") == ["res"]
    catalog.create_database(spark, "abx_t", drop_first=True)
    assert catalog.list_tables(spark, "abx_t") == []


def test_keyed_write_rejects_duplicates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "listing_id string, x double")
    with pytest.raises(ValueError):
        sinks.write_keyed(df, "abx_keyed", "listing_id")


# --- replacement by manifest -------------------------------------------------

ROWS = "experiment_id string, k int"


def _of(spark, name):
    return sorted((r.experiment_id, r.k) for r in spark.table(name).collect())


def test_manifest_empties_partitions_without_rows(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        catalog.create_database(spark, "abx_m")
        name = "abx_m.res"
        ids = ["1", "01", "it's", "gone"]
        assert sinks.replace_partitions(spark.createDataFrame([(i, n) for n, i in enumerate(ids)], ROWS), name, manifest=ids) == []
        assert _of(spark, name) == sorted((i, n) for n, i in enumerate(ids))
        again = spark.createDataFrame([("1", 10), ("1", 11)], ROWS)
        assert sinks.replace_partitions(again, name, manifest=["1", "it's", "never"]) == ["it's", "never"]
        assert _of(spark, name) == [("01", 1), ("1", 10), ("1", 11), ("gone", 3)]
        # Nothing at all came out for an experiment.
        assert sinks.replace_partitions(again.where("k > 99"), name, manifest=["gone"]) == ["gone"]
        assert _of(spark, name) == [("01", 1), ("1", 10), ("1", 11)]
        # A row of an experiment that was not run changes nothing.
        with pytest.raises(Exception, match="not in the manifest"):
            sinks.replace_partitions(spark.createDataFrame([("1", 5), ("2", 5)], ROWS), name, manifest=["1"])
        with pytest.raises(Exception, match="not in the manifest"):
            sinks.replace_partitions(spark.createDataFrame([(None, 5)], ROWS), name, manifest=["1"])
        assert _of(spark, name) == [("01", 1), ("1", 10), ("1", 11)]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)
        catalog.create_database(spark, "abx_m", drop_first=True)


def test_repeated_micro_batch_changes_nothing(spark, scratch):
    catalog.create_database(spark, "abx_b")
    src = os.path.join(scratch, "in")
    schema = "user_id long, v int"
    for i in range(3):
        spark.createDataFrame([(i, j) for j in range(4)], schema).coalesce(1).write.mode("append").parquet(src)
    write = sinks.batch_writer("abx_b.stream")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    rows = sorted(map(tuple, spark.table("abx_b.stream").collect()))
    assert len(rows) == 12 and {r[2] for r in rows} == {0, 1, 2}
    # A batch that is run again, as after a failure between its write and its commit.
    one = spark.table("abx_b.stream").where("batch_id = 1").drop("batch_id").collect()
    write(spark.createDataFrame(one, schema), 1)
    assert sorted(map(tuple, spark.table("abx_b.stream").collect())) == rows
    catalog.create_database(spark, "abx_b", drop_first=True)


# --- the log by day ----------------------------------------------------------

def test_days_outside_the_periods_are_not_opened(spark, scratch):
    import datetime as dt

    from abx.schemas import EXPERIMENTS, USERLOG
    from abx.sources import daily
    day = dt.datetime(2024, 1, 1, 12)
    rows = [(u, "1", day + dt.timedelta(days=d), "view", None) for d in range(40) for u in range(3)]
    path, table = os.path.join(scratch, "log"), os.path.join(scratch, "experiments")
    daily.write_daily(spark.createDataFrame([*rows, (9, "1", None, "view", None)], USERLOG), path)
    day = day.date()
    exps = [("a", 0.5, "true", day + dt.timedelta(days=4), day + dt.timedelta(days=6), 2), ("b", 0.5, "true", day + dt.timedelta(days=30), day + dt.timedelta(days=31), 0),
            ("old", 0.5, "true", day, day + dt.timedelta(days=39), 0)]
    rows_to_frame(spark, exps, EXPERIMENTS).write.parquet(table)
    running = spark.read.schema(EXPERIMENTS).parquet(table).where(F.col("experiment_id").isin("a", "b"))
    wanted = {2, 3, 4, 5, 6, 30, 31}
    # Files of all other days are broken: reading one would fail.
    for d in set(range(40)) - wanted:
        folder = os.path.join(path, f"date={day + dt.timedelta(days=d)}")
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"broken")
            elif name.endswith(".crc"):
                os.remove(os.path.join(folder, name))
    log = daily.read_daily(spark, path, USERLOG, running)
    assert log.columns == USERLOG.names
    got = {(r.d - day).days for r in log.select(F.to_date("event_time").alias("d")).collect()}
    assert got == wanted and log.count() == 3 * len(wanted)
    assert "dynamicpruning" in log._jdf.queryExecution().toString()
    treated = daily.read_daily(spark, path, USERLOG, running, pre=False)
    assert treated.count() == 3 * (len(wanted) - 2)
    with pytest.raises(Exception):
        spark.read.schema(USERLOG).parquet(path).count()
        spark.read.schema(USERLOG).parquet(path).agg(F.sum("user_id")).collect()
