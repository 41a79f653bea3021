import pytest
from pyspark.sql import functions as F

from abx.operators import features as FE


def test_one_hot_names_levels_and_nulls(spark):
    df = spark.createDataFrame([("a1", "Entire home (apt)", 1.0), ("a2", "Private room", 2.0), ("a3", None, 3.0)],
                               "listing_id string, room_type string, price double")
    out = FE.one_hot(df, {"room_type": FE.levels(df, "room_type")})
    assert out.columns == ["listing_id", "price", "room_type_Entirehome-apt", "room_type_Privateroom"]
    rows = {r.listing_id: r for r in out.collect()}
    assert rows["a1"]["room_type_Entirehome-apt"] == 1.0 and rows["a1"]["room_type_Privateroom"] == 0.0
    assert rows["a3"]["room_type_Entirehome-apt"] == 0.0 and rows["a3"]["room_type_Privateroom"] == 0.0


def test_one_hot_has_no_cap(spark):
    df = spark.range(1500).select(F.col("id").cast("string").alias("c"), "id")
    out = FE.one_hot_long(df, "id", ["c"])
    assert out.count() == 1500 and out.where("feature = 'c_1499'").first().id == 1499
    assert len(FE.levels(df, "c")) == 1500


def test_one_hot_long_names_like_wide(spark):
    df = spark.createDataFrame([("a1", "Entire home (apt)"), ("a2", None)], "listing_id string, room_type string")
    assert [tuple(r) for r in FE.one_hot_long(df, "listing_id", ["room_type"]).collect()] == [
        ("a1", "room_type_Entirehome-apt", 1.0)]


def test_drop_if_present(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert FE.drop_if_present(df, ["b", "c"]).columns == ["a"]


def test_one_hot_name_clash_raises(spark):
    df = spark.createDataFrame([("x", "y")], "c_d string, c string").select("c_d", F.lit("d").alias("c"))
    with pytest.raises(ValueError):
        FE.one_hot(df, {"c": ["d"]})


def test_sparse_encoder_matches_dense(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0), ("c", 4.0)], "seg string, x double")
    _, out = FE.one_hot_sparse(df, ["seg"], numeric=["x"])
    vecs = [r.features.toArray().tolist() for r in out.orderBy("x").collect()]
    # x, then a/b/c (alphabetical) and one slot for unseen levels
    assert vecs[0] == [1.0, 1.0, 0.0, 0.0, 0.0] and vecs[3] == [4.0, 0.0, 0.0, 1.0, 0.0]


def test_write_feature_table_checks_key(spark, scratch):
    df = spark.createDataFrame([("k1", 1.0), ("k2", 2.0)], "listing_id string, v double")
    FE.write_feature_table(df, "listing_id", f"{scratch}/feat")
    assert spark.read.parquet(f"{scratch}/feat").count() == 2
    bad = spark.createDataFrame([(None, 1.0)], "listing_id string, v double")
    with pytest.raises(ValueError):
        FE.write_feature_table(bad, "listing_id", f"{scratch}/feat2")
