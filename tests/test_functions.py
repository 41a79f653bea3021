import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.functions import columns as C
from abx.functions.tails import chi2_1df_sf_np, normal_sf2_np, student_sf2_np


def test_pad_id_edges(spark):
    df = spark.createDataFrame([("7",), ("123456789",), (None,), ("12345678",)], "x string")
    got = [r[0] for r in df.select(C.pad_id("x")).collect()]
    assert got == ["00000007", "123456789", None, "12345678"]


def test_hash_unit_matches_md5(spark):
    df = spark.createDataFrame([("exp1", 42), ("exp_all", 0)], "e string, u long")
    got = [r[0] for r in df.select(C.hash_unit("e", "u")).collect()]
    want = [int(hashlib.md5(f"{e}|{u}".encode()).hexdigest()[:8], 16) for e, u in [("exp1", 42), ("exp_all", 0)]]
    assert got == want


def test_round6_keeps_size_and_nan(spark):
    rows = [0.0078125, -1.2345674, 2.0, 1.5e13, -2e13, 1.2e300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    got = [tuple(r) for r in df.select(C.round6("x"), C.to_cents("x")).collect()]
    assert [g[0] for g in got[:5]] == [0.007812, -1.234567, 2.0, 1.5e13, -2e13]
    assert [g[1] for g in got[:5]] == [0.01, -1.23, 2.0, 1.5e13, -2e13]
    assert got[5][0] == pytest.approx(1.2e300) and got[6] == (math.inf,) * 2 and got[7] == (-math.inf,) * 2
    assert all(math.isnan(v) for v in got[8]) and got[9] == (None, None)


def test_clean_feature_name():
    assert C.clean_feature_name("room_type_Entire home (apt)") == "room_type_Entirehome-apt"


def test_known_tail_values():
    assert student_sf2_np([2.2281388], [10])[0] == pytest.approx(0.05, abs=1e-7)
    assert chi2_1df_sf_np([0.16])[0] == pytest.approx(0.689157, abs=1e-6)
    assert normal_sf2_np([1.959963984540054])[0] == pytest.approx(0.05, abs=1e-12)
    assert student_sf2_np([0.0], [5])[0] == pytest.approx(1.0)
    # df = 1 is Cauchy: p = 1 - 2 atan(t) / pi
    assert student_sf2_np([3.0], [1])[0] == pytest.approx(1 - 2 * math.atan(3.0) / math.pi, rel=1e-12)


@pytest.mark.parametrize("df", [1, 2, 3, 7.5, 30, 400])
def test_student_against_fine_quadrature(df):
    for t in (0.0, 1e-9, 0.01, 0.5, 1.9999, 2.0, 2.0001, 4.0, 12.0):
        theta = np.linspace(0, math.atan(t / math.sqrt(df)), 400001)
        body = np.trapezoid(np.cos(theta) ** (df - 1), theta)
        want = 1 - 2 * body * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
        assert student_sf2_np([t], [df])[0] == pytest.approx(want, abs=2e-11)


@pytest.mark.parametrize("df", [1e10, 1e12, 1e15])
def test_student_tends_to_normal(df):
    for t in (0.0, 0.3, 0.5, 1.96, 2.5, 6.0, 20.0):
        assert student_sf2_np([t], [df])[0] == pytest.approx(normal_sf2_np([t])[0], rel=1e-8, abs=1e-9)


def test_student_of_nothing_is_nan():
    assert np.isnan(student_sf2_np([math.nan, 1.0, math.inf], [5.0, 0.0, 5.0])).all()


def test_tail_udfs_null_safe(spark):
    from abx.functions.tails import student_sf2, normal_sf2
    df = spark.createDataFrame([(None, None), (2.0, 10.0)], "t double, d double")
    got = df.select(student_sf2("t", "d").alias("p"), normal_sf2("t").alias("q")).collect()
    assert got[0]["p"] is None and got[0]["q"] is None
    assert got[1]["p"] == pytest.approx(0.07338803477074, abs=1e-9)
