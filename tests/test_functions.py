"""Hand-computed edges of the scalar functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from benthic_jobs.functions import geometry, labels, spectral
from benthic_jobs.sources import surveys


def column(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_labels(spark):
    assert column(spark, labels.normalise_label, ["  Foo_Bar-baz  qux", "", None]) == ["foo bar baz qux", "", None]
    assert column(spark, labels.column_token, ["% Coral (hard)", "__", None]) == ["coral_hard", "unknown", "unknown"]
    assert column(spark, labels.coverage_class, ["29.9", "30", "60", "x", None]) == ["low", "medium", "high", None, None]
    assert column(spark, labels.abundance_code, ["0.5 = few", "none", None]) == [0.5, None, None]
    assert column(spark, labels.cloud_percent, [0.0, 0.2, 1.0, 35.0, None], "double") == [0.0, 20.0, 100.0, 35.0, 100.0]


def test_dates(spark):
    got = column(spark, labels.parse_date, ["20200506", "2020-05-06", "06/05/2020", "2020-05-06T12:00:00", "junk", "20201399", None])
    assert [str(x) if x else None for x in got] == ["2020-05-06"] * 4 + [None] * 3
    assert [str(x) for x in column(spark, labels.survey_date, ["4-May-19", "x"])] == ["2019-05-04", "None"]
    got = column(spark, labels.item_date, ['["A/20200102T1"]', "[]", "oops", None])
    assert [str(x) for x in got] == ["2020-01-02", "None", "None", "None"]


def test_dms(spark):
    got = column(spark, labels.dms_to_degrees, ["8°30'36\"", "8º30′36″S", "-8 30 36", "text", None])
    assert got == [pytest.approx(8.51), pytest.approx(-8.51), pytest.approx(-8.51), None, None]


def test_indices_without_data(spark):
    row = {f"b{i}": 0.0 for i in [1, 2, 3, 4, 5, 6, 7, 8, 11, 12]} | {"b8a": None}
    df = spark.createDataFrame([row], ", ".join(f"{k} double" for k in row))
    got = df.select(*(c.alias(k) for k, c in spectral.indices("S2", "").items())).first().asDict()
    assert got["ndvi"] is None and got["ndre"] is None and got["evi"] == 0.0
    assert all(v is None for v in df.select(*spectral.depth_invariant("S2", "").values()).first())


def test_water_column(spark):
    df = spark.createDataFrame([(0.1, 2.0), (0.1, 50.0), (0.1, 0.0), (0.1, -1.0), (None, 2.0)], "r double, d double")
    got = [r[0] for r in df.select(spectral.bottom_reflectance(F.col("r"), F.col("d"), F.lit(0.1))).collect()]
    assert got == [pytest.approx(0.1 * np.exp(0.4)), 1.0, None, None, None]
    assert column(spark, spectral.turbidity_class, [-1.5, -1.0, 0.03, 0.08, None], "double") == [None, "clear", "moderate", "turbid", None]


def test_utm_round_trip():
    rng = np.random.default_rng(1)
    lon, lat = rng.uniform(-179, 179, 2000), rng.uniform(-78, 78, 2000)
    zone = np.floor((lon + 180) / 6).astype(int) + 1
    x, y = geometry.utm_forward(lon, lat, zone)
    lon2, lat2 = geometry.utm_back(x, y, zone, lat < 0)
    assert np.abs(lon2 - lon).max() < 1e-6 and np.abs(lat2 - lat).max() < 1e-6


def test_patch_without_point(spark):
    df = spark.createDataFrame([(None, 1.0), (3.0, 0.0)], "lon double, lat double")
    got = [r[0] for r in df.select(geometry.patch_geometry(F.col("lon"), F.col("lat"), 5120.0)).collect()]
    assert got[0] is None and got[1]["epsg"] == 32631 and got[1]["x"] == pytest.approx(500000)


def test_clean_names():
    assert surveys.clean_names(["﻿Site ", "", "Unnamed: 2", "Cover"]) == ["Site", "Date", "Date_2", "Cover"]


def test_a_fourth_sensor_is_rows(spark):
    """Bands, roles, a formula of its own and the list of its indices: no code."""
    from benthic_jobs.functions import sensors

    rows = [*sensors.BANDS, *(("DS", b, i, 0.5, 1.0, False) for i, b in enumerate(("haze_blue", "leaf", "heat")))]
    pixels = spark.createDataFrame([("DS", 1, b, v) for b, v in (("haze_blue", 2), ("leaf", 4), ("heat", 8))] + [("DS", 2, "leaf", 4)], "sensor string, scene_id int, band string, dn int")
    got = {(r["scene_id"], r["band"]): r["value"] for r in spectral.reflectance(pixels, rows).collect()}
    assert got == {(1, "haze_blue"): 2.0, (1, "leaf"): 3.0, (1, "heat"): 5.0, (2, "leaf"): 4.0}
    own = spectral.indices(
        "DS", "ds_", roles={"DS": {"nir": "heat", "red": "leaf", "blue": "haze_blue"}}, names={"DS": ["ndvi", "haze"]},
        formulas=[*sensors.FORMULAS, ("haze", "blue - 0.25D * red", "blue * nir", 2.0)],
    )
    df = spark.createDataFrame([(2.0, 3.0, 5.0), (0.0, 1.0, 2.0)], "ds_haze_blue double, ds_leaf double, ds_heat double")
    a, b = df.select(*(c.alias(k) for k, c in own.items())).collect()
    assert (a["ndvi"], a["haze"]) == pytest.approx((0.25, 2.125)) and b["ndvi"] == pytest.approx(1 / 3) and b["haze"] is None
    with pytest.raises(KeyError):
        spectral.indices("LS", "", names={"LS": ["ndre"]})
