"""Every query of the library's own operators against its SQL."""

import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from benthic_jobs.plans import ORACLE_SQL, QUERIES
from benthic_jobs.plans.registry import rounded
from compare import same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        same(df, ORACLE_SQL[name], sf_dir)
    else:
        assert df.count() > 0


SUMS = "a01_plots a10_extents a12_clear_fraction a13_turbidity_index a16_glint_haze a18_patch_statistics a19_clip_rates t08_rolling_bias w3_check_dataset".split()


@pytest.mark.parametrize("name", SUMS)
def test_rounded_means_do_not_depend_on_the_shuffle(spark, sf_dir, name):
    own, rows = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows.append(sorted(map(repr, QUERIES[name](spark, sf_dir).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
    assert rows[0] == rows[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def changed(sf_dir, at, **tables):
    """A folder with the tables of ``sf_dir``, but for those given as DataFrames."""
    for path in Path(sf_dir).glob("*.parquet"):
        if path.stem not in tables:
            os.symlink(path, at / path.name)
    for name, rows in tables.items():
        rows.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def test_rounding_has_no_largest_value(spark):
    odd = [3.3e14, -9.8e15, 1e300, -1e305, float("inf"), float("-inf"), 4503599627.370497, 0.49999999999999994e-6, 2.5e-6, -3.5e-6, -0.2e-6, 0.0, None]
    mine = [r[0] for r in spark.createDataFrame([(x,) for x in odd], "x double").select(rounded("x", 6)).collect()]
    assert mine == [duckdb.execute("SELECT round(?::DOUBLE, 6)", [x]).fetchone()[0] for x in odd]
    assert spark.sql("SELECT double('NaN') AS x").where(F.isnan(rounded("x", 6))).count() == 1


@pytest.mark.parametrize("name", ["p15_s2_indices", "p16_landsat_indices", "p17_planetscope_indices"])
def test_indices_with_a_denominator_near_0(spark, sf_dir, tmp_path, name):
    counts = {1: 1474, 3: 8, 4: 1007, 5: 8, 7: 1007}  # near infrared + 6 red - 7.5 blue + 1 is 0, but for the last bits
    rows = [(8 + band, [(counts.get(band, 4321) + 0.5) / 5000 - 1] * 64, 0) for band in range(8)]
    at = changed(sf_dir, tmp_path, embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    df = QUERIES[name](spark, at)
    assert df.agg(F.max(F.abs("evi"))).first()[0] > 2**63 / 1e6
    same(df, ORACLE_SQL[name], at)


def test_a_scene_without_all_bands(spark, sf_dir, tmp_path):
    few = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id < 26")  # of the last scene, 3, two bands
    at = changed(sf_dir, tmp_path, embeddings=few)
    for name in ("p15_s2_indices", "p18_lyzenga", "p19_bottom_reflectance", "p20_deglint"):
        same(QUERIES[name](spark, at), ORACLE_SQL[name], at)
    assert QUERIES["p19_bottom_reflectance"](spark, at).where("scene_id = 3 AND site_b3 = 1").count() == 64
