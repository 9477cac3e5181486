"""Sensor facts as data: bands, scales, attenuation and index roles. A new sensor is new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed values. (sensor, band, position, scale, offset, quality band)
BANDS = [
    *(("S2", b, i, 1e-4, 0.0, False) for i, b in enumerate("b1 b2 b3 b4 b5 b6 b7 b8 b8a b11 b12".split())),
    ("S2", "scl", 11, 1.0, 0.0, True), ("S2", "aot", 12, 1e-3, 0.0, False),
    *(("LS", f"b{i + 1}", i, 2.75e-5, -0.2, False) for i in range(7)), ("LS", "qa_pixel", 7, 1.0, 0.0, True),
    *(("PS", b, i, 1e-4, 0.0, False) for i, b in enumerate("coastal_blue blue green_i green yellow red rededge nir".split())),
]
#: Fixed values. (sensor, resolution in metres, bands, most nodata per cent)
SPECS = [("S2", 10.0, 13, 5.0), ("LS", 30.0, 8, 20.0), ("PS", 3.0, 8, 10.0)]
#: Fixed values. Diffuse attenuation by band (1/m), for coastal and for clear water.
KD = {
    "S2": {"b1": 0.50, "b2": 0.30, "b3": 0.15, "b4": 0.25, "b5": 0.30, "b6": 0.35, "b7": 0.40, "b8": 0.45, "b8a": 0.45},
    "LS": {"b1": 0.50, "b2": 0.30, "b3": 0.15, "b4": 0.25, "b5": 0.45},
}
KD_CLEAR = {
    "S2": {"b1": 0.040, "b2": 0.045, "b3": 0.090, "b4": 0.450, "b5": 0.800, "b6": 2.5, "b7": 3.0, "b8": 4.5, "b8a": 4.8},
    "LS": {"b1": 0.040, "b2": 0.043, "b3": 0.090, "b4": 0.420, "b5": 4.8},
}
#: Fixed values. Band pairs of the depth-invariant index with the ratio of their attenuations.
LYZENGA = {
    "S2": [("b1", "b2", 1.5), ("b2", "b3", 1.8), ("b3", "b4", 0.6)],
    "LS": [("b1", "b2", 1.4), ("b2", "b3", 1.7), ("b3", "b4", 0.6)],
}
#: Fixed values. The band of each role, by sensor.
ROLES = {
    "S2": {"nir": "b8", "red": "b4", "green": "b3", "blue": "b2", "edge_nir": "b8a", "edge": "b5", "swir": "b11", "burn": "b12"},
    "LS": {"nir": "b5", "red": "b4", "green": "b3", "blue": "b2", "swir": "b6", "burn": "b7"},
    "PS": {"nir": "nir", "red": "red", "green": "green_i", "blue": "blue", "edge_nir": "nir", "edge": "rededge"},
}
#: Fixed values. (index, numerator, denominator, what is added to their quotient), over roles.
FORMULAS = [
    ("ndvi", "nir - red", "nir + red", 0.0), ("gndvi", "nir - green", "nir + green", 0.0), ("ndre", "edge_nir - edge", "edge_nir + edge", 0.0),
    ("ndwi", "green - nir", "green + nir", 0.0), ("mndwi", "green - swir", "green + swir", 0.0),
    ("evi", "2.5D * (nir - red)", "nir + 6 * red - 7.5D * blue + 1", 0.0), ("savi", "1.5D * (nir - red)", "nir + red + 0.5D", 0.0),
    ("nbr", "nir - burn", "nir + burn", 0.0), ("cig", "nir", "green", -1.0),
]
#: Fixed values. The indices of each sensor.
INDICES = {
    "S2": ["ndvi", "gndvi", "ndre", "ndwi", "mndwi", "evi", "savi", "nbr"], "LS": ["ndvi", "ndwi", "mndwi", "evi", "savi", "nbr"],
    "PS": ["ndvi", "gndvi", "ndre", "ndwi", "evi", "savi", "cig"],
}
#: Fixed values. Low- and high-resolution bands that see the same light.
MATCHED = [("B1", "B1"), ("B2", "B2"), ("B3", "B3"), ("B4", "B4"), ("B5", "B8A"), ("B6", "B11"), ("B7", "B12")]
#: Fixed values. First and last day of the satellites' service.
SERVICE = [
    ("L8", "2013-03-18", None), ("L9", "2013-03-18", None), ("L7", "1999-04-15", None), ("L5", "1982-07-16", "2013-06-05"),
    ("S2", "2015-07-01", None),
]


def bands(spark: SparkSession, rows: list[tuple] = BANDS) -> DataFrame:
    return spark.createDataFrame(rows, "sensor string, band string, position int, scale double, offset double, is_qa boolean")


def specs(spark: SparkSession, rows: list[tuple] = SPECS) -> DataFrame:
    return spark.createDataFrame(rows, "sensor string, resolution_m double, n_bands int, max_nodata_pct double")
