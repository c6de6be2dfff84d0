"""Schemas of the inputs, and the tables of names that go with them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# --- fixed values --------------------------------------------------------------
MEASUREMENTS = ["TMIN", "TOBS", "TMAX", "SNOW", "SNWD", "PRCP"]

COVER_TYPES = {
    1.0: "Spruce/Fir",
    2.0: "Lodgepole Pine",
    3.0: "Ponderosa Pine",
    4.0: "Cottonwood/Willow",
    5.0: "Aspen",
    6.0: "Douglas-fir",
    7.0: "Krummholz",
}

# A pair is a column repeated under a prefix: prefix_0 .. prefix_(count - 1).
COVER_FIELDS: list[str | tuple[str, int]] = [
    "Elevation", "Aspect", "Slope", "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology", "Horizontal_Distance_To_Roadways",
    "Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm",
    "Horizontal_Distance_To_Fire_Points", ("WA", 4), ("ST", 40), "Cover_Type",
]

PARTICLE_FIELDS: list[str | tuple[str, int]] = [
    "label", "lepton pT", "lepton eta", "lepton phi", "missing energy magnitude",
    "missing energy phi", "jet 1 pt", "jet 1 eta", "jet 1 phi", "jet 1 b-tag",
    "jet 2 pt", "jet 2 eta", "jet 2 phi", "jet 2 b-tag", "jet 3 pt", "jet 3 eta",
    "jet 3 phi", "jet 3 b-tag", "jet 4 pt", "jet 4 eta", "jet 4 phi", "jet 4 b-tag",
    "m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
]
# -------------------------------------------------------------------------------

# The part of a post that is read; the parser skips every other field.
POST = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("user", T.StructType([T.StructField("id_str", T.StringType())])),
])

STATION_RECORDS = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("measurements", T.ArrayType(T.StructType([
        T.StructField("measurement", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("vec", T.ArrayType(T.DoubleType())),
    ]))),
])


def expand_names(fields: Iterable[str | tuple[str, int]]) -> list[str]:
    """Column names with repeated columns written out."""
    names: list[str] = []
    for field in fields:
        if isinstance(field, tuple):
            prefix, count = field
            names += [f"{prefix}_{i}" for i in range(count)]
        else:
            names.append(field)
    return names


def numeric_schema(names: Iterable[str]) -> T.StructType:
    """All columns as doubles."""
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])
