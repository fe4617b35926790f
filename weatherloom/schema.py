"""Fixed schemas, fixed-width layouts and element constants.

Nothing here is ever inferred from data: every reader is given one of these.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------------

CORE_ELEMENTS = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")

ELEMENT_UNITS = {
    "PRCP": "mm",
    "SNOW": "mm",
    "SNWD": "mm",
    "TMAX": "°C",
    "TMIN": "°C",
}

# Elements whose VALUE is stored in tenths of the unit; all others are as is.
STORED_IN_TENTHS = ("PRCP", "TMAX", "TMIN")

EARTH_RADIUS_KM = 6371.0

# Observations (gzip CSV without a header line) ----------------------------------


def observations_schema() -> T.StructType:
    """DATE stays ``yyyyMMdd`` text and OBSERVATION_TIME stays ``HHMM`` text."""
    return _observations("MEASUREMENT_FLAG", "QUALITY_FLAG", "SOURCE_FLAG", "OBSERVATION_TIME")


def observations_schema_short() -> T.StructType:
    """The same eight columns under the short flag names."""
    return _observations("MEASUREMENT", "QUALITY", "SOURCE", "TIME")


def _observations(*flags: str) -> T.StructType:
    keys = T.StructType().add("ID", T.StringType()).add("DATE", T.StringType()).add("ELEMENT", T.StringType())
    schema = keys.add("VALUE", T.DoubleType())
    for flag in flags:
        schema = schema.add(flag, T.StringType())
    return schema


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
}


# Fixed-width dimension files ----------------------------------------------------


class Field(NamedTuple):
    """One fixed-width field; ``first`` and ``last`` are 1-indexed and inclusive."""

    name: str
    first: int
    last: int
    kind: str

    @property
    def width(self) -> int:
        return self.last - self.first + 1


# The published character ranges.
STATIONS = (
    Field("ID", 1, 11, "string"),
    Field("LATITUDE", 13, 20, "double"),
    Field("LONGITUDE", 22, 30, "double"),
    Field("ELEVATION", 32, 37, "double"),
    Field("STATE", 39, 40, "string"),
    Field("NAME", 42, 71, "string"),
    Field("GSN_FLAG", 73, 75, "string"),
    Field("HCN_CRN_FLAG", 77, 79, "string"),
    Field("WMO_ID", 81, 85, "string"),
)

COUNTRIES = (
    Field("CODE", 1, 2, "string"),
    Field("NAME", 4, 64, "string"),
)

STATES = (
    Field("CODE", 1, 2, "string"),
    Field("NAME", 4, 50, "string"),
)

INVENTORY = (
    Field("ID", 1, 11, "string"),
    Field("LATITUDE", 13, 20, "double"),
    Field("LONGITUDE", 22, 30, "double"),
    Field("ELEMENT", 32, 35, "string"),
    Field("FIRSTYEAR", 37, 40, "int"),
    Field("LASTYEAR", 42, 45, "int"),
)


def layout_schema(fields: tuple[Field, ...]) -> T.StructType:
    """The StructType a layout parses to."""
    return T.StructType([T.StructField(f.name, _TYPES[f.kind], True) for f in fields])


def station_schema() -> T.StructType:
    return layout_schema(STATIONS)


def country_schema() -> T.StructType:
    return layout_schema(COUNTRIES)


def state_schema() -> T.StructType:
    return layout_schema(STATES)


def inventory_schema() -> T.StructType:
    return layout_schema(INVENTORY)
