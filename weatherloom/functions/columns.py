"""Pure Column expressions: no DataFrame, no action, no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.schema import CORE_ELEMENTS, ELEMENT_UNITS, STORED_IN_TENTHS


def blank_to_null(text: Column) -> Column:
    """Trim spaces; a field of nothing but spaces is missing."""
    return F.nullif(F.trim(text), F.lit(""))


def fixed_width_field(line: Column, first: int, width: int, kind: str) -> Column:
    """One typed field of a fixed-width line. Unreadable numbers become null."""
    text = blank_to_null(F.substring(line, first, width))
    return text if kind == "string" else text.try_cast(kind)


# Calendar -----------------------------------------------------------------------
#
# DATE arrives either as ``yyyyMMdd`` text (straight from the files) or as a real
# date. The choice is made once from the schema, so each plan holds one form only.


def _date_is_text(df: DataFrame) -> bool:
    return isinstance(df.schema["DATE"].dataType, T.StringType)


def year_of(df: DataFrame) -> Column:
    """Year of the row; a YEAR column (such as a partition column) wins."""
    if "YEAR" in df.columns:
        return F.col("YEAR")
    if _date_is_text(df):
        return F.substring("DATE", 1, 4).try_cast("int")
    return F.year("DATE")


def month_of(df: DataFrame) -> Column:
    if _date_is_text(df):
        return F.substring("DATE", 5, 2).try_cast("int")
    return F.month("DATE")


def month_start_of(df: DataFrame) -> Column:
    """First day of the month. Reads only year and month, so day 30 of February is fine."""
    if _date_is_text(df):
        return F.try_to_date(F.concat(F.substring("DATE", 1, 6), F.lit("01")), "yyyyMMdd")
    return F.trunc("DATE", "month")


def day_of(df: DataFrame) -> Column:
    """The real date; impossible dates become null instead of failing the job."""
    if _date_is_text(df):
        return F.try_to_date("DATE", "yyyyMMdd")
    return F.col("DATE")


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("YEAR", year_of(df))


def with_calendar(df: DataFrame) -> DataFrame:
    """Add YEAR, MONTH, YEAR_MONTH and DAY (the parsed date)."""
    return df.withColumns(
        {
            "YEAR": year_of(df),
            "MONTH": month_of(df),
            "YEAR_MONTH": month_start_of(df),
            "DAY": day_of(df),
        }
    )


# Observations -------------------------------------------------------------------


def quality_ok(flag: Column | str = "QUALITY_FLAG") -> Column:
    """True when no quality check failed: the flag is missing or blank."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return flag.isNull() | (F.trim(flag) == "")


def is_core(element: Column | str = "ELEMENT") -> Column:
    element = F.col(element) if isinstance(element, str) else element
    return element.isin(*CORE_ELEMENTS)


def in_units(element: Column, value: Column) -> Column:
    """VALUE in physical units: tenths are divided by ten, the rest is unchanged."""
    return F.when(element.isin(*STORED_IN_TENTHS), value / 10.0).otherwise(value)


def unit_name(element: Column) -> Column:
    pairs = [F.lit(part) for item in ELEMENT_UNITS.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), element)


def element_divisor(element: str) -> float:
    """Divisor that turns a stored value of one element into its unit."""
    return 10.0 if element in STORED_IN_TENTHS else 1.0


# Stations -----------------------------------------------------------------------


def country_code(station_id: Column | str = "ID") -> Column:
    """The first two characters of a station ID."""
    return F.substring(station_id, 1, 2)


def with_country_code(stations: DataFrame) -> DataFrame:
    """Give the stations a COUNTRY_CODE column when they have none."""
    if "COUNTRY_CODE" in stations.columns:
        return stations
    return stations.withColumn("COUNTRY_CODE", country_code())


def has_text(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def _flag_is(column: str, network: str) -> Column:
    return F.trim(F.coalesce(F.col(column), F.lit(""))) == network


def in_network(network: str) -> Column:
    """Null-safe membership in one of the networks GSN, HCN and CRN."""
    return _flag_is("GSN_FLAG" if network == "GSN" else "HCN_CRN_FLAG", network)


def is_southern() -> Column:
    return F.col("LATITUDE") < 0


def is_territory(owner: str = "united states", home_code: str = "US") -> Column:
    """Country name mentions the owner (any bracket form), but is not its mainland."""
    return F.lower("COUNTRY_NAME").contains(owner.lower()) & (F.col("COUNTRY_CODE") != home_code)


def wrapped_longitude(longitude: Column) -> Column:
    """Longitude on 0..360, for display across the 180th meridian."""
    return F.when(longitude < 0, longitude + 360.0).otherwise(longitude)


def year_label(name: Column, year: Column) -> Column:
    return F.concat(name, F.lit(" ("), year.cast("string"), F.lit(")"))


# Text ---------------------------------------------------------------------------

_BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def bytes_text(n: Column) -> Column:
    """Byte count as text with two decimals, in steps of 1024 from B up to PB."""
    n = n.cast("double")

    def shown(power: int) -> Column:
        return F.concat(F.format_number(n / float(1024**power), 2), F.lit(" " + _BYTE_UNITS[power]))

    top = len(_BYTE_UNITS) - 1
    return reduce(
        lambda larger, power: F.when(F.abs(n) < float(1024 ** (power + 1)), shown(power)).otherwise(larger),
        reversed(range(top)),
        shown(top),
    )


def year_in_filename(path: Column) -> Column:
    """The year of a ``.../1875.csv.gz`` path, null for any other path."""
    part = F.element_at(F.split(path, "/"), -1)
    digits = part.substr(1, 4)
    named = (F.substr(part, F.lit(5)) == ".csv.gz") & (F.translate(digits, "0123456789", "") == "")
    return F.when(named, digits.try_cast("int"))
