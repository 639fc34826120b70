"""Column expressions: parsing, casting and formatting of telemetry values.

Bad text becomes NULL in every parser, so one malformed row never fails a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch.schema import OBSERVED_PATTERN, REPORT_DAY_PATTERN, UNION_MEMBERS


def parse_day(text: str | Column, pattern: str = OBSERVED_PATTERN) -> Column:
    """Text to date."""
    return F.try_to_date(text, pattern)


def parse_instant(text: str | Column, pattern: str = OBSERVED_PATTERN) -> Column:
    """Text to timestamp."""
    return F.try_to_timestamp(_column(text), F.lit(pattern))


def day_of(df: DataFrame, name: str = "data") -> Column:
    """The date of a column that holds either text or an instant."""
    return parse_day(name).alias(name) if _is_text(df, name) else F.col(name).cast("date").alias(name)


def instant_of(df: DataFrame, name: str = "data") -> Column:
    """The instant of a column that holds either text or an instant."""
    return parse_instant(name).alias(name) if _is_text(df, name) else F.col(name)


def format_day(day: str | Column, pattern: str = REPORT_DAY_PATTERN) -> Column:
    """Date to text."""
    return F.date_format(day, pattern)


def as_int(value: str | Column) -> Column:
    return _column(value).try_cast("int")


def as_double(value: str | Column) -> Column:
    return _column(value).try_cast("double")


def joined_text(values: str | Column, separator: str = ",") -> Column:
    """Array of text to delimited text; an empty array gives an empty text."""
    return F.concat_ws(separator, values)


def key_text(prefix: str, *parts: str) -> Column:
    """``prefix:part:part``. A NULL part raises: skipping it would merge different keys."""
    missing = F.lit(False)
    for part in parts:
        missing = missing | F.col(part).isNull()
    text = F.concat_ws(":", F.lit(prefix), *[F.col(part).cast("string") for part in parts])
    return F.when(missing, F.raise_error(F.lit(f"NULL in a key part of {prefix}"))).otherwise(text)


def union_member(df: DataFrame, name: str, member: str) -> Column:
    """The wanted member of a union struct column, or the column itself where it is plain."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return F.col(name).getField(member).alias(name)
    return F.col(name)


def pick_union_members(df: DataFrame, members: Mapping[str, str] = UNION_MEMBERS) -> DataFrame:
    """Flatten every union struct column named in ``members``."""
    return df.select(
        *[union_member(df, name, members[name]) if name in members else F.col(name) for name in df.columns]
    )


def typed_telemetry(df: DataFrame) -> DataFrame:
    """Plain, typed telemetry columns from raw text or union structs; other columns pass."""
    picked = pick_union_members(df)
    casts = {"vault_id": as_int, "failure": as_int, "s9_power_on_hours": as_double}
    return picked.select(*[casts[c](c).alias(c) if c in casts else F.col(c) for c in picked.columns])


def not_null(columns: Iterable[str]) -> Column:
    """True where none of the columns is NULL."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
