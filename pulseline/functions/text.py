"""Expressions for reading fields out of a comma-separated line and for writing text cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import LAST, MONEY, TIME_FORMAT

INTEGER = r"^[+-]?[0-9]+$"
# Amounts and readings may have white space around them, whole numbers may not.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# The leading timestamp (or date) of a field; whatever follows a non-digit is ignored.
LEADING_TIME = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})([^0-9].*)?$"
LEADING_DATE = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})([^0-9].*)?$"

# Fields of the line in `value`; trailing empty fields do not count.
SPLIT_FIELDS = "split(rtrim(',', value), ',')"


def compute_once(df: DataFrame, keep: Iterable[str], columns: dict[str, str]) -> DataFrame:
    """The columns `keep` plus new columns, given as SQL expressions, that are evaluated once per row.

    A plain projection would be copied by the optimizer into every later filter and expression that uses it; a
    generator over a one-element array is not.
    """
    made = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return df.select(*keep, F.expr(f"inline(array(named_struct({made})))"))


def field(fields: str, position: int) -> str:
    """One field, NULL when the line is too short."""
    return f"element_at({fields}, -1)" if position == LAST else f"get({fields}, {position})"


def parse(raw: str, kind: str, date_only: bool = False) -> str:
    """A typed value, NULL when the text is not of that type."""
    if kind == "text":
        return raw
    if kind == "time":
        return f"try_cast(regexp_extract({raw}, r'{LEADING_DATE if date_only else LEADING_TIME}', 1) AS timestamp)"
    guard, target = {
        "long": (INTEGER, "bigint"),
        "int": (INTEGER, "int"),
        "money": (DECIMAL, MONEY),
        "double": (DECIMAL, "double"),
    }[kind]
    return f"CASE WHEN {raw} RLIKE r'{guard}' THEN try_cast({raw} AS {target}) END"


def time_text(ts: Column, fmt: str = TIME_FORMAT) -> Column:
    return F.date_format(ts, fmt)


def money_text(amount: Column) -> Column:
    """Plain decimal text with two places, never scientific notation."""
    return amount.cast("decimal(38,2)").cast("string")


def percent_text(part: Column, whole: Column) -> Column:
    """100 * part / whole with one decimal, rounded half up, in whole-number arithmetic."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    tenths = F.call_function("div", 2000 * part + whole, 2 * whole)
    whole_part = F.call_function("div", tenths, F.lit(10)).cast("string")
    return F.concat(whole_part, F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def top_text(items: Column, value) -> Column:
    """`[k:v,k:v]` from a sorted array of structs; `value` turns one struct into its value text."""
    parts = F.transform(items, lambda item: F.concat(item["key"], F.lit(":"), value(item)))
    return F.concat(F.lit("["), F.concat_ws(",", parts), F.lit("]"))
