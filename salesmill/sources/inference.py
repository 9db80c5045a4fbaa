"""Types of columns that no schema names, from aggregates that any pass over the text can carry.

Every field has a narrowest kind, one bit each. A column's bits are or-ed together, so partial results
merge in any order and take one number per task; the type is the least one that all kinds found fit
into. Empty and missing fields fit anything. Unlike a fold over the fields, the result does not
depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, LONG, WHOLE, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
_NUMBERS = INT | LONG | WHOLE | DOUBLE
#: The longest decimal; longer whole numbers are doubles.
_DIGITS = 38


# A cast that fails costs many times one that succeeds, as it throws. These hold for every text that
# converts, and for few others.
_BLANKS = r"[\x00-\x20\x7F]*"
_LIKE_DOUBLE = (
    rf"(?i)^{_BLANKS}[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[fd]?"
    rf"|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[fd]?|nan|inf(?:inity)?){_BLANKS}\z"
)
_LIKE_TIMESTAMP = rf"(?i)^{_BLANKS}[+-]?t?[0-9]"


def _digits(value: Column) -> Column:
    """The digits of a whole number, without sign and without zeros in front."""
    return F.ltrim(value, F.lit("+-0"))


def _is_whole(value: Column) -> Column:
    return value.rlike(r"^[+-]?[0-9]+\z") & (F.length(_digits(value)) <= _DIGITS)


def _within(value: Column, largest: int) -> Column:
    """Whether a whole number lies between ``-largest - 1`` and ``largest``, told by its digits."""
    digits, most = _digits(value), len(str(largest))
    top = F.when(value.startswith("-"), str(largest + 1)).otherwise(str(largest))
    return (F.length(digits) < most) | ((F.length(digits) == most) & (digits <= top))


def kind(value: Column) -> Column:
    """The narrowest kind of a text, or null for an empty or missing one."""

    def fits(dtype: str) -> Column:
        return value.try_cast(dtype).isNotNull()

    whole = F.when(_within(value, (1 << 31) - 1), INT).when(_within(value, (1 << 63) - 1), LONG)
    return (
        # First, as the digits' aggregate asks for it too: it is evaluated once for both.
        F.when(_is_whole(value), whole.otherwise(WHOLE))
        .when(value.isNull() | (value == ""), F.lit(None).cast("int"))
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & fits("date"), DATE)
        .when(value.rlike(_LIKE_DOUBLE) & fits("double"), DOUBLE)
        .when(value.rlike(_LIKE_TIMESTAMP) & fits("timestamp"), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def kind_aggregates(headers: Iterable[str]) -> dict[str, Column]:
    """Two aggregates per column: the kinds found, and the digits of its longest whole number."""
    found = {}
    for i, header in enumerate(headers):
        value = F.col(f"`{header}`")
        found[f"kinds_{i}"] = F.bit_or(kind(value))
        found[f"digits_{i}"] = F.max(F.when(_is_whole(value), F.length(_digits(value))))
    return found


def least_type(kinds: int | None, digits: int | None) -> T.DataType:
    """The least type that fields of these kinds fit into; text where there are none."""
    kinds = kinds or TEXT
    if not kinds & ~_NUMBERS:
        if kinds & DOUBLE:
            return T.DoubleType()
        if kinds & WHOLE:
            return T.DecimalType(digits, 0)
        return T.LongType() if kinds & LONG else T.IntegerType()
    if not kinds & ~(DATE | TIMESTAMP):
        return T.TimestampType() if kinds & TIMESTAMP else T.DateType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def types_of(headers: Iterable[str], found: Mapping[str, int | None]) -> dict[str, T.DataType]:
    """The types from the values of ``kind_aggregates``."""
    return {
        header: least_type(found[f"kinds_{i}"], found[f"digits_{i}"])
        for i, header in enumerate(headers)
    }


def infer_types(text: DataFrame, headers: list[str]) -> dict[str, T.DataType]:
    """The types of columns of text, in one pass over them; without columns, without a pass."""
    if not headers:
        return {}
    aggregates = kind_aggregates(headers)
    row = text.agg(*(column.alias(name) for name, column in aggregates.items())).first()
    return types_of(headers, row.asDict())


def cast_to(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """The frame with its columns of text in these types."""
    return df.withColumns(
        {
            name: F.col(f"`{name}`").try_cast(dtype)
            for name, dtype in types.items()
            if dtype != T.StringType()
        }
    )
