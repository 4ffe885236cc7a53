"""Message payloads to typed transactions and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.schema import TRANSACTION_FIELDS, raw_schema


def payload_text(column="value") -> Column:
    """Binary payload read as UTF-8 text."""
    return F.col(column).cast("string")


def parse_json(column, schema: T.StructType) -> Column:
    """Text to a struct. Malformed text gives NULL fields, never a failure."""
    return F.from_json(column, schema)


def encode_rows(df: DataFrame, ignore_null_fields: bool = True, key: Column | None = None) -> DataFrame:
    """Each row as one JSON ``value``, under ``key`` if given. NULL fields are left out by default."""
    options = {"ignoreNullFields": str(ignore_null_fields).lower()}
    value = F.to_json(F.struct("*"), options).alias("value")
    return df.select(value) if key is None else df.select(key.alias("key"), value)


def decode_rows(envelope: DataFrame, schema: T.StructType, keep=()) -> DataFrame:
    """JSON payloads flattened to ``schema``'s columns.

    ``keep`` names envelope columns to carry along in front.

    The struct is unpacked by ``inline``, which no filter is moved across.
    Below a plain projection a later filter on several fields would parse the
    payload once per field.
    """
    return envelope.select(*keep, F.inline(F.array(parse_json(payload_text(), schema))))


def apply_types(records: DataFrame) -> DataFrame:
    """The six numeric fields cast from text; bad numerals become NULL.

    ``try_cast`` keeps the rest of the session's ANSI checks on.
    """
    return records.withColumns({
        name: F.col(name).try_cast(kind)
        for name, kind in TRANSACTION_FIELDS.items()
        if name in records.columns and not isinstance(kind, T.StringType)
    })


def decode_transactions(envelope: DataFrame, columns=None) -> DataFrame:
    """Transaction messages to typed rows.

    Name the ``columns`` a job needs: the JSON schema is narrowed to them, and
    the parser then skips the other fields instead of building them.
    """
    return apply_types(decode_rows(envelope, raw_schema(columns)))


def number_text(column) -> Column:
    """A double as text: plain digits from 0.0001 up to 1e16, else with an exponent.

    Spark itself turns to exponents from 1e7 on and below 0.001. What rewrites
    them is a lambda, which Spark keeps out of generated code: written in line,
    it makes methods so long that the JVM interprets them instead of compiling.
    """
    text = F.col(column).cast("string") if isinstance(column, str) else column.cast("string")
    # Most numbers have no exponent and are done here; only the others are taken apart.
    rewritten = F.transform(F.array(text), _without_exponent)[0]
    return F.when(F.contains(text, F.lit("E")), rewritten).otherwise(text)


def _without_exponent(text: Column) -> Column:
    sign = F.when(text.startswith("-"), "-").otherwise("")
    parts = F.split(F.ltrim(text, F.lit("-")), "E")
    mantissa, power = F.regexp_replace(parts[0], r"\.0$", ""), F.get(parts, F.lit(1)).cast("int")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    whole = F.rpad(digits, power + 1, "0")
    behind = F.substr(digits, power + 2)
    plain = F.concat(
        F.substr(whole, F.lit(1), power + 1), F.lit("."), F.when(behind == "", "0").otherwise(behind)
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    exponent = F.concat(
        mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0"),
    )
    written = F.when(power.between(0, 15), plain).when(power.between(-4, -1), small).otherwise(exponent)
    return F.concat(sign, written)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the form in which the feed carries records."""
    return df.select(*[
        (number_text(name) if kind == "double" else F.col(name).cast("string")).alias(name)
        for name, kind in df.dtypes
    ])
