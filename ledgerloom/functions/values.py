"""Value rules of the parameter binder: date floor, string size, typed casts, durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The earliest date the store accepts.
DATE_FLOOR = dt.datetime(1753, 1, 1)

# Parameter type -> (database type, Spark type). Unsigned types are widened.
PARAMETER_TYPES = {
    "byte": ("Byte", "smallint"),
    "sbyte": ("SByte", "tinyint"),
    "short": ("Int16", "smallint"),
    "ushort": ("UInt16", "int"),
    "int": ("Int32", "int"),
    "uint": ("UInt32", "bigint"),
    "long": ("Int64", "bigint"),
    "ulong": ("UInt64", "decimal(20,0)"),
    "float": ("Single", "float"),
    "double": ("Double", "double"),
    "decimal": ("Decimal", "decimal(38,10)"),
    "bool": ("Boolean", "boolean"),
    "string": ("String", "string"),
    "char": ("StringFixedLength", "string"),
    "Guid": ("Guid", "string"),
    "DateTime": ("DateTime", "timestamp_ntz"),
    "DateTimeOffset": ("DateTimeOffset", "timestamp"),
    "byte[]": ("Binary", "binary"),
    "XElement": ("Xml", "string"),
    "XmlDocument": ("Xml", "string"),
}

# Ranges of the integer types.
_RANGES = {
    "byte": (0, 255),
    "sbyte": (-128, 127),
    "short": (-32768, 32767),
    "ushort": (0, 65535),
    "int": (-2147483648, 2147483647),
    "uint": (0, 4294967295),
    "long": (-9223372036854775808, 9223372036854775807),
    "ulong": (0, 18446744073709551615),
}
_WHOLE = r"^\s*[+-]?\d+\s*$"
_FLOATING = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$|^\s*(?:NaN|[+-]?Infinity)\s*$"
_DECIMAL = r"^\s*[+-]?0*(\d*)(?:\.(\d*?)0*)?\s*$"
_DIGIT = r"\d"
_SIZED = r"\(\s*(\d+)\s*,\s*(\d+)\s*\)"
_DATE_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6}0{0,3})?)?)?\s*$"
_OFFSET_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6}0{0,3})?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
_GUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"


def moment(at: dt.datetime | Column | None) -> Column:
    """A zone-less UTC time: the given one, or now."""
    if at is None:
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    if isinstance(at, Column):
        return at
    # As text: lit(datetime) would pass through the zones of Python and of the session.
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def floor_date(at: Column) -> Column:
    """Dates before 1753 become 1753-01-01; null stays null."""
    # Not greatest(): it skips nulls and would turn them into 1753.
    floor = moment(DATE_FLOOR)
    return F.when(at < floor, floor).otherwise(at)


def text_units(text: Column) -> Column:
    """Length in UTF-16 units, the unit of ``nvarchar(n)``; code points differ beyond the BMP."""
    plain = F.length(text)
    wide = (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    return F.when(F.octet_length(text) == plain, plain).otherwise(wide)


def text_units_sql(text: str) -> str:
    """The same as SQL text."""
    wide = f"CAST(octet_length(encode({text}, 'UTF-16BE')) / 2 AS INT)"
    return f"IF(octet_length({text}) = length({text}), length({text}), {wide})"


def string_size(text: Column) -> Column:
    """Declared size of a string parameter: at least 1, null for null."""
    return F.when(text.isNotNull(), F.greatest(F.lit(1), text_units(text)))


def is_blank(text: Column) -> Column:
    """Null, empty, or only blanks (trailing blanks do not count towards a length)."""
    return text.isNull() | (F.length(F.rtrim(text)) == 0)


def shown(value: Column) -> Column:
    """A value inside a message: null is written out as NULL."""
    return F.coalesce(value.cast("string"), F.lit("NULL"))


def duration_ms(started: Column, finished: Column) -> Column:
    """Whole milliseconds between two zone-less timestamps."""
    # timestampdiff() would read them in the session zone and be an hour off across DST.
    seconds = (finished - started).cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def _fits_decimal(text: Column, precision: Column, scale: Column) -> Column:
    """Whether a decimal text can be stored without losing a digit."""
    whole = F.length(F.regexp_extract(text, _DECIMAL, 1))
    fraction = F.length(F.regexp_extract(text, _DECIMAL, 2))
    return text.rlike(_DECIMAL) & text.rlike(_DIGIT) & (whole <= precision - scale) & (fraction <= scale)


def _decimal_size(spark_type: str) -> tuple[int, int]:
    precision, scale = spark_type.removeprefix("decimal(").removesuffix(")").split(",")
    return int(precision), int(scale)


def cast_text(text: Column, type_name: str) -> Column:
    """Typed value of a parameter text; null if it does not fit the type.

    Nothing is lost in silence: a decimal with more digits than its type keeps, 28 before and 10
    after the point unless it carries its size like ``decimal(10,2)``, does not fit, and neither
    does a ``DateTime`` with a zone or a time finer than microseconds. ``DateTimeOffset`` gives a struct, because a Spark timestamp
    keeps only the instant. A trailing ``?`` (nullable) means nothing here.
    """
    type_name = type_name.rstrip("?")
    base = type_name.split("(")[0]
    if base not in PARAMETER_TYPES:
        raise ValueError(f"no database type for parameter type [{type_name}]")
    spark_type = type_name if base == "decimal" and base != type_name else PARAMETER_TYPES[base][1]
    # Texts that cannot be numbers or flags are sorted out first, and ranges are compared on a
    # wide type: a failing try_cast raises and catches an error per row, ten times the price. A
    # decimal cast alone would round a fraction instead of refusing it.
    if type_name in _RANGES:
        wide = "decimal(38,0)" if type_name == "ulong" else "bigint"
        low, high = [F.lit(str(bound)).cast(wide) for bound in _RANGES[type_name]]
        whole = F.when(text.rlike(_WHOLE), text.try_cast(wide))
        return F.when(whole.between(low, high), whole).cast(spark_type)
    if type_name == "bool":
        return F.when(F.lower(F.trim(text)).isin("true", "false"), F.lower(F.trim(text)) == "true")
    if type_name == "char":
        return F.when(text_units(text) == 1, text)
    if type_name == "Guid":
        return F.when(text.rlike(_GUID), F.lower(text))
    if type_name == "DateTime":
        return floor_date(F.when(text.rlike(_DATE_TIME), text.try_cast("timestamp_ntz")))
    if type_name == "DateTimeOffset":
        instant = F.when(text.rlike(_OFFSET_TIME), text.try_cast("timestamp"))
        offset = F.regexp_extract(text, r"([+-]\d{2}:?\d{2}|Z)$", 1)
        return F.when(instant.isNotNull(), F.struct(instant.alias("instant"), offset.alias("offset")))
    if spark_type in ("string", "binary"):
        return text.cast(spark_type)
    if base == "decimal":
        precision, scale = _decimal_size(spark_type)
        return F.when(_fits_decimal(text, F.lit(precision), F.lit(scale)), text.try_cast(spark_type))
    return F.when(text.rlike(_FLOATING), text.try_cast(spark_type))


def bind_columns(df: DataFrame, types: dict[str, str], errors: str = "bind_errors") -> DataFrame:
    """Cast text columns to their parameter types and list, per row, the columns that do not fit."""
    typed = {name: cast_text(F.col(name), type_name) for name, type_name in types.items()}
    failed = [
        F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name)) for name, value in typed.items()
    ]
    return df.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns],
        F.concat_ws(",", *failed).alias(errors),
    )


def _base_type(type_name: Column) -> Column:
    """A type name without a trailing ``?`` (nullable) and without the size of a decimal."""
    plain = F.regexp_replace(type_name, r"\?$", "")
    return F.when(plain.rlike(rf"^decimal{_SIZED}$"), "decimal").otherwise(plain)


def database_type(type_name: Column) -> Column:
    """Database type of a parameter type; null if unknown."""
    mapping = F.create_map(*[F.lit(x) for name, (db, _) in PARAMETER_TYPES.items() for x in (name, db)])
    return F.try_element_at(mapping, _base_type(type_name))


def fits_type(type_name: Column, text: Column) -> Column:
    """Whether a parameter text fits the type named in the same row; null texts always fit.

    A decimal with a size has to fit that size.
    """
    base = _base_type(type_name)
    fits = F.lit(False)
    for name in reversed(PARAMETER_TYPES):
        fits = F.when(base == name, cast_text(text, name).isNotNull()).otherwise(fits)
    size = [F.when(type_name.rlike(_SIZED), F.regexp_extract(type_name, _SIZED, i).cast("int")) for i in (1, 2)]
    sized = F.coalesce(_fits_decimal(text, *size), F.lit(False))
    fits = F.when((base == "decimal") & type_name.rlike(_SIZED), sized).otherwise(fits)
    return F.when(base.isin(*PARAMETER_TYPES), text.isNull() | fits).otherwise(F.lit(False))
