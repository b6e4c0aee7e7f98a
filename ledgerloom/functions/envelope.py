"""Result envelopes: one string ``'<code>,<message>'`` per call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_envelope(code: Column, message: Column) -> Column:
    return F.concat(code.cast("string"), F.lit(","), message)


def parse_envelope(line: Column) -> Column:
    """Struct of code, message, level and ok flag.

    Only the first comma separates, because messages do contain commas. Codes from 0 up are
    fine and logged as Debug; negative ones are errors. An unreadable code gives nulls.
    """
    parts = F.split(line, ",", 2)
    head = F.get(parts, F.lit(0))
    # Tested first: a failing try_cast raises and catches an error per row.
    code = F.when(head.rlike(r"^\s*[+-]?[0-9]+\s*$"), head.try_cast("bigint"))
    return F.struct(
        code.alias("result_code"),
        F.get(parts, F.lit(1)).alias("message"),
        F.when(code < 0, "Error").when(code >= 0, "Debug").alias("log_level"),
        (code >= 0).alias("is_ok"),
    )
