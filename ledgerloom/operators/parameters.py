"""Binding of call parameters, for any number of calls at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import database_type, fits_type, string_size
from ledgerloom.operators.joins import lookup


def bind_parameters(parameters: DataFrame) -> DataFrame:
    """Database type, size and status of each parameter.

    Input: ``request_id``, ``name``, ``type_name``, ``value`` (text). A name given twice in one
    request, a type without a database type, and a value that does not fit its type are errors.
    """
    call = ["request_id", "name"]
    repeated = (
        parameters.groupBy(*call).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    ).withColumn("_repeated", F.lit(True))
    type_name, value = F.col("type_name"), F.col("value")
    db_type = database_type(type_name)
    # Judged before the join: with the long type switch inside it, the join's generated method
    # grows past what the JVM compiles.
    judged = parameters.select(
        *call,
        "type_name",
        "value",
        db_type.alias("db_type"),
        F.when(db_type == "String", string_size(value)).alias("size"),
        F.when(db_type.isNull(), "unsupported type")
        .when(~fits_type(type_name, value), "bad value")
        .otherwise("ok")
        .alias("status"),
    )
    status = F.when(F.col("_repeated").isNotNull(), "duplicate name").otherwise(F.col("status"))
    return lookup(judged, repeated, call).withColumn("status", status).drop("_repeated")
