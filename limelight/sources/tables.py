"""Typed reads of the per-source tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .records import read_records

def _number(text: Column, kind: T.DataType) -> Column:
    """Exact number from text; a whole-valued decimal such as 50000.0 is an integer.

    Whether a value is whole is read off its digits, before any conversion could round: its
    places behind the point, less trailing zeros, must be made up for by the exponent.
    """
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    form = r"^[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?$"
    whole, behind = F.regexp_extract(text, form, 1), F.regexp_extract(text, form, 2)
    exponent = F.coalesce(F.regexp_extract(text, form, 3).try_cast("int"), F.lit(0))
    digits = F.concat(whole, behind)
    bare = F.rtrim(digits, F.lit("0"))
    places = F.length(behind) - (F.length(digits) - F.length(bare)) - exponent
    exact = (bare == "") | (places <= 0)
    return F.when(exact, text.try_cast("decimal(38,9)")).try_cast(kind)


def typed(text: Column, field: T.StructField, strict: bool = True) -> Column:
    """Value of a declared type from CSV text; empty text is NULL.

    Text that is no value of the type fails the job, or is NULL when not ``strict``.
    """
    if isinstance(field.dataType, T.StringType):
        return text.alias(field.name)
    bare = F.nullif(F.trim(text), F.lit(""))
    value = _number(bare, field.dataType)
    if strict:
        message = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), bare)
        wrong = bare.isNotNull() & value.isNull()
        value = F.when(wrong, F.raise_error(message).cast(field.dataType)).otherwise(value)
    return value.alias(field.name)


def read_source(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "csv",
    multi_line: bool = False, strict: bool = True,
) -> DataFrame:
    """A source table under its declared schema. Raises when the path is missing.

    CSV fields are read as text and converted exactly: integer columns with gaps, which
    are often written as decimals (``50000.0``), keep their values, and a value that does
    not fit its column fails the job unless ``strict`` is off.

    ``multi_line`` admits line breaks inside CSV fields. Files are still read in splits; what
    it costs is to count quotes first and to shuffle the lines by their splits.
    """
    if format != "csv":
        return spark.read.schema(schema).format(format).load(path)
    if multi_line:
        text = read_records(spark, path, schema.fieldNames())
    else:
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        # quotes are doubled inside quoted fields
        text = spark.read.schema(as_text).options(header=True, quote='"', escape='"').csv(path)
    return text.select(*[typed(F.col(f"`{f.name}`"), f, strict) for f in schema.fields])


def empty_source(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema. The plan is known to be empty, so joins with it fold away."""
    return spark.range(1).where(F.lit(False)).select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def optional_source(
    spark: SparkSession, path: str | None, schema: T.StructType, format: str = "csv",
    multi_line: bool = False, strict: bool = True,
) -> DataFrame:
    """Like ``read_source``, but an absent source is an empty table of the same schema.

    The left joins of the merge then yield its columns as NULL.
    """
    if path is None:
        return empty_source(spark, schema)
    try:
        return read_source(spark, path, schema, format, multi_line, strict)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_source(spark, schema)
