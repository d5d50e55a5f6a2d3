"""Article records as newline JSON, and file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspace.functions.polymorphic import json_value
from termspace.schemas import ARTICLE


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, length, modified) of the files below a path; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("source_file"), "length", F.col("modificationTime").alias("modified"))


def pending(items: DataFrame, done: DataFrame, key: str = "source_file") -> DataFrame:
    """The items whose key is not among the processed ones."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def write_articles(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line, every metadata key a list."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_scalar_articles(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line, single values as scalars and whole numbers as numbers."""
    df.select(article_json(df).alias("value")).write.mode(mode).text(path)


def article_json(df: DataFrame):
    """JSON text of a row: list columns in the scalar-or-list view, the rest as text."""
    members = []
    for field in df.schema.fields:
        column = F.col(field.name)
        values = column if isinstance(field.dataType, T.ArrayType) else F.array(column.cast("string"))
        # Text columns stay text even where they hold a number.
        value = json_value(values) if isinstance(field.dataType, T.ArrayType) else _json_text(values)
        members.append(F.concat(F.lit(f'"{field.name}":'), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _json_text(one: F.Column):
    listed = F.to_json(one)
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def read_articles(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Article records of a directory of newline JSON, by a fixed schema.

    A scalar where the schema has a list is read as a list of one; what cannot
    be read at all is left to ``read_articles_checked``.
    """
    return read_articles_checked(spark, path, schema).drop("_corrupt_record")


def read_articles_checked(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """As ``read_articles``, with the text of unreadable lines in ``_corrupt_record``."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    as_text = as_text.add("_corrupt_record", T.StringType())
    # Whether a member is a list shows in the record only: once read, "[1]" and [1] are the same text.
    lines = spark.read.text(path).filter(F.trim("value") != "")
    lines = lines.select(
        F.from_json("value", as_text, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"),
        F.try_parse_json("value").alias("v"),
    )
    columns = []
    for field in schema.fields:
        text = F.col("r").getField(field.name)
        if isinstance(field.dataType, T.ArrayType):
            kind = F.schema_of_variant(F.try_variant_get("v", f"$['{field.name}']", "variant"))
            listed = F.coalesce(F.startswith(kind, F.lit("ARRAY")), F.lit(False))
            text = F.when(listed, F.from_json(text, field.dataType)).when(text.isNotNull(), F.array(text))
        columns.append(text.alias(field.name))
    return lines.select(*columns, F.col("r._corrupt_record").alias("_corrupt_record"))
