"""Delimited-file input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
    encoding: str = "UTF-8", quote: str = '"', escape: str = '"', multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which reads the file twice.

    Multi-line records keep a file from being split, so they are off unless asked for.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
        .option("quote", quote).option("escape", escape).option("multiLine", multi_line)
    )
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)
