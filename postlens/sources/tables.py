"""Tables read by path."""

from pyspark.sql import DataFrame, SparkSession


def read_table_at(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A columnar table by its path; ``fmt`` may be any format on the class path."""
    return spark.read.format(fmt).load(path)
