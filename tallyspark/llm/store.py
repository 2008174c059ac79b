"""Cut lineage by writing a table in the folder that all executors share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyspark.session import shared_folder


def settle(df: DataFrame, compression: str = "zstd", path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (or ``path`` below it) and read it back.

    Later reads see the same rows whatever executor is lost meanwhile.
    """
    spark = df.sparkSession
    path = path or shared_folder(spark)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the queries that run inside, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
