"""Tables and streams: parquet, JDBC, delimited lists, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | str | None = None) -> DataFrame:
    """A catalog table, or parquet files when the argument is a path."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(name_or_path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, key: str = "key") -> DataFrame:
    """Day-partitioned parquet whose columns grew over time; the day range prunes partitions."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if first:
        df = df.filter(F.col(key) >= first)
    if last:
        df = df.filter(F.col(key) <= last)
    return df


def jdbc_options(url: str, table: str, column: str, lower: int | str, upper: int | str, partitions: int,
                 fetch_size: int = 10_000, **properties: str) -> dict[str, str]:
    """Options of a range-partitioned scan: many connections instead of one."""
    return {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": str(fetch_size), **properties,
    }


def read_jdbc(spark: SparkSession, view: str | None = None, **kwargs) -> DataFrame:
    """Scan a database table; see :func:`jdbc_options`. ``view`` also registers it by name."""
    df = spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
    return as_view(df, view) if view else df


def as_view(df: DataFrame, name: str, persist: bool = False) -> DataFrame:
    """Name a frame for SQL; persist only when several queries read it."""
    if persist:
        df = df.persist()
    df.createOrReplaceTempView(name)
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_delimited_list(lines: DataFrame, index: int = 1, separator: str = "__", name: str = "cp_uid") -> DataFrame:
    """One field of a separator-delimited list; lines without it are dropped."""
    part = F.get(F.split("value", separator, -1), F.lit(index))
    return lines.select(part.alias(name)).filter(F.col(name).isNotNull())


def kafka_options(servers: str, topics: str, offset_reset: str = "largest", max_per_trigger: int | None = None) -> dict[str, str]:
    """Source options: earliest only for ``smallest``; lost offsets move on instead of failing."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topics, "failOnDataLoss": "false",
        "startingOffsets": "earliest" if offset_reset == "smallest" else "latest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_lines(spark: SparkSession, **kwargs) -> DataFrame:
    """Topic values as text with their time of arrival; needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()
    return source.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived"))


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None, arrival: bool = False) -> DataFrame:
    """The same lines replayed from text files; a line arrives when its file was written."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrived")) if arrival else lines
