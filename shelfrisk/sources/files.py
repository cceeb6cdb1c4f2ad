"""Tables, SQL, text folders and CSV files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def attach_folder(spark: SparkSession, folder: str, names: list[str], prefix: str = "") -> None:
    """Make the Parquet tables of a folder available to SQL by name."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(prefix + name)


def attach_database(spark: SparkSession, url: str, names: list[str], split_column: str | None = None,
                    bounds: tuple[int, int] | None = None, tasks: int = 64, **options: str) -> None:
    """Make tables of a relational database available to SQL by name (needs its JDBC driver jar).

    With an integer `split_column` and its `bounds` each table is read by `tasks` parallel queries.
    """
    for name in names:
        reader = spark.read.format("jdbc").options(**jdbc_options(url, name, split_column, bounds, tasks, **options))
        reader.load().createOrReplaceTempView(name)


def jdbc_options(url: str, name: str, split_column: str | None = None, bounds: tuple[int, int] | None = None,
                 tasks: int = 64, **options: str) -> dict[str, str]:
    chosen = {"url": url, "dbtable": name, "fetchsize": "10000", **options}
    if split_column and bounds:
        chosen |= {"partitionColumn": split_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
                   "numPartitions": str(tasks)}
    return chosen


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def detach(spark: SparkSession, names: list[str]) -> None:
    """Forget attached tables; frames already built from them keep working."""
    for name in names:
        spark.catalog.dropTempView(name)


def query(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def first_rows(df: DataFrame, n: int = 6) -> DataFrame:
    """Preview of `n` rows."""
    return df.limit(n)


def read_sparse_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of all `.txt` files of a folder as one table: file, line."""
    lines = spark.read.option("pathGlobFilter", "*.txt").text(folder)
    return lines.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Feature dictionary from CSV with a header; numbers written as decimals are accepted."""
    raw = spark.read.csv(path, header=True, schema="feature_name string, feature_number double")
    return raw.withColumn("feature_number", F.col("feature_number").cast("int"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column, one part per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def write_flat(df: DataFrame, path: str) -> None:
    """The same table as Parquet, the better choice when Spark reads it again."""
    df.write.mode("overwrite").parquet(path)
