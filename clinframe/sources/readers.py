"""Readers for the clinical tables: Parquet folders, the catalog, or JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clinframe.sources.schema import SCHEMAS, TABLES


def read_parquet_tables(spark: SparkSession, root: str, names: Iterable[str] = TABLES,
                        conform_schema: bool = False) -> dict[str, DataFrame]:
    """``{name: spark.read.parquet(root/name)}`` for each table.

    With ``conform_schema`` each known table is projected to the columns the
    operators read, cast to the schema of :mod:`clinframe.sources.schema`
    (column pruning still reaches the scan).
    """
    out = {}
    for n in names:
        df = spark.read.parquet(f"{root.rstrip('/')}/{n}")
        out[n] = conform(df, n) if conform_schema and n in SCHEMAS else df
    return out


def read_catalog_tables(spark: SparkSession, database: str | None = None,
                        names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """Tables by (optionally qualified) name from the session catalog."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    return {n: spark.table(n) for n in names}


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                    partition_column: str, lower: int, upper: int, num_partitions: int = 64) -> DataFrame:
    """A relational-database table as a DataFrame.

    Connection options (user, password, driver) come from the caller; nothing
    is stored here.  The read is split into ``num_partitions`` range queries of
    ``partition_column`` between the two bounds (rows outside them go to the
    first and last one); without them one task would read the whole table.
    """
    if not partition_column or lower is None or upper is None:
        raise ValueError("a partition column and both of its bounds are needed to read a table in parallel")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in properties.items():
        reader = reader.option(key, value)
    return (reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions)).load())


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], sort: Sequence[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """``df`` as a catalog table bucketed by ``keys`` and sorted by keys and ``sort`` inside each bucket.

    Windows, groupings and joins that extend ``keys`` over such tables (of equal
    bucket counts) need no exchange.  Each bucket becomes one task, so choose
    ``buckets`` for the size of the table, and don't bucket by a key that one
    value dominates.
    """
    # one writer per bucket: otherwise every task writes a file into each bucket
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys, *sort).saveAsTable(table))
    return df.sparkSession.table(table)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing as a DataFrame (name, database, tableType, isTemporary)."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, tableType string, isTemporary boolean")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """``SELECT * ... LIMIT n``: an arbitrary sample, not ordered."""
    return df.limit(n)


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL text to DataFrame, with ``views`` registered as temporary views first."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns the operators read, in schema order."""
    from pyspark.sql import functions as F
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])
