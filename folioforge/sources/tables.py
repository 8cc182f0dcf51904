"""Tables of a database over JDBC, for moving an existing installation; the engine itself works on Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_table(spark: SparkSession, url: str, name: str, partitions: int = 8, fetch_size: int = 10_000, **properties: str) -> DataFrame:
    """One of the engine's tables, read in ranges of its id where it has one; the database's driver has to be on the class path."""
    if name not in schemas.TABLES:
        raise ValueError(f"unknown table {name!r}")
    reader = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch_size), **properties)
    if any(f.name == "id" and f.dataType.simpleString() == "bigint" for f in schemas.TABLES[name].schema):
        low, high = spark.read.format("jdbc").options(url=url, **properties).option("query", f'select min("id") as low, max("id") as high from {name}').load().first()
        if low is not None and high > low:
            reader = reader.options(partitionColumn="id", lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions))
    return schemas.conform(reader.option("dbtable", name).load(), name)


#: Tables that only this engine has.
OWN_TABLES = ("identifier_conflicts", "resolution_failures")


def pull(store, url: str, names=None, **properties: str) -> dict[str, int]:
    """Copy tables of a database into a store as one version, all that it can have unless they're named; rows by table."""
    spark, out = store.spark, {}
    tables = {name: read_table(spark, url, name, **properties) for name in names or schemas.TABLES if names or name not in OWN_TABLES}
    store.publish(tables)
    for name in tables:
        out[name] = store.read(name).count()
    return out


def unresolved(records: DataFrame) -> DataFrame:
    """Records that aren't linked yet; their order only matters where ids are compared, so none is made here."""
    return records.where(F.col("journal_id").isNull())
