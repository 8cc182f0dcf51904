"""Tables that change, as versioned snapshots of Parquet, and the ways of changing them as joins.

A change writes new folders and then one small manifest that names the version of every table; readers take the newest
manifest, so a change is seen whole or not at all. One writer at a time, as in the reference model.
"""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas


def durable(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder; one is made only for a local session that has none."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="folioforge-"))
    return df.checkpoint()


def next_ids(df: DataFrame, order: Iterable[Column | str], base: int | Column = 0, name: str = "id") -> DataFrame:
    """Numbers 1.. after base in a fixed order, without bringing all rows to one task.

    Rows are dealt by ranges of the order; each range's count, one row a range, gives the next its offset.
    """
    order = list(order)
    n = max(1, df.sparkSession.sparkContext.defaultParallelism)
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    dealt = durable(dealt)  # the range of a row has to be the same in both uses, even if an executor is lost between them
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    return dealt.join(F.broadcast(offsets), "_part").withColumn(name, (inside + F.col("_before") + base).cast("long")).drop("_part", "_at", "_before")


def join_one(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """many joined with one, which has a row a key; keys may be structs, and nulls in them are alike.

    Both sides are dealt anew by a value that no earlier exchange was by, so that the adaptive execution can split a key that
    very many rows share.
    """
    dealt = F.struct(F.col(key).alias("k"), F.lit(0).alias("z"))
    return many.withColumn("_dealt", dealt).join(one.withColumn("_dealt", dealt).drop(key), "_dealt").drop("_dealt")


def insert_absent(old: DataFrame, new: DataFrame, key: Iterable[str], order: Iterable[Column | str] = ()) -> DataFrame:
    """old and those rows of new whose key it lacks; of several new rows with a key the first in order stays."""
    key = list(key)
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*(order or key)))
    added = new.withColumn("_first", first).where("_first = 1").drop("_first").join(old.select(*key), key, "left_anti")
    return old.unionByName(added, allowMissingColumns=True)


def update_by_key(old: DataFrame, changes: DataFrame, key: Iterable[str], columns: Iterable[str], touched: Column | None = None, stamp: str | None = None) -> DataFrame:
    """old with columns replaced where changes has the key; a key that changes twice is an error when the rows are read.

    stamp, if named, takes touched on the rows that are hit, even where nothing differs.
    """
    key, columns = list(key), list(columns)
    twice = F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("changed twice: "), F.to_json(F.struct(*key)))).cast("boolean")).otherwise(F.lit(True))
    new = changes.groupBy(*key).agg(F.first(F.struct(*columns)).alias("_new"), twice.alias("_hit")).select(*key, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns], "_hit")
    joined = old.join(new, key, "left")
    hit = F.col("_hit").isNotNull()
    out = []
    for c in old.columns:
        if c in columns:
            out.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == stamp:
            out.append(F.when(hit, touched).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def require_unique(df: DataFrame, key: Iterable[str], what: str) -> DataFrame:
    if bad := df.groupBy(*key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"{what}: {bad[0].asDict()}")
    return df


class Store:
    """Tables below a folder: versions/<n>/<table> and manifests/<n>.json, which names the parts of every table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._fs_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._fs_path("/".join([self.root, *parts]))

    def version(self) -> int:
        folder = self._path("manifests")
        if not self.fs.exists(folder):
            return 0
        return max([0, *(int(s.getPath().getName()[:-5]) for s in self.fs.listStatus(folder) if s.getPath().getName().endswith(".json"))])

    def manifest(self, version: int | None = None) -> dict[str, list[int]]:
        """The versions whose parts make up each table."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return json.loads(self.spark.read.text(self._path("manifests", f"{version}.json").toString(), wholetext=True).first()[0])

    def vacuum(self) -> int:
        """Delete folders that the newest version doesn't name, and older manifests; how many folders went. Nobody may be reading them."""
        named = {(str(v), name) for name, versions in self.manifest().items() for v in versions}
        gone, newest = 0, self.version()
        for version in self.fs.listStatus(self._path("versions")) if self.fs.exists(self._path("versions")) else []:
            for table in self.fs.listStatus(version.getPath()):
                if (version.getPath().getName(), table.getPath().getName()) not in named:
                    gone += bool(self.fs.delete(table.getPath(), True))
        for k in range(1, newest):
            self.fs.delete(self._path("manifests", f"{k}.json"), True)
        return gone

    def read(self, name: str) -> DataFrame:
        if name not in schemas.TABLES:
            raise ValueError(f"unknown table {name!r}")
        return self._parts(name, self.manifest().get(name, []))

    def _parts(self, name: str, versions: list[int]) -> DataFrame:
        if not versions:
            return schemas.empty(self.spark, name)
        return self.spark.read.schema(schemas.TABLES[name].schema).parquet(*[self._path("versions", str(v), name).toString() for v in versions])

    def publish(self, tables: dict[str, DataFrame], check: bool = True, append: dict[str, DataFrame] | None = None) -> int:
        """Write tables whole, and new rows of those in append, as one new version; an unsound table keeps all of it from being seen.

        Appended rows are a part of their own beside the older ones, which aren't written again; they are checked by
        themselves, and their keys against those of the older rows.
        """
        new, manifest = self.version() + 1, self.manifest()
        for name, df in [*tables.items(), *(append or {}).items()]:
            place = self._path("versions", str(new), name).toString()
            # What a row breaks by itself is counted while it's written; keys take one more scan.
            conformed, seen = schemas.conform(df, name), Observation()
            broken = schemas.unsound(name, conformed.columns)
            conformed.observe(seen, F.count("*").alias("n"), F.count(F.when(broken, 1)).alias("unsound")).write.mode("overwrite").parquet(place)
            part, old = self._parts(name, [new]), [] if name in tables else manifest.get(name, [])
            bad = []
            if check and seen.get["n"]:
                bad = (schemas.row_violations(part, name) if seen.get["unsound"] else schemas.key_violations(part, name)).limit(3).collect()
            for key in schemas.TABLES[name].keys if check and old else ():
                bad += self._parts(name, old).select(*key).join(part.select(*key), list(key), "left_semi").limit(3).collect()
            if bad:
                raise ValueError(f"{name} breaks its constraints: {[r.asDict() for r in bad]}")
            manifest[name] = [*old, new]
        out = self.fs.create(self._path("manifests", f".{new}.tmp"), True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        if not self.fs.rename(self._path("manifests", f".{new}.tmp"), self._path("manifests", f"{new}.json")):
            raise RuntimeError(f"version {new} is there already")
        return new


class Frames:
    """Tables held as DataFrames, to read from as from a Store; those that aren't given are empty."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark, self.tables = spark, {name: schemas.conform(df, name) for name, df in tables.items()}

    def read(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else schemas.empty(self.spark, name)


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
