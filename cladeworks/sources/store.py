"""Versions of a partitioned taxonomy on disk, switched by one rename.

A version is a folder of its own below the store, with a Parquet table for each
name, lines of text in a contract's order, and JSON.  Its manifest (rows and a
checksum of each table, and details) is written last; the store's pointer to it
is then replaced by a rename, which the file system does as a whole.  So a
reader sees the old version or the new one, and a write that fails, at any
point, leaves the old one readable.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "current.json"


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("").getFileSystem(self._conf)

    def manifest(self) -> dict | None:
        """The current version's manifest; none if nothing was ever written whole."""
        if not self._files().exists(self._at(_POINTER)):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/{_POINTER}", wholetext=True).first()["value"])

    def write(self, tables: dict[str, DataFrame], details: dict | None = None, by: str = "fragment") -> dict:
        """A new version with ``tables``; those that have the column ``by`` are partitioned by it.  Returns its manifest."""
        version = f"v-{uuid.uuid4().hex}"
        told = {"version": version, "details": details or {}, "tables": {}}
        for name, df in tables.items():
            at = f"{self.path}/{version}/{name}"
            out = df.write
            (out.partitionBy(by) if by in df.columns else out).parquet(at)
            told["tables"][name] = {"schema": df.schema.json(), **_sums(self.spark.read.schema(df.schema).parquet(at))}
        self._switch(told)
        return told

    def _switch(self, told: dict) -> None:
        files, fresh = self._files(), self._at(f"{told['version']}/manifest.json")
        stream = files.create(fresh, True)
        try:
            stream.write(bytearray(json.dumps(told, sort_keys=True).encode()))
        finally:
            stream.close()
        # the manifest stays with its version; a copy becomes the pointer
        copy = self._at(f".{told['version']}.json")
        self._jvm.FileUtil.copy(files, fresh, files, copy, False, self._conf)
        context = self._jvm.FileContext.getFileContext(copy.makeQualified(files.getUri(), files.getWorkingDirectory()).toUri(), self._conf)
        over = self.spark.sparkContext._gateway.new_array(self._jvm.Options.Rename, 1)
        over[0] = self._jvm.Options.Rename.OVERWRITE
        context.rename(files.makeQualified(copy), files.makeQualified(self._at(_POINTER)), over)

    def read(self, name: str) -> DataFrame:
        """A table of the current version; what is read stays as it is when a later version is written."""
        told = self.manifest()
        if told is None or name not in told["tables"]:
            raise ValueError(f"no table {name} in {self.path}")
        from pyspark.sql.types import StructType

        kind = StructType.fromJson(json.loads(told["tables"][name]["schema"]))
        return self.spark.read.schema(kind).parquet(f"{self.path}/{told['version']}/{name}").select(kind.names)

    def broken(self) -> list[str]:
        """The tables whose rows or checksum are not those of the manifest."""
        told = self.manifest() or {"tables": {}}
        return sorted(name for name, was in told["tables"].items() if _sums(self.read(name)) != {k: was[k] for k in ("rows", "checksum")})

    def drop_old(self) -> None:
        """Deletes all versions but the current one, and what failed writes left."""
        told, files = self.manifest(), self._files()
        for status in files.listStatus(self._at("")):
            name = status.getPath().getName()
            if name.lstrip(".").startswith("v-") and told is not None and not name.lstrip(".").startswith(told["version"]):
                files.delete(status.getPath(), True)


def _sums(df: DataFrame) -> dict:
    """Rows and the sum of their hashes, in any order; columns by name."""
    cells = F.xxhash64(*[F.col(c).cast("string") if k.startswith("map") else F.to_json(F.struct(c)) for c, k in sorted(df.dtypes)])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(cells.cast("decimal(38,0)")).alias("h")).first()
    return {"rows": row["n"], "checksum": str(row["h"] or 0)}


def write_ordered(lines: DataFrame, path: str, ranges: int | None = None) -> None:
    """``lines`` (fragment, rest, place, uid, value) as text, a folder a fragment: known ids first and in their order, then the rest by uid.

    Rows are dealt to ranges of that order, so a large fragment has many files;
    the order of their names is the lines'.  ``ranges``: how many, if not as many as Spark finds fit.
    """
    order = ("fragment", "rest", "place", "uid", "value")
    dealt = lines.repartitionByRange(*order) if ranges is None else lines.repartitionByRange(ranges, *order)
    dealt.sortWithinPartitions(*order).select("fragment", "value").write.partitionBy("fragment").text(path)


def part_lines(assigned: DataFrame, order: DataFrame) -> DataFrame:
    """fragment, rest, place, uid, value of a partition's taxa (uid, par_id, name, rank, fragment) for ``write_ordered``; ``order`` has (uid, place)."""
    line = F.concat(F.concat_ws("\t|\t", "uid", F.coalesce("par_id", F.lit("")), "name", F.coalesce("rank", F.lit(""))), F.lit("\t|\t")).alias("value")
    return assigned.join(order.select("uid", "place"), "uid", "left").select("fragment", F.col("place").isNull().alias("rest"), "place", "uid", line)


def map_json(maps: DataFrame) -> DataFrame:
    """src, json of partition maps (src, fragment, ids): {fragment: [ids]} of each source, both sorted."""
    own = maps.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("fragment", F.array_sort("ids").alias("ids")))).alias("e"))
    return own.select("src", F.to_json(F.map_from_entries("e")).alias("json"))
