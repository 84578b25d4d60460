"""Shared-folder tables that cut lineage between the steps of an operator.

Intermediate results are written once as Parquet into the folder that the
cluster names in ``spark.checkpoint.dir``; every executor and the driver can
read them again after an executor is lost.  Only where that setting is absent
and the master is this machine (unit tests) a temporary folder is made.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a local one only where unset on one machine, an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="cladeworks-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return _LOCAL[0]


class Workspace:
    """Writes tables under one folder of its own; ``drop`` frees what is no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/cladeworks-{name}-{uuid.uuid4().hex}"
        self._n = 0

    def table(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/t{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._cladeworks_path = path  # keeps the frame and its folder together
        return out

    def counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The table and its rows, counted while it is written (a repeated task may count twice, so only 0 is exact)."""
        seen = Observation()
        out = self.table(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        return out, seen.get["rows"]

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self._delete(df._cladeworks_path)

    def drop_folder(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")

    def keep_only(self, *frames: DataFrame) -> None:
        """Deletes the tables of this workspace but for ``frames``."""
        kept = {df._cladeworks_path for df in frames}
        for k in range(1, self._n + 1):
            if (path := f"{self.root}/t{k}") not in kept:
                self._delete(path)

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the Arrow batches that Python workers get: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def plain_names(docs: DataFrame) -> DataFrame:
    """The same columns, all but ``doc_id`` and ``text`` named by their place, so that names of an operator's own cannot clash.

    ``toDF(*docs.columns)`` names them back.
    """
    return docs.toDF(*[c if c in ("doc_id", "text") else f"column_{k}" for k, c in enumerate(docs.columns)])
