"""Staged tables: cut the lineage of iterative operators.

A step's result is written once as Parquet into the folder that the cluster
names in ``spark.checkpoint.dir`` (shared by all executors, so it survives the
loss of one) and read again.  Only where that setting is absent and the master
is this machine, as in tests, a temporary folder is made.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="cladeworks-core-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return _LOCAL[0]


def staged(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_root(spark)}/cladeworks-stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
