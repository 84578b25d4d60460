"""The resource catalogue: inheritance, aliases, latest versions, licences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.folds import intervals
from ..operators.hierarchy import absorb, closure
from ..staging import staged


def registry(spark: SparkSession, folder: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """id, body (JSON text) of the resources in a folder of JSON objects {id: resource}; an id in several files, or twice, raises.

    Files named in ``skip`` (such as a merged copy) are not read.
    """
    files = spark.read.text(f"{folder}/*.json", wholetext=True).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    files = files.filter(~F.col("file").isin(*skip)) if skip else files
    keys = files.select(F.explode(F.json_object_keys("value")).alias("id"))
    twice = keys.groupBy("id").count().filter("count > 1").orderBy("id").limit(10).collect()
    if twice:
        raise ValueError(f"ids repeated: {', '.join(r['id'] for r in twice)}")
    return files.select(F.explode(F.from_json("value", "map<string, string>")).alias("id", "body"))


def inherited(resources: DataFrame, fields: list[str]) -> DataFrame:
    """``id``, ``base`` and each field, taken from the nearest resource up the chain of bases that has it."""
    tree = resources.select(F.col("id").alias("uid"), F.col("base").alias("par_id"))
    out = resources.select("id", "base")
    for f in fields:
        own = resources.filter(F.col(f).isNotNull()).select(F.col("id").alias("stop"), f)
        near = absorb(tree, own.select(F.col("stop").alias("uid"))).filter("stop is not null")
        out = out.join(near.join(own, "stop").select(F.col("uid").alias("id"), f), "id", "left")
    return out.select("id", "base", *fields)


def aliases(resources: DataFrame) -> DataFrame:
    """alias, id: the last resource of each alias; an alias that is an id raises.

    The last one is that with the largest ``place`` if there is such a column,
    the order in which a registry names its resources, and else by id.
    """
    order = F.struct("place", "id") if "place" in resources.columns else F.struct("id")
    flat = resources.select("id", order.alias("order"), F.explode("aliases").alias("alias"))
    clash = flat.join(resources.select(F.col("id").alias("alias")), "alias", "left_semi").limit(1).collect()
    if clash:
        raise ValueError(f"alias {clash[0]['alias']} is an id")
    return flat.groupBy("alias").agg(F.max_by("id", "order").alias("id"))


def terminal(resources: DataFrame) -> DataFrame:
    """id, terminal: the last in preorder of the resources at or below each."""
    tree = resources.select(F.col("id").alias("uid"), F.col("base").alias("par_id"))
    labels = staged(intervals(tree))
    return labels.select(F.col("uid").alias("id"), F.col("last").alias("first")).join(labels.select(F.col("uid").alias("terminal"), "first"), "first").select("id", "terminal")


def licences(resources: DataFrame) -> DataFrame:
    """id, licence, place: the distinct licences up the chain of bases, nearest first."""
    tree = resources.select(F.col("id").alias("uid"), F.col("base").alias("par_id"))
    # paths over the resources with a licence only, each reached from the nearest one at or above
    licensed = resources.filter("licence is not null").select(F.col("id").alias("uid"), "licence")
    near = staged(absorb(tree, licensed).filter("stop is not null"))
    own = tree.join(licensed.select("uid"), "uid", "left_semi").join(near.select(F.col("uid").alias("par_id"), F.col("stop").alias("up")), "par_id", "left")
    pairs = closure(own.select("uid", F.col("up").alias("par_id"))).join(licensed.withColumnRenamed("uid", "anc"), "anc").withColumnRenamed("des", "stop")
    rows = near.join(pairs, "stop").select(F.col("uid").alias("des"), "licence", "dist")
    first = rows.groupBy(F.col("des").alias("id"), "licence").agg(F.min("dist").alias("dist"))
    return first.select("id", "licence", F.row_number().over(Window.partitionBy("id").orderBy("dist", "licence")).alias("place"))
