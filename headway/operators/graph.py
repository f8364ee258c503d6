"""Connected components and walks to a root, by joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one that the cluster names; a local session without one gets a temporary folder, any other is an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.headway.scratch", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-headway-")
        spark.conf.set("spark.headway.scratch", folder)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores: rows of few bytes are one task else, however long their rules take."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


#: Rows of either side that meet in one block of ``block_join``, and pairs that a task makes.
BLOCK_ROWS, TASK_PAIRS = 1024, 4_000_000


def block_join(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """``left`` joined with ``right`` on ``key``, dealt to as many tasks as the pairs need, however many rows share a key.

    A key's rows are dealt to blocks of about BLOCK_ROWS on either side, and each block of
    one side meets each of the other; so a task's pairs don't grow with the input, and a
    row is sent as often as the other side has blocks.  Sizes of keys are counted first.
    """
    sizes = left.groupBy(*key).agg(F.count("*").alias("_l")).join(right.groupBy(*key).agg(F.count("*").alias("_r")), key)
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    sizes = written(sizes.select(*key, F.col("_l") * F.col("_r"), blocks("_l"), blocks("_r")).toDF(*key, "_n", "_is", "_js"))
    tasks = -(-(sizes.agg(F.sum("_n")).first()[0] or 0) // TASK_PAIRS) or 1

    def dealt(df: DataFrame, own: str, owns: str, other: str, others: str) -> DataFrame:
        part = F.pmod(F.xxhash64(*([x for x in df.columns if x not in key] or key)), F.col(owns)).cast("int")
        sent = df.join(sizes.select(*key, "_is", "_js"), key).withColumn(own, part).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        return sent.drop("_is", "_js").repartition(tasks, *key, "_i", "_j")

    return dealt(left, "_i", "_is", "_j", "_js").join(dealt(right, "_j", "_js", "_i", "_is"), [*key, "_i", "_j"]).drop("_i", "_j")


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, for nodes of edges (a, b) between different nodes.

    Each round takes the smallest label among neighbours and then the label's own
    label, so the rounds grow with the logarithm of a component's width.
    """
    edges = edges.filter(F.col("a") != F.col("b")).distinct()
    both = written(edges.union(edges.select("b", "a")).toDF("node", "other").distinct())
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        new = written(step.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("further", "new")).alias("new")))
        changed = not new.filter(F.col("label") != F.col("new")).isEmpty()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def roots(df: DataFrame, node: str, parent: str) -> DataFrame:
    """node and its root by parents, however deep; a parent that isn't there ends the walk below it, and a node in a cycle, or below one, is its own root.

    Each round doubles the steps, so rounds grow with the logarithm of the depth; after as
    many rounds as the number of nodes has bits, who still moves is in a cycle or below one.
    """
    up = df.select(F.col(node).alias("n"), F.nullif(F.trim(parent), F.lit("")).alias("p"))
    known = up.select(F.col("n").alias("p"), F.lit(True).alias("there"))
    current = written(up.join(known, "p", "left").select("n", F.when(F.col("there"), F.col("p")).alias("p")))
    rounds = max(1, current.count()).bit_length() + 1
    at = current.select("n", F.coalesce("p", "n").alias("to"), F.col("p").isNull().alias("done"))
    for _ in range(rounds):
        step = at.select(F.col("n").alias("to"), F.col("to").alias("further"), F.col("done").alias("end"))
        at = written(at.join(step, "to").select("n", F.when(F.col("done"), F.col("to")).otherwise(F.col("further")).alias("to"), (F.col("done") | F.col("end")).alias("done")))
        if at.filter("NOT done").isEmpty():
            break
    return at.select(F.col("n").alias(node), F.when(F.col("done"), F.col("to")).otherwise(F.col("n")).alias("root"))
