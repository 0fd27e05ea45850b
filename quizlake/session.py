"""Reading tables and cutting lineage; nothing here starts a job on import."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark is local."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quizlake-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably: its rows survive the loss of any executor, and later plans start from them. A copy of the plan runs, so that
    its shuffle files belong to nothing afterwards, even if the caller keeps ``df``; ``swept`` removes them."""
    checkpoint_dir(df.sparkSession)
    return df.select("*").checkpoint(eager=True)


def swept(spark: SparkSession) -> None:
    """Lets Spark remove now what nothing refers to any more, shuffle files and (``spark.cleaner.referenceTracking.cleanCheckpoints``) checkpoints.
    Without it they lie on disk until the driver happens to collect its garbage. For long queries that cut often; takes a second or two."""
    gc.collect()
    spark.sql("SELECT 1").collect()  # no job; Spark's event queues hold the last query until another one ends
    time.sleep(1.1)  # py4j tells the JVM once a second what Python has given up
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """A scan for a stage of Python work: dealt out only where the files give fewer partitions than there are cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    few = scan._jdf.queryExecution().toRdd().getNumPartitions() < cores
    return scan.repartition(2 * cores) if few else scan


def beside(one: DataFrame, two: DataFrame, on: Column | None = None) -> DataFrame:
    """Every row of ``one`` with every row of ``two`` for which ``on`` holds. Each task reads one partition of either where it lies (``cut`` tables: in
    the checkpoint), so nothing is shuffled or broadcast; the rows of a partition of ``one`` come in order, each with all of ``two``."""
    two = two.hint("shuffle_replicate_nl")
    return one.crossJoin(two) if on is None else one.join(two, on)
