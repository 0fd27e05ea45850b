"""Structured Streaming forms: repeats dropped within a watermark, and orphan references kept batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quizlake.operators import orphans


def distinct_buzzes(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """A buzz stream without the repeats of (player, tossup, position) that arrive within the delay. State expires with the watermark."""
    kept = stream.where("buzz_position is not null").withColumn("at", stream["recorded_at"].cast("timestamp"))
    return kept.withWatermark("at", delay).dropDuplicatesWithinWatermark(["player_id", "tossup_id", "buzz_position"]).drop("at")


def watch_orphans(references: DataFrame, arrivals: Callable[[], DataFrame], on_state: Callable[[orphans.OrphanState], None], checkpoint: str, deleted: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """Advances the orphan state with every batch of a stream of references (as orphans.references gives them).

    The state after each batch is stored beside the stream's checkpoint, under the number of the batch, and the next batch
    starts from what is stored. So a restarted stream goes on where it stopped, and a batch that runs again starts from the
    state before it. References are stored batch by batch; two states are kept.
    """
    spark = references.sparkSession
    root = f"{checkpoint.rstrip('/')}/orphans"

    def there(path: str):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        return fs, p

    def exists(path: str) -> bool:
        fs, p = there(path)
        return fs.exists(p)

    def step(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/references/batch={n}")
        state = orphans.OrphanState.load(spark, f"{root}/state-{n - 1}") if exists(f"{root}/state-{n - 1}/pending/_SUCCESS") else orphans.OrphanState()
        every = spark.read.parquet(f"{root}/references").where(F.col("batch") <= n)
        own = every.where(F.col("batch") == n).drop("batch")
        before = every.where(F.col("batch") < n).drop("batch")
        new = arrivals()
        if state.parents is not None:  # what the index has already in just this state says nothing new
            new = new.join(state.parents.where("loaded_at is not null and loaded_at = last_at"), ["parent_table", "key", "loaded_at"], "left_anti").select(new.columns)
        state = orphans.advance(replace(state, references=before), own, new, None if deleted is None else deleted())
        state.save(f"{root}/state-{n}")
        fs, old = there(f"{root}/state-{n - 2}")
        fs.delete(old, True)
        on_state(replace(orphans.OrphanState.load(spark, f"{root}/state-{n}"), references=every.drop("batch")))

    return references.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
