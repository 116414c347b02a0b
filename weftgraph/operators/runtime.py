"""What an iterative job needs from its session: a checkpoint folder and plan settings."""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.storagelevel import StorageLevel

# One task's share of the edges: large enough to keep task counts and shuffle maps in hand on very
# large graphs, small enough to sort and cache within an executor.
ROWS_PER_PARTITION = 16_000_000
# Below this many rows another task costs more than it saves, on an idle core and on a busy one.
ROWS_WORTH_A_TASK = 50_000
ROWS_WORTH_A_WAIT = 1_000_000


def travels(module: str) -> None:
    """Send the functions of a module to executors along with a job, so that it need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut state: the session's own setting, a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weftgraph-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own in the shared folder, if it is there."""
    _files(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def _files(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def cut(frame: DataFrame, observation: Observation | None = None, **metrics) -> DataFrame:
    """Materialise to the checkpoint folder and forget the lineage; fill ``observation`` on the way."""
    checkpoint_dir(frame.sparkSession)
    if observation is not None:
        frame = frame.observe(observation, *[value.alias(name) for name, value in metrics.items()])
    return frame.checkpoint(eager=True)


def discard(*frames: DataFrame) -> None:
    """Delete the files of tables that ``cut`` has written, once nothing reads them any more."""
    for frame in frames:
        file = frame._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            delete(frame.sparkSession, file.get())


def written(frame: DataFrame) -> bool:
    """Whether a table is one that ``cut`` has written, or otherwise exists already."""
    return frame._jdf.queryExecution().analyzed().nodeName() == "LogicalRDD"


def planned(frame: DataFrame) -> DataFrame:
    """A table planned under the settings of now and computed where it is used, for results larger than what they come of.

    What it has shuffled stays until it is let go of. A second use computes it again from there; ``cut`` it where that is dear.
    """
    spark, execution = frame.sparkSession, frame._jdf.queryExecution()
    rows = execution.toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, execution.analyzed().schema(), False), spark)


def shuffles_spent(spark: SparkSession):
    """Settings under which the shuffle files of a query are deleted at its end, not when the driver next collects garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def hold(frame: DataFrame) -> DataFrame:
    """Cache a table, in as many partitions as its size calls for at run time."""
    with settings(frame.sparkSession, {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true"}):
        return frame.persist(StorageLevel.MEMORY_AND_DISK)


def partition_count(spark: SparkSession, rows: int, worth_a_wait: int | None = None, fitting: int | None = None) -> int:
    """Partitions for a table of ``rows``: one per core, or the session's number of shuffle partitions, as
    far as the size is worth it, by ``worth_a_wait`` rows each; more if ``fitting`` rows would be exceeded in one.
    """
    worth_a_wait = worth_a_wait or ROWS_WORTH_A_WAIT
    idle = min(spark.sparkContext.defaultParallelism, -(-rows // ROWS_WORTH_A_TASK))
    asked = min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // worth_a_wait)
    return max(1, idle, asked, -(-rows // (fitting or ROWS_PER_PARTITION)))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """Session settings for the length of a block; other threads of the session see them too."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def loop_settings(spark: SparkSession, partitions: int):
    """Settings under which successive rounds share one partitioning.

    Runtime re-planning is off because a re-planned result no longer reports how it is partitioned
    and sorted; with it off, state and edges meet in place and a round shuffles its messages only.
    Broadcasts are left to those whose size this library bounds.
    """
    return settings(
        spark,
        {
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": partitions,
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
