"""Session and lineage helpers shared by tests, bench and operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library is tuned for. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("exprspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small tables on one machine: keep a partition per core instead of merging to 1 MB and 4 MB
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    made = tempfile.mkdtemp(prefix="exprspark-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def stage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from that table.

    Used where a result is read several times or a lineage grows: later reads do not recompute
    it, it survives the loss of executors, and its true size is known to the optimizer.
    """
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_width(spark: SparkSession) -> int:
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *cols: str, groups: int | None = None) -> DataFrame:
    """Hash-partition for a task that computes much on few bytes.

    Adaptive execution merges partitions by size; an explicit number of partitions is kept, so the
    work still reaches all cores. ``groups`` caps the number where fewer keys exist.
    """
    n = spread_width(df.sparkSession)
    return df.repartition(max(1, min(n, groups) if groups else n), *cols)
