"""Session settings the plans rely on, and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins here attach small keyed tables to big ones whose keys may be very
# uneven. AQE splits an oversized join partition at run time; "force" keeps it
# doing so when an aggregate on the same key follows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfsight") -> SparkSession:
    """A session for tests and single-machine runs."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # Small inputs, heavy work per row (distance joins): do not merge them into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master, where there is one machine, gets a folder of its own
    when none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfsight-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_STAGED: list[str] = []


def stage_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/shelfsight/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables this process has written. Frames over them cannot be read any more."""
    _delete(spark, _STAGED)
    _STAGED.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the stage tables written inside. Frames over them cannot be read any more."""
    before = len(_STAGED)
    try:
        yield
    finally:
        _delete(spark, _STAGED[before:])
        del _STAGED[before:]


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage where several jobs need the same intermediate result. As
    parquet it keeps column pruning and gives the optimiser true sizes, and it
    survives the loss of executors.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
