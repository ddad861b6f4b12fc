"""Session construction and the few run-time helpers every operator shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on for right results; cluster sizing is left to the deployment.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = 8, partitions: int = 8, app: str = "lexigrove") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Only a local master may go without that setting; it gets a temporary folder. On a cluster a missing setting raises RuntimeError,
    since a folder of one machine would not outlive it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        path = "file://" + tempfile.mkdtemp(prefix="lexigrove-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_MADE: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; `release` removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.add(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _MADE.discard(path)


def release(spark: SparkSession) -> int:
    """Delete all scratch folders made so far; results that read them must have been written before. Returns their number."""
    made = list(_MADE)
    for path in made:
        remove(spark, path)
    return len(made)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage; survives the loss of any executor.

    Spark removes the files when nothing refers to them any more, where spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
