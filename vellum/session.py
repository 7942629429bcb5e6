"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vellum")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else the checkpoint folder that the context was given.

    A folder of our own is made only in a local session that names none (tests); a
    cluster without a shared folder is an error, never a machine's own folder.
    """
    global _own
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _own = _own or tempfile.mkdtemp(prefix="vellum-")
        folder = _own
    return folder.rstrip("/")


_own: str | None = None


_kept: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, below one folder of this application that goes when its driver ends."""
    own = f"{shared_folder(spark)}/vellum/{spark.sparkContext.applicationId}"
    if own not in _kept:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _kept.add(own)
    return f"{own}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a table written to the shared folder and read again: lineage ends here, rows are computed once.

    Unlike checkpoint() it computes nothing twice and later readers take only the
    columns they need. A lost executor loses nothing of it. Tables go when the driver ends.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
