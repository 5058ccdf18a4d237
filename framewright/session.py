"""Session helpers: a local builder for tests and benches, and checkpoint storage that outlives executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "framewright") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("FRAMEWRIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that checkpoints go to.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is used as it is.  Only where nothing is
    named (tests, one machine) a temporary folder is set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="framewright-ckpt-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that what follows neither recomputes it nor loses it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Output:
    """A file to write bytes to, wherever the path's file system is: what ``zipfile`` and others take as a file."""

    def __init__(self, spark: SparkSession, path: str, at_once: int = 1 << 20):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
        self.held, self.at_once = bytearray(), at_once

    def write(self, data: bytes) -> int:
        self.held += data
        if len(self.held) >= self.at_once:
            self.flush()
        return len(data)

    def flush(self) -> None:
        if self.held:
            self.stream.write(self.held)
            self.held = bytearray()

    def __enter__(self) -> Output:
        return self

    def __exit__(self, *_: object) -> None:
        self.flush()
        self.stream.close()


_HELD: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, what: str = "table") -> str:
    """A path of its own in the checkpoint folder, removed by ``release`` or when the program ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/framewright-{what}-{uuid.uuid4().hex}"
    _HELD.append((spark, path))
    return path


def store(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder and read again: smaller there than a checkpoint."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def release() -> None:
    """Removes every table that was stored so far: to be called when the results that read them are written."""
    while _HELD:
        spark, path = _HELD.pop()
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001 - the session may be gone by now
            continue
