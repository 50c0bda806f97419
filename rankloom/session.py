"""Session helpers: where lineage may be cut, and how."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rankloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Building a plan costs several times more with stack traces per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_PIECES: dict[tuple[str, str], int] = {}


def spread(scan: DataFrame, path: str) -> DataFrame:
    """Use all cores where a scan has fewer pieces than there are cores.

    One file with one row group is one task however large it is. Tables that
    come in enough pieces, as any large one does, are left alone. Call it on a
    plain scan: projections and filters still move below the repartition. The
    number of pieces is looked up once per application and path.
    """
    context = scan.sparkSession.sparkContext
    key = (context.applicationId, path)
    if key not in _PIECES:
        _PIECES[key] = scan.rdd.getNumPartitions()
    cores = context.defaultParallelism
    return scan.repartition(cores) if 2 * _PIECES[key] < 3 * cores else scan


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="rankloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def settle(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from the written copy."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame, *folders: str) -> DataFrame:
    """As settle, but columnar: later reads prune columns and push filters. `folders`: last columns, a folder for each value."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """For jobs that run within: batches of about `size` bytes go to Python, however long the texts are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)
