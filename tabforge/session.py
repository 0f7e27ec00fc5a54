"""Session helpers: defaults for local runs, and where lineage may be cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabforge")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, taken from ``spark.checkpoint.dir``.

    A temporary folder, removed at the end of the process, is used only when the setting is absent *and* the
    session is local; on a cluster a missing setting is an error, since executors could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    current = getattr(spark, "_tabforge_checkpoint_dir", None)
    if current is None:
        current = tempfile.mkdtemp(prefix="tabforge-checkpoint-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark._tabforge_checkpoint_dir = current
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, a folder for each value of ``by``, and read it back.

    For tables that several passes start from: each pass then scans only its columns instead of
    repeating the work that led here, and a lost executor costs a re-read.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)


_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what :func:`stored` wrote inside the ``with`` block; its results must have been read or written by then."""
    _open.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for path in map(hadoop, _open.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, for sessions whose executors do not have it."""
    context = spark.sparkContext
    if getattr(context, "_tabforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tabforge-package-")  # the driver's own: Spark serves the file from there
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/tabforge.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(f"{folder}/tabforge.zip")
    context._tabforge_shipped = True


def spread(tables: list[DataFrame], key: list[str], rows_per_task: int = 20_000) -> list[DataFrame]:
    """Repartition tables by key when the first arrives in fewer tasks than there are cores, else leave them.

    For tables that repeated compute-heavy passes read: a few large file splits would keep most
    of the cluster idle. One pass over the first table counts its rows and tasks.
    """
    first = tables[0]
    seen = first.select(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_distinct("task").alias("t"))
    size = seen.first()
    cores = max(spark_cores(first.sparkSession), 1)
    wanted = min(cores, max(1, size["n"] // rows_per_task))
    if size["t"] >= wanted:
        return tables
    return [df.repartition(wanted, *[F.col(f"`{k}`") for k in key]) for df in tables]


def spark_cores(spark: SparkSession) -> int:
    """Tasks that the session is set up for: its cores now, or its shuffle partitions where a cluster still grows."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
