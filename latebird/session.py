"""Session settings for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Set to true where a `file:` checkpoint folder is one that all machines mount.
MOUNTED = "spark.latebird.checkpoint.mounted"

_shipped: set[str] = set()

#: The most bytes of a file that one task reads where files are dealt out singly.
_FILE_BYTES = "128m"

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "latebird") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to a temporary folder: on a cluster a
    folder of the driver's machine would be invisible to the executors. For the
    same reason a cluster's `file:` folder raises, unless the session says that
    it is mounted on every machine (`MOUNTED`).
    """
    local = spark.sparkContext.master.startswith("local")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not local and configured.startswith("file:") and spark.conf.get(MOUNTED, "") != "true":
            raise ValueError(f"{configured} is a machine's own folder; if it is mounted, set {MOUNTED}")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="latebird-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, as `--py-files` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="latebird-py-"), "latebird.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/latebird/{name}-{uuid.uuid4().hex}"


def stage_table(
    df: DataFrame, name: str, by: Sequence[str] = (), rows: int | None = None
) -> tuple[DataFrame, str]:
    """Write `df` to the shared folder and read it back: the lineage starts at
    the written files, so a lost executor costs a re-read and nothing else.
    `by`: columns of few values whose filters then skip files; they come last.
    `rows`: the most rows that a task reads back. Without it a task reads
    megabytes of files, and these say little about the size of the rows in memory."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*by)
    if rows is None:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path
    writer.option("maxRecordsPerFile", rows).parquet(path)
    return _read_by_file(spark, df.schema, path), path


def _read_by_file(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """Parquet files of less than `_FILE_BYTES`, each read by a task of its own. How
    files are dealt to tasks is a setting of the session that reads them, so a
    session beside the caller's does, with otherwise the same settings."""
    reader = spark.newSession()
    known = reader.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value:
            reader.conf.set(key, value)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        reader.conf.set(key, _FILE_BYTES)
    name = f"latebird_{uuid.uuid4().hex}"
    reader.read.schema(schema).parquet(path).createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def storage_bytes(spark: SparkSession) -> int:
    """Bytes that the executors now running can keep of tables, as Spark reports them;
    the driver's count only where it is the executor, in a local session."""
    context = spark.sparkContext
    reported = context._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        context._jsc.sc().getExecutorMemoryStatus()
    )
    by_address = {address: reported[address]._1() for address in reported}
    if len(by_address) > 1:
        driver = context._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId()
        by_address.pop(driver.hostPort(), None)
    return sum(by_address.values())


def _delete(jvm, configuration, path: str) -> None:
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(configuration).delete(hadoop_path, True)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a table written by `stage_table`."""
    drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that the session reaches."""
    context = spark.sparkContext
    _delete(context._jvm, context._jsc.hadoopConfiguration(), path)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this package when the driver program ends."""
    if "/latebird/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    context = spark.sparkContext
    jvm, configuration = context._jvm, context._jsc.hadoopConfiguration()

    def drop() -> None:
        try:
            _delete(jvm, configuration, path)
        except Exception:  # the JVM is gone; the folder stays
            pass

    atexit.register(drop)
