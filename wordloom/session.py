"""Session helpers: building a session for tests / local runs, the shared
checkpoint folder, and size checks that gate every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of a side we are willing to ship to every executor.  Every broadcast in
# the package is behind one of these checks; beyond it the plan falls back to a
# shuffle join.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "wordloom") -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench, smoke runs)."""
    master = master or os.environ.get("WORDLOOM_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WORDLOOM_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_PKG_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ensure_worker_path(spark: SparkSession) -> None:
    """Let local Python workers import this package.

    On a cluster the package is shipped with ``--py-files`` (a zip of the
    ``wordloom`` folder); in local mode the workers get the repository root
    on their PYTHONPATH through the context's worker environment.
    """
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        return
    cur = sc.environment.get("PYTHONPATH", "")
    parts = [p for p in cur.split(os.pathsep) if p]
    if _PKG_ROOT not in parts:
        sc.environment["PYTHONPATH"] = os.pathsep.join(parts + [_PKG_ROOT])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` (or ``setCheckpointDir``) names a
    shared file system folder and is used as is.  Only when nothing is set
    (tests, local runs) a scratch folder is created.
    """
    ensure_worker_path(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="wordloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/wordloom-{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used for state that is rebuilt every round (weights, round outputs,
    epoch examples): the re-read table has a short lineage and statistics
    from its real file size.  (A checkpoint keeps the estimate of the plan
    that made it, and in a loop those estimates compound.)  ``by`` names
    partition columns, so that a filter on them reads only its own files.
    """
    path = scratch_path(df.sparkSession, name)
    write_files(df, path, by)
    # The schema is known: no file is opened to infer it.
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_files(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Write ``df`` as Parquet.  The shuffle files of the write go with its end: the table
    is read from its own files, and in a loop of rounds they would add up on the disk."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").partitionBy(*(by or [])).parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that :func:`write_table` returned, through
    Spark's own file systems (whatever store the shared folder is in)."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/wordloom-" not in name:
            continue
        cut = name.find("/", name.rfind("/wordloom-") + 1)
        path = spark._jvm.org.apache.hadoop.fs.Path(name if cut < 0 else name[:cut])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(n_rows: int, row_bytes: int,
                   max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Size gate for broadcasting a side whose row count is known."""
    return n_rows <= max_rows and n_rows * row_bytes <= max_bytes
