"""Session construction and the few session-level settings the operators rely on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# A side of a join is broadcast only if its measured bytes stay under this bound.
BROADCAST_BYTES = 32 << 20

# Settings every job wants, on a laptop or on a 1000-executor cluster.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Column pruning into nested structs (JSON payloads, digest rows).
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "newslake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's base settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the cluster manager
    supplies the master and AQE coalesces shuffle partitions from the cluster default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings whose values change results (day boundaries)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Rows that travel to a Python worker at a time: texts may be long, and what a batch holds exists several times.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """What the Python parts of the operators need: the package in the workers, and batches of at most ``BATCH_ROWS``."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers where they would not find it by themselves.

    They do if the driver runs in the package's folder or has it in PYTHONPATH (the usual case, and what
    ``--py-files`` is for); else Spark distributes a zip of it, once per application.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or os.path.realpath(root) in map(os.path.realpath, filter(None, found)):
        return
    name = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "newslake"), "zip", root, "newslake")
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, as a cluster names it). Only when it is
    unset on a local master -- tests and local runs -- a fresh folder is created and registered;
    on a cluster a missing setting is an error, since executors do not share local disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no SparkContext on this client (e.g. Spark Connect)
        sc = None
    root = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="newslake-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the checkpoint root for one job's written table; ``drop_scratch`` deletes it."""
    root = checkpoint_root(spark)
    token = os.urandom(6).hex()
    path = f"{root.rstrip('/')}/newslake/{name}-{token}"
    _SCRATCH.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch() -> None:
    """Delete what stands under the paths of ``scratch_path`` and ``materialize``: call it when their readers are done.

    Runs by itself at the end of the driver process, while its session is still up.
    """
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 -- the session is gone; its shared folder is cleaned by its owner
            return


atexit.register(drop_scratch)


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table under the checkpoint folder and read it back.

    This cuts the lineage (a lost executor recomputes nothing upstream) and computes the
    plan exactly once, unlike an uncached ``checkpoint()``, which runs it twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
