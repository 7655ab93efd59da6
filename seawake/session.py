"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. All AIS times are UTC; AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting guards hot keys. The JVM never compiles
# a method of more than 8000 bytes: a stage whose generated code is longer runs operator by operator, twice as fast.
COMPILED_BYTES = "8000"
_SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": COMPILED_BYTES,
}


# Suggested settings for a large cluster (≈ 1000 executors, ~100 TB of positions). Shuffle
# partitions start high and AQE merges them to the advisory size; scans read 256 MB splits;
# skewed join / rebalance partitions are split at 5× the median.
CLUSTER_CONF = {
    **_SESSION_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "seawake") -> SparkSession:
    """Local session for tests and the benchmark; on a cluster use the provided session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.driver.memory", os.environ.get("SEAWAKE_DRIVER_MEM", "4g"))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in _SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC days and hours) on any session, keep generated code short enough to be
    compiled, and make the package importable by its Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (``addPyFile``).

    The pandas functions of the forest are pickled with references to ``seawake`` modules;
    workers started outside the repository (or on other machines) would not find them.
    Deployments may also pass the package with ``--py-files``; shipping twice is harmless.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="seawake-pkg-"), "seawake.zip")   # driver-side artifact
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, read from ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment to shared storage. Only when it is
    unset (local tests) do we create one, and register it so ``DataFrame.checkpoint`` works.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: executors cannot use a local one")
        d = tempfile.mkdtemp(prefix="seawake-ckpt-")   # local runs and tests only
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
