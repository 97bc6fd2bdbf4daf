"""Spark session helpers.

Cluster settings come from ``spark-submit``; the helpers below only fill in
what is unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on. AQE re-plans joins and coalesces shuffle output at
# runtime; skew-join splitting covers hot (site, GL) keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "yieldcast", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster they
    come from the submit configuration and should be left ``None``.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs everything in the driver JVM
            conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A session on a local master may leave it unset (tests, local bench): a
    scratch folder is created, registered, and removed when Python ends. On a cluster the setting
    must point at shared storage, so that checkpoints survive lost executors; without it this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="yieldcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df, paths: list[str] | None = None):
    """``df`` written once into the shared folder and read back; a lost executor costs a reread.

    A checkpoint would carry the plan's size estimates and constraints along, which multiply in loops. ``paths`` gets the
    folder, for tables that their maker removes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``yieldcast`` importable on executors (for mapInPandas closures).

    A zip of the package is written once per application into the shared
    checkpoint folder and registered with ``addPyFile``; on a cluster that
    was started with the package on ``--py-files`` this is a no-op re-add.
    """
    import io
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    folder = checkpoint_dir(spark)
    name = f"yieldcast-{app}.zip"
    if "://" in folder and not folder.startswith("file:"):
        # shared storage (hdfs://, s3a://, ...): write through the Hadoop FileSystem API
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(folder, name)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(hpath, True)
        try:
            out.write(bytearray(buf.getvalue()))
        finally:
            out.close()
        path = hpath.toString()
    else:
        path = os.path.join(folder.replace("file://", "").replace("file:", ""), name)
        with open(path, "wb") as fh:
            fh.write(buf.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
