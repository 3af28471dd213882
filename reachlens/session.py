"""Spark session defaults and the shared checkpoint folder.

Every operator in the package is a DataFrame -> DataFrame function; this module
only provides a session with the settings the operators assume (UTC session
time zone, adaptive execution with skew-join splitting) and resolves the
checkpoint folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even if an aggregate above needs one more shuffle for it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "reachlens",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable by Python workers on every executor
    (``addPyFile`` of a zip built once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="reachlens-pkg-"), "reachlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder used by ``DataFrame.checkpoint``.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local-mode session without the setting (tests, laptop
    runs) gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it "
            "(checkpoints must survive the loss of an executor)")
    scratch = tempfile.mkdtemp(prefix="reachlens-ckpt-",
                               dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows of a frame that is fitted many times over, in one task, before there are more tasks than cores.
FIT_ROWS = 2_000_000


def fit_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of ``stored_for_fit`` for so many rows, at most."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // FIT_ROWS))


def stored_for_fit(df):
    """``df`` stored for a fit of many rounds, each of which starts every partition's task anew: no more partitions than
    cores (one for every ``FIT_ROWS`` rows, if that is more), so that what tasks cost and send to the driver does not
    grow with the partitions the rows came in. Fewer partitions stay as they are."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.checkpoint()
    return rows.coalesce(fit_partitions(df.sparkSession, rows.count()))


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: later consumers prune columns and push filters into it, and the
    lineage is cut (a lost executor re-reads the files instead of recomputing
    the inputs)."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
