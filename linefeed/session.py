"""Session construction and the shared scratch locations.

Production jobs receive their ``SparkSession`` from the cluster; the
helpers here only fill in what a local run (tests, ``bench.py``) lacks.
Lineage is cut with ``DataFrame.checkpoint()`` into the folder the
cluster names in ``spark.checkpoint.dir``; only a local master may fall
back to a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session should carry; AQE is what turns an oversized
# shuffle into coalesced partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of collected DataFrames are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for the production cluster (~100 TB, ~1000 executors).  Shuffles
# start from many partitions and AQE coalesces them to ~256 MB each, so a
# 100 TB shuffle never runs with partitions that do not fit an executor;
# skew splitting starts at 512 MB; scans read 512 MB splits; stragglers are
# re-launched.  (Streams set their state store themselves.)
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if not k.startswith("spark.ui.")},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.speculation": "true",
}


def apply_cluster_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ``CLUSTER_CONF`` where the cluster left it unset.

    Static settings (speculation, the checkpoint cleaner) belong on the
    submit command line; they are skipped here.
    """
    for key, value in CLUSTER_CONF.items():
        if not spark.conf.isModifiable(key):
            continue
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", app: str = "linefeed",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session with the defaults above (tests and benchmarks)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode.

    On Spark Connect the server's ``spark.checkpoint.dir`` is used as it is.
    """
    sc = _context(spark)
    if sc is None:
        return spark.conf.get(CHECKPOINT_CONF, None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder for checkpoints")
        configured = tempfile.mkdtemp(prefix="linefeed-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _staging_folder(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; staging needs a shared folder")
    sc = _context(spark)
    return f"{base}/linefeed-staging/{sc.applicationId if sc is not None else 'connect'}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application under the shared checkpoint location."""
    return f"{_staging_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clean_staging(spark: SparkSession) -> None:
    """Delete what this application has staged; call it when none of its DataFrames is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_staging_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
