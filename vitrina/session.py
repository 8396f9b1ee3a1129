"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for the merge and aggregation jobs at any scale.
# AQE re-plans joins from real shuffle sizes (broadcast when a side turns out
# small, split skewed partitions of sort-merge joins) and coalesces tiny
# shuffle partitions; whole-stage codegen stays on by default.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "vitrina",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/vitrina-checkpoints") -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset
    and the master is local (tests) is a folder of our own set; on a cluster
    that would be one machine's disk, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or fallback)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder (never machine-local
    on a cluster, because the checkpoint folder is the shared one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """A write in this block removes its shuffle files when it ends. Nothing
    reads them again, but Spark keeps them until the driver's garbage
    collector finds them unused, so a job of many writes holds the shuffles of
    all on disk at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df):
    """The frame, computed once, written to the shared checkpoint folder as
    columns and read again: its plan ends there, and a lost executor takes
    nothing with it. Rows are neither kept in memory nor written twice, as a
    checkpoint of a persisted frame does, and readers take the columns that
    they need."""
    from pyspark.sql import types as T
    path = scratch_path(df.sparkSession, "cut")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors' Python workers, once a session, so that functions of it that run
    there are found wherever the driver was started. (Under spark-submit --py-files they are there already.)"""
    import tempfile
    import zipfile
    from pathlib import Path
    sc = spark.sparkContext
    if getattr(sc, "_vitrina_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = f"{tempfile.mkdtemp(prefix='vitrina-')}/vitrina.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(target)
    sc._vitrina_shipped = True
