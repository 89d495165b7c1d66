"""Session helpers: building a session for tests/benchmarks and finding the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app: str = "roundstats") -> SparkSession:
    """Session for tests and benchmarks (a cluster job brings its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Checkpoint files go away with the frames that use them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting). Library code never invents one: on a
    cluster it must be a shared folder, so a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(a shared filesystem) so iterative operators can cut lineage reliably")


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """Like :func:`checkpoint_dir`, but tests/benchmarks (``allow_local``)
    may set a fresh scratch folder when the session has none -- and only on a
    local master: a cluster must name a shared folder."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not allow_local or not spark.sparkContext.master.startswith("local"):
            raise
    d = tempfile.mkdtemp(prefix="roundstats-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d
