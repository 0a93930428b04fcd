"""Session helpers: a tuned builder for local runs and the checkpoint folder rule."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "rampart") -> SparkSession:
    """Session used by tests and the bench.

    On a cluster the caller's own session is used instead; these settings are
    the ones the library assumes: AQE on (coalescing + skew join), UTC session
    zone so naive timestamps compare equal to other engines, no UI server.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is named.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we always
    read it from the session.  Only when it is unset in a local session (tests, the bench) do we
    make a fresh folder of our own; elsewhere that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="rampart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


TASK_ROWS = 1 << 20      # rows that one task sorts or holds in a hash table


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows: the session's number, or more where a task
    would get more than ``TASK_ROWS``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs started here shuffle into ``n`` partitions, which are not merged again by
    their bytes (values of a few bytes are many rows); the session's choice comes back after."""
    ours = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write a table as Parquet under the checkpoint folder and read it back:
    lineage ends there, and a lost executor costs only its running tasks.  With
    ``partitions`` the shuffles of ``df`` have so many."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffle_partitions(spark, partitions) if partitions else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
