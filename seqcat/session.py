"""Session helpers: shared scratch space and a local session for tests/bench."""

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session.  Only in local mode, when it is
    unset (tests), a temporary folder is created and registered as the
    checkpoint dir; on a cluster a machine-local folder would not be shared,
    so an unset setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        if context.getCheckpointDir() is None:  # a running session can't set spark.checkpoint.dir itself
            context.setCheckpointDir(tempfile.mkdtemp(prefix="seqcat-ckpt-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/seqcat/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage is cut, and what is read twice is worked out once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str, which=None) -> tuple[DataFrame, int]:
    """``stored``, and the number of its rows (those where ``which`` is true), counted while they are written."""
    seen = Observation()
    rows = F.count(F.lit(1)) if which is None else F.count(F.when(which, F.lit(1)))
    return stored(df.observe(seen, rows.alias("n")), name), seen.get["n"]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: the cluster's ``spark.checkpoint.dir`` is picked up by
    Spark itself; only an unset setting in local mode gets a temporary folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        root = scratch_dir(spark, "checkpoints")
        spark.sparkContext.setCheckpointDir(root)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "seqcat") -> SparkSession:
    """A ``local[cores]`` session configured like the tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
