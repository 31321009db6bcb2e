"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# On a cluster the shuffle partition count is only the starting point: adaptive
# execution merges small partitions and splits skewed ones at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when the frames that read them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("haulmetrics")
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; fall back to a scratch folder only locally."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="haulmetrics-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder so iterative plans stay short."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint folder and read it again.

    For a frame that many passes read: its joins run once, and a pass reads the columns that it uses.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
