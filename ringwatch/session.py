"""Session settings and lineage cuts."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "ringwatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` names it. Where that is unset the session's warehouse
    folder is used; never a temporary folder. A warehouse on a machine's own disk is
    shared by nobody, so on a cluster it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not local and (root.startswith("file:") or "://" not in root):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {root} is one machine's own")
    return root.rstrip("/")


class Scratch:
    """Intermediate tables of one run, written to the shared checkpoint folder.

    A written table ends the lineage, survives the loss of any executor, is read
    back column by column, and gives Spark real sizes to choose joins by. Used in a
    ``with`` statement it drops its tables at the end, when results built on them must have been consumed.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_root(spark)}/ringwatch-{uuid.uuid4().hex}"
        self._count = 0

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        self._count += 1
        path = f"{self.folder}/{self._count:04d}-{label}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def drop(self) -> None:
        """Delete the tables; DataFrames built on them must be consumed by then."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def scratch_for(df: DataFrame, scratch: Scratch | None = None) -> Scratch:
    return scratch or Scratch(df.sparkSession)
