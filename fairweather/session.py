"""Session and shared scratch space. The caller owns the session; nothing here is global."""

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the plans in this package rely on; all but the last two are Spark's defaults.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "fairweather", **conf: str) -> SparkSession:
    """A session with adaptive execution; keyword ``spark__x__y`` sets ``spark.x.y``.

    An active session is returned as it is: its settings belong to its owner.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder for intermediate tables, or null where none is set."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that the session names."""
    root = scratch_root(spark)
    if root is None:
        raise ValueError(
            "intermediate tables need a folder that the driver and every executor can reach: "
            "set spark.checkpoint.dir or call SparkContext.setCheckpointDir"
        )
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """The intermediate tables of one job, so that they can be removed when it is over."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame to the shared scratch folder and read it back: cuts the lineage.

        What follows is planned with the true size of the table, and a lost
        executor costs no recomputation of what came before.
        """
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def observe_write(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """:meth:`materialize`, and the values of aggregates that ride on the write.

        A task that runs twice may count twice: use them for what is zero, least,
        greatest or frequent, not as totals.
        """
        observation = Observation(f"{name}-{uuid.uuid4().hex}")
        observed = df.observe(observation, *[value.alias(key) for key, value in metrics.items()])
        return self.materialize(observed, name), observation.get

    def remove(self, *tables: DataFrame) -> None:
        """Delete these tables, or all; only when nothing that reads them will run again."""
        chosen = [p for t in tables for p in self.paths if any(p in f for f in t.inputFiles())]
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in chosen if tables else list(self.paths):
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
            self.paths.remove(path)


def materialize(df: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """:meth:`Scratch.materialize`; without ``scratch`` the table stays until the folder is cleared."""
    return (scratch or Scratch(df.sparkSession)).materialize(df, name)


def observe_write(df: DataFrame, name: str, scratch: Scratch | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """:meth:`Scratch.observe_write`; without ``scratch`` the table stays until the folder is cleared."""
    return (scratch or Scratch(df.sparkSession)).observe_write(df, name, **metrics)
