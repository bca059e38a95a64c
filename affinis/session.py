"""Session helpers: a local session for tests and benchmarks, and lineage cuts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, driver_memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A local session with as many shuffle partitions as cores; stages go below ``shared`` where it is given."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", shared) if shared else SparkSession.builder
    return (
        builder.master(f"local[{cpus}]")
        .appName("affinis")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, with a part of its own for this application.

    That is ``spark.checkpoint.dir`` of the session. Where it is unset, a session whose executors are threads of one
    machine uses its warehouse folder; on a cluster that folder may be one machine's own, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/affinis-{spark.sparkContext.applicationId}"


def scratch_table(spark: SparkSession, kind: str) -> str:
    """A fresh table name of this application, for stages that need a table; ``release_stages`` drops it."""
    return f"{_table_prefix(spark)}{kind}_{uuid.uuid4().hex}"


def _table_prefix(spark: SparkSession) -> str:
    return "affinis_" + re.sub("[^0-9a-z]", "_", spark.sparkContext.applicationId.lower()) + "_"


def release_stages(spark: SparkSession) -> None:
    """Deletes what this application has written to the shared folder, and its scratch tables from the catalog.

    Call it when no DataFrame that an operator returned is needed any more.
    """
    for row in spark.sql(f"SHOW TABLES LIKE '{_table_prefix(spark)}*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS `{row['tableName']}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has splits for less than half of them.

    Such an input is small; one with enough splits is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def by_id(df: DataFrame, id: str, rows: int = 5_000) -> DataFrame:
    """Rows dealt out by their id, for texts that are taken apart and summed per id: their pieces need no shuffle then.

    The partitions are as many as the session's, also where Spark would merge small ones: a text's pieces are far more
    than the text. A larger table gets more, of about ``rows`` rows each, so that a task's pieces stay as many.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // rows)), id)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    Later stages read files, so a lost executor costs no recomputation, and the columns and
    sizes of the table are known to the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
