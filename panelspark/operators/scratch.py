"""Staged tables in the shared checkpoint folder, freed once their successors are written.

``staged`` writes a table and has Spark drop the shuffle files of that write as
soon as it is done: nothing reads them again, since later jobs read the table.
``free`` deletes staged tables by way of Hadoop's file systems; call it only
when whatever reads them has itself been written, so that a lost executor
never needs them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.session import scratch_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once under the shared folder; read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        w = df.write.option("compression", compression)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` returned."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._staged_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
