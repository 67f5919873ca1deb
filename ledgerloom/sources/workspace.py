"""Written tables: how lineage is cut and how small reference data becomes measurable.

Everything lands under the shared folder the cluster names in ``spark.checkpoint.dir``, so a lost
executor costs only the tasks it was running. A private folder is made only where that setting is
missing, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a shared folder on a cluster")
        _local_roots[app] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/ledgerloom/{label}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Store a relation as Parquet and return the stored relation.

    A partitioned table is rebalanced first: every task would otherwise write a file into every
    partition, while rebalancing still splits a partition that holds much of the data.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write to a new folder under the shared root and read it back."""
    return write_table(df, fresh_path(df.sparkSession, label))
