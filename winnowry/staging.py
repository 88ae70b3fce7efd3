"""Written intermediate tables: they cut lineage and survive lost executors.

A frame that several later jobs read is written once, as Parquet, to the shared
folder; the jobs then read only the columns they need.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from winnowry.session import shared_folder

_written: list[str] = []
DENSE = "zstd"  # for large tables of texts and numbers


def stage(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back; ``codec`` is Spark's by default."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/winnowry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    _written.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(table.staged_path)


def staged_so_far() -> int:
    """A mark for ``drop_staged``: what was staged before it stays."""
    return len(_written)


def settle(df: DataFrame, since: int) -> DataFrame:
    """A small result held by the driver, after which the tables staged for it are dropped."""
    rows, schema, spark = df.collect(), df.schema, df.sparkSession
    drop_staged(spark, since)
    return spark.createDataFrame(rows, schema)


def drop_staged(spark: SparkSession, since: int = 0, keep: Iterable[DataFrame] = ()) -> int:
    """Delete the tables staged by this driver after a mark; returns their number.

    For the end of a job: frames that still read a staged table must be written,
    held by the driver, or named in ``keep``.
    """
    configuration = spark._jsc.hadoopConfiguration()
    kept = {getattr(df, "staged_path", None) for df in keep}
    dropped = 0
    for name in _written[since:]:
        if name not in kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            dropped += bool(path.getFileSystem(configuration).delete(path, True))
            _written.remove(name)
    return dropped
