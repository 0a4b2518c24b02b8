"""Tables cut from their lineage, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

#: The JVM never compiles a method of more bytes of code; what is generated in one piece for a long list of rules would stay interpreted.
LIMIT, MOST_CODE = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Stages that run inside have their operators' code apart, in methods that the JVM compiles, where it would be too long in one piece; the setting is as before afterwards."""
    held = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, str(min(int(held), MOST_CODE)))
    try:
        yield
    finally:
        spark.conf.set(LIMIT, held)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a new local one in local mode (tests), and an error on a cluster, whose machines share no local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="pavestone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this library's own in the shared folder."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  (the session may have ended already; what is left is scratch)
        pass


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/pavestone/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def written(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: a lost executor costs later steps nothing.  `small`: in `small_methods`, for long lists of rules."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with small_methods(spark) if small else nullcontext():
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.pavestone_path = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Removes what `written` or `written_by_key` wrote; these tables can't be read any more."""
    for df in tables:
        if name := getattr(df, "pavestone_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        remove(df.sparkSession, df.pavestone_path)


def _forget(spark: SparkSession, table: str) -> None:
    """Takes a table out of the catalog when the driver ends, if the session is still there."""
    try:
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:  # noqa: BLE001
        pass


def written_by_key(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """Like `written`, but dealt into buckets by `key`: grouping or joining by it moves none of these rows again."""
    spark = df.sparkSession
    table, path = f"pavestone_{name}_{uuid.uuid4().hex}", new_path(spark, name)
    atexit.register(_forget, spark, table)
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    out = spark.table(table)
    out.pavestone_table, out.pavestone_path = table, path
    return out


def width(spark: SparkSession) -> int:
    """The number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
