"""Session settings, the shared folder for cut lineage, and skew-safe joining."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", name: str = "grainmill", **conf: str) -> SparkSession:
    """A local session with the settings the library is tuned for; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) is a temporary folder made and set.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="grainmill-")
    sc.setCheckpointDir(made)
    return sc.getCheckpointDir() or made


_WRITTEN: list[str] = []


def drop_written(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written for this program, and say how many.

    Call it once the results that were built on them have been written elsewhere: a DataFrame still reads its tables.
    """
    n = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def materialize(df: DataFrame, what: str = "t") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts the lineage so that a lost executor costs no recomputation of what came before, and gives the planner
    true sizes. Nothing is held in executor memory.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/grainmill-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot when it holds more than this share of all rows; there are at most 1/share of them, so they can be broadcast.
HOT_SHARE = 1 / 2000


def hot_split_join(rows: DataFrame, lookup: DataFrame, key: str, n_col: str, how: str = "inner", keep_key: bool = True) -> DataFrame:
    """Join many rows with a lookup that has one row per key, where any key may hold a third of all rows.

    ``lookup`` carries in ``n_col`` how many rows each key has. The rows of a key above HOT_SHARE of the total are
    salted into parts of that size, and its lookup row is repeated for each part, so no task receives a hot key. Only
    the hashes of hot keys with their numbers of parts are broadcast: fewer than 1/HOT_SHARE pairs of numbers, whatever
    the data and however large a lookup row is. (Keys of equal hash are salted alike, which changes no result.)
    ``rows`` is evaluated once. ``how`` is inner or left. Pass a ``lookup`` that is cheap to read twice (a written
    table). Without ``keep_key`` the key isn't part of the result. Null keys find nothing and are spread.
    """
    value = [c for c in lookup.columns if c not in (key, n_col)]
    limit = max(1.0, (lookup.agg(F.sum(n_col)).first()[0] or 0) * HOT_SHARE)
    hot = lookup.where(F.col(n_col) > limit).groupBy(F.xxhash64(key).alias("_hk")).agg(F.max(F.ceil(F.col(n_col) / limit)).alias("_parts"))
    spread = F.xxhash64(*rows.columns)
    salt = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(99_991))).when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts"))).otherwise(F.lit(0))
    salted = rows.join(F.broadcast(hot), F.xxhash64(key) == F.col("_hk"), "left").select(*rows.columns, salt.cast("int").alias("_salt"))
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)).cast("int") - 1)).alias("_at")
    found = lookup.select(F.col(key).alias("_key"), F.struct(*value).alias("_value")).join(F.broadcast(hot), F.xxhash64("_key") == F.col("_hk"), "left").select("_key", "_value", each)
    joined = salted.join(found.hint("shuffle_merge"), (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_at")), how)
    return joined.select(*[c for c in rows.columns if keep_key or c != key], *[F.col("_value")[c].alias(c) for c in value])


def ratio_bucket(*cols: Column | str, n: int) -> Column:
    """An even bucket number in [0, n) by hash, for spreading hot groups."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


__all__ = ["HOT_SHARE", "drop_written", "hot_split_join", "local_session", "materialize", "ratio_bucket", "shared_folder"]
