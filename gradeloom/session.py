"""Session helpers: tables, lineage cuts, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it was counted and has at most this many rows, and its rows have a bounded width.
BROADCAST_ROWS = 200_000
#: Rows of one key beyond which a join spreads them over several tasks.
HOT_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Where it is unset, a new local one, but only if
    the session itself is local; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gradeloom-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df once as a table in the shared folder and read it back: the lineage ends there and every later
    pass reads the same rows, also after an executor was lost. The schema is kept, so an empty df works."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._cut_path = path
    _MADE.append(path)
    return back


#: Tables that cut() wrote in this process and that are still there.
_MADE: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _MADE:
        _MADE.remove(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the table behind a cut() that nothing reads any more."""
    path = getattr(df, "_cut_path", None)
    if path:
        _delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that cut() writes inside are deleted at the end. Results are lazy, so write or collect them inside."""
    before = set(_MADE)
    try:
        yield
    finally:
        for path in [p for p in _MADE if p not in before]:
            _delete(spark, path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it was counted to have at most `rows` rows, else df itself (then a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """many joined with one (a row per `key`), however often a key occurs in many: keys are counted, and those with more
    than hot_rows rows are cut into parts by a hash of the column `by`, with a copy of their row of one for each. All other
    rows are neither copied nor moved otherwise than by the join itself."""
    hot = cut(many.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_parts")), "hot")
    if hot.isEmpty():
        return many.join(one, key, how)
    part = F.pmod(F.xxhash64(by), F.coalesce("_parts", F.lit(1))).cast("int")
    left = many.join(small(hot), key, "left").withColumn("_part", part).drop("_parts")
    right = one.join(small(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [key, "_part"], how).drop("_part")
