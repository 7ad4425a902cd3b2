"""What the operators share: the shared folder, written tables and joins that survive a hot key."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: A hot key is dealt over so many places.
SALTS = 16


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset and Spark runs on one machine, one of our own."""
    if not (path := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="firn-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Paths that were made outside of any `scratch` and not yet cleared.
_MADE: list[str] = []
#: Paths made in the scratches that are open, innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open scratches", default=())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (_OPEN.get() or (_MADE,))[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and lost executors cost no recomputation. The table goes with
    the innermost open `scratch`, or by `clear`."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside are deleted at the end, and no others. What the block gives back must be written by the function
    that it gets: keep(df, name) is `written` for the level outside."""
    own: list[str] = []
    outside = _OPEN.get()
    token = _OPEN.set((*outside, own))

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _OPEN.set(outside)
        try:
            return written(df, name)
        finally:
            _OPEN.reset(inner)

    try:
        yield keep
    finally:
        _OPEN.reset(token)
        _delete(spark, own)


def clear(spark: SparkSession) -> None:
    """Delete all tables written outside of scratches so far. Results of them that were not used by then cannot be read any more."""
    _delete(spark, _MADE)


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], spread: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join rows of which any share may have the same key to a table with one row a key.

    Rows of a key go to `salts` places by `spread`; each row of `one` is repeated for each place. Neither side is broadcast.
    """
    many = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    one = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(one.hint("merge"), [*keys, "_salt"], how).drop("_salt")


_CACHES: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """What a Python worker keeps for one operator. What it kept for others goes, since workers outlive stages."""
    for other in [k for k in _CACHES if k != name]:
        del _CACHES[other]
    return _CACHES.setdefault(name, {})


def stripped(text: Column) -> Column:
    """The text without any of SPACES; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")
