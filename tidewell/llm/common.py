"""Helpers that the training-data operators share."""

from __future__ import annotations

import sys
import threading
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A run of code points that are not ASCII white space is a word.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by exact spelling and position.

    Extra columns never matter, even when their names differ from the wanted
    ones only in case or occur twice; the first exact match is taken.
    """
    have = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(have))])
    return flat.select(*[F.col(f"c{have.index(n)}").alias(n) for n in names])


def slices(batches, rows: int = 512):
    """Arrow batches of at most ``rows`` rows: what Python makes of one batch stays small.

    At the end the worker, which later tasks use again, gives freed memory back.
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    trim()


def sized_slices(batches, column: int, rows: int = 1024, limit: int = 4 << 20):
    """Arrow batches of at most ``rows`` rows and, but for a single longer text, ``limit`` bytes in a column of texts."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            room = limit + (ends[at - 1] if at else 0)
            to = max(at + 1, min(at + rows, int(np.searchsorted(ends, room, "right"))))
            yield b.slice(at, to - at)
            at = to
    trim()


def sent(spark: SparkSession, model):
    """A broadcast of a model that workers without this package can read, with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(broadcast):
    return cloudpickle.loads(broadcast.value)


def trim() -> None:
    """Return freed heap to the system, where the C library can."""
    import ctypes

    free = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if free is not None:
        free(0)


def release(spark: SparkSession) -> None:
    """Let the driver forget plans that nothing uses any more.

    The relations that were broadcast for them and the files of their shuffles
    stay until the driver's JVM collects its garbage, which it puts off while it
    can grow.
    """
    import gc

    gc.collect()  # Python holds the JVM's plans
    spark._jvm.System.gc()
    trim()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in ``spark.checkpoint.dir``.

    Where it is unset a local run takes one under /tmp; on a cluster it is an
    error, as no folder of one machine would do.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or "file:///tmp/checkpoints/tidewell")
    return sc.getCheckpointDir().rstrip("/")


class _Written(threading.local):
    """Paths of the tables that a thread wrote, in order: calls on other threads neither count nor delete them."""

    def __init__(self):
        self.paths: list[str] = []


_TABLES = _Written()


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _TABLES.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many tables this thread has by now, for ``discard``."""
    return len(_TABLES.paths)


def discard(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the tables that this thread wrote since a mark, but for the last ``keep``. Nothing may still be read from them."""
    last = len(_TABLES.paths) - keep
    for path in _TABLES.paths[since:last]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    del _TABLES.paths[since:last]


def broadcastable(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint, but only when the table was counted to hold at most ``rows`` rows.

    ``df`` must be cheap to count (a materialised table); larger ones stay
    plain, so the optimizer shuffles them and splits skewed keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of an undirected graph, labelled by their smallest node.

    ``edges`` has long columns ``a`` and ``b``. Returns ``node, root`` for every
    node that has an edge. Alternates large-star and small-star steps until the
    edge set is a star forest, which is asked before each round, so none is made
    only to see that nothing changes; each step is two aggregations over edges, its
    result is written to the shared folder, and only a count comes to the
    driver. A hub's neighbours are never gathered: stars
    need no more than the minimum over them, and the joins are left to
    adaptive execution, which splits a hub's partition.

    Null nodes and self loops are ignored, repeated edges count once, no edges
    give no rows.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        hung = both.join(low, "a")
        if large:
            out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def done(e: DataFrame) -> bool:
        """Whether every node hangs on one other node at most, and on none that hangs itself."""
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("hangs")).unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("hangs")))
        each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("least"))
        return not each.agg(F.count_if((F.col("hangs") > F.lit(1)) | (F.col("hangs") > F.col("least")))).first()[0]

    spark = edges.sparkSession
    since = mark()
    cur = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    rounds = 0
    while not done(cur):
        if rounds == max_rounds:
            raise RuntimeError(f"no star forest after {max_rounds} rounds")
        cur = materialize(star(star(cur, True), False))
        discard(spark, since, keep=1)
        rounds += 1
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
