"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.runtime import ship_package

_CHECKPOINT = "spark.checkpoint.dir"
#: What a task hands to Python at once: both sides hold it, so the session's bound is lowered to this.
_BATCH, _MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the session has it. Where it is unset, a temporary folder on a single
    machine; on a cluster that is an error, as no other machine would see the folder."""
    found = spark.conf.get(_CHECKPOINT, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_CHECKPOINT} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="terrafold-")
        spark.conf.set(_CHECKPOINT, found)
    return found.rstrip("/")


class Scratch:
    """Tables of one run of an operator below the shared folder.

    A written table survives the loss of executors, unlike a cached one. ``drop`` frees a table
    that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        if bytes_of(spark.conf.get(_BATCH)) > _MOST_BYTES:
            spark.conf.set(_BATCH, str(_MOST_BYTES))
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back with the same schema (also when it has no rows)."""
        self._n += 1
        path = f"{self.root}/t{self._n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, for work that makes much of each row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that may be broadcast, and the bytes of their strings.
_FEW, _FEW_BYTES = 500_000, 16 << 20


def small(table: DataFrame, strings: str | None = None) -> DataFrame:
    """A written ``table``, to be broadcast if it is counted to be small (its column ``strings``
    too); a larger one is dealt by the join's keys."""
    size = F.octet_length(F.expr(strings)) if strings else F.lit(0)
    rows, length = table.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(table) if rows <= _FEW and length <= _FEW_BYTES else table.hint("merge")


def without(docs: DataFrame, bad: DataFrame, hashed: tuple[str, ...] = ("text",)) -> DataFrame:
    """``docs`` without the rows whose doc_id and hash (xxhash64 of ``hashed``) are in ``bad`` (doc_id, h).

    The keys are written and counted: few of them are broadcast, so that texts stay where they
    are; more go through a hashed join by key.
    """
    keys = Scratch(docs.sparkSession, "dropped").write(bad.select("doc_id", "h").distinct())
    side = keys.alias("bad")
    side = F.broadcast(side) if keys.count() <= _FEW else side.hint("shuffle_hash")
    same = F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id")) & F.xxhash64(*[f"docs.{c}" for c in hashed]).eqNullSafe(F.col("bad.h"))
    return docs.alias("docs").join(side, same, "left_anti")


#: Values that one step of ``running`` takes together.
_STEP = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def in_steps(values: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of every ``_STEP`` elements of an array, as an array."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(_STEP))
    return F.transform(starts, lambda at: use(F.slice(values, at + 1, F.lit(_STEP))))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """All leading sums (or maxima: whatever ``combine`` makes of two) of an array of longs, from 0.

    Accumulating an array copies it with every element, so that is only done within steps; what
    the steps before give is then combined with each of their elements.
    """
    none = "cast(array() as array<bigint>)"
    last = lambda found: F.coalesce(F.get(found, F.size(found) - 1), F.lit(0).cast("bigint"))
    along = lambda part: F.aggregate(part, F.expr(none), lambda acc, x: F.concat(acc, F.array(combine(last(acc), x))))

    def joined(steps: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("bigint")), along(F.transform(steps, last)))
        return let(before, lambda b: F.flatten(F.transform(steps, lambda part, i: F.transform(part, lambda x: combine(F.get(b, i), x)))))

    return let(in_steps(values, along), joined)
