"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, as the word rule of the operators has it.
WHITE = " \t\n\v\f\r"
#: A third of the labelled rows is kept out of every fit: those with this remainder.
FOLDS, HELD_OUT = 3, 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode with none set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tallystone-')}"
        spark.sparkContext.setCheckpointDir(found)
    return str(found).rstrip("/")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts reach Python in batches of this many rows for the rest of the session, unless fewer are set."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > rows:
        spark.conf.set(name, str(rows))


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_FOLDERS: dict[int, tuple[weakref.ref, str]] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors. The folder goes when the
    driver's JVM ends, or with `discard`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallystone-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at, files = _files(spark, path)
    files.deleteOnExit(at)
    again = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[id(again)] = (weakref.ref(again, lambda _, key=id(again): _FOLDERS.pop(key, None)), path)
    if _TEMPORARY:
        _TEMPORARY[-1].append(again)
    return again


_TEMPORARY: list[list[DataFrame]] = []


@contextlib.contextmanager
def temporary() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What `materialize` writes inside goes at the end, but for frames that are passed to what this gives."""
    kept: list[DataFrame] = []
    _TEMPORARY.append([])
    try:
        yield lambda frame: kept.append(frame) or frame
    finally:
        held = _TEMPORARY.pop()
        discard(*(frame for frame in held if not any(frame is k for k in kept)))




def discard(*frames: DataFrame) -> None:
    """Delete what `materialize` wrote for these frames, which nothing reads any more."""
    for frame in frames:
        kept = _FOLDERS.pop(id(frame), None)
        if kept and kept[0]() is frame:
            at, files = _files(frame.sparkSession, kept[1])
            files.delete(at, True)
            files.cancelDeleteOnExit(at)


def quoted(name: str) -> str:
    """A column's name that may hold dots, as DataFrame functions want it."""
    return f"`{name.replace('`', '``')}`"


def unnamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ... and the new name of each, so that no name can clash with a made one."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at


def extended(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]], fields: list[T.StructField], without: tuple[str, ...] = ()) -> DataFrame:
    """docs with new columns that `run` makes from Arrow batches, whose columns are named as `unnamed` does. Columns of
    docs with the names of new ones are replaced; `without` are read but not returned."""
    made = {f.name for f in fields}
    plain, at = unnamed(docs)
    kept = [n for n in docs.columns if n not in made and n not in without]
    wanted = [at[n] for n in docs.columns if n not in made or n in without]
    rows = plain.select(*wanted)
    schema = T.StructType([*(rows.schema[at[n]] for n in kept), *(T.StructField(f"made{i}", f.dataType) for i, f in enumerate(fields))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, columns in run(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(at[n]) for n in kept), *columns], names=schema.names)

    small_batches(docs.sparkSession)
    return rows.mapInArrow(whole, schema).toDF(*kept, *(f.name for f in fields))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo the number of folds; null keys are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")


def spread(key: Column, seed: int) -> Column:
    """A pseudo-random long in [0, 2^32) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 32))


def lookup(rows: DataFrame, facts: DataFrame, key: str, weight: str, heavy: int = 1000) -> DataFrame:
    """Inner join of rows with one row of facts per key, safe when one key holds a third of the rows.

    weight: the column of facts that counts the rows of a key. Keys with at least 1/heavy of all rows are at
    most `heavy`, which bounds what is broadcast; all others are joined by a shuffle, where none can be hot.
    """
    total = facts.agg(F.sum(weight)).first()[0] or 0
    hot = facts.where(F.col(weight) * heavy >= F.lit(total))
    cold = facts.where(F.col(weight) * heavy < F.lit(total))
    hot_keys = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(hot_keys, key, "left_anti").join(cold.hint("shuffle_merge"), key))


_CLAIMS: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """A Python worker serves many tasks: whoever starts to use its cache here empties those of other operators."""
    if others := [x for x in _CLAIMS if x != name]:
        for other in others:
            _CLAIMS.pop(other)()
        release()
    _CLAIMS[name] = clear


def release() -> None:
    """Give freed memory back to the system, which the allocators else keep for later."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
