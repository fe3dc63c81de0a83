"""What the operators share: input columns, words, packed numbers and shared files."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sheafline
from sheafline.session import shared_dir

#: A word is a longest run of characters other than ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"


#: By application: the driver's folder that holds the archive while Spark serves it.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Spark serves the archive from the driver, so executors need no copy of the
    package and no shared folder for it.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(sheafline.__file__).parent
    folder = _shipped[application] = tempfile.TemporaryDirectory()
    archive = os.path.join(folder.name, "sheafline-sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text) of a table; a null text is an empty one, other columns are left behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def word_array(text: Column) -> Column:
    """The words of a text as an array without empty ones."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is executed in here removes its shuffle files at its end; the session's setting is as before afterwards."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back: its lineage ends there.

    The shuffle files of the writing go with it; else they stay on disk until the
    driver happens to collect its garbage, those of all steps together.
    """
    path = shared_dir(df.sparkSession, name)
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(rows: DataFrame, key: str, bits: int) -> Column:
    """The keys of a table (long numbers) as one array of ``bits`` bits, whatever their number.

    A scalar subquery of fixed size. ``may_hold`` tests a key against it: all keys of
    the table pass, of others few as long as the bitmap is sparse.
    """
    place = F.col(key).bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    set_bits = rows.groupBy(F.shiftright(place, 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = rows.sparkSession.range(bits // 64).join(set_bits, "id", "left")
    line = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(line["bits"]).scalar()


def may_hold(found: Column, key: Column, bits: int) -> Column:
    """Whether a key's bit is set in a bitmap of that size."""
    place = key.bitwiseAND(F.lit(bits - 1))
    word = F.get(found, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


#: Rows of one key from which on they are spread, and over how many tasks.
HOT_ROWS = 200
HOT_SALTS = 64
_HOT_BITS = 1 << 16


def with_first(rows: DataFrame, keys: list[str], doc: str = "doc_id") -> DataFrame:
    """``rows`` with ``first``, the smallest ``doc`` among the rows that are equal in ``keys``.

    The smallest are found by partial sums. For the way back, a key of many rows is
    salted: its rows go to HOT_SALTS tasks, and so does a copy of its one answer. Which
    keys are hot is looked up in a bitmap of fixed size; a key that shares the bit of a
    hot one is salted too, which changes nothing in the result.
    """
    key = F.xxhash64(*keys)
    firsts = rows.groupBy(*keys).agg(F.min(doc).alias("first"), F.count("*").alias("_rows"))
    firsts = checkpointed(firsts, "firsts")
    hot = may_hold(bitmap(firsts.filter(F.col("_rows") > HOT_ROWS).select(key.alias("key")), "key", _HOT_BITS), key, _HOT_BITS)
    salt = F.when(hot, F.pmod(F.xxhash64(doc), F.lit(HOT_SALTS)).cast("int")).otherwise(0)
    every = F.when(hot, F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    answers = firsts.select(*keys, "first", F.explode(every).alias("_salt"))
    return rows.withColumn("_salt", salt).join(answers, [*keys, "_salt"]).drop("_salt")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow that gives the memory of its batches back at the end of a task.

    Workers wait for the next task, maybe of another stage, and Arrow would keep that memory meanwhile.
    """

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return through


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and flat int64 values of an Arrow list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
