"""Shared steps of the training-data operators."""

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Word separators are the ASCII white space characters; no word holds any of them.
BLANK = " \t\n\r\v\f"
_FOLD = bytes(range(65, 91)), bytes(range(97, 123))
LOWER_ASCII = bytes.maketrans(*_FOLD)
Rows = Callable[[dict[str, list]], dict[str, list]]
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal rows out over all cores when the files give fewer splits than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _give_back() -> None:
    """Hand memory that nothing holds any more back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def tidy(run: Batches) -> Batches:
    """``run`` for ``mapInArrow``, giving back what its task freed.

    Spark keeps Python workers for later tasks, and the C library keeps what they freed for them; in
    an executor of many workers that adds up. It is given back before a task begins and after it ends.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


def map_columns(df: DataFrame, reads: list[str], adds: T.StructType, work: Rows, keep: list[str] | None = None) -> DataFrame:
    """Add columns worked out batch by batch in Python.

    ``work`` gets the columns ``reads`` as lists and returns the columns ``adds``.
    ``keep`` names the columns of ``df`` that stay (all by default); added columns
    replace those of the same name.
    """
    new = set(adds.names)
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    passed = list(dict.fromkeys([*keep, *reads]))
    source = df.select(*[F.col(f"`{c}`") for c in passed])
    schema = T.StructType([f for f in source.schema.fields if f.name in keep] + adds.fields)
    arrow = to_arrow_schema(adds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, reads):
                got = work({c: part.column(c).to_pylist() for c in reads})
                arrays = [part.column(c) for c in keep] + [pa.array(got[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, names=keep + list(adds.names))

    return source.mapInArrow(tidy(run), schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def judged_rows(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], keep: F.Column, adds: list[str]) -> DataFrame:
    """The rows of ``docs`` that ``keep`` holds for, once ``operator`` has added ``adds``.

    Columns of ``docs`` that are named like an added one come through unharmed.
    """
    own = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in adds}
    judged = operator(docs.withColumnsRenamed(own)).filter(keep)
    return judged.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])


SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the columns read hold about eight megabytes a piece."""
    size = sum(batch.column(c).nbytes for c in columns)
    step = max(1, batch.num_rows * SLICE_BYTES // max(size, SLICE_BYTES))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: runs without ASCII white space; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def drawn_rows(rows: DataFrame, sample: int, draw: F.Column, total: int | None = None) -> DataFrame:
    """Rows whose ``draw``, a hash, lies below what makes about ``sample`` of them; all if there are no more.

    Nothing is sorted and a task hands on only what is drawn, so that however many tasks there
    are about ``sample`` rows come out, and seldom more than four standard deviations above it.
    """
    total = rows.count() if total is None else total
    if total <= sample:
        return rows
    least = -(1 << 63)
    return rows.filter(draw <= F.lit(least + int((1 << 64) * (sample / total)) - 1))
