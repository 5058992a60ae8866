"""What the operators of this subpackage share: reading texts in bounded slices, keeping tables, words."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most text bytes that a task works on at once. A single longer text is a slice of its own.
SLICE_BYTES = 2 << 20

# ASCII bytes that separate words: all but digits and letters. Every byte of a non-ASCII character is part of a word.
_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
# Lower-cases A-Z and turns every separator into a space.
WORD_TABLE = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


_CACHES: list[Callable[[], None]] = []


def forgettable(clear: Callable[[], None]) -> None:
    """Registers how to drop what an operator remembers in a worker process from task to task."""
    _CACHES.append(clear)


def forget() -> None:
    """Drops it, where another operator's task begins: worker processes serve many."""
    for clear in _CACHES:
        clear()


def words_of(text: str | None) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z lower-cased, as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `limit` bytes of the text column, or one row."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_string()) if batch.num_rows else []
        start = held = 0
        for i, size in enumerate(pa.compute.binary_length(sizes).to_pylist() if batch.num_rows else []):
            if i > start and held + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if batch.num_rows > start:
            yield batch.slice(start)


def crc_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def in_fold(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32(id as text) leaves `remainder`; a null id does not."""
    return F.coalesce(crc_of(doc_id) % modulus == remainder, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def new_folder(spark: SparkSession, name: str, suffix: str = "") -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}{suffix}"


def temporary(spark: SparkSession, path: str) -> str:
    """A path that was written and goes when the driver's JVM ends, also when the session was stopped before."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def shipped(query: Callable) -> Callable:
    """A query whose workers get this package from the session, as by `--py-files`, wherever the driver was started."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        context = spark.sparkContext
        if not any(name.startswith("flowspark-") for name in context._python_includes):
            package = Path(__file__).resolve().parent.parent
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                for path in sorted(package.rglob("*.py")):
                    archive.write(path, path.relative_to(package.parent))
            path = new_folder(spark, "flowspark", ".zip")
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            out = at.getFileSystem(context._jsc.hadoopConfiguration()).create(at)
            out.write(packed.getvalue())
            out.close()
            context.addPyFile(temporary(spark, path))
        return query(spark, *args)

    return run


def kept(df: DataFrame, name: str) -> DataFrame:
    """Compute once, into a table in the shared folder; lost executors do not take it with them."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    temporary(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Kept tables that are removed as soon as nothing reads them any more."""

    def __init__(self) -> None:
        self._paths: list[tuple[SparkSession, str]] = []

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        spark, path = df.sparkSession, new_folder(df.sparkSession, name)
        df.write.parquet(path)
        self._paths.append((spark, temporary(spark, path)))
        return spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove the tables; what was built on them can't be computed any more."""
        for spark, path in self._paths:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self._paths.clear()


def keep_rows(docs: DataFrame, decider: Callable[[], Callable[[list[str | None]], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, for whose texts `decider()`, called in each task, says so.

    Columns go through by position, so their names may be anything.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        decide = decider()
        for batch in slices(batches, text):
            yield batch.filter(pa.array(decide(batch.column(text).to_pylist()), pa.bool_()))

    return plain.mapInArrow(keep, plain.schema).toDF(*names)
