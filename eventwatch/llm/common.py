"""Small helpers shared by the operators of this subpackage."""

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Control of word extraction on bytes: ASCII upper case goes to lower case, every byte that is not a
#: word byte (0-9, a-z, 0x80-0xFF) to a space. UTF-8 bytes of non-ASCII characters are word bytes.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


def utf8(col: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [b or b"" for b in pc.cast(col, kind).to_pylist()]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_of(col: str | Column) -> Column:
    """Null texts count as empty."""
    c = F.col(quoted(col)) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by key over the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def give_back() -> None:
    """At the end of a task: return freed memory to the system, as idle Python workers stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 2000        # rows of an Arrow batch that holds whole texts
NARROW = 20_000     # rows of an Arrow batch of a few numbers each


def text_batches(df: DataFrame) -> DataFrame:
    """Python workers get whole texts in small batches: unless the session sets a number of rows of its own, it is
    lowered from Spark's default, which suits short rows."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_ROWS) == "10000":
        conf.set(BATCH_ROWS, str(TEXTS))
    return df


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Larger batches while jobs over narrow rows run."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(NARROW))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)
