"""Column expressions and small frames that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: The separators of ``WORD``, as characters.
SPACES = " \t\n\x0b\x0c\r"


def lean(spark: SparkSession) -> None:
    """Shuffle files go as soon as the step that made them has ended, and not when the driver happens to collect its garbage.

    What follows a step reads its checkpoint or table; a step that is run again makes its files again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def text_of(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def without(text: Column, chars: str) -> Column:
    """The text without the given characters."""
    return F.translate(text, chars, "")


def one_row(df: DataFrame):
    """The single row of a global aggregate: the only thing the driver ever fetches."""
    return df.first()


def by_bytes(items: Iterable, size_of, most: int) -> Iterator[list]:
    """Cuts a stream into lists whose sizes add up to ``most`` at the most, or that hold one item."""
    part, held = [], 0
    for item in items:
        size = size_of(item)
        if part and held + size > most:
            yield part
            part, held = [], 0
        part.append(item)
        held += size
    if part:
        yield part


def give_back() -> None:
    """Returns memory that this Python worker has freed to the system.

    Workers live on between tasks; what one task has needed would stay reserved
    beside the next task's.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every system's library has it
        pass


def tidy(batches: Iterator) -> Iterator:
    """The batches, with freed memory given back after each and at the end."""
    try:
        for batch in batches:
            yield batch
            give_back()
    finally:
        give_back()
