"""Small helpers of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space, unchanged.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts that are Python strings at a time.
SLICE = 512
#: What this Python worker keeps from task to task, by operator.
_KEPT: dict[Any, Any] = {}


def kept(owner: Any, make: Callable[[], Any]) -> Any:
    """``make()``, kept by a Python worker from task to task until another operator's task comes.

    Workers outlive a query, and memory that one operator no longer needs is what the next lacks.
    """
    if owner not in _KEPT:
        forget()
        _KEPT[owner] = make()
    return _KEPT[owner]


def forget() -> None:
    """Called by operators that keep nothing themselves."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def strings(texts: pa.Array) -> Iterator[str | None]:
    """Texts one by one, of which only a slice are Python strings: a batch holds up to 10,000."""
    for at in range(0, len(texts), SLICE):
        yield from texts.slice(at, SLICE).to_pylist()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.

    A lambda that captures a column may have its expression inlined and then
    evaluated for every element; a lambda's own argument is a value.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """All words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id but not a text (null is not the empty text)."""
    return F.xxhash64(text, text.isNull())


def carried(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``row``, so that no column of it can clash with one of an operator."""
    return docs.select(F.struct("*").alias("row"))


def same_row(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Null-safe equality on columns of two tables."""
    test = F.lit(True)
    for c in columns:
        test = test & left[c].eqNullSafe(right[c])
    return test
