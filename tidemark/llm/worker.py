"""What a Python worker keeps from one task to the next: one model at a time; and what a task is sent.

Spark gives a worker to one stage after another. A model that is kept by name alone
stays when the next stage loads its own, and an executor's memory holds both.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HELD: dict[Hashable, Any] = {}


def give_back() -> None:
    """Hand freed memory back to the system, which else stays with the process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim:
        trim(0)


def held(name: Hashable, load: Callable[[], Any]) -> Any:
    """The model of that name; if another one is held, it is let go before ``load`` runs."""
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = load()
        give_back()  # what loading alone needed
    return _HELD[name]


def packed_with(docs: DataFrame, keep: list[str], text: str, *more: Column) -> DataFrame:
    """``keep`` columns as a struct ``_row``, and the text as ``_text`` unless the row has it: a batch holds each text once."""
    return docs.select(F.struct(*keep).alias("_row"), *([] if text in keep else [F.col(text).alias("_text")]), *more)


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts of a batch of ``packed_with``."""
    return batch.column("_text") if "_text" in batch.schema.names else batch.column("_row").field(text)
