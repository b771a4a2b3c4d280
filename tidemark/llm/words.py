"""Column expressions over the words of a text: runs of anything but space, tab and \\n \\v \\f \\r."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def word_array(text: Column) -> Column:
    """Words in text order; an empty array for an empty text."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def shifted(array: Column, length: Column, *offsets: int) -> list[Column]:
    """Slices of equal ``length`` that start at each offset, for zipping neighbours."""
    return [F.slice(array, F.lit(k + 1), length) for k in offsets]


def adjacent(array: Column, size: Column, merge) -> Column:
    """``merge(x[i], x[i + 1])`` for each neighbouring pair; empty below two elements.

    Neighbours come from two slices, so the lambda captures no array: a captured
    one would be computed anew for every element.
    """
    left, right = shifted(array, F.greatest(size - 1, F.lit(0)), 0, 1)
    return F.zip_with(left, right, merge)


def present(array: Column) -> Column:
    return F.filter(array, lambda x: x.isNotNull())


def constant_array(values: list, kind: str) -> Column:
    """A Python list as one array constant, which lambdas may index; ``None`` is null."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
