"""Item lists: filters, lengths and 0/1 encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.numeric import as_col


def keep_allowed(items: Column | str, allowed: Sequence[str]) -> Column:
    """Items that are on the allow-list, order and repeats kept."""
    allowed = list(allowed)
    return F.filter(as_col(items), lambda x: x.isin(allowed))


def multi_hot(items: Column | str, classes: Sequence[str] | Column) -> Column:
    """0/1 vector (array<int>) with one slot per class, in class order."""
    items = as_col(items)
    classes = classes if isinstance(classes, Column) else F.array(*[F.lit(c) for c in classes])
    return F.transform(classes, lambda c: F.array_contains(items, c).cast("int"))


def length(items: Column | str) -> Column:
    return F.size(as_col(items))
