"""Column-to-column functions; everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Lambdas of array functions re-evaluate the outer expressions they mention
    for every element; a one-element array turns the value into a variable.
    """
    return F.transform(F.array(value), body)[0]


def lookup(table: dict, key: Column) -> Column:
    """Value of ``key`` in a small constant table, null when absent."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)
