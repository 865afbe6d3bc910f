"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, with the value computed once.

    A column used several times is inlined several times, and inside a lambda once per
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)
