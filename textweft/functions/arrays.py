"""Small helpers for array expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    A column used inside a lambda may be inlined and computed per element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
