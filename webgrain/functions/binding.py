"""Name a value inside a column expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used (also
    inside lambdas, where the optimizer does not share common parts)."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
