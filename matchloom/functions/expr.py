"""Small expression helpers shared by the nested-document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def present(items: Column) -> Column:
    """Without nulls."""
    return F.filter(items, lambda x: x.isNotNull())


def reasons(*tests: tuple[Column, str | Column]) -> Column:
    """Names of the tests that hold, in order, each once. An undecided test does not hold."""
    named = [F.when(t, F.lit(n) if isinstance(n, str) else n) for t, n in tests]
    return F.array_except(F.array(*named), F.array(F.lit(None).cast("string")))


def is_true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter on a derived column moves below the projection and takes a copy of the
    expression along; for parsed pages that means parsing several times. The columns are
    passed through a one-element generator, which filters on them do not cross.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode_outer(F.array(packed)).alias("_once")).select(*kept, "_once.*")
