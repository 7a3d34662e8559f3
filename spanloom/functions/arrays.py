"""Arrays as multisets and sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(f: Callable[..., Column], *values: Column) -> Column:
    """f(*values) with each value computed once, however often f uses it.

    Inside a lambda an expression would otherwise run again for every element;
    here the values are fields of a lambda variable.
    """
    bound = F.array(F.struct(*[v.alias(f"_{i}") for i, v in enumerate(values)]))
    return F.get(F.transform(bound, lambda x: f(*[x[f"_{i}"] for i in range(len(values))])), F.lit(0))


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once: a generator, which filters and projections above cannot look into."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def _numbered(values: Column) -> Column:
    """Each string with its number among its equals, so that a multiset becomes a set."""
    return let(lambda s: F.transform(s, lambda v, i: F.concat_ws("\0", v, (i - F.array_position(s, v)).cast("string"))), F.array_sort(values))


def multiset_minus(a: Column, b: Column) -> Column:
    """Strings of ``a`` beyond their count in ``b``, sorted."""
    return F.transform(F.array_except(_numbered(a), _numbered(b)), lambda v: F.substring_index(v, "\0", 1))


def in_order(required: Column, observed: Column) -> Column:
    """Whether ``required`` is a subsequence of ``observed``."""

    def met(required: Column, observed: Column) -> Column:
        return F.aggregate(observed, F.lit(0), lambda j, v: j + F.when(v == F.get(required, j), 1).otherwise(0)) == F.size(required)

    return let(met, required, observed)


def reasons(*named: tuple[str, Column]) -> Column:
    """Names of the conditions that hold, in the given order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named]))
