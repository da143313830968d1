"""Small column helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 for a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are computed once per row.

    A later filter on a plain column is merged into its definition, which repeats the definition for every use. A
    generator of one row stops that.
    """
    made = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once"))
    kept = [c for c in df.columns if c not in columns]
    return made.select(*kept, *[F.col(f"_once.{n}").alias(n) for n in columns])
