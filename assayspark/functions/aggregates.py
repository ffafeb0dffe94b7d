"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict(aggregate: Column, col: Column | str) -> Column:
    """NULL as soon as one input of the group is NULL."""
    return F.when(F.count(col) == F.count(F.lit(1)), aggregate)


def mean(col: Column | str, na_rm: bool = False) -> Column:
    return F.avg(col) if na_rm else strict(F.avg(col), col)


def sd(col: Column | str, na_rm: bool = False) -> Column:
    return F.stddev_samp(col) if na_rm else strict(F.stddev_samp(col), col)


def cv(col: Column | str, na_rm: bool = False) -> Column:
    """Standard deviation over mean; NULL for one value or a mean of 0."""
    return F.try_divide(sd(col, na_rm), mean(col, na_rm))


def first_row(columns: list[str], order_by: list[str]) -> Column:
    """The named columns, as a struct, of the group's first row in the given total order.

    A name after a minus sign (numbers only) falls; NULL comes last either way.
    """
    order = []
    for name in order_by:
        column = F.col(name.removeprefix("-"))
        order += [column.isNull(), -column if name.startswith("-") else column]
    return F.min_by(F.struct(*columns), F.struct(*order))


def centred_sum_of_squares(col: Column | str) -> Column:
    """Sum of squared deviations from the group mean, merged without cancellation."""
    return F.var_pop(col) * F.count(col)
