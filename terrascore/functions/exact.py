"""Sums and means that don't depend on the order of rows.

Adding doubles in another order changes the last bits, so two runs of one job
(or a task that runs again) could disagree where a score jumps. Here the terms
are added as decimals with 12 places, exactly, and the result is turned into a
double once. NaN counts as no data.

Where the decimals can't hold a group's values (the largest magnitude is
LARGE or more, or under SMALL, so that 12 places leave less than nine digits), or their
sum, all of the group is added as doubles: no value drops out or
becomes 0, but the last bits may depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,12)"
SMALL, LARGE = 1e-3, 1e25


def exact(value: Column) -> Column:
    return value.try_cast(EXACT)


def known(value: Column) -> Column:
    """The value as a double, null where it is NaN."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def exact_sum(value: Column) -> Column:
    number = known(value)
    largest = F.max(F.abs(number))
    fits = (largest == 0) | ((largest >= SMALL) & (largest < LARGE))
    return F.coalesce(F.when(fits, F.try_sum(exact(value)).cast("double")), F.sum(number))


def exact_mean(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(known(value)), F.lit(0))
