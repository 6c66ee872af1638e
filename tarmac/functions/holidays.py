"""United States federal holidays as one date expression.

Every holiday is fixed by month, day and weekday, so the flag is plain integer arithmetic on the
date: no lookup table, no join and nothing to broadcast.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from public law: (month, day, first year).
FIXED_DAYS = ((1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))
# Fixed values from public law: (month, weekday with Monday = 0, earliest day, latest day, first year).
FLOATING_DAYS = (
    (1, 0, 15, 21, 1986),
    (2, 0, 15, 21, 1971),
    (5, 0, 25, 31, 1971),
    (9, 0, 1, 7, 0),
    (10, 0, 8, 14, 1971),
    (11, 3, 22, 28, 0),
)
FRIDAY, MONDAY = 4, 0


def _fixed(date: Column) -> Column:
    return reduce(
        or_,
        [
            (F.month(date) == month) & (F.dayofmonth(date) == day) & (F.year(date) >= first_year)
            for month, day, first_year in FIXED_DAYS
        ],
    )


def is_us_holiday(date: Column) -> Column:
    """True on a federal holiday or the weekday it is observed on; null is false."""
    date = F.to_date(date)
    weekday = F.weekday(date)
    floating = reduce(
        or_,
        [
            (F.month(date) == month) & (weekday == day_of_week)
            & F.dayofmonth(date).between(first, last) & (F.year(date) >= first_year)
            for month, day_of_week, first, last, first_year in FLOATING_DAYS
        ],
    )
    observed = ((weekday == FRIDAY) & _fixed(F.date_add(date, 1))) | (
        (weekday == MONDAY) & _fixed(F.date_sub(date, 1))
    )
    return F.coalesce(_fixed(date) | floating | observed, F.lit(False))
