"""Age and income groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive upper bound and name of each group; the last name
# has no upper bound.
AGE_GROUPS = [(20, "Under 20"), (30, "20-29"), (40, "30-39"), (50, "40-49"), (None, "50+")]
INCOME_GROUPS = [
    (20000, "Under 20k"),
    (60000, "20k-59k"),
    (100000, "60k-99k"),
    (140000, "100k-139k"),
    (None, "140k+"),
]


def bucket(column, groups) -> Column:
    """The name of the first group whose bound exceeds the value; NULL stays NULL."""
    value = F.col(column)
    *bounded, (_, last) = groups
    branches = [F.when(value < upper, name) for upper, name in bounded]
    return F.coalesce(*branches, F.when(value.isNotNull(), last))


def age_group(column="user_age") -> Column:
    return bucket(column, AGE_GROUPS)


def income_group(column="user_income") -> Column:
    return bucket(column, INCOME_GROUPS)
