"""Person equivalence across tables (J6): equi join on lastname + prefix residual.

A popular lastname is a hot join key: the heavy ones are found and split by ``skew_join``.  Never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.functions.names import names_equivalent
from scholarweave.operators.skew import skew_join


def join_equivalent_names(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                          how: str = "inner", partitions: int | None = None) -> DataFrame:
    """Rows with equivalent names; the two name columns must have different names."""
    return skew_join(left, right, F.col(left_name)["lastname"], F.col(right_name)["lastname"], how,
                     names_equivalent(F.col(left_name), F.col(right_name)), partitions)
