"""The same transformation for many tenants, in one table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def for_tenants(build: Callable[..., DataFrame], sources: Mapping[str, tuple[DataFrame, ...]]) -> DataFrame:
    """Build per tenant and stack the results with a leading ``tenant`` column.

    Each tenant keeps its own plan, so its filters and partition pruning are its own. Write the result
    with ``partitionBy("tenant")``.
    """
    parts = [
        build(*frames).select(F.lit(tenant).alias("tenant"), "*") for tenant, frames in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
