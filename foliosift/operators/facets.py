"""Facet counts."""

from pyspark.sql import functions as F


def facet_counts(apps, facets=("application_type", "status_code")):
    """One row (facet, value, n) for each value of each facet column.

    One pass over the input; counts are combined before the shuffle.
    """
    rows = F.inline(
        F.array(
            *(
                F.struct(F.lit(name).alias("facet"), F.col(name).cast("string").alias("value"))
                for name in facets
            )
        )
    )
    return apps.select(rows).groupBy("facet", "value").agg(F.count("*").alias("n"))
