"""PRICE_REVENUE: enrich facts with the newest price of their key.

fact LEFT JOIN (newest lookup row per key) USING (key);
``price = coalesce(lookup price, 0)``, ``revenue = sales * price``.

The lookup side is unique per key, so the join never multiplies fact rows.
No broadcast hint is given: the lookup has one row per key and grows with the
key space, so its size is not bounded up front. Adaptive execution measures
the lookup's real shuffle output and switches to a broadcast hash join only
when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it
the join stays sort-merge and a hot or NULL fact key is split by the adaptive
skew-join rule (the left side of a left outer join is splittable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.dedup import latest_value
from lakeloom.spec import LookupSpec, TableSpec

_LOOKUP_PRICE = "__lakeloom_listing_price"


def price_revenue(fact: DataFrame, lookup: DataFrame, spec: LookupSpec) -> DataFrame:
    """Join ``fact`` with the newest ``price_col`` per ``key`` of ``lookup``.

    Existing ``price`` / ``revenue`` columns of the fact are replaced. An
    unmatched or NULL key gets price 0; a NULL sales value keeps revenue NULL.
    The key column comes first in the output (``USING`` join).
    """
    prices = latest_value(lookup, spec.key, spec.price_col, spec.order_col,
                          spec.tiebreak, alias=_LOOKUP_PRICE)
    base = fact.drop("price", "revenue")
    price = F.coalesce(F.col(_LOOKUP_PRICE), F.lit(0))
    return (base.join(prices, on=spec.key, how="left")
            .withColumn("price", price)
            .withColumn("revenue", F.col(spec.sales_col) * F.col("price"))
            .drop(_LOOKUP_PRICE))


def price_revenue_transform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Registry adapter: read the lookup table from the catalog by name."""
    if spec.lookup is None:
        raise ValueError(f"{spec.target}: PRICE_REVENUE needs a lookup spec")
    lookup = df.sparkSession.table(spec.lookup.table)
    return price_revenue(df, lookup, spec.lookup)
