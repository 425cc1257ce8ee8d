"""Build one layer from the one below it.

Each layer is written, and the next one reads what was written: a table is
computed once, however many others use it.
"""

from __future__ import annotations

from collections.abc import Sequence

from bazaarlake.contracts import GOLD, PLATINUM, RAW
from bazaarlake.lazy import Plans
from bazaarlake.operators.cleaning import clean_all
from bazaarlake.plans.gold import star_schema
from bazaarlake.plans.marts import all_marts
from bazaarlake.session import passing
from bazaarlake.sources.layers import Lake, clustered, with_period
from bazaarlake.sources.zorder import z_ordered

# Fact layout: partitions, and the columns files are clustered on.
FACT_PARTITIONS = ("year", "month")
FACT_CLUSTERS = {
    "fact_sales": ("purchase_date_key", "product_id", "order_id"),
    "fact_order_fulfillment": ("purchase_date_key", "order_id"),
}


def _read_layer(lake: Lake, layer: str, names) -> Plans:
    return Plans({n: lambda n=n: lake.read(layer, n) for n in names})


def build_silver(lake: Lake, names: Sequence[str] = ()) -> dict[str, int]:
    """Clean bronze tables into silver; returns rows per table."""
    return lake.write_all(clean_all(_read_layer(lake, "bronze", RAW)), "silver", names)


# Columns that single filters come on: each gets its share of a Z-order curve.
FACT_CURVES = {
    "fact_sales": ("product_id", "purchase_date_key"),
    "fact_order_fulfillment": ("customer_id", "purchase_date_key"),
}


def build_gold(
    lake: Lake,
    names: Sequence[str] = (),
    *,
    partitioned: bool = True,
    z_order: bool = False,
) -> dict[str, int]:
    """Star schema from silver; facts partitioned by month and clustered.

    ``z_order`` clusters them on several columns at once instead, without partitions.
    """
    star = star_schema(_read_layer(lake, "silver", RAW))
    counts = {}
    for name in names or star:
        if z_order and name in FACT_CURVES:
            with passing(star[name], name) as rows:  # sampled, then laid out
                counts[name] = lake.write(z_ordered(rows, FACT_CURVES[name]), "gold", name)
        elif partitioned and name in FACT_CLUSTERS:
            laid_out = clustered(
                with_period(star[name]), FACT_PARTITIONS, FACT_CLUSTERS[name]
            )
            counts[name] = lake.write(
                laid_out, "gold", name, partition_by=FACT_PARTITIONS
            )
        else:
            counts[name] = lake.write(star[name], "gold", name)
    return counts


def build_platinum(lake: Lake, names: Sequence[str] = ()) -> dict[str, int]:
    """Marts from the star schema."""
    marts = all_marts(_read_layer(lake, "gold", GOLD))
    return lake.write_all(marts, "platinum", names)


def mart_tables(lake: Lake) -> Plans:
    return _read_layer(lake, "platinum", PLATINUM)
