"""strata: a Spark-native medallion warehouse.

CRM and ERP extracts land in a bronze layer as delivered, are cleaned into a
silver layer and modelled into a gold star schema (two dimensions and one
fact), with data-quality rules over the raw and the modelled data.  Every step
is a pure DataFrame function; ``strata.plans.pipeline`` materialises the layers.
"""

from strata.functions.cleaning import (
    map_codes,
    prefer,
    repair_price,
    repair_sales,
    split_product_key,
    standardise_country,
    strip_chars,
    strip_prefix,
    null_if_future,
)
from strata.operators.dedup import dedup_latest, keep_last_loaded
from strata.operators.joins import orphans
from strata.operators.ordered import dense_surrogate_key, lead_within_key, scd2_end_date

__all__ = [
    "dedup_latest", "dense_surrogate_key", "keep_last_loaded", "lead_within_key",
    "map_codes", "null_if_future", "orphans", "prefer", "repair_price", "repair_sales", "scd2_end_date",
    "split_product_key", "standardise_country", "strip_chars", "strip_prefix",
]
