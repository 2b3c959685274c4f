"""Lazy access to every layer of one warehouse build.

Each relation is constructed on first use and kept, so a query that needs one
silver table does not build the others.  Building a dimension writes its rows,
range bucket and position in the bucket to the shared checkpoint folder once;
the surrogate key is then a narrow projection over that written table, so it is
the same for the fact and for every check that reads the dimension.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.functions.cleaning import NA
from strata.plans import gold, silver
from strata.sources import fixtures

# Fixed value: the reference date that replaces NOW() in compared queries.
AS_OF = "2026-01-01"


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str | None = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._cache: dict[str, DataFrame] = {}

    def _get(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def bronze(self, name: str) -> DataFrame:
        if name == "erp_loc_loads":
            return self._get("b:loads", lambda: fixtures.erp_loc_loads(self.spark, self.sf_dir))
        return self._get(f"b:{name}", lambda: fixtures.BRONZE[name](self.spark, self.sf_dir))

    def silver(self, name: str) -> DataFrame:
        if name == "erp_loc_loads":
            # ERP locations as loaded repeatedly, cleaned like silver, load sequence kept
            return self._get("s:loads", lambda: self.bronze("erp_loc_loads").select(
                *silver.location_columns(), "load_seq"))
        if name == "erp_cust_az12":
            return self._get("s:az12", lambda: silver.erp_cust_az12(self.bronze(name), self.as_of))
        fn = getattr(silver, name)
        return self._get(f"s:{name}", lambda: fn(self.bronze(name)))

    def dim_customers(self, unknown: str = NA) -> DataFrame:
        return self._get(f"g:dim_customers:{unknown}", lambda: gold.dim_customers(
            self.silver("crm_cust_info"), self.silver("erp_cust_az12"), self.silver("erp_loc_a101"), unknown))

    def dim_products(self, current_only: bool = False) -> DataFrame:
        return self._get(f"g:dim_products:{current_only}", lambda: gold.dim_products(
            self.silver("crm_prd_info"), self.silver("erp_px_cat_g1v2"), current_only))

    def dim_customers_base(self) -> DataFrame:
        """The customer dimension without its surrogate key (for audits that do not use it)."""
        return self._get("g:dim_customers_base", lambda: gold.dim_customers_unkeyed(
            self.silver("crm_cust_info"), self.silver("erp_cust_az12"), self.silver("erp_loc_a101")))

    def dim_products_base(self) -> DataFrame:
        """The product dimension without its surrogate key (for audits that do not use it)."""
        return self._get("g:dim_products_base", lambda: gold.dim_products_unkeyed(
            self.silver("crm_prd_info"), self.silver("erp_px_cat_g1v2")))

    def fact_sales_base(self) -> DataFrame:
        """The fact's rows without surrogate keys (for audits that do not use them)."""
        return self._get("g:fact_sales_base", lambda: gold.fact_sales_unkeyed(
            self.silver("crm_sales_details"), self.dim_products_base(), self.dim_customers_base()))

    def fact_sales_counted(self, copies: str) -> DataFrame:
        """Sales of the fact once each, with their number of fact rows in column ``copies``."""
        return gold.fact_sales_counted(
            self.silver("crm_sales_details"), self.dim_products_base(), self.dim_customers_base(), copies)

    def fact_sales(self) -> DataFrame:
        return self._get("g:fact_sales", lambda: gold.fact_sales(
            self.silver("crm_sales_details"), self.dim_products(), self.dim_customers()))
