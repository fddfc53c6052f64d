"""Silver and gold tables of one raw snapshot, each written once when first asked for, but for plain projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tradewinds.operators.materialise import materialise
from tradewinds.plans import gold
from tradewinds.plans.dashboard import enriched_orders
from tradewinds.plans.silver import SILVER

# Mere projections of their raw table: written, they would fill the disk to save little work.
PROJECTED = ("items",)


class Warehouse:
    """Reports read these tables the way they would read saved ones."""

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = dict(raw)
        self._tables: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = materialise(build(), lean=True)
        return self._tables[name]

    def silver(self, name: str) -> DataFrame:
        source, job = SILVER[name]
        if name in PROJECTED:
            return job(self.raw[source])
        return self._once(f"silver_{name}", lambda: job(self.raw[source]))

    def silver_tables(self) -> dict[str, DataFrame]:
        """All silver tables, one after another: together, their shuffles would lie on the disks at the same time."""
        return {name: self.silver(name) for name in SILVER}

    def staged(self, name: str) -> DataFrame:
        return gold.stage(self.silver(name), name)

    def orders_enriched(self) -> DataFrame:
        return gold.orders_enriched(self.staged("orders"), self.staged("payments"), self.staged("reviews"))

    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.staged("customers"))

    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.staged("sellers"))

    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.staged("products"))

    def dim_payment(self) -> DataFrame:
        return self._once("dim_payment", lambda: gold.dim_payment(self.staged("payments")))

    def fact_orders(self) -> DataFrame:
        return self._once(
            "fact_orders",
            lambda: gold.fact_orders(self.orders_enriched(), self.dim_customers(), self.dim_payment()),
        )

    def enriched(self) -> DataFrame:
        """The wide order table, shared by all dashboard pages."""
        return self._once("enriched_orders", lambda: enriched_orders(self.silver_tables()))
