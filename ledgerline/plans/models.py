"""The model graph over one set of source tables.

``ShopModels`` builds each model once, lazily, as a DataFrame over the sources it is
given: the driver test tables (``from_testdata``), catalog tables, or lake files.  Nothing
runs until an action; the whole graph is one Catalyst plan per query.
"""

from __future__ import annotations

from functools import cached_property
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import marts, staging
from ledgerline.sources import shop_tables


class ShopModels:
    def __init__(self, sources: Mapping[str, Callable[[], DataFrame]]):
        self._sources = dict(sources)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "ShopModels":
        src = {name: (lambda f=fn: f(spark, sf_dir)) for name, fn in shop_tables.OLTP.items()}
        src["sales_dirty"] = lambda: shop_tables.sales_dirty(spark, sf_dir)
        return cls(src)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str] | None = None) -> "ShopModels":
        names = dict(names or {})
        keys = list(shop_tables.OLTP) + ["sales_dirty"]
        return cls({k: (lambda t=names.get(k, k): spark.table(t)) for k in keys})

    def source(self, name: str) -> DataFrame:
        return self._sources[name]()

    # staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.source("customers"))

    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stg_items(self.source("items"))

    @cached_property
    def stg_payment_methods(self) -> DataFrame:
        return staging.stg_payment_methods(self.source("payment_methods"))

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.source("transactions"))

    @cached_property
    def stg_transaction_items(self) -> DataFrame:
        return staging.stg_transaction_items(self.source("transaction_items"))

    @cached_property
    def stg_transactions_static(self) -> DataFrame:
        return staging.stg_transactions_static(self.source("sales_dirty"))

    # marts
    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers)

    @cached_property
    def dim_items(self) -> DataFrame:
        return marts.dim_items(self.stg_items)

    @cached_property
    def dim_payment_methods(self) -> DataFrame:
        return marts.dim_payment_methods(self.stg_payment_methods)

    @cached_property
    def dim_transaction_items(self) -> DataFrame:
        return marts.dim_transaction_items(self.stg_transaction_items,
                                           self.stg_transactions_static, self.stg_items)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return marts.fct_transactions(self.stg_transactions, self.stg_transactions_static,
                                      self.dim_payment_methods)

    # analytics over the models
    @cached_property
    def item_quantity(self) -> DataFrame:
        from ledgerline.plans.analytics import item_quantity_from_models
        return item_quantity_from_models(self.stg_transaction_items,
                                         self.stg_transactions_static, self.stg_items,
                                         self.dim_items)
