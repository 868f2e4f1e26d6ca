"""The workshop model over the driver's star tables.

``Workshop`` wires sources -> silver -> gold lazily for one scale-factor
folder.  Frames are lazy and their plans are built once per object; callers that
reuse a result within one job write it (``order_fact_table``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.plans import gold, silver
from forecourt.sources import seeds
from forecourt.sources import star_extracts as X
from forecourt.session import drop_scratch, write_scratch
from forecourt.sources.tables import Tables

# ---------------------------------------------------------------- FIXED VALUES
MAX_VEHICLE_YEAR = 2023     # year of the reports + 1
# ------------------------------------------------------------ END FIXED VALUES


class Workshop:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    # bronze-shaped text extracts
    @cached_property
    def work_orders_raw(self) -> DataFrame:
        return X.work_orders_raw(self.t.orders)

    @cached_property
    def lines_raw(self) -> DataFrame:
        return X.work_order_lines_raw(self.t.lineitem)

    @cached_property
    def technicians_raw(self) -> DataFrame:
        return X.technicians_raw(self.t.supplier)

    @cached_property
    def parts_raw(self) -> DataFrame:
        return X.parts_raw(self.t.part)

    # silver
    @cached_property
    def work_orders(self) -> DataFrame:
        return silver.clean_work_orders(self.work_orders_raw, X.customer_id_migration(self.t.customer))

    @cached_property
    def lines(self) -> DataFrame:
        return silver.clean_lines(self.lines_raw, X.part_number_aliases(self.t.part))

    @cached_property
    def technicians(self) -> DataFrame:
        return silver.clean_technicians(self.technicians_raw)

    @cached_property
    def parts(self) -> DataFrame:
        return silver.clean_parts(self.parts_raw)

    @cached_property
    def customers(self) -> DataFrame:
        return silver.clean_customers(X.customers_raw(self.t.customer), X.customer_id_migration(self.t.customer))

    @cached_property
    def vehicles(self) -> DataFrame:
        return silver.clean_vehicles(X.vehicles_raw(self.t.customer), seeds.make_aliases(self.spark), MAX_VEHICLE_YEAR)

    @cached_property
    def opened_dates(self) -> DataFrame:
        """All opening dates, read from the extract before it is deduplicated."""
        return self.work_orders_raw.select(F.to_date(C.parse_ts("date_opened")).alias("opened"))

    # seeds
    @cached_property
    def vat_rates(self) -> DataFrame:
        return seeds.vat_rates(self.spark)

    @cached_property
    def service_types(self) -> DataFrame:
        return seeds.service_types(self.spark)

    # gold
    def order_fact(self, work_orders: DataFrame | None = None, extras: bool = False,
                   keys: list[str] = gold.ORDER_COLUMNS) -> DataFrame:
        return gold.order_fact(work_orders if work_orders is not None else self.work_orders,
                               self.lines, self.parts, self.technicians, self.vat_rates, extras=extras,
                               dates=self.opened_dates, keys=keys)

    def rated_orders(self, work_orders: DataFrame | None = None) -> DataFrame:
        if work_orders is not None:  # written: its own dates are the cheapest
            return gold.with_rates(work_orders, self.vat_rates, self.technicians)
        return gold.with_rates(self.work_orders, self.vat_rates, self.technicians, self.opened_dates)

    def priced_lines(self, keep_orphans: bool = False, carry: list[str] | None = None,
                     work_orders: DataFrame | None = None) -> DataFrame:
        return gold.price_lines(self.lines, self.rated_orders(work_orders), self.parts, keep_orphans, carry)

    @cached_property
    def order_fact_table(self) -> DataFrame:
        """The fact (with extras) written once, for jobs that read most of its
        columns several times; ``close`` deletes it."""
        self._fact_path = write_scratch(self.order_fact(extras=True), "fct_work_orders")
        return self.spark.read.parquet(self._fact_path)

    @cached_property
    def work_orders_table(self) -> DataFrame:
        """The cleaned orders written once, for jobs that read them several times; ``close`` deletes it."""
        self._orders_path = write_scratch(self.work_orders, "silver_work_orders")
        return self.spark.read.parquet(self._orders_path)

    def close(self) -> None:
        """Delete what this object wrote; call it when its results were read."""
        if "order_fact_table" in self.__dict__:
            drop_scratch(self.spark, self._fact_path)
            del self.__dict__["order_fact_table"]
        if "work_orders_table" in self.__dict__:
            drop_scratch(self.spark, self._orders_path)
            del self.__dict__["work_orders_table"]

    def shared_fact(self, extras: bool = True, keys: list[str] = gold.ORDER_COLUMNS) -> DataFrame:
        """The written fact if this job already wrote it, else the lazy plan (with the order columns of ``keys``)."""
        if "order_fact_table" in self.__dict__:
            return self.order_fact_table
        return self.order_fact(extras=extras, keys=keys)

    def service_profitability(self, fact: DataFrame | None = None) -> DataFrame:
        return gold.service_profitability(fact if fact is not None else self.order_fact(),
                                          self.service_types)
