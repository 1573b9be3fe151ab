from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from vinlake.operators import Keep, as_planned
from vinlake.plans import core, intermediate, serving, staging

STAGING = ("stg_customers", "stg_sales", "stg_after_sales", "stg_customer_addresses")
INTERMEDIATE = ("int_customer_enriched", "int_sales_enriched")
DIMENSIONS = ("dim_customer", "dim_vehicle", "dim_date", "dim_service_type")
FACTS = ("fact_sales", "fact_after_sales")
REPORTS = ("mart_sales_summary", "mart_aftersales_priority")


class Models(Mapping[str, DataFrame]):
    """Raw tables and models by name. A model refers to others by name and is planned on first use.

    Setting a name replaces what later models read under it, for instance by a table on disk that
    holds the model's rows. ``keep`` says what becomes of facts that flags are taken from.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, Callable[[], DataFrame]],
        as_of: Column | None = None,
        keep: Keep = as_planned,
    ):
        def kept_for(model: str) -> Keep:
            return lambda name, facts: keep(f"{model}/{name}", facts)

        self._made: dict[str, DataFrame] = {}
        self._replaced: set[str] = set()
        # The same rows with fewer columns, for readers that need no flag and nothing about buyers.
        self._narrow: dict[str, Callable[[], DataFrame]] = {
            "stg_sales": lambda: staging.cleaned_sales(self["raw_sales"]),
            "stg_after_sales": lambda: staging.dated_tickets(self["raw_after_sales"], as_of),
            "int_sales_enriched": lambda: intermediate.classed(
                staging.cleaned_sales(self["raw_sales"]).where("invoice_date IS NOT NULL")
            ),
            "fact_sales": lambda: intermediate.classed(intermediate.first_sales(self["raw_sales"])),
            "fact_after_sales": lambda: self._narrow["stg_after_sales"](),
            "dim_vehicle": lambda: core.dim_vehicle(self._narrow["fact_sales"]()),
            "mart_sales_summary": lambda: serving.mart_sales_summary(self._narrow["fact_sales"]()),
        }
        self._makers: dict[str, Callable[[], DataFrame]] = {
            **raw,
            "stg_customers": lambda: staging.stg_customers(self["raw_customers"]),
            "stg_sales": lambda: staging.stg_sales(self["raw_sales"], kept_for("stg_sales")),
            "stg_after_sales": lambda: staging.stg_after_sales(
                self["raw_after_sales"], self["raw_sales"], as_of, kept_for("stg_after_sales")
            ),
            "stg_customer_addresses": lambda: staging.stg_customer_addresses(self["raw_customer_addresses"]),
            "int_customer_enriched": lambda: intermediate.int_customer_enriched(
                self["stg_customers"], self["stg_customer_addresses"]
            ),
            "int_sales_enriched": lambda: intermediate.int_sales_enriched(
                self["raw_sales"], self["stg_customers"], kept_for("int_sales_enriched")
            ),
            "dim_customer": lambda: core.dim_customer(self["int_customer_enriched"]),
            "dim_date": lambda: core.dim_date(spark),
            "dim_service_type": lambda: core.dim_service_type(spark),
            "fact_sales": lambda: core.fact_sales(self["raw_sales"], self["stg_customers"]),
            "fact_after_sales": lambda: core.fact_after_sales(self["stg_after_sales"]),
            "dim_vehicle": lambda: core.dim_vehicle(self["fact_sales"]),
            "mart_sales_summary": lambda: serving.mart_sales_summary(self["fact_sales"]),
            "mart_aftersales_priority": lambda: serving.mart_aftersales_priority(
                self["fact_after_sales"], self["dim_customer"]
            ),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __setitem__(self, name: str, rows: DataFrame) -> None:
        self._made[name] = rows
        self._replaced.add(name)

    def is_planned(self, *names: str) -> bool:
        """Whether models are plans over the raw tables, none of them replaced by a table."""
        return not self._replaced & {*names}

    def columns(self, name: str, *wanted: str) -> DataFrame:
        """Some columns of a model, planned without what they do not need."""
        needs = {name, "stg_customers", "stg_sales", "stg_after_sales", "fact_sales"}
        if name in self._narrow and self.is_planned(*needs):
            narrow = self._narrow[name]()
            if {*wanted} <= {*narrow.columns}:
                return narrow.select(*wanted)
        return self[name].select(*wanted)

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
