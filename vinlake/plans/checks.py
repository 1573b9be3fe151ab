"""The declared checks of each layer, and the three hand-written ones."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinlake.fixed_values import CUSTOMER_TYPES, PRICE_CLASSES, PRIORITIES
from vinlake.operators import left_join_splittable
from vinlake.operators.quality import Check, as_failures, columns_of, failures_of, flag_shares, shares, union_all
from vinlake.plans.staging import cleaned_sales, repeat_keys


def _key(layer: str, table: str, column: str) -> list[Check]:
    return [Check("unique", layer, table, column), Check("not_null", layer, table, column)]


DECLARED = [
    *_key("staging", "raw_customers", "id"),
    *_key("staging", "raw_sales", "vin"),
    *_key("staging", "raw_after_sales", "service_ticket"),
    *_key("staging", "stg_customers", "customer_id"),
    Check("accepted_values", "staging", "stg_customers", "customer_type", values=CUSTOMER_TYPES),
    *_key("staging", "stg_sales", "vin"),
    Check("not_null", "staging", "stg_sales", "price"),
    *_key("staging", "stg_after_sales", "service_ticket"),
    Check("not_null", "staging", "stg_customer_addresses", "customer_id"),
    Check("not_null", "intermediate", "int_customer_enriched", "customer_id"),
    Check("not_null", "intermediate", "int_sales_enriched", "vin"),
    Check("accepted_values", "intermediate", "int_sales_enriched", "price_class", values=PRICE_CLASSES),
    *_key("marts", "dim_customer", "customer_id"),
    *_key("marts", "dim_vehicle", "model"),
    *_key("marts", "dim_date", "date_id"),
    *_key("marts", "dim_service_type", "service_type_code"),
    *_key("marts", "fact_sales", "vin"),
    Check("not_null", "marts", "fact_sales", "customer_id"),
    Check("relationships", "marts", "fact_sales", "customer_id", parent=("dim_customer", "customer_id")),
    Check("not_null", "marts", "fact_sales", "price"),
    *_key("marts", "fact_after_sales", "service_ticket"),
    Check("not_null", "marts", "mart_sales_summary", "total"),
    Check("accepted_values", "marts", "mart_aftersales_priority", "priority", values=PRIORITIES),
]

FLAGS = {
    "stg_customers": ("is_dob_suspect",),
    "stg_sales": ("is_duplicate_suspect",),
    "stg_after_sales": ("is_vin_not_in_sales", "is_future_date"),
}

REVENUE = "revenue_non_negative"
SERVING_INNER = "serving_without_invalid_pairs"
SERVING_EXISTS = "serving_without_invalid_rows"


def declared(kind: str | None = None, layer: str | None = None) -> list[Check]:
    """The declared checks, of one kind or one layer if given."""
    return [check for check in DECLARED if kind in (None, check.kind) and layer in (None, check.layer)]


def negative_revenue(sales_facts: DataFrame) -> DataFrame:
    """Sales with a negative price."""
    return sales_facts.where(F.col("price") < 0).select("vin", "price")


def _invalid_vins(service_facts: DataFrame) -> DataFrame:
    invalid = service_facts.where(F.col("is_vin_not_in_sales") | F.col("is_future_date"))
    return invalid.where(F.col("vin").isNotNull()).groupBy("vin").agg(F.count(F.lit(1)).alias("n_invalid"))


def served_with_invalid_tickets(mart: DataFrame, service_facts: DataFrame) -> DataFrame:
    """Vehicles in the report that also have invalid tickets, and in how many pairs.

    A pair is a report row and an invalid ticket of the same vehicle. The pairs are counted, not
    formed: both sides are reduced to one row per vehicle first. The match is on the vehicle, so
    one valid and one future ticket of a vehicle already count.
    """
    served = mart.groupBy("vin").agg(F.count(F.lit(1)).alias("n_served"))
    return served.join(_invalid_vins(service_facts), "vin").select(
        "vin", (F.col("n_served") * F.col("n_invalid")).alias("n_rows")
    )


def report_rows_with_invalid_tickets(mart: DataFrame, service_facts: DataFrame) -> DataFrame:
    """Report rows whose vehicle also has invalid tickets."""
    return left_join_splittable(mart, _invalid_vins(service_facts).select("vin"), "vin", "left_semi")


def served_vehicles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Vehicles of the planned report that also have invalid tickets: ``vin, n_served, n_invalid``.

    A vehicle in the report is a known one, so its invalid tickets are those dated ahead. Both numbers come from one
    grouping of the tickets by report row; buyers, of whom each has one row, change neither.
    """
    tickets = tables.columns("stg_after_sales", "vin", "customer_id", "service_date", "is_future_date")
    served = F.count_if(~F.col("is_future_date")).alias("n_valid")
    groups = tickets.groupBy("vin", "customer_id", F.year("service_date")).agg(served, F.count_if("is_future_date").alias("n_future"))
    vehicles = groups.groupBy("vin").agg(F.count_if(F.col("n_valid") > 0).alias("n_served"), F.sum("n_future").alias("n_invalid"))
    known = tables["raw_sales"].select(F.col("vin").alias("_vin")).distinct()
    both = vehicles.where("n_served > 0 AND n_invalid > 0")
    return both.join(known, F.col("vin") == F.col("_vin"), "left_semi")


def planned_serving_pairs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``served_with_invalid_tickets`` of the planned report, without planning the report."""
    return served_vehicles(tables).select("vin", (F.col("n_served") * F.col("n_invalid")).alias("n_rows"))


def assertion(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One of the hand-written checks as ``check_name`` and ``failures``."""
    if name == REVENUE:
        return as_failures(name, negative_revenue(columns_of(tables, "fact_sales", "vin", "price")))
    planned = getattr(tables, "is_planned", lambda *_: False)
    if planned("stg_after_sales", "fact_after_sales", "mart_aftersales_priority", "dim_customer"):
        if name == SERVING_INNER:
            return as_failures(name, planned_serving_pairs(tables), F.col("n_rows"))
        if name == SERVING_EXISTS:
            return as_failures(name, served_vehicles(tables), F.col("n_served"))
    mart, facts = tables["mart_aftersales_priority"], tables["fact_after_sales"]
    if name == SERVING_INNER:
        return as_failures(name, served_with_invalid_tickets(mart, facts), F.col("n_rows"))
    if name == SERVING_EXISTS:
        return as_failures(name, report_rows_with_invalid_tickets(mart, facts))
    raise ValueError(f"unknown check: {name}")


def layer_failures(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of a layer; the hand-written ones belong to the marts."""
    found = [failures_of(declared(layer=layer), tables)]
    if layer == "marts":
        found += [assertion(name, tables) for name in (REVENUE, SERVING_INNER, SERVING_EXISTS)]
    return union_all(found)


def _repeat_counts(sales: DataFrame) -> DataFrame:
    """Sales and suspected repeats among them, from the sizes of groups: no row has to be flagged."""
    groups = sales.groupBy(*repeat_keys(sales)).agg(F.count(F.lit(1)).alias("n"))
    total, repeats = F.sum("n"), F.sum(F.when(F.col("n") > 1, F.col("n")))
    return groups.agg(*[F.coalesce(x, F.lit(0)).alias(name) for x, name in ((total, "n_rows"), (repeats, "is_duplicate_suspect"))])


def _ticket_counts(tickets: DataFrame, raw_sales: DataFrame) -> DataFrame:
    """Tickets, those of vehicles never sold and those dated ahead, from one row per vehicle."""
    groups = tickets.groupBy("vin").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_future_date").alias("n_future"))
    known = raw_sales.select(F.col("vin").alias("_vin")).distinct()
    marked = groups.join(known, F.col("vin") == F.col("_vin"), "left")
    unknown = F.sum(F.when(F.col("_vin").isNull(), F.col("n")))
    sums = {"n_rows": F.sum("n"), "is_vin_not_in_sales": unknown, "is_future_date": F.sum("n_future")}
    return marked.agg(*[F.coalesce(x, F.lit(0)).alias(name) for name, x in sums.items()])


def all_flag_shares(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Share of flagged rows for every flag of the staging layer.

    Where staging is a plan, the shares come from group sizes and key counts; stored tables are counted as they are.
    """
    if not getattr(tables, "is_planned", lambda *_: False)(*FLAGS):
        return union_all(flag_shares(tables[table], table, flags) for table, flags in FLAGS.items())
    tickets = tables.columns("stg_after_sales", "vin", "is_future_date")
    counted = {
        "stg_sales": _repeat_counts(cleaned_sales(tables["raw_sales"])),
        "stg_after_sales": _ticket_counts(tickets, tables["raw_sales"]),
    }
    found = [shares(counts, table, FLAGS[table]) for table, counts in counted.items()]
    return union_all([flag_shares(tables["stg_customers"], "stg_customers", FLAGS["stg_customers"]), *found])
