"""The registered queries: each reads the given tables whole and returns a lazy DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.fixed_values import LANDING_PIPELINE
from vinlake.functions import blank_to_null, mixed_timestamp, strip_space, title_words
from vinlake.operators.quality import failures_of, offending, row_counts
from vinlake.plans import checks, core, serving
from vinlake.plans.models import Models
from vinlake.plans.staging import cleaned_sales
from vinlake.plans.trial_tables import AS_OF, raw_customer_addresses, source, trial_tables
from vinlake.sources.files import well_named
from vinlake.sources.landing import not_loaded

Query = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, folder: str) -> Models:
    """All tables and models over the tables of a folder, as of the fixed day."""
    return Models(spark, trial_tables(spark, folder), F.lit(AS_OF).cast("date"))


def _model(name: str) -> Query:
    return lambda spark, folder: models(spark, folder)[name]


def _checked(kind: str) -> Query:
    return lambda spark, folder: failures_of(checks.declared(kind=kind), models(spark, folder))


def _assertion(name: str) -> Query:
    return lambda spark, folder: checks.assertion(name, models(spark, folder))


def sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return serving.sales_summary_report(models(spark, folder)["mart_sales_summary"])


def aftersales_priority(spark: SparkSession, folder: str) -> DataFrame:
    return serving.aftersales_priority_report(models(spark, folder)["mart_aftersales_priority"])


def calendar_of_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The date dimension over the days that the sales span."""
    sales = cleaned_sales(models(spark, folder)["raw_sales"])
    span = sales.agg(F.min("invoice_date").alias("first_day"), F.max("invoice_date").alias("last_day"))
    return core.calendar(span)


def service_types_used(spark: SparkSession, folder: str) -> DataFrame:
    """The service type dimension with the number of tickets that refer to each type."""
    tables = models(spark, folder)
    used = tables["fact_after_sales"].groupBy("service_type_code").agg(F.count(F.lit(1)).alias("n_tickets"))
    return tables["dim_service_type"].join(used, "service_type_code", "left").withColumn(
        "n_tickets", F.coalesce("n_tickets", F.lit(0))
    )


def readiness(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts({name: table() for name, table in trial_tables(spark, folder).items()})


def flag_rates(spark: SparkSession, folder: str) -> DataFrame:
    return checks.all_flag_shares(models(spark, folder))


def missing_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The rows behind one failing check: staged sales without a price."""
    check = next(c for c in checks.declared("not_null", "staging") if c.name == "not_null_stg_sales_price")
    return offending(check, models(spark, folder))


def served_with_invalid(spark: SparkSession, folder: str) -> DataFrame:
    return checks.planned_serving_pairs(models(spark, folder))


def report_rows_with_invalid(spark: SparkSession, folder: str) -> DataFrame:
    tables = models(spark, folder)
    return checks.report_rows_with_invalid_tickets(tables["mart_aftersales_priority"], tables["fact_after_sales"])


def address_title_case(spark: SparkSession, folder: str) -> DataFrame:
    """City and province as the landing job writes them, from addresses in mixed case."""
    rows = raw_customer_addresses(spark, folder, every_customer=True)
    odd = F.col("id").cast("bigint") % 2 == 1
    city = F.when(odd, F.upper("city")).otherwise(F.concat(F.lit(" rt/rw "), F.lower("city")))
    province = F.when(odd, F.concat(F.lit("o'neil-"), F.lower("province"))).otherwise(F.lit("NULL"))
    return rows.select(
        "id",
        title_words(strip_space(blank_to_null(city))).alias("city"),
        title_words(strip_space(blank_to_null(province))).alias("province"),
    )


def landing_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Timestamps parsed from texts in every shape the landing job knows, and in none."""
    orders = source(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    day = F.col("o_orderdate")
    text = F.expr(
        """CASE o_orderkey % 13 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
           WHEN 1 THEN date_format(o_orderdate, 'yyyy/MM/dd') WHEN 2 THEN date_format(o_orderdate, 'yyyyMMdd HHmmss')
           WHEN 3 THEN date_format(o_orderdate, 'MM/dd/yyyy HH:mm:ss') WHEN 4 THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
           WHEN 5 THEN date_format(o_orderdate, 'yyyy') || '-02-30' WHEN 6 THEN date_format(o_orderdate, 'dd/MM/yyyy HH:mm')
           WHEN 7 THEN date_format(o_orderdate, 'yyyy-MM-dd hh:mm a') WHEN 8 THEN date_format(o_orderdate, 'MMM d yyyy')
           WHEN 9 THEN date_format(o_orderdate, 'd MMMM yyyy hh:mm:ss a') WHEN 10 THEN date_format(o_orderdate, 'MM-dd-yyyy')
           WHEN 11 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') || '+07:00' END"""
    )
    return orders.select("o_orderkey", mixed_timestamp(text).alias("created_at"), day.cast("date").alias("day"))


def pending_files(spark: SparkSession, folder: str) -> DataFrame:
    """Well-named files without a successful load; each order day stands for a file and its audit row."""
    day = F.col("o_orderdate").cast("date")
    days = source(spark, folder, "orders").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    ending = F.when(F.dayofmonth("day") == 1, ".CSV").otherwise(".csv")
    files = days.withColumn("source_file", F.concat(F.lit("customer_addresses_"), F.date_format("day", "yyyyMMdd"), ending))
    audit = files.where("dayofmonth(day) % 2 = 0").select(
        F.when(F.dayofmonth("day") == 2, "other").otherwise(LANDING_PIPELINE).alias("pipeline"),
        F.when(F.month("day") % 3 == 0, "failed").otherwise("success").alias("status"),
        "source_file",
    )
    return not_loaded(well_named(files), audit)


QUERIES: dict[str, Query] = {
    "q_stg_customers": _model("stg_customers"),
    "q_stg_sales": _model("stg_sales"),
    "q_stg_after_sales": _model("stg_after_sales"),
    "q_stg_customer_addresses": _model("stg_customer_addresses"),
    "q_int_customer_enriched": _model("int_customer_enriched"),
    "q_int_sales_enriched": _model("int_sales_enriched"),
    "q_dim_customer": _model("dim_customer"),
    "q_dim_vehicle": _model("dim_vehicle"),
    "q_dim_date": calendar_of_sales,
    "q_dim_service_type": service_types_used,
    "q_fact_sales": _model("fact_sales"),
    "q_fact_after_sales": _model("fact_after_sales"),
    "q_mart_sales_summary": sales_summary,
    "q_mart_aftersales_priority": aftersales_priority,
    "q_dq_unique": _checked("unique"),
    "q_dq_not_null": _checked("not_null"),
    "q_dq_accepted_values": _checked("accepted_values"),
    "q_dq_relationships": _checked("relationships"),
    "q_dq_revenue": _assertion(checks.REVENUE),
    "q_dq_serving_inner": _assertion(checks.SERVING_INNER),
    "q_dq_serving_exists": _assertion(checks.SERVING_EXISTS),
    "q_dq_flag_rates": flag_rates,
    "q_dq_readiness": readiness,
    "q_dq_missing_price_rows": missing_prices,
    "q_dq_serving_inner_rows": served_with_invalid,
    "q_dq_serving_exists_rows": report_rows_with_invalid,
    "q_addr_title_case": address_title_case,
    "q_landing_timestamps": landing_timestamps,
    "q_landing_pending_files": pending_files,
}
