"""Plans: what reaches the scan, how often data is shuffled, what a monthly table prunes."""

import re

import pytest
from pyspark.sql import functions as F

from vinlake.contract.queries import QUERIES, models
from vinlake.operators import as_planned, flag_unknown, in_folder
from vinlake.operators.quality import failures_of
from vinlake.plans import checks
from vinlake.sources.tables import as_monthly_table, by_month, days_between, schema_for

FOLDER = "/root/testdata/sf0.001"


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_no_query_leaves_the_jvm_or_multiplies_tables(spark):
    for name, query in QUERIES.items():
        plan = plan_of(query(spark, FOLDER))
        for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
            assert operator not in plan, (name, operator)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(models(spark, FOLDER)["mart_sales_summary"])
    orders = re.search(r"FileScan parquet \[([^]]*o_orderkey[^]]*)\]", plan).group(1)
    assert set(re.findall(r"[a-z_]+(?=#)", orders)) == {"o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"}
    raw = plan_of(models(spark, FOLDER)["raw_customers"])
    assert "c_nationkey" not in raw and "c_acctbal" not in raw


def test_filters_reach_the_scan(spark, tmp_path):
    models(spark, FOLDER)["raw_sales"].write.parquet(str(tmp_path / "sales"))
    from vinlake.plans.staging import stg_sales

    plan = plan_of(stg_sales(spark.read.parquet(str(tmp_path / "sales"))))
    assert plan.count("PushedFilters: [IsNotNull(vin)]") == 2


def test_sales_facts_are_shuffled_once_before_the_buyer_join(spark):
    """One exchange for the grouping; nothing is joined back."""
    from vinlake.plans.intermediate import canonical_sales

    tables = models(spark, FOLDER)
    plan = plan_of(canonical_sales(tables["raw_sales"], tables["stg_customers"]).drop("customer_name", "customer_type"))
    before_join = plan[plan.index("SortAggregate") :]
    assert before_join.count("Exchange hashpartitioning(customer_id") == 1


def test_counts_and_sums_are_hashed_not_sorted(spark):
    for name in ("stg_sales", "stg_after_sales", "mart_aftersales_priority"):
        plan = plan_of(models(spark, FOLDER)[name])
        assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan
    plan = plan_of(models(spark, FOLDER)["dim_vehicle"])
    assert plan[: plan.index("SortAggregate")].count("HashAggregate") == 2  # partial and final, by model


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("marts") / "fact_sales")
    facts = models(spark, "/root/testdata/sf0.01")["fact_sales"]
    return as_monthly_table(facts, path, "invoice_date", ["customer_id", "price_class"], key="vin")


def test_a_span_of_days_reads_only_its_months(monthly):
    span = days_between(monthly, "invoice_date", "1997-03-10", "1997-04-02")
    found = span.collect()
    plan = plan_of(span)
    assert "PartitionFilters: [isnotnull(invoice_date_month" in plan, plan
    everything = monthly.where("invoice_date BETWEEN DATE '1997-03-10' AND DATE '1997-04-02'")
    assert len(found) == everything.count() > 0


def test_a_hot_month_is_cut_into_files_by_customer(spark):
    rows = spark.range(0, 20000, 1, 4).select(
        F.col("id").alias("vin"), (F.col("id") % 997).alias("customer_id"), F.lit("2025-05-05").cast("date").alias("invoice_date")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = by_month(rows, "invoice_date", "invoice_date_month", "customer_id", "vin")
        spans = (
            parts.groupBy(F.spark_partition_id().alias("part"))
            .agg(F.min("customer_id").alias("low"), F.max("customer_id").alias("high"), F.count("*").alias("n"))
            .orderBy("low")
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(spans) == 8 and max(span.n for span in spans) < 2 * 20000 / 8
    assert all(left.high <= right.low for left, right in zip(spans, spans[1:]))


def test_facts_are_broadcast_only_by_the_size_they_are_joined_with(spark, tmp_path):
    """Groups that occupy all slices: few rows before they are repeated per slice, many after."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(400 * 320).selectExpr("id % 400 as vin", "id as ticket")
    known = spark.range(400, 500).selectExpr("id as vin")
    bytes_before, bytes_after = 400 * 64, 400 * 64 * 12
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str((bytes_before + bytes_after) // 2))
    try:
        for keep in (as_planned, in_folder(str(tmp_path))):
            flagged = flag_unknown(rows, "vin", known, ["ticket"], "is_unknown", keep)
            assert flagged.where("is_unknown").count() == 400 * 320
            flagged.collect()
            assert "BroadcastHashJoin" not in plan_of(flagged).split("_slice")[0], keep
        few = flag_unknown(rows.where("vin = 7"), "vin", known, ["ticket"], "is_unknown", in_folder(str(tmp_path)))
        assert "BroadcastHashJoin" in plan_of(few)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_checks_plan_only_what_they_read(spark):
    """One scan of a raw table per grouping of its keys, no flag is planned and nothing is joined for it."""
    scans = lambda rows, column: len(re.findall(rf"FileScan parquet \[[^]]*{column}", plan_of(rows)))
    tables = models(spark, FOLDER)
    for table, column, scanned in (("stg_sales", "vin", "o_orderkey"), ("stg_after_sales", "service_ticket", "l_orderkey")):
        check = [c for c in checks.declared("unique") if c.table == table and c.column == column]
        rows = failures_of(check, tables)
        assert scans(rows, scanned) == 1 and ("Join" not in plan_of(rows) or table == "stg_after_sales")
    assert scans(QUERIES["q_dq_unique"](spark, FOLDER), "o_orderkey") <= 8
    assert scans(QUERIES["q_dq_flag_rates"](spark, FOLDER), "o_orderkey") <= 3
    assert scans(QUERIES["q_dq_serving_inner"](spark, FOLDER), "l_orderkey") == 1


def test_narrow_models_have_the_rows_of_the_whole_ones(spark):
    tables = models(spark, "/root/testdata/sf0.01")
    for name, columns in (("stg_sales", ["vin", "price"]), ("fact_sales", ["vin", "customer_id", "price"]), ("dim_vehicle", ["model", "avg_price"])):
        narrow, whole = tables.columns(name, *columns), tables[name].select(*columns)
        assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()
    pairs = checks.served_with_invalid_tickets(tables["mart_aftersales_priority"], tables["fact_after_sales"])
    assert pairs.exceptAll(checks.planned_serving_pairs(tables)).isEmpty()
    tables["fact_sales"] = tables["fact_sales"].limit(3)
    assert tables.columns("fact_sales", "vin").count() == 3


def test_schema_of_a_layer():
    assert schema_for(None, "warehouse") == "warehouse" and schema_for(" marts ", "warehouse") == "marts"
