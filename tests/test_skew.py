"""A third of all rows under one key: results stay whole and no task gathers the hot group."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vinlake.operators import in_folder, with_slice
from vinlake.operators.hot_groups import SLICES
from vinlake.plans import checks
from vinlake.plans.models import Models

ROWS = 12000
LOW_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture(scope="module")
def hot_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("hot"))


@pytest.fixture(scope="module")
def hot(spark, hot_folder):
    """Raw tables with one hot customer, vehicle, sale group and address owner; a sixth without VIN."""
    folder = hot_folder
    key, at = F.col("id"), F.lit("2025-01-01").cast("timestamp_ntz")
    third, text = key % 3 == 0, key.cast("string")
    tables = {
        "raw_customers": [key, F.concat(F.lit("N"), text).alias("name"), F.lit("1990-01-01").alias("dob"), at.alias("created_at")],
        "raw_sales": [
            F.concat(F.lit("V"), text).alias("vin"),
            F.when(third, 1).otherwise(key).cast("bigint").alias("customer_id"),
            F.lit("RAIZA").alias("model"),
            F.when(third, "2025-01-01").otherwise("2025-02-02").cast("date").alias("invoice_date"),
            F.lit("350.000.000").alias("price"),
            at.alias("created_at"),
        ],
        "raw_after_sales": [
            F.concat(F.lit("T"), text).alias("service_ticket"),
            F.when(third, "X1").when(key % 6 == 1, F.lit(None)).otherwise(F.concat(F.lit("V"), text)).alias("vin"),
            F.when(key % 4 < 2, 1).otherwise(key).cast("bigint").alias("customer_id"),
            F.lit("RAIZA").alias("model"),
            F.when(key % 5 == 0, "2030-01-01").otherwise("2025-03-01").cast("date").alias("service_date"),
            F.lit("PM").alias("service_type"),
            at.alias("created_at"),
        ],
        "raw_customer_addresses": [
            text.alias("id"), F.when(third, "1").otherwise(text).alias("customer_id"), F.lit("a").alias("address"),
            F.lit("b").alias("city"), F.lit("c").alias("province"), F.lit("2025-01-01").alias("created_at"),
        ],
    }
    for name, columns in tables.items():
        spark.range(0, ROWS, 1, 8).select(*columns).write.parquet(f"{folder}/{name}")
    return over(spark, folder)


def over(spark, folder, **options):
    names = ("raw_customers", "raw_sales", "raw_after_sales", "raw_customer_addresses")
    raw = {name: (lambda name=name: spark.read.parquet(f"{folder}/{name}")) for name in names}
    return Models(spark, raw, F.lit("2026-01-01").cast("date"), **options)


@pytest.fixture
def low_limits(spark):
    before = {key: spark.conf.get(key, None) for key in LOW_LIMITS}
    for key, value in LOW_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(rows):
    """Rows and the final plan."""
    found = rows.collect()
    return found, rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_sale_flags_equal_windows_and_use_none(hot, low_limits):
    found, plan = run(hot["int_sales_enriched"])
    assert "Window" not in plan
    same = Window.partitionBy("customer_id", "model", "invoice_date")
    expected = hot["raw_sales"].select(
        "vin",
        (F.count("*").over(same) > 1).alias("repeated"),
        (F.row_number().over(same.orderBy("created_at", "vin")) == 1).alias("first"),
    )
    assert {(r.vin, r.is_duplicate_suspect, r.is_canonical) for r in found} == {tuple(r) for r in expected.collect()}
    assert len(found) == ROWS
    facts = hot["fact_sales"].collect()
    assert {r.vin for r in facts} == {r.vin for r in found if r.is_canonical} and len(facts) == ROWS - ROWS // 3 + 1
    assert [r.is_duplicate_suspect for r in facts if r.customer_id == 1 and r.invoice_date.month == 1] == [True]


def test_hot_sale_group_is_spread_over_slices(spark, hot, low_limits):
    """Rows of a sale join with facts under (group, slice), and no slice holds a large share."""
    _, plan = run(hot["stg_sales"])
    join = re.search(r"SortMergeJoin.*", plan).group()
    assert "_fact__slice" in join
    sliced = with_slice(hot["raw_sales"].where("customer_id = 1"), "vin").groupBy("_slice").count()
    sizes = [row["count"] for row in sliced.collect()]
    assert len(sizes) == SLICES and max(sizes) < 3 * ROWS / 3 / SLICES


def test_hot_slices_are_split_further(spark, hot, low_limits):
    """Were a slice still too large for a task, adaptive execution would cut it."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    try:
        for name in ("stg_sales", "stg_after_sales"):
            found, plan = run(hot[name].where("model = 'RAIZA'"))
            assert len(found) == ROWS and re.search(r"SortMergeJoin\(skew=true\).*_fact__slice", plan), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_hot_customer_joins_are_split(hot, low_limits):
    for name in ("int_sales_enriched", "mart_aftersales_priority"):
        _, plan = run(hot[name])
        assert "skew=true" in plan, name


def test_tickets_of_a_hot_or_missing_vehicle(hot, low_limits):
    found, plan = run(hot["stg_after_sales"])
    assert len(found) == ROWS and "Window" not in plan
    for row in found:
        number = int(row.service_ticket[1:])
        assert row.is_vin_not_in_sales == (number % 3 == 0 or number % 6 == 1)
        assert row.is_future_date == (number % 5 == 0)


def test_latest_address_of_a_hot_customer(hot, low_limits):
    found, plan = run(hot["stg_customer_addresses"])
    assert "Window" not in plan and plan.count("SortAggregate") == 2  # reduced before the shuffle
    assert len(found) == len({row.customer_id for row in found})
    newest = max((str(n) for n in range(ROWS) if n % 3 == 0 or n == 1))
    assert [str(row.address_id) for row in found if row.customer_id == 1] == [newest]


def test_invalid_pairs_are_counted_not_formed(hot, low_limits):
    mart = hot["mart_aftersales_priority"].withColumn("vin", F.substring("vin", 1, 1))
    facts = hot["fact_after_sales"].withColumn("vin", F.substring("vin", 1, 1))
    counted, plan = run(checks.served_with_invalid_tickets(mart, facts))
    invalid = facts.where("vin = 'V' AND (is_vin_not_in_sales OR is_future_date)").count()
    assert [(r.vin, r.n_rows) for r in counted] == [("V", mart.count() * invalid)]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_kept_facts_spare_the_wide_shuffle(spark, hot, hot_folder, tmp_path):
    """Facts on disk are small, so rows are flagged where they are read."""
    kept = over(spark, hot_folder, keep=in_folder(str(tmp_path / "work")))
    for name in ("stg_sales", "stg_after_sales"):
        found, plan = run(kept[name])
        assert sorted(found, key=repr) == sorted(hot[name].collect(), key=repr)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
