"""Rules that clean data never shows."""

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from test_seed import ADDRESSES, CUSTOMERS, SALES, TICKETS, make_models
from vinlake.functions import blank_to_null, mixed_date, mixed_timestamp, price_class, strip_space, title_words
from vinlake.operators import first_per_key, left_join_splittable
from vinlake.operators.quality import failures_of, offending
from vinlake.plans import checks, core
from vinlake.plans.staging import SALE_KEYS, SALE_ORDER, cleaned_sales, stg_sales
from vinlake.sources.jdbc import hash_predicates, range_predicates
from vinlake.schemas import RAW_SALES
from vinlake.sources.tables import read_raw, replace_partitions

AT = datetime(2025, 1, 1)


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(n, value) for n, value in enumerate(values)], f"n INT, v {kind}")
    return [row.r for row in rows.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()]


def test_title_words_like_python(spark):
    texts = ["rt/rw", "DKI", "o'neil", "jakarta PUSAT", "élan 2nd", "", " a ", None]
    assert apply(spark, title_words, texts) == [text if text is None else text.title() for text in texts]


def test_strip_space_takes_every_kind(spark):
    assert apply(spark, strip_space, ["\t  Bekasi \n", "a b", "  ", None]) == ["Bekasi", "a b", "", None]


def test_missing_texts(spark):
    assert apply(spark, blank_to_null, ["", "N/A", "null", "nan", "Nan", " ", "x", None]) == [None] * 4 + ["Nan", " ", "x", None]


def test_dates_of_birth(spark):
    texts = ["1998-08-04", "1980/11/15", "14/01/1995", "2001-02-30", "11/15/1980", "1998-8-4", "1998-08-04\n", "", "unknown", None]
    assert apply(spark, mixed_date, texts) == [date(1998, 8, 4), date(1980, 11, 15), date(1995, 1, 14)] + [None] * 7


def test_landing_timestamps(spark):
    texts = ["2025-03-01 14:24:40", "2025/3/9", "20250309", "03/09/2025 10:00", "2025-03-30T02:30:00", "2025-02-30", "soon", None]
    day = datetime(2025, 3, 9)
    expected = [datetime(2025, 3, 1, 14, 24, 40), day, day, day.replace(hour=10), datetime(2025, 3, 30, 2, 30), None, None, None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # has no 02:30 on that day
    try:
        assert apply(spark, mixed_timestamp, texts) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_landing_timestamps_in_other_shapes(spark):
    day, noon = datetime(2025, 1, 14), datetime(2025, 1, 14, 12, 5)
    expected = {
        "14/01/2025 10:00": day.replace(hour=10), "01/14/2025": day, "14-01-2025": day, "01-03-2025": datetime(2025, 1, 3),
        "03/04/2025": datetime(2025, 3, 4), "2025-03-01 02:24 PM": datetime(2025, 3, 1, 14, 24), "2025-01-14 12:05 pm": noon,
        "2025-01-14 12:05:07 AM": datetime(2025, 1, 14, 0, 5, 7), "Mar 1 2025": datetime(2025, 3, 1), "1 March 2025": datetime(2025, 3, 1),
        "March 1st, 2025 2:24 pm": datetime(2025, 3, 1, 14, 24), "1-Mar-2025": datetime(2025, 3, 1),
        "20250309 101112": datetime(2025, 3, 9, 10, 11, 12), "2025-03-01T14:24:40+07:00": datetime(2025, 3, 1, 14, 24, 40),
        "2025-03-01T14:24:40.5Z": datetime(2025, 3, 1, 14, 24, 40, 500000), "2025.03.01": datetime(2025, 3, 1),
        "2025-01-14 13:05 PM": None, "2025-01-14 25:00": None, "Mai 1 2025": None, "31/02/2025": None, "14/13/2025": None,
        "2025-03-01 soon": None, "202503011": None, "": None, "12": None,
    }
    assert dict(zip(expected, apply(spark, mixed_timestamp, list(expected)), strict=True)) == expected


def test_price_classes_at_their_bounds(spark):
    prices = [None, -5, 99_999_999, 100_000_000, 250_000_000, 250_000_001, 400_000_000, 400_000_001]
    classes = ["UNDEFINED"] * 3 + ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH"]
    assert apply(spark, price_class, prices, "BIGINT") == classes
    assert apply(spark, price_class, [250_000_000.5], "DOUBLE") == ["UNDEFINED"]


def test_average_between_two_classes(spark):
    facts = spark.createDataFrame([("A", 250_000_000), ("A", 250_000_001), ("B", None)], "model STRING, price BIGINT")
    rows = {row.model: tuple(row)[1:] for row in core.dim_vehicle(facts).collect()}
    assert rows == {"A": (250_000_000, 250_000_001, 250_000_000.5, "UNDEFINED"), "B": (None, None, None, "UNDEFINED")}


def test_customers_without_name_or_with_odd_dates(spark):
    customers = [(1, None, None, AT), (2, None, "1990-01-01", AT), (3, "pt x", "", AT), (4, "PT", "1900/01/01", AT), (None, "PT Y", None, AT)]
    rows = {r.customer_id: (r.customer_type, r.is_dob_suspect, r.date_of_birth) for r in make_models(spark, raw_customers=customers)["stg_customers"].collect()}
    assert rows == {
        1: ("corporate", True, None),
        2: ("individual", False, date(1990, 1, 1)),
        3: ("individual", False, None),
        4: ("individual", False, date(1900, 1, 1)),
    }


def test_sales_without_keys(spark):
    sales = [
        ("a", None, None, None, "1", AT), ("b", None, None, None, "1", AT), (None, 1, "X", date(2025, 1, 1), "1", AT),
        ("c", None, "X", date(2025, 1, 1), " 5 ", None), ("d", None, "X", date(2025, 1, 1), "x", AT),
    ]
    models = make_models(spark, raw_sales=sales)
    assert {(r.vin, r.is_duplicate_suspect, r.price) for r in models["stg_sales"].collect()} == {
        ("a", True, 1), ("b", True, 1), ("c", True, 5), ("d", True, None),
    }
    assert {(r.vin, r.is_canonical, r.price_class) for r in models["int_sales_enriched"].collect()} == {
        ("c", True, "UNDEFINED"), ("d", False, "UNDEFINED"),
    }
    assert [r.vin for r in models["fact_sales"].collect()] == ["c"]


def test_raw_invoice_date_with_a_time_of_day(spark):
    """Repeats are told by the raw value, the sale that counts by its day."""
    at = [datetime(2025, 1, 1, hour) for hour in (8, 8, 9)]
    rows = [(vin, 1, "X", invoiced, "5", created) for vin, invoiced, created in zip("abc", at, at)]
    sales = spark.createDataFrame(
        rows, "vin STRING, customer_id BIGINT, model STRING, invoice_date TIMESTAMP_NTZ, price STRING, created_at TIMESTAMP_NTZ"
    )
    models = make_models(spark)
    models["raw_sales"] = sales
    assert {(r.vin, r.is_duplicate_suspect) for r in models["stg_sales"].collect()} == {("a", True), ("b", True), ("c", False)}
    flags = {(r.vin, r.is_duplicate_suspect, r.is_canonical) for r in models["int_sales_enriched"].collect()}
    assert flags == {("a", True, True), ("b", True, False), ("c", False, False)}
    assert [(r.vin, r.is_duplicate_suspect) for r in models["fact_sales"].collect()] == [("a", True)]


def test_one_of_many_copies_counts(spark, tmp_path):
    """A third of the table is one row over and over; the stored table tells the copies apart."""
    path = str(tmp_path / "raw_sales")
    rows = spark.createDataFrame(SALES, RAW_SALES)
    copies = spark.createDataFrame([SALES[0]] * 200, RAW_SALES)
    others = spark.range(400).select(
        F.concat(F.lit("W"), "id").alias("vin"), F.col("id").alias("customer_id"),
        F.lit("X").alias("model"), F.lit("2025-01-01").cast("date").alias("invoice_date"), F.lit("5").alias("price"),
        F.lit("2025-01-01").cast("timestamp_ntz").alias("created_at"),
    )
    copies.union(others).repartition(6).write.parquet(path)
    models = make_models(spark)
    models["raw_sales"] = read_raw(spark, path, "raw_sales")
    enriched = models["int_sales_enriched"].where(F.col("vin") == SALES[0][0]).collect()
    assert len(enriched) == 200 and all(row.is_duplicate_suspect for row in enriched)
    assert sum(row.is_canonical for row in enriched) == 1
    assert models["fact_sales"].count() == 401 and models["stg_sales"].where("is_duplicate_suspect").count() == 200
    assert stg_sales(models["raw_sales"]).columns == stg_sales(rows).columns


def test_tickets_without_vehicle_or_date(spark):
    tickets = [
        ("t1", None, 1, "X", date(2025, 1, 1), "PM", AT), ("t2", "JIS8135SAD", 1, "X", None, "PM", AT),
        (None, "JIS8135SAD", 1, "X", None, "PM", AT),
    ]
    models = make_models(spark, raw_after_sales=tickets)
    flags = {(r.service_ticket, r.is_vin_not_in_sales, r.is_future_date) for r in models["stg_after_sales"].collect()}
    assert flags == {("t1", True, False), ("t2", False, False)}
    assert [(r.periode, r.vin, r.count_service) for r in models["mart_aftersales_priority"].collect()] == [(None, "JIS8135SAD", 1)]


def test_a_repeated_sale_does_not_repeat_tickets(spark):
    models = make_models(spark, raw_sales=[*SALES, SALES[1], SALES[1]])
    assert models["stg_after_sales"].count() == len(TICKETS)


def test_priority_bounds(spark):
    tickets = [
        (f"t{vin}{n}", SALES[vin][0], 3, "X", date(2025, 1, 1), "PM", AT) for vin, n_tickets in enumerate((4, 5, 10, 11)) for n in range(n_tickets)
    ]
    rows = make_models(spark, raw_after_sales=tickets)["mart_aftersales_priority"].collect()
    assert {(r.count_service, r.priority) for r in rows} == {(4, "LOW"), (5, "MED"), (10, "MED"), (11, "HIGH")}


def test_address_ids_are_told_apart_as_text(spark):
    addresses = [
        ("1", "1", "A", "c", "p", "2025-03-10"), ("2", "1", "B", "c", "p", "2025-3-9"), ("3", "01", "C", "c", "p", "2025-01-01"),
        ("x", "y", "D", "c", "p", "2025-01-01"), ("5", "2", "E", "c", "p", None), ("4", "2", "F", None, "p", "2025-01-01"),
    ]
    models = make_models(spark, raw_customer_addresses=addresses)
    rows = {tuple(row)[:4] for row in models["stg_customer_addresses"].collect()}
    assert rows == {(2, 1, "B", "c"), (3, 1, "C", "c"), (None, None, "D", "c"), (4, 2, "F", None)}
    fanned = [row for row in models["dim_customer"].collect() if row.customer_id == 1]
    assert len(fanned) == 2
    failed = failures_of(checks.declared("unique", "marts"), models).where("failures > 0").collect()
    assert [tuple(row) for row in failed] == [("unique_dim_customer_customer_id", 1)]
    assert {r.full_address for r in models["dim_customer"].collect() if r.customer_id == 2} == {"Alamat tidak tersedia"}


def _outcome(models):
    rows = failures_of(checks.DECLARED, models).collect()
    assert len(rows) == 35
    return {row.check_name: row.failures for row in rows if row.failures}


def test_declared_checks_catch_what_they_name(spark):
    sales = [
        *SALES[:3], ("n1", 99, "Q", date(2025, 1, 1), "-5", AT), ("n2", None, "R", date(2025, 1, 1), "N/A", AT),
        SALES[0][:1] + (2, "Z", date(2025, 2, 2), "1", AT), (None, 2, "Z", date(2025, 2, 2), "1", AT),
    ]
    models = make_models(spark, raw_sales=sales, raw_customers=[*CUSTOMERS, (None, "x", None, AT)])
    assert _outcome(models) == {
        "not_null_raw_customers_id": 1,
        "unique_raw_sales_vin": 1,
        "not_null_raw_sales_vin": 1,
        "unique_stg_sales_vin": 1,
        "not_null_stg_sales_price": 1,
        "unique_fact_sales_vin": 1,
        "not_null_fact_sales_customer_id": 1,
        "not_null_fact_sales_price": 1,
        "relationships_fact_sales_customer_id": 1,
        "not_null_mart_sales_summary_total": 1,
    }
    by_name = {check.name: check for check in checks.DECLARED}
    assert [tuple(r) for r in offending(by_name["relationships_fact_sales_customer_id"], models).collect()] == [(99, 1)]
    assert [tuple(r) for r in offending(by_name["unique_fact_sales_vin"], models).collect()] == [("JIS8135SAD", 2)]
    assert [r.model for r in offending(by_name["not_null_mart_sales_summary_total"], models).collect()] == ["R"]
    assert [tuple(r) for r in checks.negative_revenue(models["fact_sales"]).collect()] == [("n1", -5)]
    assert checks.assertion(checks.REVENUE, models).first().failures == 1


def test_unexpected_values_count_once_each(spark):
    models = make_models(spark)
    kinds = F.expr("CASE WHEN customer_id < 4 THEN 'firm' WHEN customer_id < 6 THEN 'state' END")
    models["stg_customers"] = models["stg_customers"].withColumn("customer_type", kinds)
    check = next(c for c in checks.declared("accepted_values") if c.table == "stg_customers")
    assert failures_of([check], models).first().failures == 2
    assert sorted(tuple(r) for r in offending(check, models).collect()) == [("firm", 3), ("state", 2)]


def test_serving_checks_match_on_the_vehicle(spark):
    """A vehicle with a valid and a future ticket is rightly in the report and fails both checks."""
    future = [(ticket, "MAS8160POE", 3, "RANGGO", date(2030, 1, 1), "PM", AT) for ticket in ("f1", "f2")]
    tickets = [*TICKETS, *future]
    models = make_models(spark, raw_after_sales=tickets)
    assert checks.assertion(checks.SERVING_INNER, models).first().failures == 2
    assert checks.assertion(checks.SERVING_EXISTS, models).first().failures == 1
    rows = checks.report_rows_with_invalid_tickets(models["mart_aftersales_priority"], models["fact_after_sales"]).collect()
    assert [(row.vin, row.periode) for row in rows] == [("MAS8160POE", 2025)]


def test_flag_shares(spark):
    shares = {row.flag: (row.n_rows, row.flagged, row.share) for row in checks.all_flag_shares(make_models(spark)).collect()}
    assert shares == {
        "is_dob_suspect": (6, 2, 2 / 6), "is_duplicate_suspect": (5, 2, 2 / 5),
        "is_vin_not_in_sales": (3, 1, 1 / 3), "is_future_date": (3, 1, 1 / 3),
    }


SALE = st.tuples(
    st.sampled_from([None, 1, 2]), st.sampled_from([None, "X", "Y"]), st.sampled_from([None, date(2025, 1, 1), date(2025, 1, 2)]),
    st.sampled_from([None, AT, datetime(2025, 1, 2)]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(SALE, min_size=1, max_size=30))
def test_one_sale_counts_per_group(spark, drawn):
    sales = [(f"V{n:02}", customer, model, day, "7", at) for n, (customer, model, day, at) in enumerate(drawn)]
    models = make_models(spark, raw_sales=sales)
    staged = {row.vin: row for row in models["stg_sales"].collect()}
    enriched = models["int_sales_enriched"].collect()
    groups = {}
    for vin, customer, model, day, _, at in sales:
        groups.setdefault((customer, model, day), []).append(((at is not None, at or AT), vin))
    assert set(staged) == {sale[0] for sale in sales}
    for members in groups.values():
        assert all(staged[vin].is_duplicate_suspect == (len(members) > 1) for _, vin in members)
    first = {min(members)[1] for key, members in groups.items() if key[2]}
    assert {row.vin for row in enriched if row.is_canonical} == first == {r.vin for r in models["fact_sales"].collect()}
    assert len(enriched) == sum(sale[3] is not None for sale in sales)


def test_hash_predicates_split_a_table():
    assert range_predicates("id", [5, 1, 9]) == ["id < 5 OR id IS NULL", "id >= 5 AND id < 9", "id >= 9"]
    assert range_predicates("id", []) == range_predicates("id", [3]) == ["1 = 1"]
    assert hash_predicates("vin", 2) == ["MOD(CRC32(vin), 2) = 0 OR vin IS NULL", "MOD(CRC32(vin), 2) = 1"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n INT, part STRING")
    path = str(tmp_path / "parts")
    replace_partitions(rows, path, "part")
    replace_partitions(spark.createDataFrame([(3, "b")], "n INT, part STRING"), path, "part")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_first_per_key_keeps_columns(spark):
    sales = spark.createDataFrame(SALES, "vin STRING, customer_id BIGINT, model STRING, invoice_date DATE, price STRING, created_at TIMESTAMP_NTZ")
    cleaned = cleaned_sales(sales)
    first = first_per_key(cleaned, list(SALE_KEYS), SALE_ORDER, rows_as="n")
    assert first.columns == [*cleaned.columns, "n"] and {r.n for r in first.collect() if r.model == "VELOS"} == {2}


def test_splittable_join_beside_columns_of_any_name(spark):
    left = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (None, "e", "f")], "k int, _right_key string, _RIGHT_HASH string")
    right = spark.createDataFrame([(1, "x")], "k int, _right_key_ string")
    found = left_join_splittable(left, right, "k")
    assert found.columns == ["k", "_right_key", "_RIGHT_HASH", "_right_key_"]
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "a", "b", "x"), (2, "c", "d", None), (None, "e", "f", None)]
    assert [r._right_key for r in left_join_splittable(left, right, "k", "left_semi").collect()] == ["a"]
