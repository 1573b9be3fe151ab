"""The documented seed rows through the whole warehouse, with the results known beforehand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vinlake.operators import as_planned, in_folder
from vinlake.plans.models import Models
from vinlake.plans.warehouse import GateFailed, Schemas, build, stored_marts
from vinlake.schemas import RAW_TABLES
from vinlake.session import work_folder
from vinlake.sources.tables import published


def _at(text):
    return datetime.fromisoformat(text)


CUSTOMERS = [
    (1, "Antonio", "1998-08-04", _at("2025-03-01 14:24:40.012")),
    (2, "Brandon", "2001-04-21", _at("2025-03-02 08:12:54.003")),
    (3, "Charlie", "1980/11/15", _at("2025-03-02 11:20:02.391")),
    (4, "Dominikus", "14/01/1995", _at("2025-03-03 09:50:41.852")),
    (5, "Erik", "1900-01-01", _at("2025-03-03 17:22:03.198")),
    (6, "PT Black Bird", None, _at("2025-03-04 12:52:16.122")),
]
SALES = [
    ("JIS8135SAD", 1, "RAIZA", date(2025, 3, 1), "350.000.000", _at("2025-03-01 14:24:40.012")),
    ("MAS8160POE", 3, "RANGGO", date(2025, 5, 19), "430.000.000", _at("2025-05-19 14:29:21.003")),
    ("JLK1368KDE", 4, "INNAVO", date(2025, 5, 22), "600.000.000", _at("2025-05-22 16:10:28.120")),
    ("JLK1869KDF", 6, "VELOS", date(2025, 8, 2), "390.000.000", _at("2025-08-02 14:04:31.021")),
    ("JLK1962KOP", 6, "VELOS", date(2025, 8, 2), "390.000.000", _at("2025-08-02 15:21:04.201")),
]
TICKETS = [
    ("T124-kgu1", "MAS8160POE", 3, "RANGGO", date(2025, 7, 11), "BP", _at("2025-07-11 09:24:40.012")),
    ("T560-jga1", "JLK1368KDE", 4, "INNAVO", date(2025, 8, 4), "PM", _at("2025-08-04 10:12:54.003")),
    ("T521-oai8", "POI1059IIK", 5, "RAIZA", date(2026, 9, 10), "GR", _at("2026-09-10 12:45:02.391")),
]
ADDRESSES = [
    ("1", "3", "Jl Lama 1", " Bekasi ", " Jawa Barat ", "2026-03-01 14:24:40"),
    ("2", "3", "Jl Baru 2", "\tJAKARTA PUSAT ", "DKI Jakarta ", "2026-03-02 14:24:40"),
]


def make_models(spark, as_of="2026-03-01", keep=as_planned, **changed):
    rows = {
        "raw_customers": CUSTOMERS, "raw_sales": SALES, "raw_after_sales": TICKETS,
        "raw_customer_addresses": ADDRESSES, **changed,
    }
    raw = {
        name: lambda name=name: spark.createDataFrame(rows[name], RAW_TABLES[name]) for name in RAW_TABLES
    }
    return Models(spark, raw, F.lit(as_of).cast("date"), keep)


@pytest.fixture(scope="module")
def seed(spark):
    return make_models(spark)


def test_customers(seed):
    rows = {row.customer_id: row for row in seed["stg_customers"].collect()}
    assert [rows[i].date_of_birth for i in range(1, 7)] == [
        date(1998, 8, 4), date(2001, 4, 21), date(1980, 11, 15), date(1995, 1, 14), date(1900, 1, 1), None,
    ]
    assert {i for i in rows if rows[i].is_dob_suspect} == {5, 6}
    assert {i for i in rows if rows[i].customer_type == "corporate"} == {6}


def test_sales_flags_and_facts(seed):
    flagged = seed["stg_sales"].where("is_duplicate_suspect").collect()
    assert {row.vin for row in flagged} == {"JLK1869KDF", "JLK1962KOP"}
    assert len(seed["stg_sales"].collect()) == 5
    enriched = {row.vin: row.is_canonical for row in seed["int_sales_enriched"].collect()}
    assert [vin for vin, canonical in enriched.items() if not canonical] == ["JLK1962KOP"]
    assert {row.vin for row in seed["fact_sales"].collect()} == set(enriched) - {"JLK1962KOP"}


def test_tickets(spark, seed):
    rows = {row.service_ticket: row for row in seed["stg_after_sales"].collect()}
    assert rows["T521-oai8"].is_vin_not_in_sales and rows["T521-oai8"].is_future_date
    assert not any(rows[t].is_vin_not_in_sales or rows[t].is_future_date for t in ("T124-kgu1", "T560-jga1"))
    later = make_models(spark, as_of="2026-12-01")["stg_after_sales"].where("service_ticket = 'T521-oai8'").first()
    assert later.is_vin_not_in_sales and not later.is_future_date


def test_addresses(seed):
    rows = [tuple(row) for row in seed["stg_customer_addresses"].collect()]
    assert rows == [(2, 3, "Jl Baru 2", "JAKARTA PUSAT", "DKI Jakarta", "2026-03-02 14:24:40")]
    full = {row.customer_id: row.full_address for row in seed["dim_customer"].collect()}
    assert full[3] == "Jl Baru 2, JAKARTA PUSAT, DKI Jakarta" and full[1] == "Alamat tidak tersedia"


def test_reports(seed):
    assert sorted(map(tuple, seed["mart_sales_summary"].collect())) == [
        ("2025-03", "MEDIUM", "RAIZA", 350000000, 1),
        ("2025-05", "HIGH", "INNAVO", 600000000, 1),
        ("2025-05", "HIGH", "RANGGO", 430000000, 1),
        ("2025-08", "MEDIUM", "VELOS", 390000000, 1),
    ]
    assert sorted(map(tuple, seed["mart_aftersales_priority"].collect())) == [
        (2025, "JLK1368KDE", "Dominikus", "Alamat tidak tersedia", 1, "LOW"),
        (2025, "MAS8160POE", "Charlie", "Jl Baru 2, JAKARTA PUSAT, DKI Jakarta", 1, "LOW"),
    ]


def test_dimensions(seed):
    vehicles = {row.model: row for row in seed["dim_vehicle"].collect()}
    assert {m: r.default_price_class for m, r in vehicles.items()} == {
        "RAIZA": "MEDIUM", "RANGGO": "HIGH", "INNAVO": "HIGH", "VELOS": "MEDIUM",
    }
    assert all(row.min_price == row.max_price == row.avg_price for row in vehicles.values())
    days = seed["dim_date"].orderBy("date_id").collect()
    assert (len(days), days[0].date_id, days[-1].date_id) == (1461, date(2024, 1, 1), date(2027, 12, 31))
    new_year = days[366]
    assert tuple(new_year) == (date(2025, 1, 1), 2025, 1, 1, "2025-01", "January", "Wednesday", 4, False)
    assert all(day.is_weekend == (day.date_id.weekday() >= 5) for day in days)
    assert [row.service_type_code for row in seed["dim_service_type"].collect()] == ["BP", "PM", "GR"]


def test_all_checks_pass_and_tables_are_stored(spark, tmp_path):
    kept, schemas = in_folder(work_folder(spark, str(tmp_path))), Schemas(str(tmp_path / "warehouse"), marts=None)
    outcome = build(make_models(spark, keep=kept), schemas)
    assert len(outcome) == 38 and all(row.failures == 0 for row in outcome)
    assert schemas.marts_folder.endswith("warehouse/warehouse")
    marts = stored_marts(spark, schemas)
    assert marts["fact_sales"].count() == 4
    assert {"dbt_loaded_at", "invoice_date_month"} <= set(marts["fact_sales"].columns)
    assert set(marts) == {
        "dim_customer", "dim_vehicle", "dim_date", "dim_service_type", "fact_sales", "fact_after_sales",
        "mart_sales_summary", "mart_aftersales_priority",
    }
    assert spark.table("stg_sales").count() == 5


def test_a_bad_layer_stops_the_run(spark, tmp_path):
    unpriced, schemas = [*SALES[:4], (*SALES[4][:4], "N/A", SALES[4][5])], Schemas(str(tmp_path / "warehouse"))
    with pytest.raises(GateFailed, match=r"^staging: not_null_stg_sales_price \(1\)$"):
        build(make_models(spark, raw_sales=unpriced), schemas)
    assert published(spark, schemas.marts_folder) is None
    with pytest.raises(GateFailed, match="empty raw tables: raw_sales"):
        build(make_models(spark, raw_sales=[]), schemas)
