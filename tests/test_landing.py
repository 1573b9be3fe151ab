"""Landing of address files: once per file, whole files only, one bad file harms no other."""

import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from vinlake.sources import landing
from vinlake.sources.files import find_files, latest_file
from vinlake.sources.landing import land_addresses, read_audit, read_landed
from vinlake.sources.raw_load import load_latest_addresses, load_source_table, read_address_file
from vinlake.streaming.address_drop import stream_addresses, stream_once

GOOD = " ID ,Customer_Id,ADDRESS,city,Province,created_at\n1,10,Jl A 1, bekasi ,jawa BARAT,2025-03-01 14:24:40\n2,11,,DKI rt/rw,N/A,soon\n"
MOVED = 'created_at,province,city,address,customer_id,id\n2025/03/02,BALI,denpasar,"Jl B, 2\nBlok ""C""",12,3\n'


@pytest.fixture
def drop(tmp_path):
    class Drop:
        folder, landing, audit = (str(tmp_path / name) for name in ("drop", "landing", "audit"))

        def put(self, name, content):
            with open(os.path.join(self.folder, name), "wb") as file:
                file.write(content.encode() if isinstance(content, str) else content)

        def run(self, spark, day="*"):
            land_addresses(spark, self.folder, self.landing, self.audit, day)

        def stream(self, spark):
            query = stream_addresses(spark, self.folder, self.landing, self.audit, str(tmp_path / "checkpoint"))
            query.awaitTermination(120)
            assert query.exception() is None

        def outcomes(self, spark):
            return {r.source_file[19:-4]: (r.status, r.rows_loaded, r.error_message) for r in read_audit(spark, self.audit).collect()}

        def rows(self, spark):
            return sorted(tuple(row)[:6] for row in read_landed(spark, self.landing).collect())

    os.mkdir(tmp_path / "drop")
    return Drop()


ROWS = [
    (1, 10, "Jl A 1", "Bekasi", "Jawa Barat", datetime(2025, 3, 1, 14, 24, 40)),
    (2, 11, None, "Dki Rt/Rw", None, None),
    (3, 12, 'Jl B, 2\nBlok "C"', "Denpasar", "Bali", datetime(2025, 3, 2)),
]


def fill(drop):
    drop.put("customer_addresses_20250301.csv", GOOD)
    drop.put("customer_addresses_20250302.csv", MOVED)
    drop.put("customer_addresses_2025.csv", GOOD)
    drop.put("customer_addresses_20250303.csv", "")
    drop.put("customer_addresses_20250304.csv", b"id,customer_id\n\xff\xfe,1\n")
    drop.put("customer_addresses_20250305.csv", "id,zip\n1,2\n")
    drop.put("customer_addresses_20250306.csv", "id,customer_id\n1,2\n3,4,5\n")
    drop.put("customer_addresses_20250307.csv", "id,customer_id\n")
    drop.put("customer_addresses_20250308.csv", "id,id\n1,2\n")
    drop.put("customer_addresses_20250311.csv", 'id,city\n1,"2\n3,4\n')


OUTCOMES = {
    "20250301": ("success", 2, None),
    "20250302": ("success", 1, None),
    "20250303": ("failed", 0, "no columns in file"),
    "20250304": ("failed", 0, "not valid UTF-8"),
    "20250305": ("failed", 0, "unknown column: zip"),
    "20250306": ("failed", 0, "1 rows with more fields than the header"),
    "20250307": ("success", 0, None),
    "20250308": ("failed", 0, "repeated column"),
    "20250311": ("failed", 0, "a quote is never closed"),
}


def test_files_load_once_and_bad_ones_fail_alone(spark, drop):
    fill(drop)
    drop.run(spark)
    assert drop.outcomes(spark) == OUTCOMES
    assert drop.rows(spark) == ROWS
    drop.run(spark)
    assert drop.rows(spark) == ROWS and drop.outcomes(spark) == OUTCOMES


def test_a_failed_file_is_tried_again_and_its_error_cleared(spark, drop):
    drop.put("customer_addresses_20250305.csv", "id,zip\n1,2\n")
    drop.run(spark)
    assert drop.outcomes(spark) == {"20250305": OUTCOMES["20250305"]}
    drop.put("customer_addresses_20250305.csv", GOOD)
    drop.run(spark)
    assert drop.outcomes(spark) == {"20250305": ("success", 2, None)}
    assert drop.rows(spark) == ROWS[:2]


def test_one_day_only(spark, drop):
    fill(drop)
    drop.run(spark, day="20250302")
    assert set(drop.outcomes(spark)) == {"20250302"} and drop.rows(spark) == ROWS[2:]


def test_a_file_missing_a_column_loads_with_nulls(spark, drop):
    drop.put("customer_addresses_20250301.csv", "id,customer_id\n7,8\n9\n")
    drop.run(spark)
    assert drop.rows(spark) == [(7, 8, None, None, None, None), (9, None, None, None, None, None)]


def test_crash_between_rows_and_audit_loads_no_row_twice(spark, drop, monkeypatch):
    fill(drop)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(landing, "_write_audit", crash)
        with pytest.raises(KeyboardInterrupt):
            drop.run(spark)
    assert drop.rows(spark) == ROWS and drop.outcomes(spark) == {}
    drop.run(spark)
    assert drop.rows(spark) == ROWS and drop.outcomes(spark) == OUTCOMES


def test_an_unreadable_file_fails_alone(spark, drop):
    fill(drop)
    missing = os.path.join(drop.folder, "customer_addresses_20250309.csv")
    present = [os.path.join(drop.folder, f"customer_addresses_{day}.csv") for day in OUTCOMES]
    landing.load_files(spark, [*present, missing], drop.landing, drop.audit)
    outcomes = drop.outcomes(spark)
    assert outcomes.pop("20250309")[0] == "failed" and outcomes == OUTCOMES
    assert drop.rows(spark) == ROWS


def test_more_files_than_one_load_takes(spark, drop, monkeypatch):
    monkeypatch.setattr(landing, "FILES_PER_LOAD", 3)
    fill(drop)
    drop.run(spark)
    assert drop.outcomes(spark) == OUTCOMES and drop.rows(spark) == ROWS


def test_stream_delivers_each_file_once(spark, drop):
    fill(drop)
    drop.stream(spark)
    not_empty = {day: outcome for day, outcome in OUTCOMES.items() if day != "20250303"}
    assert drop.outcomes(spark) == not_empty and drop.rows(spark) == ROWS
    drop.stream(spark)
    assert drop.rows(spark) == ROWS
    drop.put("customer_addresses_20250310.csv", GOOD.replace("1,10", "4,10"))
    drop.put("customer_addresses_20250305.csv", GOOD)  # failed before: left to the batch run
    drop.stream(spark)
    assert drop.outcomes(spark)["20250310"] == ("success", 2, None)
    drop.run(spark)
    assert drop.outcomes(spark)["20250305"] == ("success", 2, None)
    assert len(drop.rows(spark)) == 7


def test_stream_skips_what_the_batch_run_loaded(spark, drop):
    fill(drop)
    drop.run(spark)

    def loaded():
        audit = read_audit(spark, drop.audit).where("status = 'success'")
        return sorted(audit.select("source_file", "loaded_at").collect())

    before = loaded()
    drop.stream(spark)
    assert drop.rows(spark) == ROWS and loaded() == before


def test_latest_file_by_modification_time(spark, drop):
    with pytest.raises(FileNotFoundError):
        latest_file(find_files(spark, drop.folder))
    drop.put("customer_addresses_20250302.csv", GOOD)
    drop.put("customer_addresses_20250301.csv", MOVED)
    os.utime(os.path.join(drop.folder, "customer_addresses_20250302.csv"), (1, 1))
    assert latest_file(find_files(spark, drop.folder))[1] == "customer_addresses_20250301.csv"


def test_files_of_several_kinds(spark, drop):
    drop.put("customer_addresses_20250301.csv", GOOD)
    drop.put("customer_addresses_20250302.xlsx", b"PK")
    drop.put("other.csv", GOOD)
    names = [row.source_file for row in find_files(spark, drop.folder, kind="{csv,xlsx}").collect()]
    assert sorted(names) == ["customer_addresses_20250301.csv", "customer_addresses_20250302.xlsx"]


def test_raw_loads_replace_and_keep_a_snapshot(spark, drop, tmp_path):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "raw")
    drop.put("customer_addresses_20250301.csv", GOOD)
    for _ in range(2):
        assert load_latest_addresses(spark, drop.folder, lake, target, "2026-03-28") == 2
    drop.put("customer_addresses_20250302.csv", GOOD.replace("2,11,,DKI rt/rw,N/A,soon\n", ""))
    os.utime(os.path.join(drop.folder, "customer_addresses_20250301.csv"), (1, 1))
    assert load_latest_addresses(spark, drop.folder, lake, target, "2026-03-29") == 1
    raw = spark.read.parquet(target)
    assert raw.columns == ["id", "customer_id", "address", "city", "province", "created_at", "_ingestion_date", "_loaded_at", "_source_file"]
    assert raw.first().city == " bekasi " and raw.first()._ingestion_date == "2026-03-29"
    older = spark.read.parquet(lake).where("ingestion_date = '2026-03-28' AND id = '2'").first()
    assert (older.city, older.province, older.created_at) == ("DKI rt/rw", None, "soon")
    assert {kind for _, kind in raw.dtypes} == {"string"}
    kept = {str(row.ingestion_date): row["count"] for row in spark.read.parquet(lake).groupBy("ingestion_date").count().collect()}
    assert kept == {"2026-03-28": 2, "2026-03-29": 1}


def test_source_tables_replace(spark, drop, tmp_path):
    rows = read_address_file(spark, _put(drop, "customer_addresses_20250301.csv", GOOD))
    for _ in range(2):
        assert load_source_table(rows, str(tmp_path / "raw"), "2026-03-28") == 2
    row = spark.read.parquet(str(tmp_path / "raw")).first()
    assert (row._source, row._ingestion_date) == ("mysql", "2026-03-28")


def test_stream_takes_files_dated_long_ago_and_logs_empty_ones(spark, drop, tmp_path):
    drop.put("customer_addresses_20250301.csv", GOOD)
    drop.stream(spark)
    for day, age in (("20250310", 40), ("20250311", 8)):
        drop.put(f"customer_addresses_{day}.csv", GOOD)
        then = datetime.now().timestamp() - age * 86_400
        os.utime(os.path.join(drop.folder, f"customer_addresses_{day}.csv"), (then, then))
    drop.put("customer_addresses_20250312.csv", "")
    stream_once(spark, drop.folder, drop.landing, drop.audit, str(tmp_path / "checkpoint"))
    outcomes = drop.outcomes(spark)
    assert [outcomes[day][0] for day in ("20250310", "20250311")] == ["success", "success"]
    assert outcomes["20250312"] == ("failed", 0, "no columns in file") and len(drop.rows(spark)) == 6


@pytest.mark.parametrize("lines", [1, 2])
def test_a_quote_inside_a_field_is_text(spark, drop, monkeypatch, lines):
    rows = [f'{n},1,Pipa 5" Baru {n}' for n in range(lines)]
    path = _put(drop, "customer_addresses_20250301.csv", "id,customer_id,address\n" + "\n".join(rows) + "\n")
    assert not landing.inspect(spark, [path])[0].multi_line
    drop.run(spark)
    assert [row[2] for row in drop.rows(spark)] == [f'Pipa 5" Baru {n}' for n in range(lines)]


def test_a_file_with_ids_that_are_no_whole_numbers_fails_whole(spark, drop):
    drop.put("customer_addresses_20250301.csv", "id,customer_id\n1,2\nx,3\n4,9999999999\n")
    drop.run(spark)
    assert drop.outcomes(spark) == {"20250301": ("failed", 0, "2 rows with an id that is no whole number")}
    assert drop.rows(spark) == []


def test_a_very_long_first_line_stays_off_the_driver(spark, drop):
    drop.put("customer_addresses_20250301.csv", "id," * 30_000)
    drop.run(spark)
    assert drop.outcomes(spark)["20250301"] == ("failed", 0, "first line has over 65536 characters")


def test_errors_are_logged_whole_and_only_those_of_files(spark, drop, monkeypatch):
    path = _put(drop, "customer_addresses_20250301.csv", GOOD)
    calls = []

    def fail(message):
        def load(*_):
            calls.append(message)
            raise PySparkException(message)

        monkeypatch.setattr(landing, "_load", load)

    fail("[FAILED_READ_FILE] " + "x" * 5_000)
    landing.load_files(spark, [path], drop.landing, drop.audit)
    assert len(drop.outcomes(spark)["20250301"][2]) > 5_000
    fail("executors were lost")
    with pytest.raises(PySparkException):
        landing.load_files(spark, [path, path], drop.landing, drop.audit)
    assert calls.count("executors were lost") == 2


@pytest.mark.parametrize(
    ("content", "error"),
    [
        ("id,city\n1,2,3\n", "more fields"),
        (b"id,city\n1,\xff\n", "UTF-8"),
        ('id,city\n1,"2\n', "never closed"),
        ("", "no columns|no address file"),
    ],
)
def test_raw_load_takes_files_whole_or_not_at_all(spark, drop, tmp_path, content, error):
    drop.put("customer_addresses_20250301.csv", content)
    with pytest.raises((ValueError, FileNotFoundError), match=error):
        load_latest_addresses(spark, drop.folder, str(tmp_path / "lake"), str(tmp_path / "raw"))


def test_raw_load_keeps_line_breaks_in_quoted_values(spark, drop, tmp_path):
    drop.put("customer_addresses_20250301.csv", 'id,Address,zip\n1,"Jl B, 2\nBlok ""C""",9\n2,b,\n')
    assert load_latest_addresses(spark, drop.folder, str(tmp_path / "lake"), str(tmp_path / "raw")) == 2
    rows = {row.id: row for row in spark.read.parquet(str(tmp_path / "raw")).collect()}
    assert rows["1"].address == 'Jl B, 2\nBlok "C"' and rows["1"].zip == "9" and rows["2"].zip is None


def _put(drop, name, content):
    drop.put(name, content)
    return os.path.join(drop.folder, name)
