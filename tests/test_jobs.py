"""The jobs as started from the command line, one after the other, from drop folder to reports."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from test_seed import ADDRESSES, CUSTOMERS, SALES, TICKETS
from vinlake.jobs import main
from vinlake.plans import warehouse
from vinlake.plans.warehouse import GateFailed, Schemas, stored_marts
from vinlake.schemas import RAW_TABLES
from vinlake.session import work_folder
from vinlake.sources.landing import read_landed
from vinlake.sources.raw_load import load_source_table
from vinlake.sources.tables import published

ADDRESS = "ID, customer_id ,address,city,province,created_at\n1,3,Jl A, Bekasi ,Jawa Barat,2026-03-01 14:24:40\n"


def test_work_folder_is_where_it_is_wanted_else_where_the_cluster_says(spark, tmp_path):
    first, second = (work_folder(spark, str(tmp_path)) for _ in range(2))
    assert first != second and first.startswith(str(tmp_path))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        with pytest.raises(ValueError):
            work_folder(spark)
    else:
        assert work_folder(spark).startswith(named)


def test_from_drop_to_reports(spark, tmp_path, capsys):
    at = {name: str(tmp_path / name) for name in ("drop", "landing", "audit", "lake", "raw", "work", "checkpoint", "warehouse")}
    os.mkdir(at["drop"])
    with open(os.path.join(at["drop"], "customer_addresses_20260301.csv"), "w") as file:
        file.write(ADDRESS)
    for name, rows in (("raw_customers", CUSTOMERS), ("raw_sales", SALES), ("raw_after_sales", TICKETS)):
        table = spark.createDataFrame(rows, RAW_TABLES[name])
        if "customer_id" in table.columns:  # the source keeps it as INT
            table = table.withColumn("customer_id", F.col("customer_id").cast("int"))
        load_source_table(table, f"{at['raw']}/{name}")

    main(["load-addresses", "--drop", at["drop"], "--lake", at["lake"], "--raw", at["raw"]])
    main(["build", "--raw", at["raw"], "--as-of", "2026-03-01", "--work", at["work"], "--warehouse", at["warehouse"]])
    assert os.listdir(at["work"]) == []
    printed = capsys.readouterr().out.splitlines()
    assert printed[0] == "1 rows" and len(printed) == 39 and all(line.endswith(" 0") for line in printed[1:])
    marts = stored_marts(spark, Schemas(at["warehouse"]))
    report = marts["mart_aftersales_priority"].where("customer_name = 'Charlie'").first()
    assert (report.periode, report.address, report.priority) == (2025, "Jl A, Bekasi, Jawa Barat", "LOW")

    main(["check", "--raw", at["raw"], "--work", at["work"], "--layer", "marts", "--warehouse", at["warehouse"]])
    assert len(capsys.readouterr().out.splitlines()) == 20
    spark.createDataFrame([], RAW_TABLES["raw_sales"]).write.mode("overwrite").parquet(f"{at['raw']}/raw_sales")
    with pytest.raises(GateFailed):
        main(["build", "--raw", at["raw"], "--work", at["work"], "--warehouse", at["warehouse"]])

    main(["land", "--drop", at["drop"], "--landing", at["landing"], "--audit", at["audit"], "--date", "20260301"])
    main(["stream", "--drop", at["drop"], "--landing", at["landing"], "--audit", at["audit"], "--checkpoint", at["checkpoint"], "--once"])
    landed = read_landed(spark, at["landing"]).collect()
    assert [(row.id, row.city) for row in landed] == [(1, "Bekasi")]


def job(*arguments):
    """A job in a process of its own, which shares nothing but folders with the others."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    small = ["--driver-memory", "1g", "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=2", "--conf", "spark.ui.enabled=false"]
    env = os.environ | {"PYTHONPATH": repo, "PYSPARK_SUBMIT_ARGS": " ".join([*small, "pyspark-shell"])}
    return subprocess.run(
        [sys.executable, "-m", "vinlake.jobs", *arguments], cwd=repo, env=env, capture_output=True, text=True, timeout=600
    )


def test_builds_and_checks_in_processes_of_their_own(spark, tmp_path):
    raw, schemas = str(tmp_path / "raw"), Schemas(str(tmp_path / "warehouse"))
    common = ["--raw", raw, "--work", str(tmp_path / "work"), "--warehouse", schemas.warehouse, "--as-of", "2026-03-01"]
    check = ["check", *common, "--layer", "marts"]

    def put(sales):
        for name, rows in (("raw_customers", CUSTOMERS), ("raw_sales", sales), ("raw_after_sales", TICKETS), ("raw_customer_addresses", ADDRESSES)):
            spark.createDataFrame(rows, RAW_TABLES[name]).write.mode("overwrite").parquet(f"{raw}/{name}")

    def sold():
        return sorted(row.vin for row in stored_marts(spark, schemas)["fact_sales"].select("vin").collect())

    put(SALES)
    red = job(*check)
    assert red.returncode and "no marts are published" in red.stderr
    assert job("build", *common).returncode == 0
    first = sold()
    put(SALES[:-2])
    assert job("build", *common).returncode == 0
    assert sold() != first and len(sold()) < len(first)
    green = job(*check)
    assert green.returncode == 0 and len(green.stdout.splitlines()) == 20
    run = os.path.join(schemas.marts_folder, published(spark, schemas.marts_folder))
    stored = spark.read.parquet(f"{run}/dim_vehicle")
    spark.createDataFrame(stored.collect() * 2, stored.schema).write.mode("overwrite").parquet(f"{run}/dim_vehicle")
    red = job(*check)
    assert red.returncode and "unique_dim_vehicle_model" in red.stderr
    os.rename(f"{run}/fact_after_sales", f"{run}/elsewhere")
    red = job(*check)
    assert red.returncode and "missing marts: fact_after_sales" in red.stderr


def test_a_build_that_dies_leaves_the_earlier_marts(spark, tmp_path, monkeypatch):
    raw, at = str(tmp_path / "raw"), str(tmp_path / "warehouse")
    for name, rows in (("raw_customers", CUSTOMERS), ("raw_sales", SALES), ("raw_after_sales", TICKETS), ("raw_customer_addresses", ADDRESSES)):
        spark.createDataFrame(rows, RAW_TABLES[name]).write.parquet(f"{raw}/{name}")
    build = ["build", "--raw", raw, "--work", str(tmp_path / "work"), "--warehouse", at, "--as-of", "2026-03-01"]
    main(build)
    before = published(spark, Schemas(at).marts_folder)
    written = []

    def dies(name, rows, run):
        if len(written) == 3:
            raise KeyboardInterrupt
        written.append(name)
        return write_mart(name, rows, run)

    write_mart = warehouse.write_mart
    monkeypatch.setattr(warehouse, "write_mart", dies)
    with pytest.raises(KeyboardInterrupt):
        main(build)
    assert published(spark, Schemas(at).marts_folder) == before
    assert stored_marts(spark, Schemas(at))["fact_sales"].count() > 0 and os.listdir(tmp_path / "work") == []
