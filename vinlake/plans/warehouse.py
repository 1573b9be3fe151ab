"""The daily run: staging as views, marts as tables, each layer checked before the next is built.

Marts lie under ``<warehouse>/<schema>/<run>/<mart>``: every run writes to a folder of its own and is published
when all its checks have passed. Readers in any process find the last published run by the folder alone;
no catalog is needed.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from vinlake.operators.quality import row_counts
from vinlake.plans.checks import layer_failures
from vinlake.plans.models import DIMENSIONS, FACTS, REPORTS, STAGING, Models
from vinlake.schemas import RAW_TABLES
from vinlake.sources.tables import as_monthly_table, as_table, as_view, publish, published, schema_for, with_loaded_at


class GateFailed(Exception):
    """A layer did not pass its checks; later layers were not built."""


@dataclass(frozen=True)
class Schemas:
    """Where models are written: a folder per schema. A layer without a schema of its own goes to the default."""

    warehouse: str
    default: str = "warehouse"
    marts: str | None = "marts"

    @property
    def marts_folder(self) -> str:
        return f"{self.warehouse.rstrip('/')}/{schema_for(self.marts, self.default)}"


def gate_raw(models: Models) -> None:
    """Stop unless every raw table has rows."""
    counts = row_counts({name: models[name] for name in RAW_TABLES})
    empty = sorted(row.table_name for row in counts.where("NOT is_ready").collect())
    if empty:
        raise GateFailed(f"empty raw tables: {', '.join(empty)}")


def gate(layer: str, models: Models) -> list[Row]:
    """Run the checks of a layer and stop if one fails; a row per check is returned."""
    outcome = layer_failures(layer, models).orderBy("check_name").collect()
    failed = [f"{row.check_name} ({row.failures})" for row in outcome if row.failures]
    if failed:
        raise GateFailed(f"{layer}: {', '.join(failed)}")
    return outcome


def write_mart(name: str, rows: DataFrame, run: str) -> DataFrame:
    """Write one mart the way it is stored, into the folder of a run, and return it as stored."""
    if name in (*FACTS, *REPORTS):
        rows = with_loaded_at(rows)
    if name == "fact_sales":
        return as_monthly_table(rows, f"{run}/{name}", "invoice_date", ["customer_id", "price_class"], key="vin")
    return as_table(rows, f"{run}/{name}")


def stored_marts(spark: SparkSession, schemas: Schemas) -> dict[str, DataFrame]:
    """The published marts by name. It stops, naming what is missing, if one is not there."""
    run = published(spark, schemas.marts_folder)
    if run is None:
        raise GateFailed(f"no marts are published in {schemas.marts_folder}")
    found, missing = {}, []
    for name in (*DIMENSIONS, *FACTS, *REPORTS):
        try:
            found[name] = spark.read.parquet(f"{schemas.marts_folder}/{run}/{name}")
        except AnalysisException:
            missing.append(name)
    if missing:
        raise GateFailed(f"missing marts: {', '.join(sorted(missing))}")
    return found


def build(models: Models, schemas: Schemas) -> list[Row]:
    """Build, check and publish the warehouse; a row per check is returned.

    Each mart is read back from its files, so later marts and checks read rows, not plans: the
    sales facts are computed once and serve the vehicle dimension, the report and their checks.
    A run that fails a check, or dies, is not published: readers keep the earlier one.
    """
    gate_raw(models)
    for name in STAGING:
        models[name] = as_view(models[name], name)
    checked = gate("staging", models)
    run = f"run-{uuid4().hex}"
    first = [name for name in DIMENSIONS if name != "dim_vehicle"]
    for name in (*first, *FACTS, "dim_vehicle", *REPORTS):
        models[name] = write_mart(name, models[name], f"{schemas.marts_folder}/{run}")
    checked += gate("marts", models) + gate("intermediate", models)
    publish(models["dim_date"].sparkSession, schemas.marts_folder, run)
    return checked
