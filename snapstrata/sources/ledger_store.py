"""Where the ingestion ledger lives: a database or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapstrata.schemas import LEDGER_COLUMNS, LEDGER_SCHEMA


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    id_range: tuple[int, int] | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. With ``id_range`` the table is read in parallel slices of ``id``.

    The range only shapes the slices: rows outside it fall into the first or
    last one, so none is lost.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if id_range is not None:
        options |= {
            "partitionColumn": "id",
            "lowerBound": str(id_range[0]),
            "upperBound": str(id_range[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_ledger_jdbc(spark: SparkSession, **options: object) -> DataFrame:
    """Filters and columns chosen later are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Write a new ledger version. ``path`` must not be one the plan reads from."""
    ledger.select(*LEDGER_COLUMNS).write.mode("errorifexists").parquet(path)


def write_audit_csv(report: DataFrame, path: str, single_file: bool = False) -> None:
    """Audit rows as CSV. ``single_file`` suits a limited report only."""
    rows = report.coalesce(1) if single_file else report
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "header", True
    ).csv(path)
