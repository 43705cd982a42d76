"""JDBC reads and writes of the warehouse mirror.

Needs a JDBC driver on the class path. None ships with Spark, so these functions are exercised for
their options and statements only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.schemas import TENANT_KEYS
from millrace.sinks.merge import align, bools_to_int


@dataclass(frozen=True)
class Warehouse:
    """Connection settings. Credentials come from the caller, never from code."""

    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    batch_size: int = 1000

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url, "dbtable": table, "user": self.user, "password": self.password, "driver": self.driver,
        }

    def read_options(self, table: str, split: tuple[str, str, str, int] | None = None) -> dict[str, str]:
        """``split`` is (column, lower, upper, partitions): without it one task reads everything."""
        options = self.options(table)
        if split:
            column, low, high, parts = split
            options |= {
                "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts),
            }
        return options


def read_table(
    spark: SparkSession, warehouse: Warehouse, table: str, split: tuple[str, str, str, int] | None = None
) -> DataFrame:
    """SRC-03."""
    return spark.read.format("jdbc").options(**warehouse.read_options(table, split)).load()


def reload_table(df: DataFrame, warehouse: Warehouse, table: str) -> None:
    """Full reload that keeps the table definition (SNK-04, SNK-07)."""
    (
        bools_to_int(df)
        .write.format("jdbc")
        .options(**warehouse.options(table))
        .option("truncate", True)
        .option("batchsize", warehouse.batch_size)
        .mode("overwrite")
        .save()
    )


def swap_statements(table: str, stage: str, columns: list[str]) -> list[str]:
    """Statements of one transaction: drop the tenants found in the stage, then take its rows."""
    same = " AND ".join(f"s.{c} = t.{c}" for c in TENANT_KEYS)
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} t WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}",
        f"DROP TABLE {stage}",
    ]


def replace_tenants_in_table(df: DataFrame, warehouse: Warehouse, table: str, keys: list[str]) -> None:
    """Replace the tenants present in the frame, or append to a global table (SNK-05, SNK-08).

    Executors load a stage table in parallel; the swap is one transaction in the database, so a
    failure leaves the old rows in place and no row passes through the driver.
    """
    spark = df.sparkSession
    target = read_table(spark, warehouse, table).schema
    shaped = align(df, target, keys)
    writer = shaped.write.format("jdbc").option("batchsize", warehouse.batch_size)
    if not set(TENANT_KEYS) <= set(shaped.columns):
        writer.options(**warehouse.options(table)).mode("append").save()
        return
    stage = f"{table}_stage"
    writer.options(**warehouse.options(stage)).mode("overwrite").save()
    _run_in_transaction(spark, warehouse, swap_statements(table, stage, shaped.columns))


def _run_in_transaction(spark: SparkSession, warehouse: Warehouse, statements: list[str]) -> None:
    spark._jvm.java.lang.Class.forName(warehouse.driver)
    link = spark._jvm.java.sql.DriverManager.getConnection(warehouse.url, warehouse.user, warehouse.password)
    try:
        link.setAutoCommit(False)
        for text in statements:
            statement = link.createStatement()
            statement.executeUpdate(text)
            statement.close()
        link.commit()
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()
