"""Tenant directory: users, companies, factories and their registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import text
from millrace.schemas import FACTORY_GOVERNORATES


def tenant_directory(
    users: DataFrame, companies: DataFrame, factories: DataFrame, factory_key: str = "factory_id"
) -> DataFrame:
    """Users with their company, and their factory where there is one (JN-07)."""
    return users.join(companies, "company_id").join(factories, factory_key, "left")


def check_ownership(df: DataFrame, factories: DataFrame, company_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose factory belongs to the company, and the others (JN-10)."""
    owned = factories.filter(F.col("company_id") == company_id).select("factory_id").distinct()
    return df.join(owned, "factory_id", "left_semi"), df.join(owned, "factory_id", "left_anti")


def known_places(df: DataFrame, place_col: str, allowed: list[str] = FACTORY_GOVERNORATES) -> tuple[DataFrame, DataFrame]:
    """Rows with a listed place, and the rejected ones; a missing place is rejected (PRJ-12)."""
    listed = F.coalesce(F.col(place_col).isin(allowed), F.lit(False))
    return df.filter(listed), df.filter(~listed)


def factory_rows(requests: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Factory rows from registration requests: code if given, else the name (STR-01). Requests whose
    identifier ``existing`` already has give no row: ``rejected_requests`` names them."""
    given = F.when(F.length(F.trim("factory_code")) > 0, F.col("factory_code")).otherwise(F.col("factory_name"))
    made = requests.select(
        text.unit_id("company_id", given).alias("factory_id"), "company_id", "factory_name", "governorate"
    )
    return made if existing is None else made.join(existing.select("factory_id"), "factory_id", "left_anti")


def rejected_requests(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Requests whose identifier is taken."""
    return factory_rows(requests).join(existing.select("factory_id"), "factory_id", "left_semi")
