"""Tenant scoping: every stored row carries ``company_id`` and ``factory_id``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.schemas import ALL_FACTORIES, TENANT_KEYS


@dataclass(frozen=True)
class Tenant:
    """A scope. Empty company means every tenant; no factory or the sentinel means company-wide."""

    company_id: str | None = None
    factory_id: str | None = None

    @property
    def company_wide(self) -> bool:
        return not self.factory_id or self.factory_id == ALL_FACTORIES

    def predicate(self, alias: str | None = None) -> Column:
        """Company always, factory unless company-wide (PRJ-03)."""
        if not self.company_id:
            raise ValueError("a tenant predicate needs a company")
        name = (lambda c: f"{alias}.{c}") if alias else (lambda c: c)
        cond = F.col(name("company_id")) == self.company_id
        if not self.company_wide:
            cond = cond & (F.col(name("factory_id")) == self.factory_id)
        return cond


def scope(tenant: Tenant, alias: str | None = None):
    """Transform for ``df.transform``: the filter sits directly on the scan, so the tenant-first
    layout prunes partitions (PRJ-04)."""

    def apply(df: DataFrame) -> DataFrame:
        return df.filter(tenant.predicate(alias))

    return apply


def run_scope(df: DataFrame, company_id: str | None, factory_id: str | None) -> DataFrame:
    """Job scope: each part applies on its own, and only where the column exists (PRJ-02)."""
    for name, wanted in zip(TENANT_KEYS, (company_id, factory_id)):
        if wanted and name in df.columns:
            df = df.filter(F.col(name) == wanted)
    return df


def tag(df: DataFrame, company_id: str, factory_id: str, keep_existing: bool = False) -> DataFrame:
    """Set the tenant columns as text; ``keep_existing`` fills only those that are missing (PRJ-01)."""
    values = dict(zip(TENANT_KEYS, (company_id, factory_id)))
    kept = {c: F.col(c) if keep_existing and c in df.columns else F.lit(v) for c, v in values.items()}
    unnamed = [c for c, v in values.items() if v is None and not (keep_existing and c in df.columns)]
    if unnamed:
        raise ValueError(f"the rows have no {' and '.join(unnamed)}: name a tenant with both parts")
    return df.withColumns({c: value.cast("string") for c, value in kept.items()})


def strip_reserved(df: DataFrame) -> DataFrame:
    """Drop tenant columns that came with untrusted input (PRJ-06)."""
    return df.drop(*TENANT_KEYS)


SCOPES = ("factory", "company", "all")


def training_scope(df: DataFrame, tenant: Tenant, level: str) -> DataFrame:
    """Rows that train a tenant's model: its factory's, its company's or all (PRJ-05).

    The caller names the level, so one row more never changes what a model is trained on;
    ``scope_sizes`` tells how many rows each level has.
    """
    if level not in SCOPES:
        raise ValueError(f"level must be one of {SCOPES}")
    if level == "all" or not set(TENANT_KEYS) <= set(df.columns):
        return df
    company = df.filter(F.col("company_id") == tenant.company_id)
    return company if level == "company" else company.filter(F.col("factory_id") == tenant.factory_id)


def scope_sizes(df: DataFrame, tenant: Tenant) -> DataFrame:
    """Rows of each training scope, in one pass (PRJ-05)."""
    in_company = F.col("company_id") == tenant.company_id
    return df.agg(
        F.count_if(in_company & (F.col("factory_id") == tenant.factory_id)).alias("factory"),
        F.count_if(in_company).alias("company"),
        F.count(F.lit(1)).alias("all"),
    )


def tenants_of(df: DataFrame) -> DataFrame:
    """Distinct tenant pairs (SET-02)."""
    return df.select(*TENANT_KEYS).distinct()
