"""Uploaded feed files of one tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.directory import check_ownership
from millrace.schemas import FEED_KEYS, TENANT_KEYS, UPLOAD_REQUIRED
from millrace.sinks.merge import insert_ignore
from millrace.tenancy import Tenant, strip_reserved, tag


class UploadRejected(ValueError):
    """The file cannot be taken; the message says why."""


def missing_columns(df: DataFrame, feed: str) -> list[str]:
    """Required columns the upload lacks (PRJ-07)."""
    return [c for c in UPLOAD_REQUIRED[feed] if c not in df.columns]


def validate(df: DataFrame, feed: str) -> DataFrame:
    if feed not in UPLOAD_REQUIRED:
        raise UploadRejected(f"unknown feed {feed}; choose from {sorted(UPLOAD_REQUIRED)}")
    missing = missing_columns(df, feed)
    if missing:
        raise UploadRejected(f"missing columns {missing}; the file has {df.columns}, needed are {UPLOAD_REQUIRED[feed]}")
    if df.isEmpty():
        raise UploadRejected("file is empty")
    return df


def take_upload(df: DataFrame, feed: str, tenant: Tenant, factories: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows an upload adds to the raw table (SRC-06).

    Tenant columns of the file are dropped and set from the caller's tenant; the factory must belong
    to the company; keys already present win.
    """
    owned, _foreign = check_ownership(factories.select("factory_id").filter(factories.factory_id == tenant.factory_id),
                                      factories, tenant.company_id)
    if owned.isEmpty():
        raise UploadRejected(f"factory {tenant.factory_id} does not belong to {tenant.company_id}")
    tagged = tag(strip_reserved(validate(df, feed)), tenant.company_id, tenant.factory_id)
    return insert_ignore(existing, tagged, TENANT_KEYS + FEED_KEYS[feed])
