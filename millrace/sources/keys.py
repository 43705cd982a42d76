"""Which raw files may hold the keys of an upload, and which uploads were taken before.

Beside a raw table stands an index: for each of its files a Bloom filter of the keys in it, in blocks of 32,768 bits. A key
belongs to one block of a filter and sets four bits there, so a look-up is one equality join on tenant and block and four
bit tests, without Python. An upload then reads the key columns of the files that may hold one of its keys, not those of
its tenant's whole history. A filter has 16 to 32 bits a key, so at most
about one file in four hundred is read in vain for a key.

The ledger has a row for each upload taken: tenant, feed and a digest of its rows that does not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.schemas import FEED_KEYS, TENANT_KEYS
from millrace.sources.tables import path_exists, read_table
from millrace.sources.uploads import take_upload
from millrace.tenancy import Tenant, strip_reserved

BLOCK_BITS = 32_768
BITS_PER_KEY = 16
PROBES = 4
FILTER = "file string, company_id string, factory_id string, blocks long, block long, bits binary"


def _spot(keys: list[str], blocks: Column) -> tuple[Column, Column]:
    """Block of a key in a filter of so many blocks, and the array of its bits there. Keys are compared as text."""
    text = [F.col(k).cast("string") for k in keys]
    other = F.xxhash64(*text, F.lit("bits"))
    bits = [F.shiftrightunsigned(other, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]
    return F.pmod(F.xxhash64(*text), blocks), F.array(*bits)


def index_files(spark: SparkSession, table: str, keys: list[str], index: str) -> None:
    """Add filters of the files that the index does not know yet; only their key columns are read.

    Filters of files that are gone stay and are passed over when read. A run that died is made up for by the next.
    """
    rows = read_table(spark, table).select(*TENANT_KEYS, *keys, F.col("_metadata.file_path").alias("file"))
    if path_exists(spark, index):
        rows = rows.join(_filters(spark, index).select("file").distinct(), "file", "left_anti")
    named = rows.filter(_all_there(keys))
    # A filter has a power of two of blocks, so uploads meet few sizes.
    sizes = named.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    doublings = F.ceil(F.log2(F.greatest(F.col("n") * BITS_PER_KEY / BLOCK_BITS, F.lit(1.0))))
    sized = named.join(sizes.select("file", F.pow(F.lit(2.0), doublings).cast("long").alias("blocks")), "file")
    block, bits = _spot(keys, F.col("blocks"))
    spread = sized.select("file", *TENANT_KEYS, "blocks", block.alias("block"), F.explode(bits).alias("bit"))
    made = spread.groupBy("file", *TENANT_KEYS, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    made.write.mode("append").parquet(index)


def _filters(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(FILTER).parquet(index)


def _all_there(keys: list[str]) -> Column:
    """Keys with a null match nothing, so they are in no filter."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    return there


def _has(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(bits.substr((F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def may_hold(spark: SparkSession, new: DataFrame, keys: list[str], index: str) -> DataFrame:
    """(file) of the indexed files that may hold a key of the rows, within the tenants of the rows. No file that does is left out."""
    filters = _filters(spark, index)
    wanted = new.filter(_all_there(keys)).select(*TENANT_KEYS, *keys).distinct()
    # Sizes are powers of two, so a tenant has few.
    sizes = filters.select(*TENANT_KEYS, "blocks").distinct()
    sized = wanted.join(sizes, TENANT_KEYS)
    block, bits = _spot(keys, F.col("blocks"))
    asked = sized.select(*TENANT_KEYS, "blocks", block.alias("block"), bits.alias("_asked")).distinct()
    met = asked.join(filters, [*TENANT_KEYS, "blocks", "block"])
    held = F.lit(True)
    for i in range(PROBES):
        held = held & _has(F.col("bits"), F.col("_asked")[i])
    return met.filter(held).select("file").distinct()


def possible_rows(spark: SparkSession, new: DataFrame, table: str, keys: list[str], index: str) -> DataFrame:
    """The rows of the files that may hold a key of ``new``: enough to find every key that is there already.

    Files of the rows' tenants that came after the index was made are read as well.
    """
    whole = read_table(spark, table)
    known = _filters(spark, index).select("file").distinct()
    tenants = new.select(*TENANT_KEYS).distinct()
    named = whole.select(*TENANT_KEYS, F.col("_metadata.file_path").alias("file"))
    places = named.join(tenants, TENANT_KEYS, "left_semi").select("file").distinct()
    fresh = places.join(known, "file", "left_anti")
    chosen = places.join(may_hold(spark, new, keys, index), "file", "left_semi").unionByName(fresh)
    # The metadata column escapes paths as addresses do, in which a plus sign is itself.
    plain = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file")
    paths = [r.file for r in chosen.distinct().select(plain).orderBy("file").toLocalIterator()]
    if not paths:
        return whole.limit(0)
    kind = T.StructType([T.StructField(f.name, f.dataType, True) for f in whole.schema.fields])
    return spark.read.schema(kind).option("basePath", table).parquet(*paths)


def take_indexed(
    spark: SparkSession, df: DataFrame, feed: str, tenant: Tenant, factories: DataFrame, table: str, index: str
) -> DataFrame:
    """The rows that an upload adds (SRC-06, SNK-12), as ``take_upload`` on the whole table gives them."""
    keys = FEED_KEYS[feed]
    tagged = strip_reserved(df).withColumns({"company_id": F.lit(tenant.company_id), "factory_id": F.lit(tenant.factory_id)})
    held = possible_rows(spark, tagged, table, keys, index)
    return take_upload(df, feed, tenant, factories, held)


# -- ledger -------------------------------------------------------------------------------------


def content_digest(df: DataFrame) -> DataFrame:
    """(n_rows, digest) of the rows as a multiset: column order and row order do not count, repeats do."""
    cols = sorted(c for c in df.columns if c not in TENANT_KEYS)
    row = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]), {"ignoreNullFields": "false"}), 256)
    part = lambda at: F.conv(F.substring(row, at, 14), 16, 10).cast("decimal(38,0)")
    sums = df.select(*[part(1 + 14 * i).alias(f"s{i}") for i in range(4)]).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)]
    )
    return sums.select("n_rows", F.sha2(F.concat_ws("|", F.lit(",".join(cols)), "n_rows", *[f"s{i}" for i in range(4)]), 256).alias("digest"))


def _entry(df: DataFrame, feed: str, tenant: Tenant) -> DataFrame:
    return content_digest(df).select(
        F.lit(tenant.company_id).alias("company_id"), F.lit(tenant.factory_id).alias("factory_id"), F.lit(feed).alias("feed"), "digest", "n_rows"
    )


def taken_before(spark: SparkSession, df: DataFrame, feed: str, tenant: Tenant, ledger: str) -> bool:
    """Whether the tenant's upload of these rows to the feed stands in the ledger."""
    if not path_exists(spark, ledger):
        return False
    entry = _entry(df, feed, tenant)
    return not entry.join(spark.read.schema(entry.schema).parquet(ledger), ["company_id", "factory_id", "feed", "digest"], "left_semi").isEmpty()


def note_taken(df: DataFrame, feed: str, tenant: Tenant, ledger: str) -> None:
    """Write the upload to the ledger, after its rows were appended: a run that dies in between only means another look-up."""
    _entry(df, feed, tenant).coalesce(1).write.mode("append").parquet(ledger)
