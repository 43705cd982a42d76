"""What the text operators share: table access, the white space class, row numbers, stored tables."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import scratch_path

#: The six ASCII white space characters, as a character class body.
SPACE = r"\x20\x09-\x0D"


#: Folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers get the driver's place of this package for their imports,
    as the functions of the operators are sent to them by name; a cluster may install it instead."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, name: str = "__row") -> DataFrame:
    """Rows of a table read from files under a number of their own, whatever their identifiers.

    The number is the file's place among the paths and the row's place in the file. It does not depend on how
    files are split, so whatever is derived from one scan can be joined to another, also after executors come or go.
    """
    places = df.select(F.col("_metadata.file_path").alias("path")).distinct()
    files = stored(places.withColumn("file", F.row_number().over(Window.orderBy("path")).cast("long")), "files")
    path, file = free_name(df, "__path"), free_name(df, "__file")
    spot = df.withColumns({path: F.col("_metadata.file_path"), name: F.col("_metadata.row_index")})
    met = spot.join(files.toDF(path, file), path)
    return met.withColumn(name, F.call_function("shiftleft", F.col(file), F.lit(40)).bitwiseOR(F.col(name))).drop(path, file)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
