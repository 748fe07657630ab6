"""The agency directory: who a wire record is written for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import location as dateline_location


def directory(agencies: DataFrame, groups: DataFrame, group_filter: str = "%") -> DataFrame:
    """a_id, prefix, lede, uname, name, location and usable of agencies(a_id, filename, leads, ug_id, agency_name) with a group of
    groups(ug_id, uname, descrip) whose description is LIKE the filter. Ledes that are bytes are Latin-1."""
    leads = F.decode("leads", "ISO-8859-1") if dict(agencies.dtypes)["leads"] == "binary" else F.col("leads")
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    rows = agencies.join(groups.where(F.col("descrip").like(group_filter)).select("ug_id", "uname"), "ug_id")
    out = rows.select(F.col("a_id").cast("int").alias("a_id"), text(F.col("filename")).alias("prefix"), text(leads).alias("lede"), F.nullif("uname", F.lit("")).alias("uname"), F.coalesce("agency_name", F.lit("")).alias("name"))
    return out.withColumn("location", dateline_location(F.col("lede"))).withColumn("usable", usable(F.col("prefix"), F.col("lede")))


def usable(prefix: Column, lede: Column) -> Column:
    """Enough to build a row; a byline may be missing."""
    return (F.coalesce(prefix, F.lit("")) != "") & (F.coalesce(lede, F.lit("")) != "")


def agency(rows: DataFrame, a_id: int) -> DataFrame:
    """One agency, or none."""
    return rows.where(F.col("a_id") == a_id).limit(1)
