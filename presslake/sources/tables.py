"""Readers of the text inputs: site lists, seed lists, archives, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls

_URL = r"(?i)^(?:https?://)?[^\s,/]+\.[^\s,]+"


def sites(lines: DataFrame) -> DataFrame:
    """line_no, url, domain of lines(line_no, value): comments and rows without a URL skipped, the scheme filled in, the first row of each domain kept."""
    cells = F.transform(F.split(F.regexp_replace("value", "^﻿", ""), ","), lambda c: F.trim(c, F.lit('" ')))
    url = F.element_at(F.concat(F.filter(cells, lambda c: c.rlike(_URL)), F.array(F.lit(""))), 1)
    url = F.when(url.rlike("(?i)^https?://"), url).otherwise(F.concat(F.lit("https://"), url))
    rows = lines.where(~F.trim("value").startswith("#")).select("line_no", url.alias("url")).where("url <> 'https://'")
    rows = rows.withColumn("domain", urls.registrable_domain(F.col("url")))
    return rows.groupBy("domain").agg(F.min_by(F.struct("line_no", "url"), "line_no").alias("r")).select("r.line_no", "r.url", "domain")


def seed_list(spark: SparkSession, path: str) -> DataFrame:
    """a_id, newsroom_url, domain of a seed CSV with a header; missing domains are derived."""
    rows = spark.read.csv(path, header=True)
    have = {c.lstrip("﻿").strip().lower(): c for c in rows.columns}
    pick = lambda name: F.col(f"`{have[name]}`") if name in have else F.lit(None).cast("string")
    out = rows.select(pick("a_id").try_cast("int").alias("a_id"), F.trim(pick("newsroom_url")).alias("newsroom_url"), F.nullif(F.trim(pick("domain")), F.lit("")).alias("domain"))
    return out.where("newsroom_url IS NOT NULL").withColumn("domain", F.coalesce("domain", urls.registrable_domain(F.col("newsroom_url"))))


def quality_report(rows: DataFrame) -> DataFrame:
    """problem, n over rows(a_id STRING, newsroom_url, fields INT): what is wrong with a legacy list."""
    dup = lambda c: rows.groupBy(c).count().where(f"count > 1 AND {c} IS NOT NULL").select(F.lit(f"duplicate_{c}").alias("problem"), (F.col("count") - 1).alias("n"))
    own = F.array_compact(F.array(F.when(F.col("fields") != 3, F.lit("field_count")), F.when(F.col("a_id").try_cast("int").isNull(), F.lit("bad_a_id")), F.when(urls.host(F.col("newsroom_url")) == "", F.lit("bad_url"))))
    found = rows.select(F.explode(own).alias("problem"), F.lit(1).cast("long").alias("n")).unionAll(dup("a_id")).unionAll(dup("newsroom_url"))
    return found.groupBy("problem").agg(F.sum("n").alias("n"))


def clean_targets(rows: DataFrame, seed: int = 0, sample: int | None = None) -> DataFrame:
    """a_id, newsroom_url, domain of the usable rows of a legacy list, the first (least a_id) of each URL; a seeded sample of different domains if asked for."""
    usable = rows.withColumns({"a_id": F.col("a_id").try_cast("int"), "newsroom_url": F.trim("newsroom_url"), "domain": urls.registrable_domain(F.col("newsroom_url"))})
    usable = usable.where((urls.host(F.col("newsroom_url")) != "") & F.contains("domain", F.lit(".")))
    out = usable.groupBy("newsroom_url").agg(F.min("a_id").alias("a_id"), F.min("domain").alias("domain")).select("a_id", "newsroom_url", "domain")
    if sample is None:
        return out
    one = out.groupBy("domain").agg(F.min_by(F.struct("a_id", "newsroom_url"), "newsroom_url").alias("t"))
    return one.orderBy(F.xxhash64("domain", F.lit(seed)), "domain").limit(sample).select("t.a_id", "t.newsroom_url", "domain")


def top_counts(rows: DataFrame, column: str, limit: int = 15) -> DataFrame:
    """The commonest values of a column, the first by name of equals."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(limit)


def stored_audit(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Measurements of audit JSON lines: what is derived (findings, score, verdict) is left out, to be judged anew; bad lines are skipped."""
    rows = spark.read.text(path).select(F.from_json("value", schema).alias("r")).where("r.a_id IS NOT NULL").select("r.*")
    return rows.drop("findings", "score", "verdict")


def archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of all daily files; bad lines are skipped, file and pos tell the order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("pos"))
    return lines.withColumn("r", F.from_json("value", schema)).where(F.col("r").isNotNull() & F.col("r.url").isNotNull()).select("r.*", "file", "pos")


def console(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """Ad-hoc SQL over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
