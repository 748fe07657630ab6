"""Mixing sources to target weights, DataFrame functions only.

Each document gets a hash-random key (of its id and its text, so that repeated or null ids are no hot key). Sources are cut at their budgets by prefix sums over that order,
taken at three levels of the key (first digits, more digits, the rows themselves), so that no window
holds a whole source: a source of any size is dealt over 65,536 leaf groups. Only the id, the source,
the size and the key are shuffled, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_on, nested

#: Hex digits of the key that name the upper and the leaf groups.
UPPER, LEAF = 2, 4


def size(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sizes(source, source_size) with target: share of all words dealt by weight, at most `most` times a source's size.

    Sources in order of code points, null last, take the weights in turn. What a full source can't
    take is dealt again by weight: target = least(cap, level * weight), where the level is the largest of
    (words - caps of the sources filled first) / (weights of the rest), sources taken by cap / weight.
    The windows here run over one row a source (the mix's configuration), not over documents.
    """
    n = len(weights)
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(n)) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    rest = F.sum("_weight").over(whole) - (F.sum("_weight").over(before) - F.col("_weight"))
    filled = F.sum("_cap").over(before) - F.col("_cap")
    levels = ranked.withColumn("_level", (F.sum("source_size").over(whole) * F.lit(float(share)) - filled) / rest)
    return levels.withColumn("target", F.least("_cap", F.max("_level").over(whole) * F.col("_weight"))).select("source", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes of the row, repeats counted).

    A source's order is that of md5(seed:doc_id:md5(text)), then doc_id and size; it is repeated for whole epochs
    while they fit, then taken from the front to the exact word, so that taken sums to floor(target) and
    a rerun gives the same. No row's taken passes `most` (rounded up) times its size. Null text has size 0
    and takes 0; a null source is a source of its own, the last; null ids stay;
    equal rows are interchangeable; an empty table gives no rows; other columns are not read.
    """
    text = F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].alias("source"), size(docs[text_col]).alias("size"), key.alias("_key"))
    return _taken(rows, weights, share, most).drop("_key")


def _taken(rows: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """rows(doc_id, source, size, _key) with source_size, target and taken."""
    leaf, upper = F.substring("_key", 1, LEAF), F.substring("_key", 1, UPPER)
    rows = rows.withColumn("_leaf", leaf)

    def running(w, column: str) -> Column:
        """Sum over the rows in front of this one."""
        return F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(column)

    leaves = rows.groupBy("source", "_leaf").agg(F.sum("size").alias("_n")).withColumn("_upper", F.substring("_leaf", 1, UPPER))
    leaves = leaves.withColumn("_in_upper", running(Window.partitionBy("source", "_upper").orderBy("_leaf"), "_n"))
    uppers = leaves.groupBy("source", "_upper").agg(F.sum("_n").alias("_u"))
    sums = targets(uppers.groupBy("source").agg(F.sum("_u").alias("source_size")), weights, share, most)
    uppers = uppers.withColumn("_before", running(Window.partitionBy("source").orderBy("_upper"), "_u"))

    offsets = join_on(leaves, join_on(uppers, sums, "source"), "source", "_upper")
    offsets = offsets.select("source", "_leaf", (F.col("_before") + F.col("_in_upper")).alias("_before"), "source_size", "target")
    rows = rows.withColumn("_in_leaf", running(Window.partitionBy("source", "_leaf").orderBy("_key", "doc_id", "size"), "size"))
    joined = join_on(rows, offsets, "source", "_leaf").withColumn("_at", F.col("_before") + F.col("_in_leaf"))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    left = budget - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_at")))
    return joined.select("doc_id", "source", "size", "_key", "source_size", "target", (epochs * F.col("size") + cut).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The mixed documents, with the columns of docs: a row for each whole time a document is taken, and
    one cut to its first words where the budget ends inside it.

    Documents without words (null and empty texts too) stay once. Null ids and sources are as in mix. Rows that
    are alike in every column are told apart by nothing, so what was taken of them all is dealt among them evenly; rows that share only
    an id are documents of their own. Columns may have any names; n_chars is counted anew where text was cut. An empty table gives none.
    """
    whole = nested(docs)
    row = F.col("row")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row["doc_id"].cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(row["text"], F.lit("")).cast("binary"))).cast("binary"))
    # nulls are told from values: the hash passes over them
    alike = F.xxhash64(row, *[row[c].isNull() for c in docs.columns]) if not any(t.startswith("map") for _, t in docs.dtypes) else F.xxhash64(F.to_json(row))
    key = F.concat(key, F.hex(alike))
    rows = whole.select("row", row["doc_id"].cast("long").alias("doc_id"), row["source"].alias("source"), size(row["text"]).alias("size"), key.alias("_key"))
    sums = _taken(rows.drop("row"), weights, share, most).groupBy("_key").agg(F.sum("taken").alias("_sum"), F.count("*").alias("_rows"), F.any_value("size").alias("_size"))
    out = rows.select("row", "_key").join(sums, "_key")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))  # among rows alike in every column; dealt and sorted by the join
    out = out.withColumn("_nth", nth)
    full, rest = F.floor(F.col("_sum") / F.col("_size")), F.pmod("_sum", "_size")
    own = F.floor(full / F.col("_rows")) + F.when(F.col("_nth") <= F.pmod(full, F.col("_rows")), 1).otherwise(0)
    last = F.when((F.col("_nth") == F.col("_rows")) & (rest > 0), F.array(rest.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    copies = F.when(F.col("_size") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.concat(F.array_repeat(F.lit(0).cast("long"), own.cast("int")), last))
    out = out.select("row", F.explode(copies).alias("_words"))
    words = F.regexp_extract_all(row["text"], F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    out = out.select("row", F.when(F.col("_words") > 0, head).alias("_cut"))
    changed = {"text": F.coalesce("_cut", row["text"])} | ({"n_chars": F.coalesce(F.length("_cut").cast(dict(docs.dtypes)["n_chars"]), row["n_chars"])} if "n_chars" in docs.columns else {})
    return out.select(*[changed.get(c, row[c]).alias(c) for c in docs.columns])


#: DuckDB SQL of the query's rows.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM r),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS lev
      FROM w WINDOW o AS (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT source, source_size, least(cap, max(lev) OVER () * weight) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - pos)) AS BIGINT) AS taken FROM e
"""
