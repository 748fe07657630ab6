"""MinHash near-duplicates: universal hash minima in bands, signature check, exact check, connected components.

Shape of the job, for N documents of which M differ in their shingle sets:

1. One pass over the texts, written once, gives each document's set (64-bit shingle hashes), a 128-bit name of that
   set, its band keys and a sketch of its signature. Documents of equal sets meet by name under a
   pre-aggregating groupBy, so copies cost one row from there on.
2. Bands are counted by key with map-side combining; keys of one row (nearly all) drop out. In every
   other bucket each member is paired with the bucket's most central one, which meets most others over all
   its buckets: linear in the bucket.
3. Pairs pass the signature check, then the exact check on full sets, and become links.
4. Large-star and small-star alternate until the links are stars.
5. What stars in buckets can't see - a member that isn't close to its bucket's centre, but to another
   member - is settled exactly: in buckets whose members ended in different components, members of
   different components are paired and checked the same way. What each member has in common with the
   centre, and which shingles it has beside it, rules out nearly all pairs that are no links before they are made.

No pair within a component is made, and none of a far member with the core of a group, so a group of
copies of any size costs its size.
With 45 bands of 6 rows a pair of similarity 0.8 shares no bucket with a chance of 1.2e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches, nested

BANDS, ROWS = 45, 6
#: Bits of the filter of members (4 MB), and places over which a hot centre is dealt.
FILTER_BITS, SALTS = 1 << 25, 16
#: Minima of which the sketch keeps a byte; a pair is dropped if fewer than SKETCH_LEAST agree: 6 standard deviations below the mean at 0.8.
SKETCH, SKETCH_LEAST = 128, 0.58
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20240607)
_A = _random.integers(1, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of a word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """text -> sorted distinct 64-bit hashes of its shingles of `width` words; A-Z are lower-cased first.

    bytes.split() parts exactly at \\x20 and \\x09-\\x0D. With fewer words the whole sequence is one shingle.
    """

    def __init__(self, width: int) -> None:
        self.width = width
        self.words = _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.words) > 200_000:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.width, len(words))
        acc = h[: len(h) - n + 1] + np.uint64(n)
        for k in range(1, n):
            acc = acc * _STEP + h[k : len(h) - n + 1 + k]
        return np.unique(_mixed(acc))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash a*x mod 2^32 (a odd) over a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = None
    for at in range(0, len(x), 512):  # blocks stay in the cache
        block = np.multiply.outer(x[at : at + 512], _A).min(axis=0)
        best = block if best is None else np.minimum(best, block)
    return best


def set_name(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


_NAMED = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary())]


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """Every row with its set's size, name, band keys and sketch; a row without words or without an id has no name and no bands."""
    out = pa.schema([*_NAMED, ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def start():
        shingler = Shingler(width)
        salts = np.arange(BANDS, dtype=np.uint64)

        def f(batch):
            sets = [shingler(t) for t in batch.column(1).to_pylist()]
            signed = [len(s) > 0 and i is not None for i, s in zip(batch.column(0).to_pylist(), sets, strict=True)]
            m = np.array([minima(s) for s, has in zip(sets, signed, strict=True) if has], dtype=np.uint32).reshape(-1, BANDS, ROWS)
            keys = np.broadcast_to(salts, (len(m), BANDS))
            for k in range(ROWS):
                keys = _mixed(keys * _STEP + m[:, :, k].astype(np.uint64))
            at = np.concatenate([[0], np.cumsum(signed)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(at * BANDS), pa.array(keys.ravel().view(np.int64)))
            low = m.reshape(len(m), BANDS * ROWS)[:, :SKETCH].astype(np.uint8)
            sketches = [low[i].tobytes() if has else None for i, has in zip(at[:-1].tolist(), signed, strict=True)]
            return [batch.column(0), [len(s) for s in sets], [set_name(s) if has else None for s, has in zip(sets, signed, strict=True)], bands, sketches]

        return f

    return map_batches(docs, out, start)


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Signature check: pairs (a, b) whose sketches agree often enough."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)

    def start():
        def f(batch):
            sides = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SKETCH) for k in (2, 3)]
            close = pa.array((sides[0] == sides[1]).mean(axis=1) >= SKETCH_LEAST)
            return [batch.column(k).filter(close) for k in (0, 1)]

        return f

    return map_batches(pairs.select("a", "b", "sketch_a", "sketch_b"), pa.schema([("a", pa.int64()), ("b", pa.int64())]), start)


def _compared(pairs: DataFrame, sets: DataFrame, beside: bool = False) -> DataFrame:
    """pairs(a, b) with the sizes of the intersection and the union of their full sets and, if asked for, what only a has."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("hashes").alias(f"set_{side}")), side)
    out = pa.schema([(c, pa.int64()) for c in ("a", "b", "common", "both")] + [("beside", pa.list_(pa.int64()))] * beside)

    def start():
        def f(batch):
            common, union, rest = [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # merges two sorted runs
                common.append(int((both[1:] == both[:-1]).sum()))
                union.append(len(both) - common[-1])
                if beside:
                    rest.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64))
            return [batch.column(0), batch.column(1), common, union, *[rest] * beside]

        return f

    return map_batches(pairs.select("a", "b", "set_a", "set_b"), out, start)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (its smallest reachable node) for every node of links(a, b), by alternating large-star and small-star.

    Minima are taken by pre-aggregating groupBys, so the neighbours of a hub are never gathered, and are met by its edges at
    SALTS places; the edges are written to the shared folder after each round.
    """
    places = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))

    def met(edges: DataFrame, least: DataFrame) -> DataFrame:
        """edges(u, v) with m of least(u, m)."""
        return edges.withColumn("_s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least.withColumn("_s", places), ["u", "_s"]).drop("_s")

    edges = scratch.store(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = met(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = met(large, least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.store(small)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class _Members:
    """A Bloom filter of ids, FILTER_BITS bits whatever the data: who is in it passes, and so do a few others."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @classmethod
    def of(cls, ids: DataFrame) -> _Members:
        """Of a column doc_id. The words of the filter are put together by a pre-aggregating groupBy and come to the driver as FILTER_BITS / 64 rows at most."""
        places = F.explode(F.array(*[F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(FILTER_BITS)) for k in range(2)]))
        words = ids.select(places.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("b")).toPandas()
        bits = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
        bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
        return cls(bits.view(np.uint64))

    def passed(self, places: np.ndarray) -> np.ndarray:
        """places[n, 2]: which rows have both their bits set."""
        words = self.bits[places >> 6] >> (places & 63).astype(np.uint64)
        return ((words & np.uint64(1)) != 0).all(axis=1)


def near_duplicates(docs: DataFrame, width: int = 2, part: int = 80, whole: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept (doc_id = component_id).

    Two documents are linked if whole * |A and B| >= part * |A or B| for their sets of distinct shingles.
    Null, empty or wordless text has an empty set (n_shingles 0) and no link: its row is kept, its own
    component. A null id is linked with nothing: component_id is null and kept true. Rows that repeat an id are
    one node, and each gets that node's component. An empty table gives no rows; no other column is read.
    """
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    scratch = Scratch(docs.sparkSession)
    kept = Scratch(docs.sparkSession)  # what the result still reads
    signed = kept.store(_signed(docs, width))
    named = signed.where("set_id IS NOT NULL").groupBy("set_id")
    classes = scratch.store(named.agg(F.min("doc_id").alias("node"), *[F.any_value(c).alias(c) for c in ("n_shingles", "bands", "sketch")]))

    rows = classes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = scratch.store(rows.join(shared, "key"))
    # the member that meets most others over all its buckets stands in the middle of its group
    central = sized.join(sized.groupBy("node").agg(F.sum("n").alias("met")), "node")
    central = central.groupBy("key").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("rep"))
    buckets = scratch.store(sized.select("key", "node").join(central, "key"))
    sketches = classes.select("node", "sketch")
    members = buckets.select(F.col("node").alias("doc_id")).distinct()

    # a bounded filter of the members travels to the texts, so that no text is shuffled; sets of others that pass are met by no pair
    filter_ = docs.sparkSession.sparkContext.broadcast(_Members.of(members))

    def start():
        shingler = Shingler(width)

        def f(batch):
            places = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)], axis=1)
            ours = batch.filter(pa.array(filter_.value.passed(places)))
            return [ours.column(0), [shingler(t).tobytes() for t in ours.column(1).to_pylist()]]

        return f

    placed_docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text", *[F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(FILTER_BITS)).alias(f"p{k}") for k in range(2)])
    sets = scratch.store(map_batches(placed_docs, pa.schema([("node", pa.int64()), ("hashes", pa.binary())]), start))

    pairs = buckets.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    enough = F.col("common") * whole >= F.col("both") * part
    links = scratch.store(_compared(_alike(pairs, sketches), sets).where(enough).select("a", "b"))
    labels = scratch.store(components(links, scratch))

    # centres whose members are of several components, with what each member has in common with the centre
    spoked = buckets.select("node", "rep").distinct().join(labels, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("label"))
    mixed = spoked.groupBy("rep").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("rep")
    # a centre of very many members is dealt over SALTS places; what is copied there is one number
    salted = spoked.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    copies = mixed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spoked = scratch.store(salted.join(copies, ["rep", "_salt"]).drop("_salt").join(classes.select("node", "n_shingles"), "node"))
    measured = _compared(spoked.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")), sets, beside=True)
    placed = spoked.join(measured.withColumnsRenamed({"a": "node", "b": "rep"}), ["node", "rep"], "left")
    placed = scratch.store(placed.select("node", "rep", "label", F.col("n_shingles").alias("n"), F.coalesce("common", "n_shingles").alias("common"), F.coalesce("both", "n_shingles").alias("both"), F.coalesce("beside", F.array().cast("array<bigint>")).alias("beside")))
    # Two members that are both linked to the centre are in one component, so one of each pair sought isn't: `far`.
    # What two sets share lies inside the centre's set or beside it, so linked pairs have enough in common with the
    # centre, or they share a shingle beside it.
    far = placed.where(~enough).select("rep", *[F.col(c).alias(f"far_{c}") for c in ("node", "label", "n", "common", "beside")])
    apart = F.col("label") != F.col("far_label")
    for x, y in (("", "far_"), ("far_", "")):
        apart &= F.col(f"{x}n") * whole >= F.col(f"{y}n") * part

    def may(most):
        """Whether sets that share no more than `most` can be alike enough."""
        return most * (whole + part) >= (F.col("n") + F.col("far_n")) * part

    inside = F.least("common", "far_common")
    # Shingles beside the centre stand in one order, so behind the first that two members share each has no more than
    # are left to it; a shingle met later than that makes no pair.
    left = F.least(F.col("n") - F.col("common") - F.col("place"), F.col("far_n") - F.col("far_common") - F.col("far_place"))
    pair = [F.greatest("node", "far_node").alias("a"), F.least("node", "far_node").alias("b")]
    members = placed.select("rep", "node", "label", "n", "common")
    rest = far.drop("far_beside").join(members, "rep").where(apart & may(inside)).select(*pair)
    by_shingle = placed.select("rep", "node", "label", "n", "common", F.posexplode("beside").alias("place", "shingle"))
    far = far.select("rep", "far_node", "far_label", "far_n", "far_common", F.posexplode("far_beside").alias("far_place", "shingle"))
    rest = rest.unionAll(far.join(by_shingle, ["rep", "shingle"]).where(apart & may(inside + left)).select(*pair)).distinct()
    new = scratch.store(_compared(_alike(rest, sketches), sets).where(enough).select("a", "b"))
    if not new.isEmpty():
        labels = scratch.store(components(links.unionAll(new), scratch))

    # each class's members get the component of its smallest id
    out = labels.join(classes.select("node", "set_id"), "node", "right").select("set_id", F.coalesce("component", "node").alias("class_component"))
    out = kept.store(out)
    scratch.clear()
    joined = signed.select("doc_id", "n_shingles", "set_id").join(out, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("class_component", "doc_id")).otherwise(F.col("doc_id"))
    joined = joined.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    return joined.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """docs with one document of each near-duplicate group (the one of the smallest id); columns as they were.

    Rows without words or without an id stay. Of rows that repeat both id and text one stays, whichever (their other columns
    may differ); rows that repeat an id with another text are one node of the graph, so they go or stay together. An empty table gives none.
    """
    gone = near_duplicates(docs, width).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    out = docs.join(gone, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
    repeated = docs.where(docs["doc_id"].isNotNull()).groupBy(docs["doc_id"].alias("_id")).count().where("count > 1").select("_id")
    repeated = Scratch(docs.sparkSession).store(repeated)
    if repeated.isEmpty():  # the usual case: ids are unique, and no row is looked at again
        return out
    many = out.join(repeated, out["doc_id"] == F.col("_id"), "left_semi")
    words = F.coalesce(F.trim(many["text"]), F.lit("")) != ""
    one = nested(many.where(words)).groupBy(F.col("row.doc_id"), F.xxhash64("row.text"), F.md5(F.col("row.text").cast("binary"))).agg(F.first("row").alias("row")).select("row.*")
    return out.join(repeated, out["doc_id"] == F.col("_id"), "left_anti").unionByName(many.where(~words)).unionByName(one)


#: DuckDB SQL of the query's rows: all pairs by inverted index, reachability by recursion.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
c AS MATERIALIZED (SELECT list_sort(sh) AS sh, min(doc_id) AS node, len(any_value(sh)) AS n FROM s WHERE len(sh) > 0 GROUP BY list_sort(sh)),
u AS MATERIALIZED (SELECT node, n, hash(unnest(sh)) AS h FROM c),
e AS MATERIALIZED (SELECT a.node AS x, b.node AS y FROM u a JOIN u b ON a.h = b.h AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e2 AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT node, node AS reach FROM c UNION SELECT e2.x, r.reach FROM r JOIN e2 ON e2.y = r.node WHERE r.reach < e2.x),
l AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id, s.doc_id = coalesce(l.component, s.doc_id) AS kept
FROM s LEFT JOIN c ON list_sort(s.sh) = c.sh LEFT JOIN l ON l.node = c.node
"""
