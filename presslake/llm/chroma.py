"""Chroma audio fingerprints: filters over an integral image of pitch-class frames, packed to 32-bit integers.

Frames of a recording are turned into twelve pitch-class energies; rectangle filters on their integral
image are quantised to two bits each, sixteen of them to an integer. Two recordings are aligned by
the histogram of offsets at which they hold equal integers, then by the share of wrong bits at the best offset.

Over a table, recordings of equal items are one class. A join on the integers tells which groups of classes share
any; each class goes to the pairs of groups where it has a partner, and there all pairs that share an integer are aligned.
A frequent integer enters that join as the list of its groups, never as a list of recordings.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

RATE, FRAME, HOP, SPAN = 4096, 512, 256, 8
#: (first frame, frames, first class, classes, kind): kind 0 splits the rectangle in time, 1 in pitch.
FILTERS = tuple((t, w, c, h, k) for k in (0, 1) for t, w in ((0, 8), (2, 4)) for c, h in ((0, 12), (0, 4), (4, 4), (8, 4)))
#: Bounds between the four levels of a filter.
LEVELS = (-0.15, 0.0, 0.15)
#: A match overlaps in LEAST items (two seconds) or all of the shorter recording, with at most this share of wrong bits.
LEAST, MOST_WRONG = 32, 0.2
#: Items of a group of classes on average, and pairs of places met at once: they bound a task's memory.
GROUP_ITEMS, AT_ONCE = 1 << 18, 1 << 20
_BINS = np.fft.rfftfreq(FRAME, 1 / RATE)
_USED = _BINS >= 55
_CLASS = (np.round(12 * np.log2(_BINS[_USED] / 440.0)).astype(int) % 12)


def chroma(samples: np.ndarray) -> np.ndarray:
    """recordings x frames x 12 energies of recordings of one length, each frame scaled to length 1."""
    n = 1 + (samples.shape[1] - FRAME) // HOP if samples.shape[1] >= FRAME else 0
    if n <= 0:
        return np.zeros((len(samples), 0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME, axis=1)[:, ::HOP][:, :n] * np.hanning(FRAME)
    power = np.abs(np.fft.rfft(frames, axis=2)[:, :, _USED]) ** 2
    out = power @ np.eye(12)[_CLASS]
    return out / np.maximum(np.sqrt((out**2).sum(2, keepdims=True)), 1e-9)


def _printed(samples: np.ndarray) -> np.ndarray:
    """recordings x positions: one uint32 for each position at which all filters fit."""
    frames = chroma(samples)
    n = frames.shape[1] - SPAN + 1
    if n <= 0:
        return np.empty((len(samples), 0), dtype=np.uint32)
    image = np.zeros((len(samples), frames.shape[1] + 1, 13))
    image[:, 1:, 1:] = frames.cumsum(1).cumsum(2)
    area = lambda t0, t1, c0, c1: image[:, t1 : t1 + n, c1] - image[:, t0 : t0 + n, c1] - image[:, t1 : t1 + n, c0] + image[:, t0 : t0 + n, c0]
    out = np.zeros((len(samples), n), dtype=np.uint32)
    for t, w, c, h, kind in FILTERS:
        a, b = (area(t, t + w // 2, c, c + h), area(t + w // 2, t + w, c, c + h)) if kind == 0 else (area(t, t + w, c, c + h // 2), area(t, t + w, c + h // 2, c + h))
        value = np.round(np.log1p(np.maximum(a, 0)) - np.log1p(np.maximum(b, 0)), 9)
        level = sum((value >= bound).astype(np.uint32) for bound in LEVELS)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))  # Gray code: near levels differ in one bit
    return out


def fingerprints_of(recordings: list[np.ndarray]) -> list[np.ndarray]:
    """The integers of each recording, none for one too short; recordings of one length go through the filters together, about AT_ONCE samples at once."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * len(recordings)
    by_length: dict[int, list[int]] = {}
    for i, x in enumerate(recordings):
        by_length.setdefault(len(x), []).append(i)
    for length, own in by_length.items():
        step = max(1, AT_ONCE // max(1, length))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            for i, items in zip(part, _printed(np.stack([np.asarray(recordings[i], dtype=np.float64) for i in part])), strict=True):
                out[i] = items
    return out


def fingerprint(samples: np.ndarray) -> np.ndarray:
    return fingerprints_of([samples])[0]


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, float] | None:
    """(offset, share of wrong bits): b is a from position offset on. None if no integer is shared; of equal votes the smallest offset wins."""
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        places.setdefault(x, []).append(i)
    votes = Counter(i - j for j, x in enumerate(b.tolist()) for i in places.get(x, ()))
    if not votes:
        return None
    offset = min(votes, key=lambda o: (-votes[o], o))
    low, high = max(0, offset), min(len(a), len(b) + offset)
    wrong = np.bitwise_count(a[low:high] ^ b[low - offset : high - offset]).sum()
    return offset, float(wrong) / (32 * (high - low))


def tones(values: np.ndarray) -> np.ndarray:
    """A recording made of a short tone for each value, its pitch rising with the value: sound for tables that hold none."""
    pitch = np.clip(np.round(values * 24), -24, 24)
    t = np.arange(HOP) / RATE
    return np.sin(2 * np.pi * (440 * 2 ** (pitch / 12))[:, None] * t).ravel()


PRINTED = pa.schema([("rec_id", pa.int64()), ("n_items", pa.int64()), ("sha256", pa.string()), ("items", pa.list_(pa.int64()))])


def fingerprints(rows: DataFrame, sound: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """rec_id, n_items, sha256 and items (packed integers) of rows(rec_id, samples ARRAY<DOUBLE>).

    sound turns a row's samples into a recording first (see tones). Null samples and recordings too short have no items; null or
    non-finite values count as silence; null ids and repeated rows stay; an empty table gives none; other columns are not read. One pass without a shuffle.
    """

    def start():
        def f(batch):
            heard = [np.nan_to_num(np.array(x, dtype=np.float64), posinf=0.0, neginf=0.0) if x else np.empty(0) for x in batch.column(1).to_pylist()]
            items = fingerprints_of([sound(x) if len(x) else x for x in heard] if sound else heard)
            return [batch.column(0), [len(x) for x in items], [hashlib.sha256(x.tobytes()).hexdigest() for x in items], [x.astype(np.int64) for x in items]]

        return f

    rows = rows.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("samples").cast("array<double>").alias("samples"))
    return map_batches(rows, PRINTED, start, slice_bytes=1 << 16 if sound else 4 << 20)


_MATCHES = pa.list_(pa.struct([("wrong", pa.float64()), ("rec_id", pa.int64()), ("offset", pa.int64()), ("votes", pa.int64())]))
_FOUND = pa.schema([("cls", pa.int64()), ("matches", _MATCHES)])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All items, the recording and place of each, and where each recording starts."""
    lengths = np.array([len(x) for x in lists], dtype=np.int64)
    starts = np.concatenate([[0], lengths.cumsum()])
    rec = np.repeat(np.arange(len(lists)), lengths)
    return np.concatenate([np.array(x, dtype=np.uint32) for x in lists]), rec, np.arange(starts[-1]) - starts[rec], starts


def align_all(left: list[list[int]], right: list[list[int]] | None, first: np.ndarray) -> np.ndarray:
    """Rows (left, right, offset, votes, wrong) of every pair that matches, as align() has them; right None: pairs within left.

    first[l, r] answers whether left l stands before right r: offsets are from the one to the other, so that the
    order in which groups meet doesn't change a choice among equal votes.
    """
    a, rec_a, pos_a, start_a = _flat(left)
    b, rec_b, pos_b, start_b = (a, rec_a, pos_a, start_a) if right is None else _flat(right)
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a), np.searchsorted(b[order], a, "right")
    ends = (high - low).cumsum()
    n_b, half = len(start_b) - 1, max(np.diff(start_a).max(), np.diff(start_b).max())
    span, out = 2 * half + 1, [np.empty((0, 5))]
    keys, counts, at = [], [], 0
    while at < len(a):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + AT_ONCE, "right")))
        whole = start_a[np.searchsorted(start_a, to, "right") - 1]  # up to the end of a recording, if one ends here
        to = int(whole) if whole > at else to
        n = (high - low)[at:to]
        place = order[np.arange(n.sum()) + np.repeat(high[at:to] - (ends[at:to] - done), n)]
        l, r, offset = np.repeat(rec_a[at:to], n), rec_b[place], np.repeat(pos_a[at:to], n) - pos_b[place]
        if right is None:
            l, r, offset = l[l < r], r[l < r], offset[l < r]
        offset = np.where(first[l, r], offset, -offset)
        k, c = np.unique((l * n_b + r) * span + offset + half, return_counts=True)
        keys, counts, at = [*keys, k], [*counts, c], to
        if at not in start_a:  # a recording of very many pairs goes on: its votes add up
            k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            keys, counts = [k], [np.bincount(inverse, weights=np.concatenate(counts), minlength=len(k)).astype(np.int64)]
            continue
        k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(k)).astype(np.int64)
        keys, counts = [], []
        if not len(k):
            continue
        pair = k // span
        begins = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        top = np.maximum.reduceat(c, begins)
        best = np.flatnonzero(c == np.repeat(top, np.diff([*begins, len(k)])))
        best = best[np.unique(pair[best], return_index=True)[1]]  # of equal votes the smallest offset
        l, r, offset, c = pair[best] // n_b, pair[best] % n_b, k[best] % span - half, c[best]
        shift = np.where(first[l, r], offset, -offset)  # from left to right
        n_l, n_r = start_a[l + 1] - start_a[l], start_b[r + 1] - start_b[r]
        begin, end = np.maximum(0, shift), np.minimum(n_l, n_r + shift)
        long = np.flatnonzero(end - begin >= np.minimum(LEAST, np.minimum(n_l, n_r)))
        part = 0
        sizes = (end - begin)[long].cumsum()
        while part < len(long):
            upto = max(part + 1, int(np.searchsorted(sizes, (sizes[part - 1] if part else 0) + AT_ONCE, "right")))
            these, part = long[part:upto], upto
            n = (end - begin)[these]
            step = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
            x = a[np.repeat(start_a[l[these]] + begin[these], n) + step]
            y = b[np.repeat(start_b[r[these]] + (begin - shift)[these], n) + step]
            wrong = np.add.reduceat(np.bitwise_count(x ^ y).astype(np.int64), n.cumsum() - n) / (32 * n)
            kept = wrong <= MOST_WRONG
            out.append(np.stack([l[these], r[these], offset[these], c[these], wrong], axis=1)[kept])
    return np.concatenate(out)


def matched(prints: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """prints with class_id, copies and matches: the recordings that align with each, the fewest wrong bits first.

    Recordings of equal items are a class: class_id is its smallest id, copies its size; both are null without items.
    matches has one entry for each other class that shares an integer, overlaps enough and has few wrong bits at the
    offset of most votes: rec_id (its class_id), offset (the other begins at this place of this one), votes and wrong.
    """
    scratch = Scratch(prints.sparkSession)
    prints = scratch.store(prints)
    classes = prints.where("n_items > 0").groupBy("sha256").agg(F.min("rec_id").alias("class_id"), F.count("*").alias("copies"), F.any_value("items").alias("items"))
    total = prints.agg(F.sum("n_items")).first()[0] or 0
    groups = -(-total // group_items) or 1
    classes = scratch.store(classes.withColumn("cls", F.monotonically_increasing_id()).withColumn("grp", F.pmod(F.xxhash64("sha256"), F.lit(groups))))
    tokens = classes.select("cls", "grp", F.explode(F.array_distinct("items")).alias("item"))
    shared = tokens.groupBy("item", "grp").agg(F.count("*").alias("n")).groupBy("item").agg(F.collect_list(F.struct("grp", "n")).alias("held"), F.sum("n").alias("n")).where("n > 1").drop("n")
    tokens = tokens.join(shared, "item").select("cls", "grp", F.transform(F.filter("held", lambda h: (h["grp"] != F.col("grp")) | (h["n"] > 1)), lambda h: h["grp"]).alias("held"))
    visits = tokens.groupBy("cls", "grp").agg(F.array_distinct(F.flatten(F.collect_set("held"))).alias("held")).select("cls", F.explode("held").alias("other"), "grp")
    visits = visits.select("cls", F.least("grp", "other").alias("low"), F.greatest("grp", "other").alias("high"))
    placed = visits.join(classes.select("cls", "class_id", "grp", F.unhex("sha256").alias("sha"), "items"), "cls")

    def aligned(table: pa.Table) -> pa.Table:
        at_low = table.column("grp").to_numpy() == table.column("low").to_numpy()
        cls, sha, items = table.column("cls").to_numpy(), table.column("sha").to_pylist(), table.column("items").to_pylist()
        sides = [np.flatnonzero(at_low), np.flatnonzero(~at_low)]
        within = not len(sides[1])
        if within:
            sides[1] = sides[0]
        rank = np.empty(len(sha), dtype=np.int64)
        rank[sorted(range(len(sha)), key=sha.__getitem__)] = np.arange(len(sha))
        lists = [[items[i] for i in side] for side in sides]
        l, r, offset, votes, wrong = align_all(lists[0], None if within else lists[1], rank[sides[0]][:, None] < rank[sides[1]][None, :]).T
        l, r = sides[0][l.astype(int)], sides[1][r.astype(int)]
        offset = np.where(rank[l] < rank[r], offset, -offset)
        own, others = np.concatenate([l, r]), np.concatenate([r, l])
        order = np.argsort(own, kind="stable")
        own, others = own[order], others[order]
        columns = [np.concatenate([wrong, wrong])[order], table.column("class_id").take(pa.array(others)).combine_chunks(), np.concatenate([offset, -offset])[order], np.concatenate([votes, votes])[order]]
        structs = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(t.type.to_pandas_dtype())) for c, t in zip(columns, _MATCHES.value_type, strict=True)], [t.name for t in _MATCHES.value_type])
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(own)).astype(np.int32)), structs)
        return pa.table([pa.array(cls[own[begins]]), lists], schema=_FOUND)

    from pyspark.sql.pandas.types import from_arrow_schema

    found = placed.groupBy("low", "high").applyInArrow(aligned, from_arrow_schema(_FOUND))
    lists = found.groupBy("cls").agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"))
    known = classes.select("sha256", "class_id", "copies", "cls").join(lists, "cls", "left").drop("cls")
    out = prints.join(known, "sha256", "left")
    return out.select(*prints.columns, "class_id", "copies", F.coalesce("matches", F.array().cast("array<struct<wrong:double,rec_id:bigint,offset:bigint,votes:bigint>>")).alias("matches"))
