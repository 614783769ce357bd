"""Substring deduplication by fingerprints of growing length at content-sampled positions.

Every byte that lies in a string of ``length`` bytes (200 by default) which
also starts anywhere else is removed. A suffix array over all positions would
shuffle many times the corpus, so positions are thinned first, without losing
a match: each ``length``-byte window names the position of its smallest hashed
``GRAM``-byte gram (the leftmost of equals) its *anchor*. Equal windows have
equal anchors at equal offsets, and one anchor stands for about 80 windows.

This stands in place of prefix doubling: no ranks are paired. Spark groups
the fingerprints of three rounds. A round looks at sets of windows and takes
two strings of each: its *core*, which all its windows share, and its *hull*,
which they fill.

* A core seen once: none of the windows repeats, done.
* A hull seen twice: all of the windows repeat, done; one set of the class
  goes on if its core is also in other hulls.
* The rest, at the edges of copied passages, goes to the next round with
  longer cores: the gram of an anchor (32 bytes), then ``STEP`` neighbouring
  offsets of it (185 bytes), then single windows (200 bytes), where a rank
  seen twice is a repeat.

A fingerprint is a polynomial modulo 2**61 - 1 of the bytes. A verdict always
rests on two of them: those of core and hull, or two of a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .textkernel import int64, prefix_hash, rolling_hash, rolling_prefix, slices, span_hash

LENGTH = 200
GRAM = 32
STEP = 16
_SETS = [pa.field("a", pa.int32()), pa.field("lo", pa.int32()), pa.field("hi", pa.int32()), pa.field("core", pa.int64()), pa.field("hull", pa.int64())]
_SETS_SQL = "array<struct<a:int,lo:int,hi:int,core:bigint,hull:bigint>>"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = True) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that starts twice or more.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns
    one row per input row: ``doc_id, n_bytes, n_removed, n_spans,
    spans array<struct<start,end>>`` (byte offsets, end exclusive),
    ``kept_sha256`` and, with ``keep_text``, ``kept binary`` (the bytes left;
    removal may split a character). Null text is empty; texts shorter than
    ``length`` keep all; repeated rows are copies of each other and lose every
    window; an empty table gives an empty table. Matches never cross texts and
    are judged on the input.
    """
    if not 0 < gram <= length or length < STEP:
        raise ValueError(f"gram must be between 1 and length, and length at least {STEP}")
    scratch = Scratch(docs.sparkSession, "substring")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")

    nested = scratch.table(
        rows.mapInArrow(_anchors(length, gram), f"doc_id bigint, h bigint, sets {_SETS_SQL}"), "anchors"
    )
    anchors = nested.select("doc_id", "h", F.inline("sets"))
    whole, open_sets = _round(anchors, scratch, "round-1")
    scratch.drop("anchors")

    nested = scratch.table(
        _with_text(rows, open_sets).mapInArrow(_steps(length), f"doc_id bigint, h bigint, sets {_SETS_SQL}"), "steps"
    )
    steps = nested.select("doc_id", "h", F.inline("sets"))
    more, open_sets = _round(steps, scratch, "round-2")
    scratch.drop("steps")

    windows = scratch.table(
        _with_text(rows, open_sets).mapInArrow(_windows(length), "doc_id bigint, h bigint, s array<int>, rank array<bigint>, other array<bigint>"), "windows"
    )
    flat = windows.select("doc_id", "h", F.inline(F.arrays_zip("s", "rank", "other")))
    twice = scratch.table(flat.groupBy("rank", "other").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "twice")
    single = flat.join(twice, ["rank", "other"]).select("doc_id", "h", F.col("s").alias("lo"), (F.col("s") + 1).alias("hi"))

    covered = scratch.table(
        whole.unionByName(more).unionByName(single).groupBy("doc_id", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")), "covered"
    )
    scratch.drop("round-1-alive", "round-1-classes", "round-2-alive", "round-2-classes", "windows", "twice")
    joined = rows.join(
        covered.withColumnsRenamed({"doc_id": "d", "h": "g"}).hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left"
    )
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:int,end:int>>, kept_sha256 string"
    schema += ", kept binary" if keep_text else ""
    return joined.select("doc_id", "text", "runs").mapInArrow(_cut(length, keep_text), schema)


def _round(sets: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """The window runs that repeat whole, and one set of each class that is still open."""
    ranks = sets.groupBy("core").agg(F.count(F.lit(1)).alias("n"), (F.min("hull") == F.max("hull")).alias("same"))
    # Tables of their own: joins on a frequent rank can then be split.
    ranks = scratch.table(ranks.filter("n > 1").drop("n"), f"{name}-ranks")
    alive = scratch.table(sets.join(ranks, "core"), f"{name}-alive")
    scratch.drop(f"{name}-ranks")
    mixed = alive.filter("NOT same")
    one = F.min(F.struct("doc_id", "h", "a", "lo", "hi")).alias("one")
    classes = scratch.table(mixed.groupBy("core", "hull").agg(F.count(F.lit(1)).alias("n"), one), f"{name}-classes")
    twice = mixed.join(classes.filter("n > 1").select("core", "hull"), ["core", "hull"], "left_semi")
    settled = alive.filter("same").select("doc_id", "h", "lo", "hi").unionByName(twice.select("doc_id", "h", "lo", "hi"))
    return settled, classes.select("one.*")


def _with_text(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``doc_id, h, text, sets`` of the texts that have any."""
    own = sets.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g")).agg(F.collect_set(F.struct("lo", "hi", "a")).alias("sets"))
    return rows.join(own.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))).select("doc_id", "h", "text", "sets")


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` neighbours, by doubling."""
    have, m = 1, keys
    while have * 2 <= width:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have :])
    return m


def _nested(counts: np.ndarray, parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    offsets[1:] = np.cumsum(counts)
    value = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(parts, _SETS, strict=True)], fields=_SETS)
    return pa.ListArray.from_arrays(pa.array(offsets), value)


def _anchors(length: int, gram: int):
    """The sets of round 1: each anchor, the window starts ``[lo, hi)`` it stands for, and its two ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, h = batch.column(0), batch.column(1)
            for t in slices(batch.column(2)):
                size = len(t.buf)
                counts = np.zeros(t.n, np.int64)
                parts = [np.zeros(0, np.int64)] * 5
                if size >= length:
                    prefix = prefix_hash(t.buf)
                    at = np.arange(size - gram + 1)
                    grams = rolling_hash(rolling_prefix(t.buf), at, at + gram)
                    bits = np.uint64(max(1, int(size).bit_length()))
                    keys = ((grams >> bits) << bits) | at.astype(np.uint64)
                    low = _smallest(keys, length - gram + 1)
                    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
                    inside = np.ones(len(anchor), dtype=bool)
                    for b in t.off[1:-1]:  # windows that would cross into the next text
                        inside[max(0, b - length + 1) : b] = False
                    s = np.flatnonzero(inside)
                    a = anchor[s]
                    new = np.ones(len(s), dtype=bool)
                    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(s)) - 1
                    lo, hi, a = s[first], s[last] + 1, a[first]
                    stretch = span_hash(prefix, lo, hi - 1 + length) + (a - lo).astype(np.uint64)
                    row = np.searchsorted(t.off, lo, side="right") - 1
                    counts = np.bincount(row, minlength=t.n)
                    base = t.off[row]
                    parts = [a - base, lo - base, hi - base, int64(span_hash(prefix, a, a + gram)), int64(stretch)]
                yield pa.RecordBatch.from_arrays([doc.slice(t.first, t.n), h.slice(t.first, t.n), _nested(counts, parts)], ["doc_id", "h", "sets"])

    return run


def _runs(column: pa.Array, row: int, fields: int = 2) -> np.ndarray:
    """The structs of a row's list as an array of one column for each field; ``lo, hi`` come first."""
    item = column[row]
    if not item.is_valid:
        return np.zeros((0, fields), np.int64)
    return np.stack([item.values.field(k).to_numpy(zero_copy_only=False) for k in range(fields)], 1).astype(np.int64)


def _steps(length: int):
    """The sets of round 2: up to ``STEP`` neighbouring offsets of the listed anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(2)):
                prefix = prefix_hash(t.buf)
                lists = [_runs(batch.column(3), t.first + i, 3) for i in range(t.n)]
                base = np.repeat(t.off[:-1], [len(x) for x in lists])
                row = np.repeat(np.arange(t.n), [len(x) for x in lists])
                lo, hi, a = (np.concatenate(lists) + base[:, None]).T
                # Offsets of the anchor in its windows: from a - hi + 1 to a - lo; cut on a grid of STEP.
                first, last = (a - hi + 1) // STEP, (a - lo) // STEP
                n = last - first + 1
                each = np.repeat(np.arange(len(n)), n)
                q = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + first[each]
                a, lo, hi, row, base = a[each], lo[each], hi[each], row[each], base[each]
                lo, hi = np.maximum(lo, a - q * STEP - STEP + 1), np.minimum(hi, a - q * STEP + 1)
                core = span_hash(prefix, a - q * STEP, a - q * STEP - STEP + 1 + length) + q.astype(np.uint64)
                hull = span_hash(prefix, lo, hi - 1 + length) + (a - lo).astype(np.uint64)
                parts = [a - base, lo - base, hi - base, int64(core), int64(hull)]
                counts = np.bincount(row, minlength=t.n)
                columns = [batch.column(k).slice(t.first, t.n) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, _nested(counts, parts)], ["doc_id", "h", "sets"])

    return run


def _windows(length: int):
    """The rank of every window in the listed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(2)):
                prefix = prefix_hash(t.buf)
                starts, offsets = [], [0]
                for i in range(t.n):
                    pairs = _runs(batch.column(3), t.first + i)
                    own = np.unique(np.concatenate([np.arange(lo, hi) for lo, hi in pairs] or [np.zeros(0, np.int64)]))
                    starts.append(own + t.off[i])
                    offsets.append(offsets[-1] + len(own))
                s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                rank, other = (span_hash(p, s, s + length, k) for k, p in enumerate((prefix, prefix_hash(t.buf, 1))))
                local = s - np.repeat(t.off[:-1], np.diff(offsets))
                cuts = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(t.first, t.n),
                        batch.column(1).slice(t.first, t.n),
                        pa.ListArray.from_arrays(cuts, pa.array(local, pa.int32())),
                        pa.ListArray.from_arrays(cuts, pa.array(int64(rank))),
                        pa.ListArray.from_arrays(cuts, pa.array(int64(other))),
                    ],
                    ["doc_id", "h", "s", "rank", "other"],
                )

    return run


def merge_runs(pairs: np.ndarray, length: int) -> np.ndarray:
    """The disjoint byte spans ``[start, end)`` that windows starting in ``[lo, hi)`` cover."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    start, end = pairs[:, 0], np.maximum.accumulate(pairs[:, 1] - 1 + length)
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return np.stack([start[first], end[np.append(first[1:], len(start)) - 1]], 1)


def _cut(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"] + ["kept"] * keep_text
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for t in slices(batch.column(1)):
                raw = t.buf.tobytes()
                sizes, removed, spans, digests, texts = [], [], [], [], []
                for i in range(t.n):
                    b, e = int(t.off[i]), int(t.off[i + 1])
                    cut = merge_runs(_runs(batch.column(2), t.first + i), length).tolist()
                    left, at = [], b
                    for x, y in cut:
                        left.append(raw[at : b + x])
                        at = b + y
                    kept = b"".join([*left, raw[at:e]])
                    sizes.append(e - b)
                    removed.append(e - b - len(kept))
                    spans.append([{"start": x, "end": y} for x, y in cut])
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept)
                columns = [
                    batch.column(0).slice(t.first, t.n),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([len(x) for x in spans], pa.int64()),
                    pa.array(spans, span_type),
                    pa.array(digests, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.binary())] * keep_text, names)

    return run
