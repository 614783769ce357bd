"""HyperMinHash near-duplicates: compressed registers, banding, corrected estimate, exact check.

A document's shingles are dealt into ``REGISTERS`` buckets by hash. A bucket
keeps only its smallest value, as a 16-bit register: the count of leading
zeros (6 bits) and the mantissa bits after them (10 bits). Empty registers of
short documents borrow from the first full bucket on a fixed pseudo-random
path, so two sets agree in a register with probability close to their Jaccard
similarity at every size. Bands of ``WIDTH`` registers make the candidates; at
48 bands of 6 a pair at 0.8 is missed with a probability below 1e-6.

1. Documents with equal shingle sets are one class, with one representative.
2. In each band bucket every class meets the bucket's smallest member only;
   pairs whose collision-corrected estimate is far below the threshold go, the
   others are confirmed on the full sets, and links become components.
3. Buckets that still hold several components are compared block by block,
   only across components, on full sets. Nothing is capped: a class meets
   every other class of its buckets unless links already join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import compare_in_blocks, local_roots
from .components import connected_components
from .scratch import Scratch
from .textkernel import LOWER, Texts, by_doc, int64, mix64, slices, window_hash, word_hash, words

WIDTH = 6
BANDS = 48
REGISTERS = WIDTH * BANDS
MANTISSA = 10
BLOCK = 192
#: The arrays made for a slice of texts take many times its bytes.
SLICE_BYTES = 1 << 20
#: Two different values share a register with about this probability (HyperMinHash: 6 and 10 bits).
COLLISION = 0.17 / 2**MANTISSA
#: Candidates estimated this far under the threshold are not checked: six standard deviations of the estimate.
SLACK = 6 * (0.8 * 0.2 / REGISTERS) ** 0.5


def near_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose shingle sets overlap by ``percent`` or more.

    ``docs`` has ``doc_id`` and ``text``. Words are ``[^\\x20\\x09-\\x0D]+``
    after lower-casing A-Z; a text with fewer words than ``shingle`` has its
    whole sequence as one shingle. Two documents link if ``100 * |A & B| >=
    percent * |A | B|``, confirmed on the full sets (of 64-bit shingle
    hashes, made from BLAKE2 hashes of the words). Returns a row per input row: ``doc_id, text_hash, n_shingles,
    component_id`` (smallest ``doc_id`` reachable), ``kept``. Null, empty and
    blank texts, and rows with a null ``doc_id``, have no shingles to compare
    and link with nothing; repeated rows link with each other.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, s1 bigint, s2 bigint, registers binary, bands array<bigint>"
    sketches = scratch.table(rows.mapInArrow(_sketch(shingle), schema), "sketches")
    full = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    by_set = ["n_shingles", "s1", "s2"]
    reps = full.groupBy(*by_set).agg(F.min(F.struct("doc_id", "text_hash")).alias("least")).select(*by_set, F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("rep_text"))
    # The representative's row; rows of one id and text are alike.
    sketch = scratch.table(
        full.join(reps, by_set)
        .filter("doc_id = rep AND text_hash = rep_text")
        .dropDuplicates(["rep", *by_set])
        .select("rep", "rep_text", "n_shingles", "s1", "s2", "registers", "bands"),
        "reps",
    ).withColumn("id", F.xxhash64("rep", "s1", "s2"))
    member = scratch.table(sketch.select("id", F.posexplode("bands").alias("t", "key")).select("id", "t", F.xxhash64("t", "key").alias("bucket")), "bands")
    heads = scratch.table(member.groupBy("bucket").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "heads")
    shared = scratch.table(member.join(heads, "bucket").select("bucket", "t", "id", "head"), "shared")
    scratch.drop("bands", "heads")

    # Against the head of each bucket.
    registers = sketch.select("id", "n_shingles", "registers")
    stars = (
        shared.filter("id <> head").select("id", "head").distinct()
        .join(registers, "id")
        .join(registers.select(F.col("id").alias("head"), F.col("n_shingles").alias("m"), F.col("registers").alias("other")), "head")
        .filter(F.least("n_shingles", "m") * 100 >= F.greatest("n_shingles", "m") * percent)
    )
    likely = scratch.table(
        stars.mapInArrow(_estimate(percent / 100 - SLACK, stars.columns), "id bigint, head bigint"), "likely"
    )
    wanted = shared.select("id").distinct().join(sketch.select("id", "rep", "rep_text", "s1", "s2"), "id")
    texts = rows.filter("doc_id IS NOT NULL").join(wanted.select(F.col("rep").alias("doc_id"), F.col("rep_text").alias("text_hash"), "id", "s1", "s2"), ["doc_id", "text_hash"])
    sets = scratch.table(
        texts.select("id", "s1", "s2", "text").mapInArrow(_sets(shingle), "id bigint, shingles array<bigint>").dropDuplicates(["id"]), "sets"
    )
    common = F.size(F.array_intersect("x", "y"))
    confirmed = (
        likely.join(sets.select("id", F.col("shingles").alias("x")), "id")
        .join(sets.select(F.col("id").alias("head"), F.col("shingles").alias("y")), "head")
        .filter(common * 100 >= (F.size("x") + F.size("y") - common) * percent)
        .select(F.col("id").alias("a"), F.col("head").alias("b"))
    )
    links = scratch.table(confirmed, "star-links")
    first = connected_components(links, scratch, "first")

    # Across the components that still share a bucket.
    labelled = shared.join(first.withColumnRenamed("node", "id"), "id", "left").select("bucket", "t", "id", F.coalesce("component", "id").alias("component"))
    labelled = scratch.table(labelled, "labelled")
    # The component with most members of a bucket is its main one: no pairs inside it.
    parts = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    split = parts.groupBy("bucket").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("all"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    split = scratch.table(split.select("bucket", F.col("top.component").alias("top"), (F.col("all") - F.col("top.k")).alias("n"), F.col("top.k").alias("n_main")), "split")
    open_rows = labelled.join(split, "bucket").select("bucket", "t", "id", "component", "top", "n", "n_main")
    payload = sets.join(sketch.select("id", "bands"), "id")
    more = scratch.table(
        compare_in_blocks(open_rows, "bucket", "id", payload, BLOCK, _across(percent), "a bigint, b bigint", F.col("component") == F.col("top")), "block-links"
    )
    component = connected_components(links.unionByName(more), scratch, "all")

    # Back to documents: the smallest doc_id of every component.
    named = sketch.select("id", "rep", *by_set).join(component.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    per_set = scratch.table(named.join(smallest, "component").select(*by_set, "component_id"), "sets-named")
    # Texts without shingles would all meet at one key: they need no join.
    none = sketches.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    out = full.join(per_set, by_set).select("doc_id", "text_hash", "n_shingles", "component_id").unionByName(none)
    result = scratch.table(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "result")
    scratch.drop("sketches", "reps", "shared", "labelled", "split", "likely", "sets", "star-links", "block-links", "sets-named")
    return result


def shingles_of(t: Texts, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a slice: their row, value, and the count per row."""
    buf = LOWER[t.buf]
    w = words(t)
    h = word_hash(buf, w)
    grams = window_hash(h, shingle)
    ok = w.doc[: len(grams)] == w.doc[shingle - 1 :] if len(grams) else np.zeros(0, bool)
    docs, values = w.doc[: len(grams)][ok], grams[ok]
    first = np.cumsum(w.per_doc) - w.per_doc
    few = np.flatnonzero((w.per_doc > 0) & (w.per_doc < shingle))
    whole = np.zeros(len(few), np.uint64)
    for k in range(shingle - 1):
        live = w.per_doc[few] > k
        whole[live] = mix64(whole[live] + h[first[few[live]] + k]) + np.uint64(101 + k)
    return by_doc(np.concatenate([values, whole]), np.concatenate([docs, few]), t.n)


_PATH: dict[str, np.ndarray] = {}


def _paths() -> np.ndarray:
    """For each register, the order in which it looks for a full bucket (itself first)."""
    if "p" not in _PATH:
        rng = np.random.default_rng(29)
        p = np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])
        own = np.argsort(p != np.arange(REGISTERS)[:, None], axis=1, kind="stable")
        _PATH["p"] = np.take_along_axis(p, own, 1).astype(np.int16)
    return _PATH["p"]


def registers_of(doc: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
    """The filled 16-bit registers of each text, ``n_docs`` rows."""
    mixed = mix64(values ^ np.uint64(0x5851F42D4C957F2D))
    bucket = (mixed >> np.uint64(40)) % np.uint64(REGISTERS)
    # 40 bits decide the minimum; the compressed register keeps their leading zeros and mantissa.
    tail = mix64(mixed) >> np.uint64(24)
    least = np.full(n_docs * REGISTERS, 1 << 40, np.int64)
    np.minimum.at(least, doc * REGISTERS + bucket.astype(np.int64), tail.astype(np.int64))
    least = least.reshape(n_docs, REGISTERS)
    empty = least == 1 << 40
    _, exponent = np.frexp(np.where(empty, 0, least).astype(np.float64))
    zeros = np.minimum(40 - exponent, 62)
    shift = np.maximum(exponent - 1 - MANTISSA, 0)
    mantissa = np.where(exponent - 1 >= MANTISSA, least >> shift, least << np.maximum(MANTISSA - exponent + 1, 0)) & ((1 << MANTISSA) - 1)
    out = (zeros.astype(np.uint16) << MANTISSA) | mantissa.astype(np.uint16)
    paths = _paths()
    for i in np.flatnonzero(empty.any(axis=1) & ~empty.all(axis=1)):
        holes = np.flatnonzero(empty[i])
        full = ~empty[i]
        path = paths[holes, :64]
        found = full[path]
        at = found.argmax(axis=1)
        source = path[np.arange(len(holes)), at]
        late = ~found[np.arange(len(holes)), at]
        if late.any():
            rest = paths[holes[late]]
            source[late] = rest[np.arange(len(rest)), full[rest].argmax(axis=1)]
        out[i, holes] = out[i, source]
    return out


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for t in slices(batch.column(1), SLICE_BYTES):
                doc, values, n = shingles_of(t, shingle)
                s1, s2 = np.zeros(t.n, np.uint64), np.zeros(t.n, np.uint64)
                if len(doc):
                    at = np.flatnonzero(n)
                    first = (np.cumsum(n) - n)[at]
                    s1[at] = np.add.reduceat(mix64(values), first)
                    s2[at] = np.add.reduceat(mix64(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                regs = registers_of(doc, values, t.n)
                key = np.zeros((t.n, BANDS), np.uint64)
                banded = regs.reshape(t.n, BANDS, WIDTH).astype(np.uint64)
                for k in range(WIDTH):
                    key = mix64(key + banded[:, :, k] + salt)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1, dtype=np.int32) * BANDS), pa.array(int64(key.ravel())))
                raw = regs.astype("<u2").tobytes()
                step = 2 * REGISTERS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(t.first, t.n),
                        batch.column(2).slice(t.first, t.n),
                        pa.array(n.astype(np.int64)),
                        pa.array(int64(s1)),
                        pa.array(int64(s2)),
                        pa.array([raw[i : i + step] for i in range(0, len(raw), step)], pa.binary()),
                        lists,
                    ],
                    ["doc_id", "text_hash", "n_shingles", "s1", "s2", "registers", "bands"],
                )

    return run


def _sets(shingle: int):
    """The full sets of the texts whose set is the wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(3), SLICE_BYTES):
                doc, values, n = shingles_of(t, shingle)
                cuts = np.concatenate([[0], np.cumsum(n)])
                mixed = mix64(values)
                total = np.zeros(t.n, np.uint64)
                at = np.flatnonzero(n)
                if len(at):
                    total[at] = np.add.reduceat(mixed, cuts[at])
                want = batch.column(1).slice(t.first, t.n).to_numpy()
                use = np.flatnonzero(int64(total) == want)
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(int64(values)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n).take(pa.array(use)), lists.take(pa.array(use))], ["id", "shingles"]
                )

    return run


def _estimate(least: float, columns: list[str]):
    """Keep pairs whose collision-corrected share of equal registers is ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(columns.index(c)).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("registers", "other"))
            same = (a == b).mean(axis=1) if len(a) else np.zeros(0)
            use = pa.array((same - COLLISION) / (1 - COLLISION) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(columns.index(c)).filter(use) for c in ("id", "head")], ["id", "head"])

    return run


def _across(percent: int):
    """Links between members of different components, on full sets, in the first band where a pair meets."""

    def compare(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        ids, t, own, comp = (table.column(c).to_numpy() for c in ("id", "t", "own", "component"))
        column = table.column("shingles").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        at = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False)
        bands = table.column("bands").combine_chunks()
        bands = bands.chunk(0) if isinstance(bands, pa.ChunkedArray) else bands
        band = bands.flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        size = np.diff(at)
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            i, j = np.triu_indices(hi - lo, 1)
            i, j = i + lo, j + lo
            use = comp[i] != comp[j]
            if (own[lo:hi] != own[lo]).any():
                use &= own[i] != own[j]
            use &= np.minimum(size[i], size[j]) * 100 >= np.maximum(size[i], size[j]) * percent
            i, j = i[use], j[use]
            first = (band[i] == band[j]).argmax(axis=1) == t[lo]
            i, j = i[first], j[first]
            if not len(i):
                continue
            common = _common(flat, at, lo, hi, i - lo, j - lo)
            near = common * 100 >= (size[i] + size[j] - common) * percent
            i, j = i[near], j[near]
            root = local_roots(hi - lo, i - lo, j - lo)
            moved = np.flatnonzero(root != np.arange(hi - lo))
            out_a.append(ids[lo + moved])
            out_b.append(ids[lo + root[moved]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return compare


def _common(flat: np.ndarray, at: np.ndarray, lo: int, hi: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``i`` and ``j`` of one group."""
    if len(i) <= 16:
        own = [flat[at[lo + k] : at[lo + k + 1]] for k in range(hi - lo)]
        return np.array([len(np.intersect1d(own[x], own[y], assume_unique=True)) for x, y in zip(i, j, strict=True)])
    values = flat[at[lo] : at[hi]]
    member = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))
    _, column, n = np.unique(values, return_inverse=True, return_counts=True)
    use = n[column] > 1
    member, (_, column) = member[use], np.unique(column[use], return_inverse=True)
    total = np.zeros((hi - lo, hi - lo), np.float32)
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    for start in range(0, int(column.max(initial=-1)) + 1, 8192):  # dense only for some columns at a time
        x, y = np.searchsorted(column, [start, start + 8192])
        dense = np.zeros((hi - lo, 8192), np.float32)
        dense[member[x:y], column[x:y] - start] = 1
        total += dense @ dense.T
    return total[i, j].astype(np.int64)
