"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosine, components.

Each of ``tables`` hash tables keys a vector by the signs of its products with
``bits`` random hyperplanes. At the production values (64 tables, 20 bits) two
vectors of cosine 0.98 meet in some table with probability above 1 - 1e-8.
Every meeting is verified by the exact cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import compare_in_blocks, local_roots, pairs_of
from .components import connected_components
from .scratch import Scratch

TABLES = 64
BITS = 20
BLOCK = 256


def near_vectors(vectors: DataFrame, threshold: float = 0.98, tables: int = TABLES, bits: int = BITS, seed: int = 17) -> DataFrame:
    """Link vectors of the same label with a cosine of ``threshold`` or more.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``. Returns one row
    per input row: ``vec_id, n_links, component_id, kept``. A null id or label and a
    vector that is null, empty, zero or holds null or non-finite values link
    with nothing; vectors of different dimensions do not link. Labels of any
    type are compared as text. Rows that share a ``vec_id`` are vectors of
    their own, each with its links. Equal vectors of one label are one class
    until the end, so a group of copies costs one vector, and a bucket of many
    near copies is compared in blocks. An empty table gives an empty table.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine, F.lit(False)))
    usable = rows.filter("usable").select("vec_id", "label", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    same = usable.groupBy("label", "v").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    # Stored with their numbers, so that every later step sees the same ones.
    classes = scratch.table(same.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    signed = scratch.table(
        classes.select("class_id", "copies", "label", "v").mapInArrow(
            _signatures(tables, bits, seed), "class_id bigint, copies bigint, label string, u array<double>, keys array<int>"
        ),
        "signed",
    )
    keys = signed.select(
        "class_id", F.posexplode("keys").alias("t", "key"), F.xxhash64("label", F.size("u"), "t", "key").alias("bucket")
    ).drop("key")
    sizes = scratch.table(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
    shared = keys.join(sizes, "bucket").select("bucket", "t", "class_id", "n")
    payload = signed.select("class_id", "copies", "label", "u", "keys")
    found = scratch.table(
        compare_in_blocks(shared, "bucket", "class_id", payload, BLOCK, _verify(threshold), "class_id bigint, root bigint, links bigint"),
        "found",
    )
    component = connected_components(found.filter("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")), scratch)
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = classes.join(links, "class_id", "left").join(component.withColumnRenamed("node", "class_id"), "class_id", "left")
    joined = joined.select("label", "v", "first_id", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    joined = scratch.table(joined, "joined")
    names = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least"))
    per_class = joined.join(names, "component", "left").select("label", "v", "n_links", F.coalesce("least", "first_id").alias("component_id"))
    linked = usable.join(per_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _signatures(tables: int, bits: int, seed: int):
    """Unit vectors (largest component first scaled to 1, so nothing overflows) and their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            column = batch.column(3)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(sizes)])
            units = np.empty(len(flat))
            keys = np.empty((len(sizes), tables), np.int32)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                where = at[own][:, None] + np.arange(dim)
                m = flat[where]
                m = m / np.abs(m).max(axis=1, keepdims=True)
                m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * bits))
                for lo in range(0, len(own), 512):
                    part = m[lo : lo + 512]
                    signs = (part @ planes[dim] > 0).reshape(len(part), tables, bits)
                    keys[own[lo : lo + 512]] = signs @ weights
                units[where] = m
            offsets = pa.array(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.ListArray.from_arrays(offsets, pa.array(units)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * tables), pa.array(keys.ravel())),
                ],
                ["class_id", "copies", "label", "u", "keys"],
            )

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """List column of one length as a matrix; shorter rows are padded with zeros."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    sizes = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _verify(threshold: float):
    """Pairs are counted in the first table in which they meet."""

    def compare(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        unit, keys = _matrix(table.column("u")), _matrix(table.column("keys"))
        ids, copies = table.column("class_id").to_numpy(), table.column("copies").to_numpy()
        t, own, label = (table.column(c).to_numpy() for c in ("t", "own", "label"))
        links = np.zeros(len(ids), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in pairs_of(cuts, own, 1 << 15):
            first = (keys[a] == keys[b]).argmax(axis=1) == t[a]
            a, b = a[first], b[first]
            near = (np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold) & (label[a] == label[b])
            a, b = a[near], b[near]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            left.append(a)
            right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        # Rows of one class are one node; smaller ids become roots.
        names, node = np.unique(ids, return_inverse=True)
        root = names[local_roots(len(names), node[a], node[b])]
        total = np.zeros(len(names), np.int64)
        np.add.at(total, node, links)
        some = (total > 0) | (root != names)
        return pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(root[some]), pa.array(total[some])], ["class_id", "root", "links"])

    return compare
