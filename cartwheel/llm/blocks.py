"""Pairs inside buckets, compared block by block.

Members of a bucket are dealt into blocks of bounded size, and every pair of
blocks is one small task-local group. A bucket of any size is thus compared
whole, spread over many tasks, and no row for a pair is ever made: a group
gives back a few columns per member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Compare = Callable[[pa.Table, np.ndarray], pa.RecordBatch]


def compare_in_blocks(rows: DataFrame, bucket: str, member: str, payload: DataFrame, size: int, compare: Compare, schema: str, main: Column | None = None) -> DataFrame:
    """Run ``compare`` over all block pairs of all buckets.

    ``rows(bucket, member, ..., n)`` holds each membership once, ``n`` being
    the bucket's number of members; ``payload`` adds columns by ``member``.
    Members for which ``main`` is true need no comparison with each other; then
    ``n`` counts the others, and a column ``n_main`` these.
    ``compare(table, cuts)`` gets whole groups: rows ``cuts[i]:cuts[i+1]`` of
    ``table`` are group ``i``, at most ``2 * size`` rows. Rows carry ``own``,
    their block; a pair of different blocks concerns only pairs across.
    """
    main = F.lit(False) if main is None else main
    others, mains = (F.ceil(F.col(c) / F.lit(size)).cast("int") for c in ("n", "n_main"))
    deal = lambda count: F.pmod(F.xxhash64(F.col(member), F.lit(11)), count.cast("bigint")).cast("int")
    upto = lambda count: F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda x, y: F.struct(F.least(x, y).alias("i"), F.greatest(x, y).alias("j"))
    sized = rows.withColumn("main", main) if "n_main" in rows.columns else rows.withColumn("main", main).withColumn("n_main", F.lit(0))
    # Blocks of the main members are numbered after the others'; main blocks meet the others only.
    dealt = sized.withColumn("own", F.when(F.col("main"), others + deal(mains)).otherwise(deal(others)))
    met = F.when(F.col("main"), upto(others)).otherwise(upto(others + mains))
    dealt = dealt.withColumn("pair", F.explode(F.transform(met, lambda k: pair(k, F.col("own")))))
    dealt = dealt.select(*rows.columns, "own", F.col("pair.i").alias("bi"), F.col("pair.j").alias("bj")).join(payload, member)
    keys = [bucket, "bi", "bj"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(whole_groups(keys, compare), schema)


def whole_groups(keys: list[str], compare: Compare):
    """Cut the sorted rows of a partition into whole groups, some batches at a time."""

    def cuts_of(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        if table.num_rows:
            new[0] = True
        for key in keys:
            x = table.column(key).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new])
            cuts = cuts_of(rest)
            if len(cuts) > 2:  # the last group may go on in the next batch
                yield compare(rest.slice(0, cuts[-2]).combine_chunks(), cuts[:-1])
                rest = rest.slice(cuts[-2])
        if rest is not None and rest.num_rows:
            yield compare(rest.combine_chunks(), cuts_of(rest))

    return run


def pairs_of(cuts: np.ndarray, own: np.ndarray, limit: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``(i, j)``, ``i < j``, inside the groups, about ``limit`` at a time.

    Groups of one size are enumerated together. In a group of two blocks only
    pairs of different blocks count.
    """
    sizes = np.diff(cuts)
    for size in np.unique(sizes[sizes > 1]):
        starts = cuts[:-1][sizes == size]
        i, j = np.triu_indices(size, 1)
        step = max(1, limit // len(i))
        for at in range(0, len(starts), step):
            base = starts[at : at + step, None]
            a, b = (base + i).ravel(), (base + j).ravel()
            # own is constant in a group of one block
            first = np.repeat(own[starts[at : at + step]], len(i))
            mixed = np.repeat(np.array([(own[s : s + size] != own[s]).any() for s in starts[at : at + step]]), len(i)) if size > 2 else first != own[b]
            use = ~mixed | (own[a] != own[b])
            yield a[use], b[use]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches over the links ``a[i] - b[i]``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    while (root[root] != root).any():
        root = root[root]
    return root
