"""Importance resampling towards a target corpus, with hashed word features.

A feature is a run of one to three words; its bucket is the CRC-32 of its
bytes. How much oftener a bucket is met in the target than in the documents
is its gain, a document's weight is the sum of its features' gains, and the
documents are drawn without replacement by weight plus seeded Gumbel noise.

The CRCs of an Arrow batch are found together: distinct features are grouped
by equal length into matrices of bytes, one column after the other is worked
into all CRCs of a matrix, and the buckets are scattered back to every place
where the features stand.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .textkernel import LOWER, Texts, slices, words

BUCKETS = 10_000
WIDTH = 3
#: Matrices of at most this many bytes are worked on at a time.
MATRIX_BYTES = 1 << 20
#: Features over this many bytes are hashed one by one: a matrix of a few rows would cost a step for each byte.
LONG = 4096
SLICE_BYTES = 1 << 20

#: Bytes that are no part of a word, after lower-casing.
GAP = np.ones(256, dtype=bool)
GAP[0x30:0x3A] = GAP[0x61:0x7B] = GAP[0x80:] = False


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """Weight, score and rank of every row of ``docs(doc_id, text)`` for a draw towards ``target(text)``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
    Returns, for each input row, ``doc_id, n_words, n_features, weight, score,
    rank``. Of the ``N`` rows with ``min_words`` words or more the
    ``floor(percent * N / 100)`` of highest score, ties to the smaller
    ``doc_id`` (null first), have a ``rank`` from 1; it is null for the
    others. Null and empty texts have no features and the weight 0. A null
    ``doc_id`` is written as nothing in the seed. Repeated rows are rows of
    their own; which of two identical ones is drawn is left open. An empty
    target gives every feature a gain from the documents alone; an empty
    table gives an empty table. Other columns are ignored.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be between 1 and 65536")
    scratch = Scratch(docs.sparkSession, "resampling")
    hashed = scratch.table(hashed_features(docs.select("doc_id", "text"), buckets), "features")
    wanted = hashed_features(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), buckets)
    gain = gains(bucket_totals(hashed, buckets), bucket_totals(wanted, buckets), buckets)
    weighed = hashed.mapInArrow(_weights(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = scratch.table(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    scratch.drop("features")

    # Sorted over all partitions: a row's place is the rows of the partitions before, and its own number there.
    able = scored.filter(F.col("n_words") >= min_words).withColumn("uid", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc("doc_id"), F.asc("uid")]
    placed = able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = scratch.table(placed.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)}), "placed")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # a row per partition
    drawn = percent * sum(n for _, n in sizes) // 100
    before, at = [], 0
    for part, n in sizes:
        before.append((part, at))
        at += n
    offsets = F.broadcast(docs.sparkSession.createDataFrame(before, "part bigint, before bigint"))
    place = F.col("before") + F.col("at") + 1
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = placed.join(offsets, "part").select(*columns, F.when(place <= drawn, place).alias("rank"))
    return ranked.unionByName(scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of ``seed:doc_id``; floors go down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u)))


def hashed_features(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` of ``rows(doc_id, text)``; ``buckets``: 16-bit numbers, one for each feature."""
    return rows.mapInArrow(_hash(buckets), "doc_id bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_totals(hashed: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over the whole table; tasks send one row for each bucket, and so does the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0))[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    sums = hashed.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(have: np.ndarray, want: np.ndarray, buckets: int) -> np.ndarray:
    """``floor(1000 * ln(share wanted / share there))`` of each bucket, one added to every count."""
    above, below = float(have.sum() + buckets), float(want.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1) * above / ((s + 1) * below))) for s, t in zip(have.tolist(), want.tolist(), strict=True)], np.int64)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 16-bit numbers of a binary column, and where each row's begin."""
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]].view("<u2"), (off - off[0]) // 2


def _weights(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, off = _numbers(batch.column(3))
            upto = np.concatenate([[0], np.cumsum(gain[numbers])])
            weight = pa.array(upto[off[1:]] - upto[off[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], weight], ["doc_id", "n_words", "n_features", "weight"])

    return run


def _hash(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(1), SLICE_BYTES):
                n_words, doc, bucket = feature_buckets(t, buckets)
                n = np.bincount(doc, minlength=t.n)
                raw = bucket[np.argsort(doc, kind="stable")].astype("<u2").tobytes()
                offsets = np.concatenate([[0], np.cumsum(n)]) * 2
                lists = pa.Array.from_buffers(pa.large_binary(), t.n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), pa.array(n_words), pa.array(n.astype(np.int64)), lists], ["doc_id", "n_words", "n_features", "buckets"]
                )

    return run


def feature_buckets(t: Texts, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, and the row and bucket of every feature."""
    low = LOWER[t.buf]
    w = words(t._replace(buf=low), GAP)
    # The words alone, one space after each: every feature is one span of this.
    size = w.end - w.start
    solid = low[~GAP[low]]
    at = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.full(at[-1], 0x20, np.uint8)
    text[np.arange(len(solid)) + np.repeat(np.arange(len(size)), size)] = solid
    cuts = np.concatenate([[0], np.cumsum(size)])
    plain = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(solid)])
    coded = plain.dictionary_encode()
    first_code, n_codes = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)

    docs, out, code = [], [], first_code
    for k in range(1, WIDTH + 1):
        if k > 1:  # a run's code is that of the run without its last word, and the last word
            code = code[: max(0, len(code) - 1)] * n_codes + first_code[k - 1 :]
        inside = w.doc[: len(code)] == w.doc[k - 1 :]
        places = np.flatnonzero(inside)
        _, one, inverse = np.unique(code[places], return_index=True, return_inverse=True)
        start = places[one]
        crc = crc32_of_spans(text, at[start], at[start + k] - 1 - at[start])
        docs.append(w.doc[places])
        out.append((crc % np.uint32(buckets))[inverse])
        if k < WIDTH:  # small codes again; places across texts keep a code of no use
            small = np.zeros(len(code), np.int64)
            small[places] = inverse
            code = small
    return w.per_doc.astype(np.int64), np.concatenate(docs), np.concatenate(out)


def _crc_table() -> np.ndarray:
    """What each low byte does to the rest of a CRC-32 (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc32_of_spans(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans ``text[start:start + size]``: matrices of equal length, column by column."""
    table = _crc_table()
    out = np.zeros(len(start), np.uint32)
    if not len(start):
        return out
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(order, first[1:]), strict=True):
        if length > LONG:
            out[rows] = [zlib.crc32(text[s : s + length]) for s in start[rows].tolist()]
            continue
        step = max(1, MATRIX_BYTES // max(1, length))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            matrix = text[start[part] + np.arange(length)[:, None]]  # a row for each byte position
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = table[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[part] = ~crc
    return out
