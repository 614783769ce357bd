"""Quality rules: counts of a text, and its divergence from language references.

Every text gets a histogram of character classes and one of common words. The
reference of a language is the sum of the histograms of all its texts that
pass the base rules, over the whole corpus. The verdict compares a text with
the reference of its ``lang`` by Jensen-Shannon distance (the square root of
the divergence, base 2, from 0 to 1): the character classes, the common words
with one bin for all other words, and the common words alone. A language's
limits are the upper fences of the distances of all its texts, in bands of
length, as short texts lie further off. Texts of no language, or of one with
little text, are held against the sum of all references and share its limits.
Short texts, whose histograms say little, are not judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .textkernel import LOWER, Texts, Words, codes_of, slices, words

#: Frequent function words of four languages.
COMMON_WORDS = (
    "the of and to in is that it for with as on be was by at this from or an are not have he his which but they "
    "le la les de des du et en un une que qui dans pour par sur est avec ou au ce il se ne pas plus "
    "der die das und zu von den mit ist nicht ein eine im auf dem sich es als auch "
    "el los las y del por con para su lo como al más o pero sus"
).split()

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Distances above these reject in any language; texts under JUDGED_WORDS words are not judged, languages under JUDGED_TEXTS texts have no reference.
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.65
JUDGED_WORDS = 50
JUDGED_TEXTS = 20
#: A fence lies this many interquartile ranges above the upper quartile of the distances, and LEAST_MARGIN at least.
FENCE = 3
LEAST_MARGIN = 0.07

SYMBOLS = b"#*$%&|<>"
#: The arrays made for a slice of texts take many times its bytes.
SLICE_BYTES = 1 << 20
N_CLASSES = 11
_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_DISTANCES = ["char_distance", "word_distance", "function_distance"]


def quality_scores(
    docs: DataFrame,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    judged_words: int = JUDGED_WORDS,
    judged_texts: int = JUDGED_TEXTS,
) -> DataFrame:
    """Measures and the verdict of every row of ``docs(doc_id, text, lang)``.

    Returns ``doc_id, lang, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance,
    function_distance, kept``, one row per input row (repeated rows repeat).
    Null and empty texts have no words and fail the base rules. A distance
    above the fence of its language and length, or above
    ``max_char_distance`` or ``max_word_distance``, rejects. A null ``lang``,
    and one of fewer than ``judged_texts`` passing texts, is judged by the
    reference of the whole corpus. A distance is null where it is not judged:
    for a text of under ``judged_words`` words, or where no text passes the
    base rules. Other columns are ignored; an empty table
    gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    schema = "doc_id bigint, lang string, text_hash bigint, " + ", ".join(f"{c} bigint" for c in _COLUMNS) + ", chars array<int>, common array<int>"
    rows = docs.select("doc_id", "lang", F.xxhash64("text").alias("text_hash"), "text")
    measured = scratch.table(rows.mapInArrow(_measure, schema), "measured")
    measured = measured.withColumn("base_failed", base_failed())

    good = measured.filter("NOT base_failed")
    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(len(COMMON_WORDS) + 1)]
    histograms = [F.array(*[F.col(f"{k}{i}") for i in range(n)]) for k, n in (("c", N_CLASSES), ("w", len(COMMON_WORDS) + 1))]
    by_lang = scratch.table(good.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), *sums), "by-lang")
    # A table of its own, small or not: the join on a frequent language can be split.
    large = by_lang.filter((F.col("texts") >= judged_texts) & F.col("lang").isNotNull())
    reference = scratch.table(large.select(F.col("lang").alias("judged_by"), histograms[0].alias("ref_chars"), histograms[1].alias("ref_common")), "reference")
    every = by_lang.agg(*[F.sum(c).alias(c) for c in by_lang.columns[2:]]).select(*histograms).first()
    whole = [np.array([x or 0 for x in h], np.float64)[None] for h in every]  # one histogram of each kind
    scored = measured.join(reference, F.col("lang") == F.col("judged_by"), "left").mapInArrow(
        _score(judged_words, whole),
        "doc_id bigint, lang string, judged_by string, text_hash bigint, " + ", ".join(f"{c} bigint" for c in _COLUMNS) + ", base_failed boolean, " + ", ".join(f"{c} double" for c in _DISTANCES),
    )
    scored = scratch.table(scored, "scored")
    scratch.drop("measured", "reference", "by-lang")

    limits = scratch.table(_fences(scored.filter("NOT base_failed AND char_distance IS NOT NULL"), judged_texts), "limits")
    limits = limits.withColumnRenamed("judged_by", "limits_of")
    limited = scored.join(limits, F.col("judged_by").eqNullSafe(F.col("limits_of")), "left").withColumn("limit", F.array_max(F.filter("limits", lambda x: x["band"] <= _band())))
    ceilings = {"char_distance": max_char_distance, "word_distance": max_word_distance, "function_distance": 1.0}
    far = [F.coalesce(F.col(c) > F.least(F.lit(ceilings[c]), F.col(f"limit.{c}")), F.lit(False)) for c in _DISTANCES]
    return limited.withColumn("kept", ~(F.col("base_failed") | far[0] | far[1] | far[2])).drop("limits", "limit", "limits_of", "judged_by")


def _band() -> Column:
    """Texts of about the same length: the power of two below the number of words."""
    return F.floor(F.log2("n_words")).cast("int")


def _fences(judged: DataFrame, least: int) -> DataFrame:
    """``(judged_by, limits)``: the fences of each length band with ``least`` texts, and of all lengths as band -1.

    A text takes the last band that is not above its own. The quartiles are
    exact to a thousandth, so their state is bounded whatever the rows.
    """

    def fence(name: str) -> Column:
        q = F.percentile(F.round(name, 3), F.array(F.lit(0.25), F.lit(0.75)))
        return (F.get(q, F.lit(1)) + F.greatest(FENCE * (F.get(q, F.lit(1)) - F.get(q, F.lit(0))), F.lit(LEAST_MARGIN))).alias(name)

    def of(band: Column) -> DataFrame:
        return judged.groupBy("judged_by", band.alias("band")).agg(F.count(F.lit(1)).alias("texts"), *[fence(c) for c in _DISTANCES])

    both = of(_band()).unionByName(of(F.lit(-1))).filter(F.col("texts") >= least)
    return both.groupBy("judged_by").agg(F.collect_list(F.struct("band", *_DISTANCES)).alias("limits"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of two count matrices; not a number if a row sums to 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / p.sum(axis=1, keepdims=True), q / q.sum(axis=1, keepdims=True)
        m = (p + q) / 2
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
        return np.sqrt(np.maximum((left + right) / 2, 0)) + 0 * (p + q).sum(axis=1)


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of float rows; a null row is all zero."""
    out = np.zeros((len(column), width))
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out[there] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _distances(chars: np.ndarray, common: np.ndarray, ref_chars: np.ndarray, ref_common: np.ndarray) -> list[np.ndarray]:
    """The three distances of each row; the last bin of ``common`` holds all other words."""
    function = js_distance(common[:, :-1], ref_common[:, :-1])
    none = (common[:, :-1].sum(axis=1) == 0) & (ref_common[:, :-1].sum(axis=1) > 0)
    return [js_distance(chars, ref_chars), js_distance(common, ref_common), np.where(none, 1.0, function)]


def _score(judged_words: int, whole: list[np.ndarray]):
    """Distances of each row; a row without a reference is held against the histograms ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = ["doc_id", "lang", "judged_by", "text_hash", *_COLUMNS, "base_failed"]
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            short = get("n_words").to_numpy() < judged_words
            chars, ref_chars = (_dense(get(c), N_CLASSES) for c in ("chars", "ref_chars"))
            common, ref_common = (_dense(get(c), len(COMMON_WORDS) + 1) for c in ("common", "ref_common"))
            none = get("judged_by").is_null().to_numpy(zero_copy_only=False)
            ref_chars[none], ref_common[none] = whole
            out = [get(c) for c in plain]
            for d in _distances(chars, common, ref_chars, ref_common):
                out.append(pa.array(d, pa.float64(), mask=short | np.isnan(d)))
            yield pa.RecordBatch.from_arrays(out, [*plain, *_DISTANCES])

    return run


def _char_classes() -> np.ndarray:
    """Class of each byte of UTF-8; continuation bytes are left out (class N_CLASSES)."""
    c = np.full(256, 7, np.int64)  # other ASCII punctuation
    c[ord("a") : ord("z") + 1] = 0
    c[ord("A") : ord("Z") + 1] = 1
    c[ord("0") : ord("9") + 1] = 2
    c[[0x20, 9, 10, 11, 12, 13]] = 3
    c[list(b".,;:!?'\"-()")] = 4
    c[list(b"[#*$%&<>]{}=+/\\^_~@`")] = 5
    c[0xC2:0xF5] = 6  # first byte of a character beyond ASCII
    c[:9] = c[14:32] = c[127] = 8
    c[0x80:0xC0] = N_CLASSES
    c[ord("!")] = 9
    c[ord("|")] = 10
    return c


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    classes = _char_classes()
    vocabulary = {w.encode(): i for i, w in enumerate(COMMON_WORDS)}
    for batch in batches:
        for t in slices(batch.column(3), SLICE_BYTES):
            w = words(t)
            off = t.off
            row = np.repeat(np.arange(t.n), np.diff(off))
            solid = np.zeros(len(t.buf) + 1, np.int64)
            np.cumsum((t.buf & 0xC0) != 0x80, out=solid[1:])
            word_chars = np.bincount(w.doc, solid[w.end] - solid[w.start], t.n).astype(np.int64)
            n_symbols = np.bincount(row, symbol[t.buf], t.n).astype(np.int64)
            chars = np.bincount(row * (N_CLASSES + 1) + classes[t.buf], minlength=t.n * (N_CLASSES + 1)).reshape(t.n, -1)[:, :N_CLASSES]

            codes, distinct = codes_of(t.buf, w.start, w.end)
            bin_of = np.array([vocabulary.get(_bare(x), len(vocabulary)) for x in distinct.to_pylist()], np.int64)[codes]
            bins = len(vocabulary) + 1
            common = np.bincount(w.doc * bins + bin_of, minlength=t.n * bins).reshape(t.n, -1)

            columns = [
                batch.column(0).slice(t.first, t.n),
                batch.column(1).slice(t.first, t.n),
                batch.column(2).slice(t.first, t.n),
                pa.array(w.per_doc.astype(np.int64)),
                pa.array(word_chars),
                pa.array(n_symbols),
                pa.array(_dup_lines(t, w)),
                pa.array(_repeat_words(codes, w.doc, t.n)),
                _rows(chars),
                _rows(common),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "text_hash", *_COLUMNS, "chars", "common"])


def _bare(word: bytes) -> bytes:
    """The word in lower case, without one closing mark."""
    return word[: -1 if len(word) > 1 and word[-1:] in b".,;:!?" else None].translate(LOWER.tobytes())


def _rows(m: np.ndarray) -> pa.Array:
    offsets = np.arange(m.shape[0] + 1, dtype=np.int32) * m.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel().astype(np.int32)))


def _again(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does an equal one of its row come before it, and does any equal one exist."""
    order = np.lexsort((keys, doc))  # stable: equal keys stay in reading order
    k, d = keys[order], doc[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    before, any_other = np.zeros(len(k), bool), np.zeros(len(k), bool)
    before[order] = same[:-1]
    any_other[order] = same[:-1] | same[1:]
    return before, any_other


def _dup_lines(t: Texts, w: Words) -> np.ndarray:
    newline = np.flatnonzero(t.buf == 10)
    start = np.union1d(t.off[:-1], newline + 1)
    doc = np.searchsorted(t.off, start, side="right") - 1
    keep = (doc < t.n) & (start < len(t.buf))
    start, doc = start[keep], doc[keep]
    stop = np.minimum(np.append(start[1:], len(t.buf)), t.off[doc + 1])
    end = np.where((stop > start) & (t.buf[stop - 1] == 10), stop - 1, stop)
    has_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, doc = start[has_word], end[has_word], doc[has_word]
    before, _ = _again(codes_of(t.buf, start, end)[0], doc)
    return np.bincount(doc[before], minlength=t.n).astype(np.int64)


def _repeat_words(codes: np.ndarray, doc: np.ndarray, n: int, width: int = 5) -> np.ndarray:
    """Words in runs of ``width`` words that their text holds twice; a run's code is that of its first words and its last."""
    runs, words_left = codes, codes
    for _ in range(width - 1):
        words_left = words_left[1:]
        _, runs = np.unique(runs[: len(words_left)] * (codes.max(initial=0) + 1) + words_left, return_inverse=True)
    at = np.flatnonzero(doc[: len(runs)] == doc[width - 1 :]) if len(runs) else np.zeros(0, np.int64)
    _, twice = _again(runs[at], doc[at])
    delta = np.zeros(len(codes) + 1, np.int64)
    np.add.at(delta, at[twice], 1)
    np.add.at(delta, at[twice] + width, -1)
    return np.bincount(doc, np.cumsum(delta)[:-1] > 0, n).astype(np.int64)
