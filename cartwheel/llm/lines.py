"""Line dedup: prefix doubling over line-ID sequences, later copies of maximal repeated runs deleted.

The corpus is read as sequences of line IDs. Prefix doubling ranks runs of
1, 2, 4 ... lines: the rank of a run of ``2h`` lines is the pair of the ranks
of its halves, Spark groups equal pairs, and runs seen once drop out, until no
rank repeats. A group of equal ranks is an interval of the suffix array whose
longest common prefix is at least the run length; its earliest position (by
document, then line) is the copy that stays.

Where a run of ``min_lines`` lines has an earlier copy and the run one line
before does not continue the same copy, a maximal run begins. Its length is the
longest common prefix of the two positions, found from the ranks of all
lengths, the longest first. A single line is a run if it is long or stands in
many documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]"
KEY = ["d", "h"]


def drop_repeated_lines(docs: DataFrame, min_lines: int = 2, min_words: int = 50, min_docs: int = 50, least_left: int = 0) -> DataFrame:
    """Delete later copies of repeated runs of lines from every text.

    A run counts when it has ``min_lines`` lines (a power of two), or is one
    line of ``min_words`` words or more, or one line, of any length, that
    stands in ``min_docs`` documents or more. Lines are split at ``\\n``; lines
    without a word are no part of a run, but those inside a deleted run go
    with it. The first copy, in the order of ``doc_id`` (null first), text
    hash and line, stays. Returns the input's columns, in order, with the new
    text, one row for each input row (a text may become empty); with
    ``least_left``, texts that lose lines and keep fewer words are left out
    with their row, others never. Null text stays null, and rows that repeat both ``doc_id`` and text are one document
    that is not a copy of itself: they come out alike. An empty table stays
    empty. Columns of any other name pass through.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    scratch = Scratch(docs.sparkSession, "lines")
    found = repeated_runs(docs, scratch, min_lines, min_words, min_docs)
    gone = found.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    gone = scratch.table(gone.withColumnsRenamed({"d": "gd", "h": "gh"}), "gone")
    scratch.drop_others("gone")
    names = docs.columns
    boxed = docs.select(F.struct(*[_quoted(c) for c in names]).alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"))
    # Grows with the corpus: never broadcast, at any size.
    joined = boxed.join(gone.hint("merge"), F.col("d").eqNullSafe(F.col("gd")) & (F.col("h") == F.col("gh")), "left")
    # Line numbers of all runs in one flat, sorted list, so each line looks itself up once.
    dead = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"]))))
    left = F.array_except(F.sequence(F.lit(0), F.size(F.split("row.text", "\n", -1)) - 1), dead)
    joined = joined.withColumn("left", F.when(F.col("runs").isNotNull(), left))
    parts = F.split("row.text", "\n", -1)
    text = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform("left", lambda i: F.get(parts, i)), "\n"))
    if least_left:
        joined = joined.filter(F.col("runs").isNull() | (F.regexp_count(text, F.lit(WORD + "+")) >= least_left))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.{_quoted(c)}").alias(c) for c in names])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def repeated_runs(docs: DataFrame, scratch: Scratch, min_lines: int, min_words: int, min_docs: int) -> DataFrame:
    """``d, h, first, last, lines, source``: lines ``first..last`` of a text are a run with an earlier copy.

    ``lines`` counts the run's lines with a word; ``source`` is the place of
    the copy that stays: document, text hash, and number of the line among
    those with a word.
    """
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text").filter("text IS NOT NULL")
    numbered = F.transform(F.split("text", "\n", -1), lambda s, i: F.struct(i.alias("line"), s.alias("s")))
    worded = F.filter(numbered, lambda x: x["s"].rlike(WORD))
    lines = texts.select(*KEY, F.posexplode(worded).alias("seq", "x")).select(
        *KEY,
        "seq",
        F.col("x.line").alias("first"),
        F.col("x.line").alias("last"),
        F.unhex(F.md5(F.col("x.s").cast("binary"))).alias("rank"),  # 128 bits
        (F.regexp_count("x.s", F.lit(WORD + "+")) >= min_words).alias("long"),
    )
    runs = _seen_twice(scratch.table(lines, "lines"), scratch, 1)
    scratch.drop("lines")
    found = runs.filter("later")
    if min_lines > 1:
        # Rows that repeat a document do not count twice. A table of its own, as the ranks are.
        often = runs.filter(F.col("places") >= min_docs).select("rank", *KEY).distinct().groupBy("rank").agg(F.count(F.lit(1)).alias("docs"))
        often = scratch.table(often.filter(F.col("docs") >= min_docs).select("rank", F.lit(True).alias("often")), "often")
        found = found.filter(F.col("long") | (F.col("places") >= min_docs)).join(often, "rank", "left").filter("long OR often")
    single = found.select(*KEY, "first", "last", F.lit(1).alias("lines"), "source")

    ranked, width = {1: runs.select(*_PLACED)}, 1
    while True:
        head = ranked[width].select(*KEY, "seq", "first", F.col("rank").alias("r1"))
        tail = ranked[width].select(F.col("d").alias("td"), F.col("h").alias("th"), (F.col("seq") - width).alias("tseq"), "last", F.col("rank").alias("r2"))
        on = F.col("d").eqNullSafe(F.col("td")) & (F.col("h") == F.col("th")) & (F.col("seq") == F.col("tseq"))
        paired = head.join(tail, on).select(*KEY, "seq", "first", "last", F.unhex(F.md5(F.concat("r1", "r2"))).alias("rank"))
        runs = _seen_twice(paired, scratch, 2 * width)
        if runs.isEmpty():
            break
        width *= 2
        ranked[width] = runs.select(*_PLACED)
    if min_lines not in ranked:
        return single if min_lines > 1 else single.limit(0)
    return single.unionByName(_maximal(ranked, min_lines, scratch)) if min_lines > 1 else _maximal(ranked, 1, scratch)


#: What is known of a repeated run: where it is, its rank, and its earliest copy.
_PLACED = [*KEY, "seq", "first", "last", "rank", "later", "source"]


def _seen_twice(runs: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """The runs whose rank occurs at two places; ``source`` is the earliest, ``later`` tells the others, ``places`` how often it occurs."""
    place = F.struct(*KEY, "seq")
    ends = runs.groupBy("rank").agg(F.min(place).alias("source"), F.max(place).alias("highest"), F.count(F.lit(1)).alias("places")).filter("source < highest")
    # A table of its own, so that a join on a frequent rank can be split.
    ranks = scratch.table(ends.select("rank", "source", "places"), f"ranks-{width}")
    # Rows that repeat a document are one place: no later step meets them twice.
    return scratch.table(runs.join(ranks, "rank").withColumn("later", F.col("source") < place).distinct(), f"runs-{width}")


def _maximal(ranked: dict[int, DataFrame], least: int, scratch: Scratch) -> DataFrame:
    """The maximal runs of ``least`` lines or more that have an earlier copy, each with its whole length.

    Runs of ``least`` lines that follow each other in a text and in the copy
    are one maximal run, which begins at the first of them.
    """
    later = ranked[least].filter("later")
    before = Window.partitionBy(*KEY).orderBy("seq")
    same = (F.lag("seq").over(before) == F.col("seq") - 1) & F.lag(F.struct(F.col("source.d"), F.col("source.h"), F.col("source.seq") + 1)).over(before).eqNullSafe(
        F.struct(F.col("source.d"), F.col("source.h"), F.col("source.seq"))
    )
    starts = later.withColumn("goes_on", F.coalesce(same, F.lit(False))).filter("NOT goes_on")
    runs = scratch.table(starts.select(*KEY, "seq", "first", F.col("first").alias("last"), F.lit(0).alias("lines"), "source"), "starts")
    for width in sorted(ranked, reverse=True):
        # Both places must go on with runs of one rank, ``width`` lines longer.
        own = ranked[width].select(F.col("d").alias("xd"), F.col("h").alias("xh"), F.col("seq").alias("xs"), F.col("last").alias("own_last"), F.col("rank").alias("own_rank"))
        other = ranked[width].select(F.col("d").alias("yd"), F.col("h").alias("yh"), F.col("seq").alias("ys"), F.col("rank").alias("other_rank"))
        at = F.col("d").eqNullSafe(F.col("xd")) & (F.col("h") == F.col("xh")) & (F.col("seq") + F.col("lines") == F.col("xs"))
        there = F.col("source.d").eqNullSafe(F.col("yd")) & (F.col("source.h") == F.col("yh")) & (F.col("source.seq") + F.col("lines") == F.col("ys"))
        both = runs.join(own, at, "left").join(other, there, "left")
        longer = F.coalesce(F.col("own_rank") == F.col("other_rank"), F.lit(False))
        grown = both.select(*KEY, "seq", "first", F.when(longer, F.col("own_last")).otherwise(F.col("last")).alias("last"), (F.col("lines") + F.when(longer, width).otherwise(0)).alias("lines"), "source")
        runs = scratch.table(grown, f"grown-{width}")
    return runs.select(*KEY, "first", "last", "lines", "source")
