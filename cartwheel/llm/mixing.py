"""Mixing overlapping sources to target weights by min-cost flow, then seeded documents.

Documents are aggregated by *membership pattern*, the set of sources they may
be taken for. A pattern's words are capacity, once for each of ``max_repeats``
passes, and a pass costs more than the one before (convex repetition costs),
so fresh text is routed before repeated text. The flow from patterns to source
quotas is found on the driver: its size is that of the patterns and sources,
never that of the documents. Every document of a pattern is then taken as
often as the flow passes over it whole, and a seeded choice of documents once
more, up to the words that are left.
"""

from __future__ import annotations

import functools
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: More patterns than this are an error: their number must not grow with the documents.
MAX_PATTERNS = 10_000
#: The seeded order is cut in bins of bins of this number, until a bin holds at most LAST_BIN rows of a pattern.
BINS = 1024
LAST_BIN = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(sources: list[str | None]) -> dict[str | None, float]:
    """1, 2, 3, 1, 2, 3 ... over the sources by code point, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    return {s: float(i % 3 + 1) for i, s in enumerate(ordered)}


def targets_of(sizes: dict[str | None, int], weights: dict[str | None, float], total: float, max_repeats: int = 3) -> dict[str | None, float]:
    """Shares of ``total`` by weight; none above ``max_repeats`` times its size, the excess reshared."""
    left, open_sources, target = float(total), dict(weights), {}
    while open_sources:
        unit = left / sum(open_sources.values())
        over = [s for s, w in open_sources.items() if w * unit > max_repeats * sizes[s]]
        if not over:
            target |= {s: w * unit for s, w in open_sources.items()}
            break
        for s in over:
            target[s] = float(max_repeats * sizes[s])
            left -= target[s]
            del open_sources[s]
    return target


def route(patterns: list[tuple[int, list[int]]], quotas: list[int], max_repeats: int = 3) -> list[list[int]]:
    """Words that each pattern gives each source: a min-cost flow.

    ``patterns`` are (words, sources); pass ``k`` over a pattern costs ``k``
    for each word.
    """
    n, m = len(patterns), len(quotas)
    sink = 1 + n + m
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, room = [], []

    def edge(a: int, b: int, cap: int) -> int:
        for x, y, c in ((a, b, cap), (b, a, 0)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
        return len(to) - 2

    links, entry = {}, []
    for p, (words, members) in enumerate(patterns):
        entry.append(edge(0, 1 + p, 0))
        for s in members:
            links[p, s] = edge(1 + p, 1 + n + s, max_repeats * words)
    for s, q in enumerate(quotas):
        edge(1 + n + s, sink, q)
    # All costs stand on the first edges, so the cheapest flow is found pass by
    # pass: the capacity of one more pass, then all that can flow.
    for _ in range(max_repeats):
        for e, (words, _members) in zip(entry, patterns, strict=True):
            room[e] += words
        _fill(graph, to, room, 0, sink)
    return [[room[links[p, s] ^ 1] if (p, s) in links else 0 for s in range(m)] for p in range(n)]


def _fill(graph: list[list[int]], to: list[int], room: list[int], source: int, sink: int) -> None:
    """Augment to a maximum flow: blocking flows in layered graphs."""
    while True:
        layer = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > 0 and to[e] not in layer:
                    layer[to[e]] = layer[a] + 1
                    queue.append(to[e])
        if sink not in layer:
            return
        nxt, path, at = [0] * len(graph), [], source
        while True:
            if at == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                del path[next(i for i, e in enumerate(path) if not room[e]) :]  # go on from the first edge that is full
                at = to[path[-1]] if path else source
            while nxt[at] < len(graph[at]):
                e = graph[at][nxt[at]]
                if room[e] > 0 and layer.get(to[e], -1) == layer[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                nxt[at] += 1
            else:
                if at == source:
                    break
                at = to[path.pop() ^ 1]
                nxt[at] += 1


def mix(docs: DataFrame, members: Column, weights: dict[str | None, float] | None = None, total: int | None = None, max_repeats: int = 3, seed: int = 7, size: Column | None = None, tie: Column | None = None) -> DataFrame:
    """How often each row of ``docs(doc_id, text)`` is taken, for sources at target weights.

    Without ``text``, give the rows' ``size``, a whole number that is never
    null, and ``tie``, which tells rows of one ``doc_id`` apart (default: the
    text). The columns may have any names but ``mix``.

    ``members`` gives the array of sources that a row may be taken for; a null
    element is a source, a null array is the null source alone. Sizes are
    words. ``weights`` default to :func:`cyclic_weights`; ``total`` defaults
    to the words of the corpus. Returns the input's columns and ``mix``, a
    struct of ``size, pattern, source_size, target`` (of the first of the
    row's sources), ``copies`` (0 to ``max_repeats``) and ``taken`` (words,
    repeats counted), one row per input row. Texts without a word, and null
    texts, are taken with their pattern's whole passes and add no words.
    Repeated rows are rows of their own. Reruns agree, up to the choice
    between identical rows. An empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    spark = docs.sparkSession
    boxed = docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"), F.coalesce(members, F.array(F.lit(None).cast("string"))).alias("m"), *([] if size is None else [size.alias("size")]), (tie if tie is not None else F.col("text") if "text" in docs.columns else F.lit(None).cast("string")).alias("tie"))
    own = F.array_sort(F.array_distinct("m"))
    keyed = boxed.select("row", own.alias("m"), (word_count(F.col("row.text")) if size is None else F.col("size")).alias("size"), F.pmod(F.xxhash64("row.doc_id", "tie", F.lit(seed)), F.lit(1 << 40)).alias("seeded"))
    keyed = keyed.withColumn("pattern", F.to_json("m"))
    # Row ids live in a table, so that every later step sees the same ones.
    ids = keyed.withColumn("uid", F.monotonically_increasing_id())
    # The seeded order: 40 bits of the row's content, then 20 that part identical rows.
    ids = ids.withColumn("u", F.shiftleft("seeded", 20) + F.pmod(F.xxhash64("uid"), F.lit(1 << 20))).drop("seeded")
    ids = scratch.table(ids, "rows")
    rows = ids.select("uid", "pattern", "size", "u", F.col("row.doc_id").alias("doc_id"))

    found = rows.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found = sorted(found, key=lambda r: r["pattern"])
    parsed = {r["pattern"]: r["m"] for r in ids.groupBy("pattern").agg(F.min("m").alias("m")).collect()}
    sizes: dict[str | None, int] = {}
    for r in found:
        for s in parsed[r["pattern"]]:
            sizes[s] = sizes.get(s, 0) + r["words"]
    weights = weights or cyclic_weights(list(sizes))
    weights = {s: w for s, w in weights.items() if s in sizes}
    target = targets_of(sizes, weights, sum(r["words"] for r in found) if total is None else total, max_repeats)
    names = list(weights)
    flow = route([(r["words"], [names.index(s) for s in parsed[r["pattern"]] if s in weights]) for r in found], [round(target[s]) for s in names], max_repeats)

    plan = []
    for r, out in zip(found, flow, strict=True):
        whole, rest = divmod(sum(out), r["words"]) if r["words"] else (0, 0)
        first = next((s for s in parsed[r["pattern"]] if s in weights), None)
        plan.append((r["pattern"], sizes.get(first, 0), float(target.get(first, 0.0)), whole, rest))
    schema = StructType([StructField("pattern", StringType()), StructField("source_size", LongType()), StructField("target", DoubleType()), StructField("whole", LongType()), StructField("rest", LongType())])
    plans = spark.createDataFrame(plan, schema)  # at most MAX_PATTERNS rows

    once_more = scratch.table(_seeded(rows, F.broadcast(plans.filter("rest > 0").select("pattern", "rest")), scratch), "once-more")
    # Lists of rows grow with the corpus: their joins are merge joins at every size.
    chosen = ids.join(once_more.withColumn("more", F.lit(1)).hint("merge"), "uid", "left").join(F.broadcast(plans), "pattern")
    copies = F.col("whole") + F.coalesce("more", F.lit(0))
    info = F.struct("size", "pattern", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    return chosen.select("row.*", info.alias("mix"))


def _seeded(rows: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """``uid`` of the rows that make up ``rest`` words of each pattern, in seeded order.

    Rows are taken in the order until the next one does not fit; the rows that
    are not larger than the words still missing are tried again, until there
    are none. Then the one row left whose size is nearest to the gap is taken,
    if that brings the words nearer.
    """
    taken, step = None, 0
    left = rows.filter("size > 0").join(wanted, "pattern").withColumn("gap", F.col("rest")).drop("rest")
    left = scratch.table(left, "left-0")
    while not (small := left.filter("size <= gap")).isEmpty():
        step += 1
        got = scratch.table(_in_order(small, scratch, step), f"got-{step}")
        taken = got if taken is None else taken.unionByName(got)
        words = got.groupBy("pattern").agg(F.sum("size").alias("have"))
        others = left.join(got.select("uid").hint("merge"), "uid", "left_anti").join(F.broadcast(words), "pattern", "left")
        left = scratch.table(others.withColumn("gap", F.col("gap") - F.coalesce("have", F.lit(0))).drop("have"), f"left-{step}")
        scratch.drop(f"left-{step - 1}")
    off = F.abs(F.col("size") - F.col("gap"))
    near = left.withColumn("off", off).filter("off < gap")
    nearest = near.groupBy("pattern").agg(F.min(F.struct("off", "u", "doc_id", "uid")).alias("best")).select("best.uid")
    return nearest if taken is None else taken.select("uid").unionByName(nearest)


def _in_order(rows: DataFrame, scratch: Scratch, step: int) -> DataFrame:
    """The rows that come, in seeded order, before the ``gap`` of their pattern is exceeded.

    Bins of the order are summed and the bin in which the words run out is
    opened, twice and until it is small; its rows are looked at one by one.
    """
    left, taken, level = rows.withColumn("now", F.col("gap")), [], 0
    while level < 2 or (level < 6 and left.groupBy("pattern").count().filter(F.col("count") > LAST_BIN).count()):
        level += 1
        bin_of = F.shiftright("u", 60 - 10 * level).bitwiseAND(BINS - 1)
        sums = left.withColumn("bin", bin_of).groupBy("pattern", "now", "bin").agg(F.sum("size").alias("words"))
        upto = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("pattern").orderBy("bin")))
        cut = upto.filter("upto > now").groupBy("pattern").agg(F.min(F.struct("bin", (F.col("now") - F.col("upto") + F.col("words")).alias("rest"))).alias("cut"))
        cut = scratch.table(cut.select("pattern", F.col("cut.bin").alias("cut_bin"), F.col("cut.rest").alias("rest")), f"cut-{step}-{level}")
        parted = left.withColumn("bin", bin_of).join(F.broadcast(cut), "pattern", "left")  # a row for each pattern
        taken.append(parted.filter("cut_bin IS NULL OR bin < cut_bin").select(*rows.columns))
        left = parted.filter("bin = cut_bin").withColumn("now", F.col("rest")).drop("bin", "cut_bin", "rest")
    last = left.withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("u", "uid")))
    taken.append(last.filter("upto <= now").select(*rows.columns))
    return functools.reduce(DataFrame.unionByName, taken)
