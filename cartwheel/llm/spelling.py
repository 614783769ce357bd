"""Spelling variants: a vocabulary acceptor composed with a one-edit transducer and itself.

Two words are near if one edit (an inserted, deleted or replaced code point)
turns one into the other. The pairs are the paths through ``A o T o A``: ``A``
is the minimal acyclic acceptor of the vocabulary, ``T`` copies letters and
makes one edit, at the first place where the two words differ. Until the edit
both sides of the composition are in states reached by the same letters, so
the machine is cut there: a *part* holds the words that share everything
outside a segment of positions, and its initial state is the one reached after
what they share.

* A word of length ``L`` is cut in two segments, and the edit lies in one of
  them: either the part shares the beginning, or (the machine read backwards)
  the end. Words of length ``L - 1`` are put to the same parts.
* A part of more than ``PART`` words is cut again, its segment halved. In a
  segment of one position the words differ in one letter, so a part is never
  larger than the alphabet.

A task builds one minimal acceptor for many parts (they share their states),
walks the composition from the initial state of each, and gives back one row
for each word of a part: how many near words it has there, and the best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import whole_groups
from .scratch import Scratch

RUN = r"[A-Za-zÀ-ÿ]+"
#: A part of more words is cut again.
PART = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, change: Callable[[Column, Column], Column] | None = None, pattern: str = RUN) -> DataFrame:
    """``word, n`` of all whole texts of ``docs(doc_id, text)``: runs of ``pattern``, A-Z lower-cased.

    ``change(doc_id, word)`` may rewrite each occurrence. Null and empty texts
    have no words; repeated rows count each time; other columns are ignored.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word"))
    runs = runs.select("doc_id", F.translate("word", UPPER, LOWER).alias("word"))
    # Counted in each task before the shuffle: a frequent word costs one row a task.
    word = F.col("word") if change is None else change(F.col("doc_id"), F.col("word"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def spelling_variants(words: DataFrame, factor: int = 5, part: int = PART) -> DataFrame:
    """Near words, form and root of every word of ``words(word, n)``.

    A word's *form* is its near word of largest ``n``, ties to the smallest in
    code-point order, if that ``n`` is ``factor`` times the word's or more; the
    *root* follows forms to the last and is the word itself without a form.
    Returns ``word, n, n_near, form, form_n, root``, one row per distinct word;
    rows that repeat a word add up, null words and null ``n`` are left out, an
    empty word is a word, an empty table gives an empty table. ``factor`` must
    be over 1, so that forms cannot go round.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2")
    scratch = Scratch(words.sparkSession, "spelling")
    words = words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    words = scratch.table(words, "words")
    near = scratch.table(_near(_first_parts(words), scratch, part), "near")
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    joined = words.join(best.hint("merge"), "word", "left")
    form = F.when(-F.col("best.rank") >= factor * F.col("n"), F.col("best.word"))
    named = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.rank")).alias("form_n"))
    named = scratch.table(named, "named")
    scratch.drop("near", "words")
    roots = _roots(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch)
    return named.join(roots.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _first_parts(words: DataFrame) -> DataFrame:
    """Every word as the longer (or equally long) one of a pair, and as the shorter one, in both halves."""
    size = F.char_length("word")
    roles = F.array(F.struct(size.alias("length"), F.lit(True).alias("long")), F.struct((size + 1).alias("length"), F.lit(False).alias("long")))
    rows = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*")
    half = F.floor(F.col("length") / 2).cast("int")
    return _cut(rows, F.lit(0), half, F.col("length"))


def _cut(rows: DataFrame, lo: Column, middle: Column, hi: Column) -> DataFrame:
    """The rows once for the segment ``[lo, middle)`` of their positions and once for ``[middle, hi)``."""
    halves = F.filter(F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi"))), lambda s: s["lo"] < s["hi"])
    cut = rows.select("word", "n", "length", "long", F.explode(halves).alias("s")).select("word", "n", "length", "long", "s.*")
    rest = F.col("hi") - F.when(F.col("long"), 0).otherwise(1) + 1  # where the shared end begins, from 1
    ahead, behind = F.substring("word", F.lit(1), F.col("lo")), F.substring("word", rest, F.col("length"))
    # The numbers fix how long the shared beginning and end are, so the key needs no mark between them.
    return cut.withColumn("part", F.concat_ws(":", "length", "lo", "hi", F.concat(ahead, behind)))


def _near(rows: DataFrame, scratch: Scratch, limit: int) -> DataFrame:
    """``word, n_near, best`` of each word in each part, large parts cut until they are small."""
    found, level = None, 0
    while True:
        rows = scratch.table(rows, f"rows-{level}")
        sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("members"), F.count_if("long").alias("longs")).filter("members > 1 AND longs > 0")
        sizes = scratch.table(sizes.select("part", "members"), f"sizes-{level}")
        large = (F.col("members") > limit) & (F.col("hi") - F.col("lo") > 1)
        shared = scratch.table(rows.join(sizes.hint("merge"), "part").withColumn("large", large).drop("members"), f"shared-{level}")
        scratch.drop(f"rows-{level}", f"sizes-{level}")
        small = shared.filter("NOT large").select("part", "long", "word", "n", "lo", "hi")
        walked = small.repartition("part").sortWithinPartitions("part", "long", "word").mapInArrow(
            whole_groups(["part"], _walk), "word string, n_near bigint, best struct<rank:bigint,word:string>"
        )
        found = walked if found is None else found.unionByName(walked)
        rows = shared.filter("large")
        if rows.isEmpty():
            return found
        level += 1
        rows = _cut(rows, F.col("lo"), F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"), F.col("hi"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """Forms followed to the last, by doubling the step until none goes further."""
    step = 0
    roots = scratch.table(forms, "roots-0")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        moved = roots.join(up.hint("merge"), "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        step += 1
        nxt = scratch.table(moved, f"roots-{step}")
        scratch.drop(f"roots-{step - 1}")
        roots = nxt.select("word", "root")
        if nxt.filter("moved").isEmpty():
            return roots


# --- in a task ------------------------------------------------------------------------------------


class Acceptor:
    """A minimal acyclic acceptor of several sets of strings, one initial state for each.

    A state's arcs carry how many strings are accepted by the arcs before, so
    a path gives its string's number in the sorted set.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.count: list[int] = []
        self.final: list[bool] = []

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, *arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.arcs)
            table, n = {}, int(final)
            for letter, to in arcs:
                table[letter] = (to, n)
                n += self.count[to]
            self.arcs.append(table)
            self.count.append(n)
            self.final.append(final)
        return state

    def add(self, strings: list[str]) -> int:
        """The initial state of a set of distinct strings, given in code-point order."""
        open_arcs: list[list[tuple[str, int]]] = [[]]
        finals, last = [False], ""

        def close(depth: int) -> None:
            while len(open_arcs) > depth + 1:
                state = self._state(finals.pop(), open_arcs.pop())
                open_arcs[-1].append((last[len(open_arcs) - 1], state))

        for s in strings:
            shared = 0
            while shared < len(last) and shared < len(s) and last[shared] == s[shared]:
                shared += 1
            close(shared)
            for _ in range(len(s) - shared):
                open_arcs.append([])
                finals.append(False)
            finals[-1] = True
            last = s
        close(0)
        return self._state(finals[0], open_arcs[0])

    def common(self, x: int, y: int, at_x: int, at_y: int, but: str | None = None) -> Iterator[tuple[int, int]]:
        """Numbers of the strings that both states accept, which do not begin with ``but``."""
        todo = [(x, y, at_x, at_y, but)]
        while todo:
            x, y, i, j, but = todo.pop()
            if x == y and but is None:
                for k in range(self.count[x]):
                    yield i + k, j + k
                continue
            if self.final[x] and self.final[y]:
                yield i, j
            few, many = (self.arcs[x], self.arcs[y]) if len(self.arcs[x]) <= len(self.arcs[y]) else (self.arcs[y], self.arcs[x])
            for letter in few:
                if letter in many and letter != but:
                    (a, p), (b, q) = self.arcs[x][letter], self.arcs[y][letter]
                    todo.append((a, b, i + p, j + q, None))

    def replaced(self, start: int) -> Iterator[tuple[int, int]]:
        """Pairs of strings of ``start`` that differ in one letter."""
        todo = [(start, 0)]
        while todo:
            state, at = todo.pop()
            arcs = list(self.arcs[state].values())
            for k, (a, p) in enumerate(arcs):
                for b, q in arcs[:k]:
                    yield from self.common(a, b, at + p, at + q)
                if self.count[a] > 1:
                    todo.append((a, at + p))

    def deleted(self, longer: int, shorter: int, after: str) -> Iterator[tuple[int, int]]:
        """Pairs of a string of ``longer`` and one of ``shorter``, which lacks one letter of it.

        The letter is the first at which they differ; ``after`` is the letter
        behind the strings, and counts for that.
        """
        todo = [(longer, shorter, 0, 0)]
        while todo:
            x, y, i, j = todo.pop()
            for letter, (a, p) in self.arcs[x].items():
                # What follows the deleted letter does not begin with it.
                if not (letter == after and self.final[y]):
                    yield from self.common(a, y, i + p, j, letter)
                if letter in self.arcs[y]:
                    b, q = self.arcs[y][letter]
                    todo.append((a, b, i + p, j + q))


def _walk(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
    """Walk the composition from the initial state of each part; one row for each word that has near words there."""
    word, long = table.column("word").to_pylist(), table.column("long").to_numpy(zero_copy_only=False)
    n, lo, hi = (table.column(c).to_numpy() for c in ("n", "lo", "hi"))
    acceptor = Acceptor()
    counts = np.zeros(len(word), np.int64)
    best: list[tuple[int, str] | None] = [None] * len(word)

    def meet(i: int, j: int) -> None:
        for own, other in ((i, j), (j, i)):
            counts[own] += 1
            rank = (-int(n[other]), word[other])
            if best[own] is None or rank < best[own]:
                best[own] = rank

    for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        a, b = int(lo[first]), int(hi[first])
        split = first + int((~long[first:last]).sum())  # shorter words come first
        shorter = acceptor.add([w[a : b - 1] for w in word[first:split]]) if split > first else None
        longer = acceptor.add([w[a:b] for w in word[split:last]])
        if last - split > 1:
            for i, j in acceptor.replaced(longer):
                meet(split + i, split + j)
        if shorter is not None:
            for i, j in acceptor.deleted(longer, shorter, word[split][b : b + 1]):
                meet(split + i, first + j)
    use = np.flatnonzero(counts)
    ranks = pa.StructArray.from_arrays([pa.array([best[i][0] for i in use], pa.int64()), pa.array([best[i][1] for i in use], pa.string())], ["rank", "word"])
    return pa.RecordBatch.from_arrays([pa.array([word[i] for i in use], pa.string()), pa.array(counts[use]), ranks], ["word", "n_near", "best"])
