"""Sequence packing: a swap-based local search that empties bins.

Documents become token ids plus an end id; longer ones are cut into full
sequences with the remainder first, so at most one piece of a document is
short. Short pieces are dealt into groups of bounded size, each packed by one
task, which starts with a bin for every piece and empties bins by moves. The
pieces of all bins that stayed underfull meet in new groups, and there the
search moves and swaps until it finds no step.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, worker_state

CAPACITY = 1024
END_ID = 2
GROUP = 8192
#: Words whose ids a task remembers: up to twice this number.
CACHE_WORDS = 100_000
#: White space as Unicode has it, where the tokenizer splits texts.
_WS = r"\t-\r\x20\x85\xa0  -     　"
#: A word of Latin letters before something that is no letter; else anything up to white space; white space.
_CHUNK = re.compile(
    rf" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]++(?![^\x00-\x40\x5b-\x60\x7b-\x7f])| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every text of ``docs(doc_id, text)``.

    Returns ``doc_id, piece, start, length, ids_crc32`` (of the ids as unsigned
    little-endian 32-bit integers) and, with ``keep_ids``, ``ids``. Null text
    is empty: one piece with the end id alone. Repeated rows give repeated
    pieces. ``tokenizer`` is the path of a ``tokenizers`` JSON file, readable
    on the executors.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    return rows.mapInArrow(_pieces(tokenizer, capacity, end_id, keep_ids), schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, keep_ids: bool = False) -> DataFrame:
    """Pack every piece of ``docs`` into sequences of at most ``capacity`` ids.

    Returns the columns of :func:`token_pieces` with ``sequence_id`` and
    ``offset``, the piece's place there; pieces lie gapless from 0. An empty
    table gives an empty table.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = token_pieces(docs, tokenizer, capacity, end_id, keep_ids).withColumn("uid", F.monotonically_increasing_id())
    pieces = scratch.table(pieces, "pieces")
    short = pieces.filter(F.col("length") < capacity).select("uid", "length")

    def packed(rows: DataFrame, n: int, salt: int, swaps: bool) -> DataFrame:
        groups = max(1, -(-n // group))
        dealt = rows.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)))
        return dealt.groupBy("g").applyInPandas(_pack_group(capacity, swaps), "uid bigint, length bigint, bin bigint, offset bigint, fill bigint, g bigint")

    first = scratch.table(packed(short, short.count(), 1, False), "first")
    # Bins that kept room meet the others' in new groups.
    loose = first.filter(F.col("fill") < capacity - capacity // 64).select("uid", "length")
    second = packed(loose, loose.count(), 2, True)
    done = first.filter(F.col("fill") >= capacity - capacity // 64).withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    # Round in the two low bits, then the bin (below 2**20) and the group.
    number = F.shiftleft(F.shiftleft("g", 20) + F.col("bin"), 2) + F.col("round")
    places = scratch.table(done.select("uid", number.alias("sequence_id"), "offset"), "places")
    full = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", F.shiftleft("uid", 2)).withColumn("offset", F.lit(0).cast("bigint"))
    scratch.drop("first")
    return full.unionByName(pieces.join(places, "uid")).drop("uid")


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
        for batch in batches:
            doc_ids, column = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 256):
                texts = column.slice(lo, 256).to_pylist()
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(encode(texts)):
                    ids = np.append(ids, np.uint32(end_id))
                    head = len(ids) % capacity or min(len(ids), capacity)
                    cuts = [0, *range(head, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        row.append(lo + i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].astype("<u4").tobytes()))
                        if keep_ids:
                            kept.append(ids[a:b].astype(np.int32))
                columns = [
                    doc_ids.take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, names)

    return run


def _encoder(path: str):
    """Texts to id arrays, by the tokenizer, with a memory of words that goes with the task.

    A byte-level BPE tokenizer never merges across its pre-tokens, and these
    never reach across the chunks of ``_CHUNK``, so a text's ids are those of
    its chunks in order. A chunk of letters is one pre-token and goes straight
    to the tokenizer's model. Texts that hold one of the tokenizer's special
    strings go to it whole.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    state = worker_state().setdefault(f"encoder {path}", {})
    if not state:
        tokenizer = Tokenizer.from_file(path)
        if not isinstance(tokenizer.model, BPE) or not isinstance(tokenizer.pre_tokenizer, ByteLevel) or tokenizer.normalizer is not None:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        state.update(tokenizer=tokenizer, special=special, letters=_byte_letters())
    tokenizer, special, model, letters = state["tokenizer"], state["special"], state["tokenizer"].model, state["letters"]

    # An idle worker must not hold the words beside the next stage's memory.
    memory: dict[str, dict[str, bytes]] = {"new": {}, "old": {}}

    def learn(missing: list[str]) -> dict[str, bytes]:
        found, rest = {}, []
        for c in missing:
            if c.isalpha() or (c[0] == " " and c[1:].isalpha()):
                ids = [t.id for t in model.tokenize(c.encode().decode("latin-1").translate(letters))]
                found[c] = array("I", ids).tobytes()
            else:
                rest.append(c)
        for c, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            found[c] = array("I", e.ids).tobytes()
        return found

    def encode(texts: list[str]) -> list[np.ndarray]:
        whole = [any(s in t for s in special) for t in texts]
        chunks = [[] if w else _CHUNK.findall(t) for t, w in zip(texts, whole, strict=True)]
        new, old = memory["new"], memory["old"]
        missing = set().union(*chunks) - new.keys()
        known = missing & old.keys()
        new.update(zip(known, map(old.__getitem__, known), strict=True))
        new.update(learn(list(missing - known)))
        out = [np.frombuffer(b"".join(map(new.__getitem__, cs)), np.uint32) for cs in chunks]
        if len(new) > CACHE_WORDS:  # half of the memory goes, what is in use stays
            memory["old"], memory["new"] = new, {}
        for i in np.flatnonzero(whole):
            out[i] = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

    return encode


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def _pack_group(capacity: int, swaps: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        lengths = rows["length"].to_numpy()
        bins = improve([[i] for i in range(len(lengths))], lengths.tolist(), capacity, swaps)
        order = np.array([i for b in bins for i in b], dtype=np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        picked = lengths[order]
        before = np.cumsum(picked) - picked
        first = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1]) if len(number) else np.zeros(0, np.int64)
        fill = np.add.reduceat(picked, first) if len(first) else picked
        return pd.DataFrame(
            {"uid": rows["uid"].to_numpy()[order], "length": picked, "bin": number, "offset": before - before[first][number], "fill": fill[number], "g": rows["g"].to_numpy()}
        )

    return run


class _Open:
    """The underfull bins, found by their room and the lengths that they hold."""

    def __init__(self, capacity: int):
        self.rooms = np.zeros(capacity + 1, np.int32)  # bins of each room
        self.holds = np.zeros((capacity + 1, capacity + 1), np.int32)  # bins with a piece of each length, of each room
        self.most = np.full(capacity + 1, -1, np.int64)  # the most room beside a piece of each length
        self.of_room: dict[int, dict[int, None]] = {}
        self.of_both: dict[tuple[int, int], dict[int, None]] = {}

    def add(self, b: int, room: int, lengths: set[int]) -> None:
        self.rooms[room] += 1
        self.of_room.setdefault(room, {})[b] = None
        for n in lengths:
            self.holds[n, room] += 1
            self.of_both.setdefault((room, n), {})[b] = None
            self.most[n] = max(self.most[n], room)

    def remove(self, b: int, room: int, lengths: set[int]) -> None:
        self.rooms[room] -= 1
        del self.of_room[room][b]
        for n in lengths:
            self.holds[n, room] -= 1
            del self.of_both[room, n][b]
            if self.most[n] == room and not self.holds[n, room]:
                left = np.flatnonzero(self.holds[n])
                self.most[n] = left[-1] if len(left) else -1


def improve(bins: list[list[int]], lengths: list[int], capacity: int, swaps: bool = True) -> list[list[int]]:
    """Local search: empty bins by moves and by one-for-one and two-for-one swaps.

    First every bin, the fullest first, moves its pieces while there is room
    for them in fuller bins; then the least filled ones swap, too. A step moves a piece of a bin into one that is at least as full and can
    hold it, or swaps it (or two pieces of the bin) for one smaller piece of
    such a bin. All rooms and lengths are looked up: swaps that fill the other
    bin to the brim come first, and a bin is passed over only if it has no
    step at all. Every step raises the sum of squared fills, so the search
    ends: when no bin has a step, or there are no more bins than all pieces
    need. Without ``swaps`` it ends after the moves.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    used = sum(1 for b in bins if b)
    index = _Open(capacity)
    kinds = lambda b: {lengths[i] for i in bins[b]}
    for b in range(len(bins)):
        if bins[b] and fill[b] < capacity:
            index.add(b, capacity - fill[b], kinds(b))

    def give(b: int, c: int, out: list[int], back: int | None) -> None:
        """Pieces ``out`` of ``b`` to ``c``, piece ``back`` of ``c`` to ``b``; ``b`` is not in the index."""
        index.remove(c, capacity - fill[c], kinds(c))
        for i in out:
            bins[b].remove(i)
            bins[c].append(i)
        gain = sum(lengths[i] for i in out)
        if back is not None:
            bins[c].remove(back)
            bins[b].append(back)
            gain -= lengths[back]
        fill[b] -= gain
        fill[c] += gain
        if fill[c] < capacity:
            index.add(c, capacity - fill[c], kinds(c))

    def swap(b: int, room: int, n: int, out: list[int]) -> None:
        c = next(iter(index.of_both[room, n]))
        give(b, c, out, next(i for i in bins[c] if lengths[i] == n))

    every = np.arange(capacity + 1)

    def step(b: int, swaps: bool = True) -> bool:
        limit = capacity - fill[b]  # bins that are at least as full
        rooms = np.flatnonzero(index.rooms[: limit + 1])
        if not len(rooms):
            return False
        own = {lengths[i]: i for i in bins[b]}
        moves = [(int(rooms[at]) - n, n) for n in own if (at := int(np.searchsorted(rooms, n))) < len(rooms)]
        if moves:
            left, n = min(moves, key=lambda m: (m[0], -m[1]))
            give(b, next(iter(index.of_room[left + n])), [own[n]], None)
            return True
        if not swaps:
            return False
        groups = {n: [i] for n, i in own.items()}
        for k, i in enumerate(bins[b]):
            for j in bins[b][:k]:
                groups.setdefault(lengths[i] + lengths[j], [i, j])
        sums = np.array(list(groups))  # single pieces first
        back = sums[:, None] - rooms[None, :]  # the piece that would fill a bin of that room
        brim = np.flatnonzero(index.holds[np.clip(back, 0, capacity), rooms[None, :]] > 0)
        if len(brim):
            k, at = divmod(int(brim[0]), len(rooms))
            swap(b, int(rooms[at]), int(back[k, at]), groups[int(sums[k])])
            return True
        # The roomiest bin beside each length tells whether there is any swap.
        roomy = index.most.copy()
        for n in np.flatnonzero(roomy > limit):
            roomy[n] = np.flatnonzero(index.holds[n, : limit + 1])[-1:].sum()
        left = roomy[None, :] + every[None, :] - sums[:, None]  # what the other bin would have left
        able = (left >= 0) & (every[None, :] < sums[:, None]) & (roomy[None, :] > 0)
        if not able.any():
            return False
        k, n = divmod(int(np.where(able, left, capacity + 1).argmin()), capacity + 1)
        swap(b, int(roomy[n]), n, groups[int(sums[k])])
        return True

    def empty(b: int, swaps: bool) -> bool:
        """All steps of one bin; whether there was one."""
        nonlocal used
        index.remove(b, capacity - fill[b], kinds(b))
        going = False
        while bins[b] and step(b, swaps):
            going = True
        if bins[b]:
            index.add(b, capacity - fill[b], kinds(b))
        else:
            used -= 1
        return going

    underfull = lambda: sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: fill[b])
    for b in reversed(underfull()):
        if fill[b] < capacity:
            empty(b, swaps=False)
    going = swaps
    while going and used > least:
        going = False
        for b in underfull():
            if fill[b] < capacity and used > least:
                going |= empty(b, swaps=True)
    return [b for b in bins if b]
