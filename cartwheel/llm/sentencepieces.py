"""SentencePiece encoding and decoding: a score-ordered agenda of adjacent symbol pairs.

A merge-type (BPE) vocabulary gives every piece a score. A text starts as one
symbol for each character; all adjacent pairs whose concatenation is a piece
stand in an agenda, best score first, leftmost of equals. The best pair is
merged and its new neighbours are put in, until the agenda is empty. Symbols
that are no piece are written as bytes.

Short pieces of text are merged many at a time, long ones with a heap. Merges
never cross two kinds of places, so texts are cut there and a Python
worker remembers the ids of the chunks: a character that is part of no longer
piece stands alone, and where no piece holds the space mark after another
character, a space mark begins a chunk. In every Arrow batch the chunks that are new to
the worker are checked against the ``sentencepiece`` library, ids and decoded
text both; whole texts can be.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .scratch import worker_state

SPACE_MARK = "▁"
#: Chunks whose ids a Python worker remembers: up to twice this number, none over this many characters.
CACHE_CHUNKS = 500_000
CACHE_LENGTH = 64
ROWS = 256
#: Chunks of up to this many characters are merged side by side, longer ones one by one.
SHORT = 32
#: The agenda's entry of a pair that is no piece: a rank after all others.
NO_PAIR = 1 << 60
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def encode_documents(docs: DataFrame, model: str, check: str = "chunks") -> DataFrame:
    """Ids of every whole text of ``docs(doc_id, text)``, and the text that they decode to.

    Returns, for each input row, ``doc_id, ids array<int>, decoded string``,
    without begin or end ids. ``model`` is the path of a BPE model file,
    readable on the executors. With ``check`` ``"chunks"`` every chunk is
    compared with the library when a worker first meets it, with ``"texts"``
    every whole text, with ``"none"`` nothing; a difference raises. Null text
    is empty and has no ids; repeated rows repeat; other columns are ignored;
    an empty table gives an empty table.
    """
    if check not in ("chunks", "texts", "none"):
        raise ValueError("check must be 'chunks', 'texts' or 'none'")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encode(model, check), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def decode_ids(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the id list in column ``ids``; null ids give null."""
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if x is None else vocabulary.decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def _vocabulary(path: str) -> Vocabulary:
    state = worker_state()
    key = f"pieces {path}"
    if key not in state:
        with open(path, "rb") as f:
            state[key] = Vocabulary(f.read())
    return state[key]


def _encode(path: str, check: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        library = _library(path) if check != "none" else None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                texts = batch.column(1).slice(lo, ROWS).to_pylist()
                raw = vocabulary.encode(texts, library if check == "chunks" else None)
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])])
                ids = np.frombuffer(b"".join(raw), np.int32)
                decoded = vocabulary.decode_all(ids, offsets)
                if check == "texts":
                    lists = [ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                    if library.encode(texts, num_threads=1) != lists or library.decode(lists, num_threads=1) != decoded.to_pylist():
                        raise ValueError("the ids differ from the sentencepiece library's")
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), lists, decoded], ["doc_id", "ids", "decoded"])

    return run


def _library(path: str):
    import sentencepiece

    state = worker_state()
    key = f"library {path}"
    if key not in state:
        state[key] = sentencepiece.SentencePieceProcessor(model_file=path)
    return state[key]


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, raw[at : at + size]
            at += size


class Vocabulary:
    """Pieces, scores and rules of a BPE model file."""

    def __init__(self, model: bytes):
        parts = list(_fields(model))
        pieces = [dict(_fields(v)) for k, v in parts if k == 1]
        trainer, normalizer = ({k: v for part, raw in parts if part == n for k, v in _fields(raw)} for n in (2, 3))
        kinds = [p.get(3, NORMAL) for p in pieces]
        # Model type 2 is BPE; the other fields are suffix marks, byte fallback, the rewriting rules, space trimming, space marks.
        plain = trainer.get(3) == 2 and not trainer.get(24) and trainer.get(35)
        if not plain or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a BPE model with byte fallback, without rewriting, space trimming, user-defined or unused pieces is needed")
        names = [p[1].decode() for p in pieces]
        self.prefix = SPACE_MARK if normalizer.get(3, 1) else ""
        self.index = {names[i]: i for i, k in enumerate(kinds) if k == NORMAL}
        scores = np.frombuffer(b"".join(p.get(2, b"\0" * 4) for p in pieces), "<f4")
        # Equal scores have equal ranks: then the leftmost pair comes first.
        rank = np.unique(-scores, return_inverse=True)[1].tolist()
        longer = [(names[i], i) for i, k in enumerate(kinds) if k == NORMAL and len(names[i]) > 1]
        chars = sorted({c for p, _ in longer for c in p} - self.index.keys())
        #: A number for each piece, and for each character of a piece that is none itself.
        self.symbol = self.index | {c: len(names) + i for i, c in enumerate(chars)}
        self.none = len(names) + len(chars)
        if self.none >= 1 << 20:
            raise ValueError("the vocabulary has too many pieces")
        #: Pairs of symbols that make a piece: its rank and its number.
        self.merges: dict[int, int] = {}
        for p, i in longer:
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    self.merges[left << 20 | right] = rank[i] << 20 | i
        self.byte = {int(names[i], 16): i for i, k in enumerate(kinds) if k == BYTE for names[i] in (names[i][1:-1],)}
        unknown = trainer.get(44, " ⁇ ".encode())
        whole = {NORMAL: lambda i: names[i].replace(SPACE_MARK, " ").encode(), BYTE: lambda i: bytes([int(names[i], 16)]), UNKNOWN: lambda i: unknown, CONTROL: lambda i: b"\xff"}  # an end of a run of bytes, never UTF-8
        self.bytes_of = [whole[k](i) for i, k in enumerate(kinds)]
        self.marked = {i for i, k in enumerate(kinds) if k == NORMAL and names[i].startswith(SPACE_MARK)}
        self.single = {i for i, k in enumerate(kinds) if k == BYTE}
        self.control = {i for i, k in enumerate(kinds) if k == CONTROL}
        joining = "".join(sorted({c for p, _ in longer for c in p} - {SPACE_MARK}))
        inner = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p, _ in longer)
        group = f"[{re.escape(joining)}{SPACE_MARK if inner else ''}]"
        self.chunk = re.compile(rf"{SPACE_MARK}*{group}+|{SPACE_MARK}+|(?s:.)" if joining else r"(?s:.)")
        #: A character that is part of no longer piece.
        self.stop = next(c for c in map(chr, chain([10, 0], range(0xE000, 0xF8FF))) if c not in joining)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_entries = np.array([self.merges[k] for k in self.pair_keys.tolist()], np.int64)
        if not len(self.pair_keys):
            self.pair_keys, self.pair_entries = np.array([-1]), np.array([NO_PAIR])
        self.by_code = np.full(0x110000, self.none, np.int64)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.by_code[ord(c)] = i
        sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def encode(self, texts: list[str], library=None) -> list[bytes]:
        """Ids of each text, as 32-bit numbers; chunks seen before come from memory, half of which goes when it is full.

        With ``library`` the chunks that are not in memory are checked.
        """
        cut = [self.chunk.findall(self.prefix + t.replace(" ", SPACE_MARK)) if t else [] for t in texts]
        known, learned = self.new, []
        for c in set().union(*cut) - known.keys():
            ids = self.old.get(c)
            if ids is None:
                learned.append(c)
            else:
                known[c] = ids
        short = [c for c in learned if len(c) <= SHORT and all(map(self.index.__contains__, c))]
        known.update(zip(short, self.agendas(short), strict=True))
        rest = [c for c in learned if c not in known]
        known.update((c, array("i", self.agenda(c)).tobytes()) for c in rest)
        if library is not None and learned:
            self.verify(learned, library)
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in cut]
        for c in rest:
            if len(c) > CACHE_LENGTH:
                del known[c]
        if len(known) > CACHE_CHUNKS:
            self.old, self.new = known, {}
        return out

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of id lists that come from ``encode``, all at once: their pieces' bytes side by side."""
        sizes = self.sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.starts[ids] - upto[:-1], sizes) + np.arange(upto[-1])]
        begin, end = upto[offsets[:-1]], upto[offsets[1:]]
        if self.prefix:  # each text begins with a piece that has the space mark of the prefix
            some = np.flatnonzero(end > begin)
            flat = np.delete(flat, begin[some])
            gone = np.concatenate([[0], np.cumsum(end > begin)])
            begin, end = begin - gone[:-1], end - gone[1:]
        cuts = np.append(begin, end[-1:]).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(flat)))
        texts.validate(full=True)
        return texts.cast(pa.string())

    def verify(self, chunks: list[str], library) -> None:
        """Compare the ids of chunks, parted by a character that merges with nothing, with the library's."""
        text = self.stop + self.stop.join(chunks).replace(SPACE_MARK, " ")
        stop = self.agenda(self.stop)
        ids = self.agenda(self.prefix) if self.prefix else []
        for c in chunks:
            ids += stop
            ids += array("i", self.new[c])
        if library.encode(text) != ids or library.decode(ids) != self.decode(ids):
            raise ValueError("the ids differ from the sentencepiece library's")

    def agenda(self, chunk: str) -> list[int]:
        """Merge the best adjacent pair until none is a piece; the ids of what is left.

        An entry of the agenda is a rank and the place of a pair's left symbol.
        It holds if the pair that now stands there has that rank.
        """
        merges, n = self.merges, len(chunk)
        symbols = [self.symbol.get(c, self.none) for c in chunk]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            m = merges.get(symbols[i] << 20 | symbols[i + 1])
            if m is not None:
                agenda.append(m >> 20 << 32 | i)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            m = merges.get(symbols[i] << 20 | symbols[j])
            if m is None or m >> 20 != entry >> 32:
                continue
            own = symbols[i] = m & 0xFFFFF
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges.get(own << 20 | symbols[k])
                if m is not None:
                    heappush(agenda, m >> 20 << 32 | i)
            h = before[i]
            if h >= 0:
                m = merges.get(symbols[h] << 20 | own)
                if m is not None:
                    heappush(agenda, m >> 20 << 32 | h)
        known = len(self.bytes_of)
        out: list[int] = []
        for c, s in zip(chunk, symbols, strict=True):
            if 0 <= s < known:
                out.append(s)
            elif s >= known:
                out += [self.byte[b] for b in c.encode()]
        return out

    def agendas(self, chunks: list[str]) -> list[bytes]:
        """:meth:`agenda` of many short chunks at once, as 32-bit numbers.

        The chunks are the rows of a matrix of symbols, and a second matrix has
        the agenda: the entry of every adjacent pair. Each round merges every
        row's best entry, until no row has one.
        """
        size = np.array([len(c) for c in chunks], np.int64)
        flat = self.by_code[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        out: list[bytes] = [b""] * len(chunks)
        first = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 4096)):  # rows of like length
            width = int(size[part].max(initial=1)) + 1
            column = np.arange(width)
            inside = column < size[part, None]
            symbols = np.where(inside, flat[np.minimum(first[part, None] + column, max(0, len(flat) - 1))], self.none)
            pairs = self.pairs_of(symbols[:, :-1], symbols[:, 1:])
            rows, left = np.arange(len(part)), size[part].copy()
            done = symbols.copy()
            while len(rows):
                best = (pairs >> 20).argmin(axis=1)  # the leftmost of equals
                every = np.arange(len(rows))
                entry = pairs[every, best]
                going = entry < NO_PAIR
                done[rows[~going]] = symbols[~going]
                rows, symbols, pairs, best, entry = rows[going], symbols[going], pairs[going], best[going], entry[going]
                if not len(rows):
                    break
                every = every[: len(rows)]
                left[rows] -= 1
                own = entry & 0xFFFFF
                after = column + (column > best[:, None])
                symbols = np.take_along_axis(np.pad(symbols, ((0, 0), (0, 1)), constant_values=self.none), after, 1)
                symbols[every, best] = own
                after = column[:-1] + (column[:-1] > best[:, None])
                pairs = np.take_along_axis(np.pad(pairs, ((0, 0), (0, 1)), constant_values=NO_PAIR), after, 1)
                pairs[every, best] = self.pairs_of(own, symbols[every, best + 1])
                inner = np.flatnonzero(best > 0)
                at = best[inner] - 1
                pairs[inner, at] = self.pairs_of(symbols[inner, at], own[inner])
            raw = done[np.arange(width) < left[:, None]].astype(np.int32).tobytes()
            cuts = np.concatenate([[0], np.cumsum(left)]) * 4
            for i, lo, hi in zip(part.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                out[i] = raw[lo:hi]
        return out

    def pairs_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The agenda's entry of each pair of symbols: rank and merged piece, or ``NO_PAIR``."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_entries[at], NO_PAIR)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: space marks are spaces, the first one is the prefix, runs of byte ids are UTF-8."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return self._decode_by_piece(ids)
        return text[1:] if self.prefix and ids and ids[0] in self.marked else text

    def _decode_by_piece(self, ids: list[int]) -> str:
        """As ``decode``, where ids end inside a character: a byte that begins none is one replacement mark."""
        out, run = [], b""
        for i in [*ids, -1]:
            if i in self.single:
                run += self.bytes_of[i]
                continue
            while run:
                size = next((k for k in range(1, 5) if _is_character(run[:k])), 0)
                out.append(run[:size].decode() if size else "\ufffd")
                run = run[max(size, 1) :]
            if i >= 0 and i not in self.control:
                piece = self.bytes_of[i].decode()
                out.append(piece[1:] if self.prefix and not out and i in self.marked else piece)
        return "".join(out)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False
