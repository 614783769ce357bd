"""Deterministic per-row draws for the generator.

A draw is a pure function of (seed, stream, row number): 32 bits of an MD5
digest. Rows therefore come out the same whatever the number of
partitions or executors, and a retried task recomputes the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


WORDS_PER_DIGEST = 4  # one MD5 digest holds four 32-bit words


def draw(seed: int, stream: str, row: Column) -> Column:
    """Unsigned 32-bit value for ``row`` in the named stream (one digest per stream)."""
    key = F.concat_ws(":", F.lit(str(seed)), F.lit(stream), row.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def draws(seed: int, row: Column, streams: Sequence[str]) -> dict[str, Column]:
    """Independent 32-bit values for several streams from as few digests as possible.

    Stream ``i`` takes word ``i % 4`` of digest ``i // 4``, where digest ``d``
    is ``md5("seed:d:row")``. Whole-stage codegen evaluates each digest once
    per row (common subexpression elimination), so eight streams cost two
    MD5s instead of eight.
    """
    out: dict[str, Column] = {}
    for i, stream in enumerate(streams):
        digest, word = divmod(i, WORDS_PER_DIGEST)
        key = F.concat_ws(":", F.lit(str(seed)), F.lit(str(digest)), row.cast("string"))
        hexword = F.substring(F.md5(key), 1 + 8 * word, 8)
        out[stream] = F.conv(hexword, 16, 10).cast("bigint")
    return out


def in_range(u: Column, low: int, high: int) -> Column:
    """Map a draw to an integer in [low, high]."""
    return F.lit(low) + u % (high - low + 1)


def pick(u: Column, values: Sequence[str]) -> Column:
    """Map a draw to one of ``values``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (u % len(values) + 1).cast("int"))


def cents_in_range(u: Column, low_cents: int, high_cents: int) -> Column:
    """Map a draw to an amount in [low, high] with two decimals, as decimal(12,2)."""
    cents = in_range(u, low_cents, high_cents)
    return (cents.cast("decimal(12,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(12,2)")


def uniform_int(seed: int, stream: str, row: Column, low: int, high: int) -> Column:
    """Integer in [low, high]."""
    return in_range(draw(seed, stream, row), low, high)


def choice(seed: int, stream: str, row: Column, values: Sequence[str]) -> Column:
    """One of ``values``."""
    return pick(draw(seed, stream, row), values)


def uniform_cents(seed: int, stream: str, row: Column, low_cents: int, high_cents: int) -> Column:
    """Amount in [low, high] with two decimals, as decimal(12,2)."""
    return cents_in_range(draw(seed, stream, row), low_cents, high_cents)


def padded_id(prefix: str, n: Column, width: int) -> Column:
    """``prefix`` plus ``n`` zero-padded to ``width`` digits (``C0058``).

    For n >= 0; numbers wider than ``width`` keep all their digits, like ``%04d``.
    """
    digits = n.cast("bigint").cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)
