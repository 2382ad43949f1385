"""Spans found in texts: their column type, digests over them, and cutting them out."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

# start and stop count code points, stop exclusive; base spans are those of the plain patterns
SPANS = "array<struct<kind:string,start:int,stop:int,score:double,base:boolean>>"


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of all spans in their order, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.base & (s.kind == kind))).cast("long")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s.base)


def blank_out(text: str, spans: Sequence[tuple[int, int, str]]) -> str:
    """``text`` with each span (start, stop, kind) replaced by ``[KIND]``; overlapping spans become one, named after the first."""
    out, at = [], 0
    for start, stop, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


class Cover:
    """Spans of one text, asked for overlaps in logarithmic time each."""

    def __init__(self, spans: Sequence[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.furthest = list(accumulate((b for _, b in self.spans), max))

    def touches(self, start: int, stop: int) -> bool:
        """Whether some span shares a character with ``start:stop``."""
        n = bisect_left(self.starts, stop)
        return n > 0 and self.furthest[n - 1] > start
