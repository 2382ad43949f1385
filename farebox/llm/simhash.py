"""SimHash near-duplicates: fingerprints of word shingles, linked at a small Hamming distance by bit-sliced comparison.

Candidates come from the pigeonhole principle, used twice: fingerprints at distance 3 or less agree in one of four
16-bit quarters, and in one of four 12-bit parts of the other 48 bits. So 16 keys of 28 bits miss no link, and a key
holds few unrelated fingerprints even among 10^10. Within a key, fingerprints are compared in slices: bit planes lie
vertically, 64 fingerprints to a word; the distances of a fingerprint to 64 others are counted together by carry-save
additions, and words in which all 64 exceed the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.components import connected_components
from farebox.llm.tasks import own_columns, small_batches, spare_names, stored, with_python_columns, without

RADIUS = 3
# Fingerprints of a key that one comparison unit holds per side; larger keys are cut into tiles, all pairs of which meet.
TILE = 8192
_PAIRS_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 1 << 16
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Bit b is set if it is set in over half the XXH64 (seed 42) of the shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    elif words_per_shingle == 3:
        shingles = [b"%b %b %b" % x for x in zip(words, words[1:], words[2:])]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(words_per_shingle)])))
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(shingles), _HASHES_AT_ONCE):
        part = shingles[i:i + _HASHES_AT_ONCE]
        hashes = np.fromiter((digest(s, 42) for s in part), "<u8", len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(shingles), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """``df`` with ``fingerprint_bits`` (the 64 bits as a long). NULL and empty texts have fingerprint 0."""

    def make():
        return lambda texts: [np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64).view(np.int64)]

    return with_python_columns(df, [text], "fingerprint_bits long", make)


def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit v of word w of plane b is bit b of fingerprint 64 w + v."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (fingerprint ``query[i]``, word ``word[i]`` of the planes): the pairs that still hold somebody within
    the radius, and the bits of those. ``radius + 1`` is a power of two, so that a counter's overflow says "beyond"."""
    counters = [np.zeros(len(query), np.uint64) for _ in range((radius + 1).bit_length() - 1)]
    beyond, alive = np.zeros(len(query), np.uint64), np.arange(len(query))
    for bit in range(64):
        carry = planes[bit][word] ^ -((query >> np.uint64(bit)) & np.uint64(1))
        for counter in counters:
            counter ^= carry
            carry &= ~counter
        beyond |= carry
        if bit in (11, 19, 31, 47):
            stay = beyond != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not stay.all():
                alive, query, word, beyond = alive[stay], query[stay], word[stay], beyond[stay]
                counters = [c[stay] for c in counters]
    return alive, ~beyond


class _Forest:
    """Union-find over the fingerprints of a batch; ``join`` says whether a link was new."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def roots(self) -> np.ndarray:
        while not np.array_equal(self.parent, up := self.parent[self.parent]):
            self.parent = up
        return self.parent

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def spanning_links(values: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (i, j) that connect what the links at distance ``radius`` or less between ``i`` and ``low[i] <= j < high[i]`` connect.

    A forest instead of all links: at most one link less than there are fingerprints.
    """
    planes, forest, links = _planes(values), _Forest(len(values)), []
    asks = np.flatnonzero(high > low)
    spans = ((high[asks] - 1) >> 6) - (low[asks] >> 6) + 1
    ends = np.cumsum(spans)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, _PAIRS_AT_ONCE):
        flat = np.arange(begin, min(total, begin + _PAIRS_AT_ONCE))
        which = np.searchsorted(ends, flat, side="right")
        who = asks[which]
        word = (low[who] >> 6) + flat - (ends[which] - spans[which])
        alive, near = _within(planes, values[who], word, radius)
        who, word = who[alive], word[alive]
        # cut off what lies outside low..high
        start, stop = np.clip(low[who] - (word << 6), 0, 63), np.clip(high[who] - (word << 6), 1, 64)
        everything = np.uint64(0xFFFFFFFFFFFFFFFF)
        near &= (everything << start.astype(np.uint64)) & (everything >> (64 - stop).astype(np.uint64))
        some = near != 0
        who, word, near = who[some], word[some], near[some]
        if not len(who):
            continue
        lowest = np.bitwise_count((near & -near) - np.uint64(1)).astype(np.int64)
        links += [(int(i), int(j)) for i, j in zip(who, (word << 6) + lowest) if forest.join(i, j)]
        row, bit = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        i, j, roots = who[row], (word[row] << 6) + bit, forest.roots()
        open_ = roots[i] != roots[j]
        links += [(int(a), int(b)) for a, b in zip(i[open_], j[open_]) if forest.join(a, b)]
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, tile pair and tile -> links; whole groups are worked on, many small ones at a time."""

    def flush(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, pair, tile, value = rows
        new_group = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])
        group_end = np.r_[new_group[1:], len(key)]
        group = np.repeat(np.arange(len(new_group)), group_end - new_group)
        low, high = new_group[group], np.arange(len(key))
        # a pair of different tiles: only the second tile asks, and only the first is asked
        first_tile, crossed = pair >> 20, (pair >> 20) != (pair & 0xFFFFF)
        asked = np.bincount(group, weights=tile == first_tile, minlength=len(new_group)).astype(np.int64)
        high = np.where(crossed, np.where(tile == first_tile, low, low + asked[group]), high)
        links = spanning_links(value.view(np.uint64), low, high)
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(value[ends[:, 0]]), pa.array(value[ends[:, 1]])], names=["node", "to"])

    held = None
    for batch in batches:
        new = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
        if len(held[0]) >= _ROWS_AT_ONCE:
            key, pair = held[0], held[1]
            cut = np.flatnonzero((key != key[-1]) | (pair != pair[-1]))
            if len(cut):
                at = int(cut[-1]) + 1
                yield flush(tuple(x[:at] for x in held))
                held = tuple(x[at:] for x in held)
    if held is not None and len(held[0]):
        yield flush(held)


def _keys(bits: str) -> list[str]:
    """SQL of the 16 keys: table number above, then a quarter of 16 bits and a 12-bit part of the rest."""
    out = []
    for quarter in range(4):
        others = [q for q in range(4) if q != quarter]
        # the other 48 bits, in order
        rest = " | ".join(f"shiftleft(shiftrightunsigned({bits}, {16 * q}) & 65535, {16 * i})" for i, q in enumerate(others))
        for part in range(4):
            own = f"shiftrightunsigned({bits}, {16 * quarter}) & 65535"
            out.append(f"shiftleft({4 * quarter + part}L, 28) | shiftleft({own}, 12) | (shiftrightunsigned({rest}, {12 * part}) & 4095)")
    return out


def near_links(fingerprints: DataFrame) -> DataFrame:
    """``node``, ``to``: links that connect the distinct fingerprints of ``bits`` at distance 3 or less.

    Complete as to who is connected, without writing out all pairs of a group. A key with more than ``TILE``
    fingerprints is cut into tiles, each pair of which is a comparison unit of its own, so no unit grows with the data.
    """
    small_batches(fingerprints.sparkSession)
    keyed = fingerprints.select("bits", F.explode(F.array(*[F.expr(k) for k in _keys("bits")])).alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(
        "key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    placed = keyed.join(crowded, "key").withColumn("tile", F.pmod(F.xxhash64("bits"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    units = placed.select("key", "bits", "tile", other.alias("other")).select(
        "key", (F.least("tile", "other").cast("long") * (1 << 20) + F.greatest("tile", "other")).alias("pair"),
        F.col("tile").cast("long").alias("tile"), "bits")
    return units.repartition("key", "pair").sortWithinPartitions("key", "pair", "tile").mapInArrow(_compare, "node long, to long")


def near_duplicate_components(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``fingerprint_bits``, ``root`` and ``component_id`` (the smallest doc_id that links
    lead to, its own included) per document.

    Texts without words (NULL, empty) have fingerprint 0 and are linked like any other. Repeated rows give repeated
    rows. A NULL id is nobody's component id unless the component has no other. An empty table gives none.
    """
    ids = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    marked = stored(without(with_fingerprints(ids), ["text"]), "fingerprints")
    distinct = marked.groupBy(F.col("fingerprint_bits").alias("bits")).agg(F.min("doc_id").alias("least"))
    roots = connected_components(near_links(distinct.select("bits")), "node", "to")
    # `stored` keeps the comparison from being run for each use
    placed = stored(distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "least"), "roots")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("bits", "root").join(least, "root")
    return marked.join(named, F.col("fingerprint_bits") == F.col("bits")).select(
        "doc_id", "text_hash", "fingerprint_bits", "root", "component_id")


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` (same columns) with the document of the smallest id of every component of near-duplicates.

    Of rows that repeat that id and text one stays, whichever other columns they have; a NULL id comes after all others.
    Texts without words (NULL, empty) are near-duplicates of each other. An empty table gives none. Columns may have any
    name and type.
    """
    parts = near_duplicate_components(documents, doc_id, text)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k")
    id_, hash_, own, nth = spare_names(documents, 4)
    chosen = parts.groupBy("root").agg(least).select(F.col("k.doc_id").alias(id_), F.col("k.text_hash").alias(hash_))
    keyed = documents.select(*own_columns(documents), F.xxhash64(documents[f"`{text}`"]).alias(own))
    kept = keyed.join(chosen, keyed[f"`{doc_id}`"].eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_)), "left_semi")
    # equal rows in any order; the first per task is all that is shuffled
    order = F.xxhash64(F.to_json(F.struct(*own_columns(kept, documents))))
    one = F.row_number().over(Window.partitionBy(kept[f"`{doc_id}`"], own).orderBy(order))
    first = kept.select(*own_columns(kept, documents), one.alias(nth)).where(F.col(nth) == 1)
    return first.select(*own_columns(first, documents))
