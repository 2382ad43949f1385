"""Spelling variants: words that differ by one inserted, deleted or replaced letter, found with bitsets over a vocabulary.

Two words within one edit agree in their first or in their last half, so words are compared only in units that share
such a half. A unit is indexed by (position, letter): a bitset of the words with that letter there. A word is looked up
by walking through its letters once, all words of the unit at the same time: the set without an error, and the sets with
one error, whose positions are shifted by one after an insertion or deletion.

A unit with many words is cut by halving what is not yet known to be equal, first or last half again, until it is small
or one letter is left to differ, when the alphabet bounds it. Every near pair is met in exactly one unit: where both
halves agree, the unit of the last half leaves the pair to that of the first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.tasks import small_batches, stored

# Words of a unit that are compared at once; larger units are halved.
UNIT = 4096
NO_LIMIT = 2**31 - 1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_runs(text: Column, at_least: int = 1) -> Column:
    """Maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of this length or more, A-Z lower-cased; NULL has none."""
    found = F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]{%d,}" % at_least), F.lit(0))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda w: F.translate(w, _UPPER, _LOWER))


class PositionIndex:
    """Words of two neighbouring lengths, ``shorter`` and one more, as bitsets: bit i stands for word i."""

    def __init__(self, words: Sequence[str], shorter: int):
        self.shorter, self.everything = shorter, (1 << len(words)) - 1
        self.at: list[dict[str, int]] = [{} for _ in range(shorter + 2)]
        self.longer_ones = 0
        for i, word in enumerate(words):
            bit = 1 << i
            if len(word) > shorter:
                self.longer_ones |= bit
            for letters, letter in zip(self.at, word):
                letters[letter] = letters.get(letter, 0) | bit

    def near(self, word: str, apart_before: int = NO_LIMIT) -> int:
        """Words at exactly one edit, without those that share the first ``apart_before`` letters.

        A word of the greater length is compared with the shorter ones only: others of its own length belong to the
        unit in which it is the shorter one.
        """
        at, zero, shared = self.at, self.everything, 0
        if len(word) > self.shorter:
            lacking = 0  # one letter of the word was left out: the others' letters stand one place earlier
            for i, letter in enumerate(word):
                lacking = (lacking & at[i - 1].get(letter, 0)) | zero
                zero &= at[i].get(letter, 0)
                if i + 1 == apart_before:
                    shared = zero
            found = lacking & ~self.longer_ones
        else:
            replaced = more = 0  # one letter differs; one letter came in between, so that others stand one place later
            for i, letter in enumerate(word):
                here = zero & at[i].get(letter, 0)
                more = (more | zero) & at[i + 1].get(letter, 0)
                replaced = (replaced & at[i].get(letter, 0)) | (zero ^ here)
                zero = here
                if i + 1 == apart_before:
                    shared = zero
            found = (replaced & ~self.longer_ones) | ((more | zero) & self.longer_ones)
        return found & ~shared


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit, falling n and word -> how many near words a word has in its unit, and the first of them."""

    def rows():
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    out: list[tuple] = []
    names = ["word", "n_near", "best", "best_n"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]

    def flush():
        columns = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for _, group in groupby(rows(), key=lambda r: r[0]):
        unit = list(group)
        if len(unit) < 2:
            continue
        words, shorter, apart_before = [r[1] for r in unit], unit[0][3], unit[0][4]
        index = PositionIndex(words, shorter)
        for word in words:
            near = index.near(word, apart_before)
            if near:
                first = (near & -near).bit_length() - 1  # the unit's words are in falling order of n
                out.append((word, near.bit_count(), words[first], unit[first][2]))
        if len(out) >= 10_000:
            yield flush()
    yield flush()


def _halved(units: DataFrame) -> DataFrame:
    """Each row twice: once for the first half of what is not yet known to be equal, once for the last half."""
    half = F.floor((F.col("shorter") - F.col("front") - F.col("back")) / 2).cast("int")
    front = F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back"), F.col("apart_before").alias("apart_before"))
    back = F.struct(
        F.col("front").alias("front"), (F.col("back") + half).alias("back"),
        F.least("apart_before", F.col("front") + half).alias("apart_before"))
    # where all words of a unit share the letters that its pairs must not share, it has no pair
    return units.select("word", "n", "shorter", F.explode(F.array(front, back)).alias("part")).select(
        "word", "n", "shorter", "part.*").where("front < apart_before")


def _with_key(units: DataFrame) -> DataFrame:
    ends = F.concat(F.left("word", F.col("front")), F.lit("|"), F.right("word", F.col("back")))
    return units.withColumn("unit", F.concat_ws(",", "shorter", "front", "back", "apart_before", ends))


def near_words(words: DataFrame, unit_size: int = UNIT) -> DataFrame:
    """``word``, ``n_near`` (number of words at one edit), ``best_n`` and ``best`` (the most frequent of them, the first
    in code-point order of equals); words without any are left out.

    ``words`` has distinct ``word`` and their ``n``. All pairs are counted, whatever the number of words that share
    letters: units of more than ``unit_size`` words are halved again and again, rows of others stay as they are.
    """
    small_batches(words.sparkSession)
    length = F.char_length("word")
    # a word is the shorter one (or of equal length) in a unit of its length, and the longer one in the unit below
    start = words.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("shorter"), F.lit(0).alias("front"), F.lit(0).alias("back"),
        F.lit(NO_LIMIT).alias("apart_before")).where("shorter > 0")
    units = _with_key(_halved(start))
    while True:
        crowded = stored(units.groupBy("unit").count().where(
            (F.col("count") > unit_size)).select("unit"), "crowded")
        # what is left of the shorter word, taken from the unit's own name
        part = [F.split("unit", ",")[i].cast("int") for i in range(3)]
        crowded = crowded.where(part[0] - part[1] - part[2] >= 2)
        if crowded.isEmpty():
            break
        large = units.join(crowded, "unit", "left_semi")
        units = stored(units.join(crowded, "unit", "left_anti").unionByName(_with_key(_halved(large))), "units")
    found = units.select("unit", "word", "n", "shorter", "apart_before").repartition("unit").sortWithinPartitions(
        "unit", F.desc("n"), "word").mapInArrow(_compare, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.n")).alias("best_n"))


def variant_groups(words: DataFrame, ratio: int = 10, unit_size: int = UNIT) -> DataFrame:
    """``word``, ``n``, ``form``, ``form_n``, ``root``, ``n_near`` for distinct ``word`` with their occurrences ``n``.

    ``form``: the most frequent word at one edit, if it is at least ``ratio`` times as frequent, else NULL (ties: the
    first in code-point order); ``root``: where following forms ends, the word itself without a form. Forms grow by
    ``ratio`` with every step, so there are no circles and the last is reached in log(n) steps.

    NULL and empty words are left out; of a word given repeatedly the occurrences are added. An empty table gives none.
    Words may be of any length and any letters; other columns are not looked at.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its variant")
    distinct = stored(words.where("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    near = near_words(distinct, unit_size)
    is_form = F.col("best_n") >= ratio * F.col("n")
    named = stored(distinct.join(near, "word", "left").select(
        "word", "n", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "forms")
    links = named.where("form is not null").select("word", F.col("form").alias("root"))
    # each round doubles the steps taken; those that have reached a root meet no further link
    while True:
        further = links.select(F.col("word").alias("mid"), F.col("root").alias("beyond"))
        stepped = stored(links.join(further, F.col("root") == F.col("mid"), "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        links = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            break
    return named.join(links, "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "n", "form", "form_n", "root", "n_near")
