"""Benchmark decontamination with DataFrame functions alone: a broadcast hash set of test n-grams, then exact checks.

A window is ``window`` consecutive words of a benchmark item (or all words of a shorter item). Instead of hashing every
window of a document, its word positions 0, s, 2s, … with s = half a window are looked at: whichever place a window
occurs at, the ``window - s + 1`` words from the first such position inside it lie in it completely. So one short n-gram
per s words is looked up in the hash set, nothing is missed, and the few hits are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.tasks import spare_names, without

# Hashes a broadcast may hold (8 bytes each, about 200 MB with the hash table); a larger set is joined by shuffle.
MOST_BROADCAST_HASHES = 8_000_000

_NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z; NULL has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _NOT_A_WORD), lambda w: w != "")


def _step(length: int) -> int:
    """Distance of the positions looked at for windows of this length."""
    return max(1, length // 2)


def _gram_hash(words: str, start: Column, length: int) -> Column:
    """Hash of the n-gram that stands for windows of this length; the length is part of it."""
    return F.xxhash64(F.lit(length), *[F.get(F.col(words), start + i) for i in range(length - _step(length) + 1)])


def item_windows(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """Distinct windows: ``window_text`` (words joined by a space), ``length``, and the sorted ids of items with it.

    An item without id counts under the empty id; an item without words has no window.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("words")
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = items.select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    return (
        starts.select("item", "length", F.slice("words", F.col("at"), F.col("length")).alias("words"))
        .groupBy(F.array_join("words", " ").alias("window_text"), "length")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``n_words``, ``spans`` (sorted word ranges start/stop of the
    windows found), ``items`` (sorted texts of the item ids), ``n_hit`` (words inside any span).

    A NULL or empty text has no words and no spans. Repeated documents give as many equal rows; documents that share
    an id but not the text are kept apart by ``text_hash``. Ids may be NULL. Documents and benchmark may be empty;
    other columns are not looked at. Words count wherever they stand, so a text's length has no limit.
    """
    spark = documents.sparkSession
    windows = item_windows(benchmark, window, item_id, item_text)
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most `window` numbers
    code = window + 1  # position and length travel as one number: position * code + length

    split = F.split("window_text", " ")
    grams = None
    for n in lengths:
        per_offset = F.explode(F.sequence(F.lit(0), F.lit(_step(n) - 1)))
        of_length = windows.where(F.col("length") == n).select(split.alias("words"), per_offset.alias("offset"))
        hashes = of_length.select(_gram_hash("words", F.col("offset"), n).alias("known"))
        grams = hashes if grams is None else grams.union(hashes)
    grams = spark.createDataFrame([], "known long") if grams is None else grams.distinct()

    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words_of(F.col(text)).alias("words")
    ).withColumn("n_words", F.size("words"))
    places = [
        F.when(F.col("n_words") >= n, F.sequence(F.lit(n), F.lit(n) + (F.col("n_words") - n + _step(n)) * code, F.lit(_step(n) * code)))
        .otherwise(F.array().cast("array<int>")) for n in lengths
    ]
    # -1 stands for the document itself, so that documents without a hit stay
    looked_at = docs.select("*", F.explode(F.concat(F.array(F.lit(-1)), *places)).alias("place"))
    at, length = F.expr(f"place div {code}").cast("int"), F.col("place") % code
    hashed = F.lit(None).cast("long")
    for n in lengths:
        hashed = F.when(length == n, _gram_hash("words", at, n)).otherwise(hashed)
    # the windows that an n-gram may belong to begin at first .. last; only their words travel on, not the document's
    first = F.lit(0)
    for n in lengths:
        first = F.when(length == n, F.greatest(at - (_step(n) - 1), F.lit(0))).otherwise(first)
    # the document's own row gets a hash of its own, so that it is dealt out like any other should the join shuffle
    itself = F.col("place") < 0
    own = F.xxhash64(F.lit("document"), "doc_id", "text_hash")
    looked_at = looked_at.select(
        "doc_id", "text_hash", "n_words", "place", F.when(itself, own).otherwise(hashed).alias("gram"),
        F.when(~itself, F.slice("words", first + 1, at + length - first)).alias("near"))
    small = grams.limit(MOST_BROADCAST_HASHES + 1).count() <= MOST_BROADCAST_HASHES
    known = (F.col("gram") == F.col("known")) & ~itself
    hit = looked_at.join(F.broadcast(grams) if small else grams, known, "left").where(itself | F.col("known").isNotNull())

    last = F.least(at, F.col("n_words") - length)
    starts = F.when(F.col("known").isNotNull() & (last >= first), F.sequence(first, last))
    # no window's words look like the stand-in for a document's own row
    found = F.when(itself, F.concat(F.lit("\0"), F.hex("gram"))).otherwise(
        F.array_join(F.slice("near", F.col("start") - first + 1, length), " "))
    candidates = hit.select("*", F.explode_outer(starts).alias("start")).select(
        "doc_id", "text_hash", "n_words", itself.alias("itself"), length.alias("length"), "start", found.alias("found"))
    checked = candidates.join(
        windows.withColumnRenamed("length", "window_length"),
        (F.col("found") == F.col("window_text")) & (F.col("length") == F.col("window_length")) & ~F.col("itself"), "left",
    ).where(F.col("itself") | F.col("window_text").isNotNull())
    span = F.when(F.col("window_text").isNotNull(), F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("stop")))
    found = checked.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("itself")).alias("copies"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    nothing = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))
    covered = F.aggregate("spans", nothing, lambda a, s: F.struct(
        (a.covered + F.greatest(F.lit(0), s.stop - F.greatest(s.start, a.upto))).alias("covered"),
        F.greatest(a.upto, s.stop).alias("upto")), lambda a: a.covered)
    return found.withColumn("n_hit", covered).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")


def _contaminated(documents: DataFrame, benchmark: DataFrame, window: int, doc_id: str, text: str, names: list[str]) -> DataFrame:
    """Id, text hash, spans and number of words hit, under these names, of each different document with a hit."""
    found = find_contamination(documents, benchmark, window, doc_id, text).where("n_hit > 0")
    return found.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "text_hash", "spans", "n_hit"), names)]).dropDuplicates(names[:2])


def remove_contaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``documents`` (same columns, which may have any name) without those in which a benchmark window occurs.

    A NULL or empty text holds no window and stays. Repeated rows stay or go together; rows that share an id but not the
    text are judged each by its own. An empty table or benchmark is no special case.
    """
    names = spare_names(documents, 4)
    bad = _contaminated(documents, benchmark, window, doc_id, text, names).select(*names[:2])
    same = documents[f"`{doc_id}`"].eqNullSafe(F.col(names[0])) & (F.xxhash64(documents[f"`{text}`"]) == F.col(names[1]))
    return documents.join(bad, same, "left_anti")


_PIECE = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"


def remove_spans(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``documents`` with the words of benchmark windows cut out of the text and a column ``n_removed`` of words.

    Runs of other characters stay as they are; a text without hits is unchanged, NULL stays NULL, repeated rows are changed
    alike. Columns may have any name; one called ``n_removed`` is replaced. Only texts with hits are taken apart, each
    different one once, word by word, so a long text costs in proportion to its length.
    """
    id_, hash_, spans, hits, piece, cut = spare_names(documents, 6)
    rest = without(documents, ["n_removed"])
    bad = _contaminated(documents, benchmark, window, doc_id, text, [id_, hash_, spans, hits])
    same = documents[f"`{doc_id}`"].eqNullSafe(F.col(id_)) & (F.xxhash64(documents[f"`{text}`"]) == F.col(hash_))
    texts = documents.join(bad, same).select(id_, hash_, spans, documents[f"`{text}`"].alias(piece)).dropDuplicates([id_, hash_])
    key = F.struct(F.col(id_).alias("id"), F.col(hash_).alias("hash"))
    pieces = texts.select(key.alias("key"), F.posexplode(F.regexp_extract_all(F.col(piece), F.lit(_PIECE), F.lit(1))).alias("at", "piece"))
    # words and runs of other characters alternate: the n-th word is piece 2 n, or 2 n + 1 where the text begins otherwise
    starts = F.when(texts[piece].rlike("^" + _PIECE.split("|")[1].rstrip(")")), 1).otherwise(0)
    # looked up before the spans are taken apart, not in the text again for each of them
    begun = texts.select(key.alias("key"), starts.alias("first"), F.col(spans).alias("spans"))
    words = begun.select("key", "first", F.explode("spans").alias("span")).select(
        "key", "first", F.explode(F.sequence(F.col("span.start"), F.col("span.stop") - 1)).alias("nth")).select(
        "key", (F.col("nth") * 2 + F.col("first")).alias("at")).distinct()
    left = pieces.join(words, ["key", "at"], "left_anti").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    done = bad.select(id_, hash_, hits, key.alias("key")).join(left, "key", "left").select(
        id_, hash_, hits, F.coalesce(F.array_join(F.col("pieces.piece"), ""), F.lit("")).alias(cut))
    joined = documents.join(done, same, "left")
    columns = [
        (F.coalesce(F.col(cut), joined[f"`{c}`"]).alias(c) if c == text else joined[f"`{c}`"]) for c in rest.columns]
    return joined.select(*columns, F.coalesce(F.col(hits), F.lit(0)).cast("long").alias("n_removed"))
