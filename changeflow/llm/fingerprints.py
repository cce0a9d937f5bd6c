"""Homomorphic multiset fingerprints of documents, in DataFrame functions alone.

A text is a multiset of paragraphs, cut at line ends and after the end of a sentence. A
paragraph is hashed to a wide vector of LANES signed bytes; the fingerprint is the sum
of the vectors modulo MODULUS. So it does not depend on the order of paragraphs, two
fingerprints add up to that of both texts together, and paragraphs can be inserted into
or deleted from a fingerprint without the rest of the text.

The lanes of a difference of two fingerprints are sums over the paragraphs that the texts
do not share, with independent signs: their mean square estimates how many these are.
``likeness`` is one less that number by the paragraphs (by squared multiplicity) of both.

A null or empty text has no paragraphs and a fingerprint of zeros; two such are alike.
Null ids rank below all others. Rows of equal id are ordered by descending text. An empty
table gives an empty result; a single row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64
MODULUS = 1 << 24
HEX_DIGITS = 6
PARAGRAPH_END = r"\n|(?<=[.!?])\s+"
#: Key ranges for each shuffle partition, so that hashing them out stays even.
RANGES_PER_PARTITION = 4


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END)


def lanes(paragraph: str) -> list[Column]:
    """The vector of a paragraph: signed bytes, zeros for an empty one.

    Two 64-bit hashes of the text, from different seeds, are widened to all lanes.
    """
    seeds = F.xxhash64(paragraph), F.xxhash64(F.lit("paragraph"), paragraph)
    counted = (F.col(paragraph) != "").cast("long")
    words = [F.xxhash64(*seeds, F.lit(i)) for i in range(LANES // 8)]
    return [
        counted * (F.shiftrightunsigned(w, 8 * j).bitwiseAND(F.lit(0xFF)) - F.lit(128))
        for w in words
        for j in range(8)
    ]


def summed(exploded: DataFrame, *keys: str, paragraph: str = "_paragraph") -> DataFrame:
    """Fingerprints (``vector``) of the rows' paragraphs by key."""
    sums = [F.sum(lane).alias(f"_lane{i}") for i, lane in enumerate(lanes(paragraph))]
    vector = F.array(*(F.pmod(F.col(f"_lane{i}"), F.lit(MODULUS)) for i in range(LANES)))
    return exploded.groupBy(*keys).agg(*sums).select(*keys, vector.alias("vector"))


def fingerprints(frame: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Fingerprints of texts by key; texts of one key are taken together."""
    exploded = frame.select(*keys, F.explode(paragraphs(F.col(text))).alias("_paragraph"))
    return summed(exploded, *keys)


def inserted(into: Column, added: Column) -> Column:
    return F.zip_with(into, added, lambda a, b: F.pmod(a + b, F.lit(MODULUS)))


def deleted(from_: Column, taken: Column) -> Column:
    return F.zip_with(from_, taken, lambda a, b: F.pmod(a - b, F.lit(MODULUS)))


def shown(vector: Column) -> Column:
    """The fingerprint as a string of hexadecimal digits."""
    digits = F.transform(vector, lambda lane: F.lpad(F.hex(lane), HEX_DIGITS, "0"))
    return F.concat_ws("", digits)


def _length(vector: Column) -> Column:
    """The squared length, lanes taken as numbers around zero."""
    half = MODULUS // 2
    around = F.transform(vector, lambda x: (F.pmod(x + half, F.lit(MODULUS)) - half).cast("double"))
    return F.aggregate(around, F.lit(0.0), lambda total, x: total + x * x)


def likeness(one: Column, other: Column) -> Column:
    """How much of two texts is the same, from 0 to 1; 1 for equal fingerprints."""
    both = _length(one) + _length(other)
    share = F.lit(1.0) - _length(deleted(one, other)) / both
    return F.when(both == 0, 1.0).otherwise(F.greatest(F.lit(0.0), share))


def _range_bounds(keys: DataFrame, ranges: int) -> list[int]:
    """Keys that cut all into ranges of about equal size; each is one of the keys."""
    shares = F.lit([i / ranges for i in range(1, ranges)])
    found = keys.agg(F.percentile_approx("_key", shares, max(10_000, 10 * ranges))).first()[0]
    return sorted(set(found or []))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds lie below a key, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = F.lit([1 << b for b in reversed(range(len(bounds).bit_length()))])
    held = F.lit(bounds)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.try_element_at(held, at + step) < key, F.lit(False)), at + step
        ).otherwise(at),
    )


def beside_next(documents: DataFrame, ranges: int) -> DataFrame:
    """Documents in descending id order, each beside the text that follows it.

    Ids are cut into ranges; the first document of each range is also put at the end of
    the range before it, and the first of all at the end of the last. So the texts are
    shuffled once, and no task needs more than its ranges. Rows: ``_range``, ``_row`` (in
    the order of the range), ``_guest`` (not 0 for rows put at an end), ``doc_id``,
    ``_text`` and ``_next``.
    """
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), lowest).alias("_key"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    bounds = _range_bounds(rows.select("_key"), ranges)
    highest = rows.agg(F.max("_key")).first()[0]
    ranged = rows.withColumn("_own", _range_of(F.col("_key"), bounds))
    above = F.try_element_at(F.lit(bounds or [0]), F.col("_own") + 1)
    places = F.array_compact(
        F.array(
            F.struct(F.col("_own").alias("range"), F.lit(0).alias("guest")),
            F.when(
                F.lit(bool(bounds)) & (above == F.col("_key")),
                F.struct((F.col("_own") + 1).alias("range"), F.lit(1).alias("guest")),
            ),
            F.when(
                F.col("_key") == F.lit(highest),
                F.struct(F.lit(0).alias("range"), F.lit(2).alias("guest")),
            ),
        )
    )
    placed = ranged.select("doc_id", "_key", "_text", F.explode(places).alias("_place")).select(
        F.col("_place.range").alias("_range"), F.col("_place.guest").alias("_guest"), "doc_id",
        "_key", "_text",
    )
    order = Window.partitionBy("_range").orderBy("_guest", F.desc("_key"), F.desc("_text"))
    return placed.select(
        "_range",
        F.row_number().over(order).alias("_row"),
        "_guest",
        "doc_id",
        "_text",
        F.lead("_text").over(order).alias("_next"),
    )


def with_edits(documents: DataFrame, ranges: int) -> DataFrame:
    """Fingerprints of every document and of its text with the last third replaced.

    The last third of the characters gives way to as many from the start of the next
    document, in descending id order, the first following the last.
    """
    n_chars = F.length("_text")
    third = F.floor(n_chars / 3).cast("int")
    edited = F.concat(
        F.left("_text", n_chars - third), F.left(F.coalesce("_next", F.lit("")), third)
    )
    texts = beside_next(documents, ranges).select(
        "_range", "_row", "_guest", "doc_id", n_chars.cast("long").alias("n_chars"), "_text",
        edited.alias("_edited"),
    )
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("_text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text")),
    )
    keys = ["_range", "_row", "_guest", "doc_id", "n_chars", "edited_sha256"]
    digest = F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256")
    both = texts.select(*keys[:-1], digest, F.explode(kinds).alias("_kind"))
    exploded = both.select(
        *keys,
        F.col("_kind.kind").alias("_edit"),
        F.explode(paragraphs(F.col("_kind.text"))).alias("_paragraph"),
    )
    vectors = summed(exploded, *keys, "_edit")
    # a document's own row is followed by its edited text's, then by the next document's
    follows = Window.partitionBy("_range").orderBy("_row", "_edit")
    return (
        vectors.withColumn("_edited", F.lead("vector", 1).over(follows))
        .withColumn("_next", F.lead("vector", 2).over(follows))
        .where((F.col("_edit") == 0) & (F.col("_guest") == 0))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            shown(F.col("vector")).alias("fingerprint"),
            shown(F.col("_edited")).alias("edited_fingerprint"),
            likeness(F.col("vector"), F.col("_edited")).alias("near_edited"),
            likeness(F.col("vector"), F.col("_next")).alias("near_next"),
        )
    )
