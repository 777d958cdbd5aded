"""Operator 5: document fingerprints by one-permutation MinHash, DataFrame
functions only.

A text's word shingles are hashed once. The top bits of a hash choose one of
``BINS`` bins; a bin keeps its smallest hash. An empty bin takes the value of a
non-empty one that a hash of (bin, candidate) chooses, which is optimal
densification: every non-empty bin is equally likely, and two texts with the
same non-empty bins choose alike. Stored are the low-order 8 bits of each bin,
as hex. Bins agree by chance with probability 1/256; the likeness of two
fingerprints corrects for that: (share of equal bins - 1/256) / (1 - 1/256).

Words are runs without white space, lower-cased; with fewer words than a
shingle has, the whole sequence is one shingle.

``with_next`` gives each document the next one by doc_id. Ids are cut into
ranges of about equal numbers of rows at approximate quantiles; a range also
gets a copy of the first row of the next one, so one shuffle of the texts and a
window within each range suffice.

Defined cases: a null text is empty; a text without words has an empty
fingerprint, whose likeness is 1 to another empty one and 0 to any other; a
null doc_id comes first; rows with the same doc_id are ordered by their text; a
single document follows itself; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins, a power of two, and words of a shingle.
BINS, SHINGLE = 128, 5
#: Rows of a range of ids, and the fewest and most ranges.
RANGE_ROWS, MIN_RANGES, MAX_RANGES = 20_000, 96, 1 << 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    """Hashes of the words, in order."""
    words = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hash of each run of ``size`` words; of all of them if there are fewer."""
    def runs(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.slice(w, F.lit(1), n - (size - 1)),
                           lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, size))))
        return F.when(n >= size, each).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return let(words, runs)


def bin_minima(shingles: Column, bins: int = BINS) -> Column:
    """Smallest hash of each non-empty bin, in the order of the bins."""
    shift = 64 - int(math.log2(bins))
    return let(F.sort_array(shingles), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift))))


def densified(minima: Column, bins: int = BINS) -> Column:
    """Low-order bits (-128 to 127) of all bins; no bins for no minima."""
    shift = 64 - int(math.log2(bins))
    low = lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("tinyint")

    def fill(m: Column) -> Column:
        def filled(own: Column) -> Column:
            donor = lambda k: F.array_min(F.transform(m, lambda x: F.struct(
                F.xxhash64(k, F.shiftright(x, shift)).alias("h"), x.alias("x"))))["x"]
            return F.transform(F.sequence(F.lit(-bins // 2), F.lit(bins // 2 - 1)), lambda k: low(let(
                F.array_position(own, k), lambda p: F.when(p > 0, F.get(m, (p - 1).cast("int"))).otherwise(donor(k)))))

        every = let(F.transform(m, lambda x: F.shiftright(x, shift).cast("int")), filled)
        return (F.when(F.size(m) == bins, F.transform(m, low)).when(F.size(m) > 0, every)
                .otherwise(F.array().cast("array<tinyint>")))
    return let(minima, fill)


def fingerprint(text: Column, size: int = SHINGLE, bins: int = BINS) -> Column:
    """The packed bins of a text (array of tinyint; empty without words)."""
    return densified(bin_minima(shingle_hashes(word_hashes(text), size), bins), bins)


def as_hex(packed: Column) -> Column:
    """The fingerprint as a string, two digits a bin."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x.cast("long") + 128), 2, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, corrected for chance."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    corrected = (equal - 1.0 / 256) / (1 - 1.0 / 256)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), corrected)))


def range_of(key: Column, bounds: list[int]) -> tuple[Column, Column]:
    """(number of bounds at or below the key, whether the key is a bound), by
    a search in two levels of the square root of the number of bounds."""
    if not bounds:
        return F.lit(0), F.lit(False)
    step = math.isqrt(len(bounds) - 1) + 1
    parts = F.lit([bounds[i : i + step] for i in range(0, len(bounds), step)])
    coarse = F.size(F.filter(F.lit(bounds[::step]), lambda b: b <= key))
    fine = F.filter(F.get(parts, coarse - 1), lambda b: b <= key)
    n = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(fine))
    return n, F.when(coarse == 0, False).otherwise(F.element_at(fine, -1) == key)


def with_next(docs: DataFrame, key: str, text: str, carried: list[str]) -> DataFrame:
    """``docs`` with next_<c> for each of ``carried``: the value in the row that
    follows by (key, text); the first row follows the last one. ``key`` is a
    long without nulls."""
    size = docs.agg(F.count("*").alias("n"), F.min(key).alias("low")).first()
    if not size["n"]:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in carried))
    ranges = min(max(MIN_RANGES, size["n"] // RANGE_ROWS), MAX_RANGES)
    cuts = docs.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], max(10_000, 4 * ranges))).first()[0]
    bounds = sorted({c for c in cuts if c > size["low"]})
    n, first = range_of(F.col(key), bounds)
    # (range, copy): 0 the row itself, 1 a copy for the range before, 2 a copy behind the last range
    places = (F.when(F.col(key) == size["low"], F.array(F.struct(n, F.lit(0)), F.struct(F.lit(len(bounds)), F.lit(2))))
              .when(first, F.array(F.struct(n, F.lit(0)), F.struct(n - 1, F.lit(1))))
              .otherwise(F.array(F.struct(n, F.lit(0)))))
    places = places.cast("array<struct<part:int,copy:int>>")
    w = Window.partitionBy("_place.part").orderBy(F.col("_place.copy") == 2, key, text, "_place.copy")
    return (docs.withColumn("_place", F.explode(places))
            .select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in carried))
            .where(F.col("_place.copy") == 0).drop("_place"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has its last
    floor(n_chars / 2) characters replaced by the first as many of the next
    document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.length("text").alias("n"),
                       fingerprint(F.col("text")).alias("packed"))
    rows = with_next(rows, "key", "text", ["text", "packed"])
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n", "packed", "next_packed", edited.alias("edited"))
    rows = rows.select("doc_id", "n", "packed", "next_packed", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("edited")).alias("edited_packed"))
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", as_hex(F.col("packed")).alias("fingerprint"),
        as_hex(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"))
