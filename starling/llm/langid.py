"""Operator 3: language ID by compression with per-language dictionaries.

For every language a raw-content zstandard dictionary is filled with text of
that language. A text belongs to the language whose dictionary compresses it
to the fewest bytes. If the runner-up is nearly as small, the margin is narrow
and the text is rejected. Compressed are the letters only, in lower case, other
characters as one space, so that capitals, digits and marks do not hide the
language. A line that the sample holds again and again (notices, near copies)
stands once in each language's dictionary that has it.

Training takes a bounded sample: at most ``per_language`` distinct texts a
language, however many copies each has, those of smallest text hash, of which ``dictionary_bytes`` fill the dictionary.
Every label that
training rows have is learned. Only the text and the label of training rows are used. Classification covers
every row and every whole text, in one pass without a shuffle.

Sizes are whole bytes, so below ``SHORT`` bytes a narrow margin says nothing:
such texts are kept, with a low score.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and rejected; a tie goes to the language with more training rows; repeated rows
get the same answer; with no labelled row at all everything is ``und``; further
columns are ignored. Long texts are compressed whole, in blocks of
``BLOCK_BYTES`` that each start from the dictionary: in one long stream a text's
own repetition would hide it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from starling.llm.common import SLICE_ROWS, give_back, let_go_of_other_stages

#: Texts of a language that may be sampled for its dictionary.
PER_LANGUAGE = 256
#: Bytes of text in a dictionary, and in all of them together: with more labels
#: than fit, every label has an equal, smaller share (1 KiB at least).
DICTIONARY_BYTES, ALL_BYTES = 112 * 1024, 128 * 112 * 1024
#: Bytes of a text that are compressed at a time.
BLOCK_BYTES = 4096
#: Compression level.
LEVEL = 5
#: A margin below this share of the smallest size is narrow.
NARROW = 0.005
#: Bytes of normalised text below which no text is rejected for its margin.
SHORT = 128

NO_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    """The letters in lower case, everything between them as one space."""
    return NO_LETTERS.sub(" ", text.lower()).strip()


def sample_texts(labelled: DataFrame, label: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """(label, text, h, n) of at most ``per_language`` distinct texts a label,
    those of the smallest text hash; n is the label's number of rows. A first
    count per label, of distinct texts by their sketch, sets a hash limit that
    keeps a few times as many, so a label with a third of all rows is thinned in
    the scan; copies are merged before the rank."""
    return _sample(labelled, label, per_language)[0]


def _sample(labelled: DataFrame, label: str, per_language: int) -> tuple[DataFrame, int]:
    """``sample_texts`` and the number of labels."""
    rows = labelled.where(F.col(label).isNotNull() & (F.length("text") > 0)).select(F.col(label).cast("string").alias("label"), "text")
    h = F.xxhash64("text")
    counts = {r["label"]: r for r in rows.groupBy("label").agg(
        F.count("*").alias("n"), F.approx_count_distinct(h, 0.02).alias("texts")).collect()}
    if not counts:
        return rows.selectExpr("label", "text", "0L AS h", "0L AS n").limit(0), 0
    grid = 1 << 30
    limits = F.create_map(*[x for k, r in counts.items() for x in (
        F.lit(k), F.lit(min(grid, math.ceil(grid * 4.0 * per_language / max(r["texts"], 1)))))])
    sizes = F.create_map(*[x for k, r in counts.items() for x in (F.lit(k), F.lit(r["n"]))])
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "text"))
    return (rows.withColumn("h", h).where(F.pmod(F.col("h"), F.lit(grid)) < limits[F.col("label")]).distinct()
            .withColumn("rank", rank).where(F.col("rank") <= per_language)
            .select("label", "text", "h", sizes[F.col("label")].alias("n"))), len(counts)


def build_dictionaries(sample: list[tuple[str, str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary's content per label, in the order of the sample. A line that
    a label holds several times stands in it once. The texts share ``size`` in
    turns of 1 KiB, so that one long text does not fill it alone."""
    turn, by_label, seen = 1024, {}, {}
    for label, text in sample:
        met, own = seen.setdefault(label, set()), []
        for x in map(normalise, text.split("\n")):
            if x and x not in met:
                met.add(x)
                own.append(x)
        by_label.setdefault(label, []).append(" ".join(own).encode("utf-8"))
    out = {}
    for label, texts in by_label.items():
        parts, total, at = [], 0, 0
        while total < size and any(at < len(t) for t in texts):
            for t in texts:
                piece = t[at : at + min(turn, size - total)]
                parts.append(piece)
                total += len(piece)
            at += turn
        out[label] = b" ".join(p for p in parts if p)
    return out


def train(labelled: DataFrame, label: str = "lang", per_language: int = PER_LANGUAGE,
          dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries of all labels, the one with most rows first. A task fills a
    label's dictionary from its at most ``per_language`` distinct texts; the
    driver gets the dictionaries only, cut to their share of ALL_BYTES."""

    def fill(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("text", "ascending")])
        label, n = t["label"][0].as_py(), t["n"][0].as_py()
        content = build_dictionaries([(label, x) for x in t["text"].to_pylist()], size)[label]
        give_back()
        return pa.table({"label": pa.array([label], pa.string()), "n": pa.array([n], pa.int64()),
                         "content": pa.array([content], pa.binary())})

    sample, labels = _sample(labelled, label, per_language)
    size = min(dictionary_bytes, max(1024, ALL_BYTES // max(labels, 1)))
    rows = sample.groupBy("label").applyInArrow(fill, "label string, n long, content binary").collect()
    return {r["label"]: bytes(r["content"]) for r in sorted(rows, key=lambda r: (-r["n"], r["label"]))}


class Classifier:
    """Compressors with one prepared dictionary per language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.labels, self.compressors = list(dictionaries), []
        for content in dictionaries.values():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected); the margin is the runner-up's
        excess over the smallest size, as a share of it."""
        letters = normalise(text) if text and self.labels else ""
        if not any(map(str.isalpha, letters)):  # digits such as a half or a circled one are no letters
            return "und", 0.0, 0.0, True
        data = letters.encode("utf-8")
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in enumerate(self.compressors))
        best = sizes[0]
        margin = sizes[1][0] / best[0] - 1.0 if len(sizes) > 1 else 1.0
        return self.labels[best[1]], 1.0 - 0.5 * math.exp(-20.0 * margin), margin, margin < NARROW and len(data) >= SHORT


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str | Column] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred, score, margin, rejected.

    The dictionaries (ALL_BYTES together, or 1 KiB a label if that is more)
    go to the executors as one broadcast variable.
    """
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)
    found = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                        StructField("margin", DoubleType()), StructField("rejected", BooleanType())])

    @F.arrow_udf(found)
    def classify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go_of_other_stages()
        model = Classifier(held.value)
        types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        for batch in texts:
            rows = [model.classify(t) for at in range(0, len(batch), SLICE_ROWS) for t in batch.slice(at, SLICE_ROWS).to_pylist()]
            columns = [*zip(*rows)] or [()] * 4
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=found.fieldNames())
            del rows, columns
            give_back()

    # only the texts go through Python and only the results come back; a
    # condition on them must not make the optimizer classify twice
    kept = docs.select(*keep).columns
    out = docs.select(*keep, classify.asNondeterministic()("text").alias("_found"))
    return out.select(*(F.col(f"`{c}`") for c in kept), *(F.col("_found").getField(c).alias(c) for c in found.fieldNames()))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null: the fold of '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds
