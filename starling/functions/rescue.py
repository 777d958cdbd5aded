"""Rescued data (S7): what a fixed schema would drop, kept in a VARIANT column.

Two things get lost between a change file and silver: columns that silver does
not know, and values that its types cannot hold (a price of "n/a" becomes
NULL). Both are collected in one object per row, ``_rescued``:

* a column beyond the required ones under its own name, as its text;
* a value that was not empty but whose typed column came out NULL, under the
  name of its source column, as its text.

Rows without either have NULL there. The object is built and stored as VARIANT,
so that it can be queried by path and needs no schema of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

RESCUED = "_rescued"


def as_variant(entries: Column) -> Column:
    """A map of texts as a VARIANT object without its null values; NULL if
    nothing is left."""
    kept = F.map_filter(entries, lambda _, v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.parse_json(F.to_json(kept)))


def rescue_columns(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """The required columns, and all others as one VARIANT."""
    known = {c.lower() for c in required}
    extra = [c for c in rows.columns if c.lower() not in known]
    pairs = [x for c in extra for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    found = as_variant(F.create_map(*pairs)) if pairs else F.lit(None).cast("variant")
    return rows.select(*required, found.alias(RESCUED))


def merge_rescued(rescued: Column, values: Mapping[str, Column]) -> Column:
    """``rescued`` with further entries; a null value adds none."""
    pairs = [x for name, v in values.items() for x in (F.lit(name), v)]
    entries = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    before = F.coalesce(F.from_json(F.to_json(rescued), "map<string,string>"), F.create_map().cast("map<string,string>"))
    added = F.map_filter(entries, lambda _, v: v.isNotNull())
    # a source column of that name can only be the same one: the later entry is the same text
    kept = F.map_filter(before, lambda k, _: ~F.array_contains(F.map_keys(added), k))
    return as_variant(F.map_concat(kept, added))


def unread(text: Column, typed: Column) -> Column:
    """The text, where it holds something that its type could not."""
    return F.when(typed.isNull() & (F.trim(text) != ""), text)


def with_rescued(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(RESCUED, VariantType(), True)])
