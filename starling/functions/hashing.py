"""Change hash (F1, F2): sha-256 hex of the concatenated type-2 attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def change_hash(*cols: Column | str, sep: str = "", null_marker: str | None = None) -> Column:
    """``sha2(concat_ws(sep, cols...), 256)``.

    The default (no separator, NULLs skipped) matches the warehouse's existing
    hashes; ("ab", "c") and ("a", "bc") collide under it. Pass a separator
    such as ``"\\x1f"`` and a ``null_marker`` to make the text unambiguous.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_marker is not None:
        parts = [F.coalesce(p.cast("string"), F.lit(null_marker)) for p in parts]
    return F.sha2(F.concat_ws(sep, *parts), 256)
