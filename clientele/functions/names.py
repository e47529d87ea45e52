"""Full names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(
    first: Column | str, last: Column | str, sep: str = "", null_safe: bool = False
) -> Column:
    """First and last name joined by ``sep``.

    Strict by default: null if either part is null. With ``null_safe`` a
    missing part counts as empty text and the separator stays, which is why
    this is not ``concat_ws``.
    """
    parts = [F.col(p) if isinstance(p, str) else p for p in (first, last)]
    if null_safe:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(parts[0], F.lit(sep), parts[1]) if sep else F.concat(*parts)
