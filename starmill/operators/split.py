"""Train and test rows chosen by the row key instead of by a random stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_train(keys: Sequence[str | Column], fraction: float = 0.8) -> Column:
    """True for about ``fraction`` of all keys, the same ones under any partitioning.

    The digest of the key is uniform in hexadecimal order, so comparing it with a
    prefix of the wanted size needs no number conversion.
    """
    bound = min(round(fraction * 2**32), 2**32 - 1)
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return digest < F.lit(f"{bound:08x}")
