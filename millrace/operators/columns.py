"""Column selection, renaming, row ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: What a preview shows at most.
PREVIEW_ROWS = 1000


def rename_and_drop(
    df: DataFrame, renames: Mapping[str, str] | None = None, drops: tuple[str, ...] = ()
) -> DataFrame:
    """Rename, then drop; a name that is absent is ignored in both."""
    return df.withColumnsRenamed(dict(renames or {})).drop(*drops)


def expand_struct(df: DataFrame, struct: str, *others: str) -> DataFrame:
    """All fields of ``struct`` as columns, after the ``others``."""
    return df.select(*others, f"{struct}.*")


def row_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique increasing ids with gaps; costs no shuffle (see ``row_index`` for no gaps)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def explode_words(df: DataFrame, text: str, *others: str, name: str = "word") -> DataFrame:
    """One row per space-separated word; repeated spaces give empty words."""
    return df.select(*others, F.explode(F.split(F.col(text), " ")).alias(name))


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> list[Row]:
    """The first rows to look at, at most ``PREVIEW_ROWS``: as many partitions are read, one after
    another, as it takes to have them."""
    if not 0 <= n <= PREVIEW_ROWS:
        raise ValueError(f"a preview has 0 to {PREVIEW_ROWS} rows")
    return df.take(n)
