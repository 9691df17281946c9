"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words of every contract: runs of characters other than blank, tab, line ends and the like.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that helper columns cannot clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def text_of(column: str = "text") -> Column:
    """A text as bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def row_key(doc_id: Column, text: Column) -> Column:
    """A key that equals only for rows with equal id and text; rows without an id have one too."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit(""))))
