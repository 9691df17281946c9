"""Text helpers over response bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: line ends accepted in text, CSV and TSV bodies.
LINE_END = r"\r\n|\r|\n"


def body_text(body: Column) -> Column:
    """UTF-8 text of a binary body; malformed bytes become U+FFFD, as a decoder would do."""
    return F.make_valid_utf8(F.coalesce(body, F.lit(b"")).cast("string"))


def split_lines(text: Column, limit: int = -1) -> Column:
    """Pieces of ``text`` between line ends; the alternation is used only where there is a CR.

    With a limit, the last piece is all that is left behind ``limit - 1`` pieces.
    """
    return F.when(F.contains(text, F.lit("\r")), F.split(text, LINE_END, limit)).otherwise(F.split(text, "\n", limit))


def drop_tail(pieces: Column) -> Column:
    """Without the empty piece behind a final line end, which is not a line."""
    has_tail = F.element_at(pieces, -1) == ""
    return F.when(has_tail, F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)


def first_header(headers: Column, name: str) -> Column:
    """First value of a response header; header names are held in lower case."""
    return F.try_element_at(F.try_element_at(headers, F.lit(name.lower())), F.lit(1))
