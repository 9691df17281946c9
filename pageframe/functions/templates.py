"""``#field`` templates, compiled once on the driver to a ``concat`` of literals and columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a placeholder is "#" and a field name of word characters.
PLACEHOLDER = re.compile(r"#(\w+)")


def template_fields(template: str) -> list[str]:
    """Field names in a template, each once, in order."""
    return list(dict.fromkeys(PLACEHOLDER.findall(template)))


def fill_template(template: str, value_of: Callable[[str], Column]) -> Column:
    """Fill every placeholder in a single pass; a field name is always the longest match."""
    parts: list[Column] = []
    for i, piece in enumerate(PLACEHOLDER.split(template)):
        if i % 2:
            parts.append(value_of(piece))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")
