"""URL expressions: placeholders, parameters and link resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The index placeholder of a URL and the "next" rule of a Link header.
INDEX_PLACEHOLDER = "{pagination.index}"
NEXT_LINK = r'<([^>]*)>(?:\s*;[^;,<]*)*?\s*;\s*rel\s*=\s*"?next"?\s*(?:[;,]|$)'
ABSOLUTE_URL = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def fill_index(url: Column, index: Column) -> Column:
    return F.replace(url, F.lit(INDEX_PLACEHOLDER), index.cast("string"))


def next_in_link_header(link: Column) -> Column:
    """URL marked ``rel="next"`` in a Link header, NULL if there is none."""
    return F.nullif(F.regexp_extract(link, NEXT_LINK, 1), F.lit(""))


def resolve_link(link: Column, first_url: Column, page_url: Column) -> Column:
    """Absolute URL of a link found in a body.

    A link that starts with ``/`` is put behind scheme and authority of the first URL; any
    other relative link is resolved against the page it was found on.
    """
    origin = F.concat(
        F.try_parse_url(first_url, F.lit("PROTOCOL")),
        F.lit("://"),
        F.try_parse_url(first_url, F.lit("AUTHORITY")),
    )
    page = F.regexp_replace(page_url, r"[?#].*$", "")
    folder = F.regexp_replace(page, r"(?<![/:])/[^/]*$", "")
    link = F.nullif(link, F.lit(""))
    return (
        F.when(link.rlike(ABSOLUTE_URL), link)
        .when(link.startswith("//"), F.concat(F.try_parse_url(first_url, F.lit("PROTOCOL")), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def add_parameter(url: Column, name: str, value: Column) -> Column:
    """``url`` with one more query parameter, put in front of a fragment."""
    base = F.regexp_replace(url, r"#.*$", "")
    fragment = F.regexp_extract(url, r"#.*$", 0)
    joint = F.when(base.rlike(r"[?&]$"), F.lit("")).when(F.instr(base, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    return F.concat(base, joint, F.url_encode(F.lit(name)), F.lit("="), F.url_encode(value), fragment)
