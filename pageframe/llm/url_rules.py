"""URL rules that follow redirects: what is blocked under one address is blocked under its aliases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.llm.components import components
from pageframe.llm.rows import LOWER, UPPER

#: (verdict, host and path). A list of at most some thousands: it is part of the expression.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, which also keeps the generated code small."""
    return F.transform(F.array(value), use)[0]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def _host(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)


def _path(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_of(url: Column) -> Column:
    return _host(_rest(url))


def path_of(url: Column) -> Column:
    return _path(_rest(url))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits as (rule, verdict); null if none does."""
    table = [(verdict, rule, *rule.split("/", 1)) for verdict, rule in rules]
    cells = [
        F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(f"/{p}").alias("path"))
        for v, rule, h, p in table
    ]
    fits = F.filter(F.array(*cells), lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.array_max(fits)


#: Segments of a path that are folded at a time, so that work follows the path's length.
_FOLDED = 256


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments: read from its end, each ``..`` takes the next segment that is none."""
    closed = F.regexp_replace(path, r"/\.\.?$", "$0/")
    parts = F.split(closed, "/")
    rest = F.reverse(F.slice(parts, 2, F.size(parts) - 1))
    none = F.struct(F.lit(0).alias("skip"), F.lit("").alias("path"))

    def step(state: Column, part: Column) -> Column:
        taken = (part == ".") | (part == "..") | (state["skip"] > 0)
        skip = F.when(part == "..", state["skip"] + 1).when((part != ".") & (state["skip"] > 0), state["skip"] - 1).otherwise(state["skip"])
        return F.struct(skip.alias("skip"), F.when(taken, state["path"]).otherwise(F.concat(F.lit("/"), part, state["path"])).alias("path"))

    def steps(state: Column, block: Column) -> Column:
        own = F.aggregate(block, F.struct(state["skip"].alias("skip"), F.lit("").alias("path")), step)
        return _bound(own, lambda o: F.struct(o["skip"].alias("skip"), F.concat(o["path"], state["path"]).alias("path")))

    blocks = _bound(rest, lambda r: F.transform(F.sequence(F.lit(0), F.floor(F.size(r) / _FOLDED).cast("int")), lambda i: F.slice(r, i * _FOLDED + 1, _FOLDED)))
    return F.when(path.rlike(r"(?s)/\.\.?(/|$)"), F.aggregate(blocks, none, steps)["path"]).otherwise(path)


def node_of(url: Column) -> Column:
    """One name for an address however it is written: host, path and query, without scheme and fragment.

    User names, the scheme's own port and ``.`` and ``..`` segments are left out, and no path is ``/``.
    """
    scheme = F.lower(F.regexp_extract(url, "(?s)^(.*?)://", 1))

    def named(rest: Column) -> Column:
        at = F.regexp_replace(_host(rest), "^.*@", "")
        at = F.when(scheme == "http", F.regexp_replace(at, ":(80)?$", "")).when(scheme == "https", F.regexp_replace(at, ":(443)?$", "")).otherwise(at)
        path = F.regexp_replace(_path(rest), "(?i)%2e", ".")
        path = F.when(path == "", F.lit("/")).otherwise(_bound(path, _without_dots))
        return F.when(rest == "", F.lit("")).otherwise(F.concat(at, path, F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)))

    return _bound(_rest(url), named)


#: What a browser does not read as tags: comments, open ones to the end, and the content of raw elements.
_UNREAD = r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(script|style|textarea|title|template)\b.*?(?:</\1|\z)"


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    value = F.regexp_replace(quoted, r"""(?is)^\s[^=]*=\s*["']?|["']$""", "")
    return F.replace(value, F.lit("&amp;"), F.lit("&"))


def targets(html: Column) -> Column:
    """Addresses that a page names as its canonical link or refreshes to, as they are written.

    Comments and the content of scripts, styles and other raw elements are not read.
    """
    asked = html.rlike("(?i)canonical|refresh")  # most pages have neither
    html = F.regexp_replace(html, _UNREAD, "")
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*+>"), F.lit(0)), lambda t: F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)"))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*+>"), F.lit(0)), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    to = F.transform(metas, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?is)^[\s0-9.]*[;,]\s*url\s*=\s*[\"']?([^\"']*)", 1))
    every = F.concat(F.transform(links, lambda t: _attribute(t, "href")), to)
    none = F.array().cast("array<string>")
    return F.when(asked, F.filter(F.transform(every, lambda u: F.trim(u)), lambda u: u != "")).otherwise(none)


def resolved(base: Column, link: Column) -> Column:
    """``link`` as seen from the page at ``base``; null if it is none that a host serves, as ``mailto:``."""
    scheme = F.regexp_extract(base, "(?s)^(.*?)://", 1)
    return _bound(_rest(base), lambda rest: _bound(link, lambda to: _absolute(scheme, _host(rest), _path(rest), to)))


def _absolute(scheme: Column, host: Column, path: Column, link: Column) -> Column:
    root, folder = F.concat(scheme, F.lit("://"), host), F.regexp_replace(path, "[^/]*$", "")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike("^[#?]"), F.concat(root, path, link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, by) of every row of ``pages`` (page_id, url, html).

    A url that a rule fits has the verdict of the longest such rule. Any other takes part in the
    equivalence of redirects: pages and the addresses they name as canonical or refresh to are
    connected, and a component holds the verdicts of the rules that fit its addresses, also of
    those that are no page here. An explicit allow anywhere in it comes first; else an explicit block
    makes its ruleless addresses blocked; else they are allowed. ``by`` is rule, alias or default.

    Addresses are compared as ``node_of`` names them, so ``http://a.org:80/p/../x`` is ``https://a.org/x``;
    a ruleless url is an alias of its own such name, too: where a rule blocks that one, it is blocked.
    Links in comments and in scripts name nothing.

    Only links are shuffled, as pairs of addresses, and only pages that are ruleless and on a link
    take a verdict from elsewhere. A null url, or one without ``://``, has an empty host and path and
    is judged as such, without aliases; a null html names no address; repeated rows give a row each;
    no rows give none; other columns are ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), node_of(F.col("url")).alias("node"))
    rows = rows.withColumn("r", matched_rule(F.col("host"), F.col("path"), rules))
    named = pages.filter("url is not null and html is not null").select("url", F.explode(targets(F.col("html"))).alias("link"))
    edges = named.select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("url"), F.col("link"))).alias("b"))
    roots = stored(components(edges.filter("a != '' and b != ''"), "a", "b"), "aliases")
    # a node is what follows the scheme of a url
    verdict = _bound(F.struct(_host(F.col("node")).alias("h"), _path(F.col("node")).alias("p")), lambda u: matched_rule(u["h"], u["p"], rules))["verdict"]
    known = roots.select("root", verdict.alias("v")).groupBy("root")
    known = known.agg(F.max(F.col("v") == "allow").alias("allow"), F.max(F.col("v") == "block").alias("block"))
    alias = roots.withColumn("own", F.coalesce(verdict == "block", F.lit(False))).join(known, "root")
    alias = alias.select("node", "own", (F.coalesce("block", F.lit(False)) & ~F.coalesce("allow", F.lit(False))).alias("blocked"))
    alias = alias.filter("blocked or own").select(F.col("node").alias("_node"), "blocked")
    joined = rows.join(alias, (rows["node"] == alias["_node"]) & rows["r"].isNull(), "left")
    inherited = F.when(F.col("r").isNull(), F.coalesce("blocked", verdict == "block", F.lit(False))).otherwise(F.lit(False))
    by = F.when(F.col("r").isNotNull(), "rule").when(inherited, "alias").otherwise("default")
    final = F.coalesce(F.col("r.verdict"), F.when(inherited, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", F.col("r.rule").alias("rule"), final.alias("verdict"), by.alias("by"))
