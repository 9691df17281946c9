"""XML pages: elements by a result path, fields by relative paths, one ``from_xml`` per body."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageframe.functions.typed import aside, quote, text_as, text_is_plainly_fine
from pageframe.functions.xpath_syntax import XPath, expand, is_open, parse_paths
from pageframe.functions.xpaths import Node, add_path, case_true, first_of, names_of, narrow, parse_xpath, select_nodes, text_of
from pageframe.operators.entries import IS_SUCCESS, PAGE, explode_entries, finish, first_reason, line_error, page_problem

CORRUPT = "_corrupt_record"
# Name of the root element, behind a declaration, comments and a document type.
# Possessive: a loop that may give back keeps a stack frame for each round.
ROOT = r"^(?:\s++|\uFEFF|<\?[\s\S]*?\?>|<!--[\s\S]*?-->|<!DOCTYPE[^>\[]*(?:\[[\s\S]*?\]\s*)?>)*+<(?:[^\s:/>]+:)?([^\s/>:]+)"


def parse_xml(text: Column, root: Node) -> Column:
    """The parts of an XML body that ``root`` names, case counting; comments and prefixes are dropped."""
    text = case_true(text, root)
    ddl = ", ".join([*root.fields(), f"`{CORRUPT}` STRING"])
    options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": CORRUPT, "ignoreSurroundingSpaces": "false"}
    return F.from_xml(text, ddl, options)


def root_matches(text: Column, path: XPath) -> Column:
    return F.regexp_extract(text, ROOT, 1) == path.steps[0].name if path.steps else F.lit(False)


def absolute_nodes(doc: Column, root: Node, path: XPath) -> tuple[Column, Node]:
    """Elements an absolute path leads to, starting at the parsed root element."""
    first = path.steps[0]
    if not first.predicates:
        return select_nodes(doc, root, path.steps[1:])
    tops = narrow(F.array(doc), root, first)
    target = root
    for step in path.steps[1:]:
        target = target.children[step.name]
    return F.flatten(F.transform(tops, lambda t: select_nodes(t, root, path.steps[1:])[0])), target


def first_text(doc: Column, root: Node, path: XPath) -> Column:
    """Text of the first node at an absolute path."""
    found, target = absolute_nodes(doc, root, path)
    first = F.get(found, F.lit(0))
    return first[f"_{path.attribute}"] if path.attribute else text_of(first, target)


def xml_primitive(text: Column, path: str) -> Column:
    """Text at an absolute path of an XML body; NULL if it is absent or empty or the body is no XML."""
    wanted = parse_xpath("/" + path.strip().lstrip("/"))
    root = Node()
    add_path(root, wanted)
    doc = parse_xml(text, root)
    good = doc[CORRUPT].isNull() & root_matches(text, wanted)
    return F.when(good, F.nullif(first_text(doc, root, wanted), F.lit("")))


def xml_entries(
    pages: DataFrame,
    schema: T.StructType,
    handling: str,
    result_path: str,
    mapping: dict[str, str] | None = None,
) -> DataFrame:
    """Records of XML pages. Fields without a mapping are read from the child of that name."""
    mapping = mapping or {}
    paths = [mapping.get(f.name, f.name).strip().lstrip("/") for f in schema]
    raw = [f"r{i}" for i in range(len(schema))]
    rows = _rows(pages, result_path, paths, raw)
    values = [f"v{i}" for i in range(len(schema))]
    fields = list(zip(schema, raw, values, strict=True))
    rows = rows.selectExpr("*", *[f"{text_as(r, f)} AS {v}" for f, r, v in fields])
    plain = " AND ".join(text_is_plainly_fine(r, v, f) for f, r, v in fields)
    error = aside(f"struct({', '.join(raw)})", "e", element_error(schema, raw))
    problem = f"CASE WHEN page_error IS NULL AND NOT ({plain}) THEN {error} END"
    return finish(rows, schema, problem, handling, values)


NOT_XML = "The page is not valid XML"
#: A result path of known names, and the relative paths of each field below it.
Plan = tuple[XPath, list[tuple[XPath, ...]]]


def plan_paths(pages: DataFrame, result_path: str, fields: list[str]) -> list[Plan]:
    """The element paths that ``result_path`` stands for, each with the paths of ``fields`` below it.

    Where names are left open (``//``, ``*``), the elements of all bodies are read first, as a schema
    is inferred; elements of one such path come in document order, those of several path by path.
    """
    results, below = [replace(p, absolute=True) for p in parse_paths(result_path)], [parse_paths(f) for f in fields]
    if not all(p.steps for p in results):
        raise ValueError(f"unsupported XPath '{result_path}': it names no element")
    if not any(is_open(p) for paths in (results, *below) for p in paths):
        return [(p, below) for p in results]
    names = names_of(pages.filter(IS_SUCCESS))
    plans = []
    for p in dict.fromkeys(q for r in results for q in expand(r, names)):
        here = tuple(s.name for s in p.steps)
        plans.append((p, [tuple(q for f in paths for q in expand(f, names, here)) for paths in below]))
    return plans


def plan_elements(text: Column, doc: Column, root: Node, plans: list[Plan], of: Callable[[Node, Plan, Column], Column], kind: str) -> Column:
    """What ``of`` makes of the elements of all plans, as one array of ``kind``."""
    parts = []
    for plan in plans:
        nodes, element = absolute_nodes(doc, root, plan[0])
        made = F.transform(nodes, partial(of, element, plan))
        parts.append(F.when(root_matches(text, plan[0]), made).otherwise(F.array().cast(f"array<{kind}>")))
    return F.concat(*parts) if parts else F.array().cast(f"array<{kind}>")


def _rows(pages: DataFrame, result_path: str, paths: list[str], raw: list[str]) -> DataFrame:
    """One row per element with the texts of its fields, by ``from_xml``."""
    plans, root = plan_paths(pages, result_path, paths), Node()
    for path, fields in plans:
        element = add_path(root, path)
        for f in (f for field in fields for f in field):
            add_path(element, f)
    parsed = pages.select(*PAGE, "status", "text", F.when(F.expr(IS_SUCCESS), parse_xml(F.col("text"), root)).alias("doc"))
    doc = F.col("doc")
    problem = F.expr(page_problem((f"doc IS NULL OR doc.{CORRUPT} IS NOT NULL", NOT_XML))).alias("page_error")
    if len(plans) == 1:
        path, fields = plans[0]
        items, element = absolute_nodes(doc, root, path)
        items = F.when(root_matches(F.col("text"), path), items).otherwise(F.array().cast(f"array<{element.ddl()}>"))
        rows = explode_entries(parsed.select(*PAGE, items.alias("items"), problem))
        return rows.select("*", *[first_of(F.col("entry"), element, f).alias(r) for f, r in zip(fields, raw, strict=True)])
    kind = f"struct<{', '.join(f'{r}:string' for r in raw)}>"

    def texts(element: Node, plan: Plan, e: Column) -> Column:
        return F.struct(*[first_of(e, element, f).alias(r) for f, r in zip(plan[1], raw, strict=True)])

    items = plan_elements(F.col("text"), doc, root, plans, texts, kind)
    rows = explode_entries(parsed.select(*PAGE, items.alias("items"), problem))
    return rows.select("*", *[F.col(f"entry.{r}") for r in raw])


def element_error(schema: T.StructType, raw: list[str]) -> str:
    """SQL for the error of an element: its first field that is null where it must not be, or of another type."""
    reasons = []
    for field, r in zip(schema, raw, strict=True):
        text = f"e.{r}"
        if not field.nullable:
            no_value = f"{text} IS NULL" if isinstance(field.dataType, T.StringType) else f"coalesce({text}, '') = ''"
            advice = "which its schema does not allow"
            reasons.append((no_value, f"field '{field.name}' is null, {advice}"))
        reasons.append(
            (
                f"coalesce({text}, '') <> '' AND ({text_as(text, field)}) IS NULL",
                f"field '{field.name}' is not of type {field.dataType.simpleString()}",
            )
        )
    texts = ", ".join(f"{quote(f.name)}, e.{r}" for f, r in zip(schema, raw, strict=True))
    body = f"to_json(named_struct({texts}), map('ignoreNullFields', 'false'))"
    return line_error(body, first_reason(reasons))
