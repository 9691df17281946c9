"""XPath over XML bodies, compiled on the driver to a ``from_xml`` schema and array expressions.

Paths are steps of element names with conditions of any form that XPath 1.0 has for them; the last
step may be ``@attribute`` or ``text()``. Name prefixes do not count. Descendants and ``*`` are
replaced by the names that the documents have (``element_names``) before they are compiled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.xpath_syntax import Call, Literal, Number, Operation, Step, Union, XPath, is_open, parse_paths, paths_in

_NAME = r"(?:[^\s:/>!?]+:)?"


def parse_xpath(path: str) -> XPath:
    """One location path of known names; anything else is refused with a ``ValueError``."""
    paths = parse_paths(path)
    if len(paths) > 1 or is_open(paths[0]):
        raise ValueError(f"unsupported XPath '{path}': it needs the names that the documents have")
    return paths[0]


@dataclass
class Node:
    """What is read of an element: its text, some attributes, some child elements.

    ``label`` is the name it has in the schema, which is another one only if two names differ in
    nothing but their case.
    """

    attributes: set[str] = field(default_factory=set)
    children: dict[str, Node] = field(default_factory=dict)
    label: str = ""

    def child(self, name: str) -> Node:
        return self.children.setdefault(name, Node(label=name))

    @property
    def is_text(self) -> bool:
        return not self.attributes and not self.children

    def fields(self) -> list[str]:
        out = ["`_VALUE` STRING"] + [f"`_{a}` STRING" for a in sorted(self.attributes)]
        return out + [f"`{c.label}` ARRAY<{c.ddl()}>" for _, c in sorted(self.children.items())]

    def ddl(self) -> str:
        return "STRING" if self.is_text else f"STRUCT<{', '.join(self.fields())}>"

    def names(self) -> set[str]:
        """The names of all elements below."""
        return {n for name, c in self.children.items() for n in {name, *c.names()}}

    def relabel(self, labels: dict[str, str]) -> None:
        for name, c in self.children.items():
            c.label = labels.get(name, name)
            c.relabel(labels)


def add_path(start: Node, path: XPath) -> Node:
    """Make sure that all ``path`` needs, its conditions included, is read below ``start``."""
    node = start
    steps = path.steps[1:] if path.absolute else path.steps
    if path.absolute and path.steps:
        _add_conditions(node, path.steps[0])
    for step in steps:
        node = node.child(step.name)
        _add_conditions(node, step)
    if path.attribute:
        node.attributes.add(path.attribute)
    return node


def _add_conditions(node: Node, step: Step) -> None:
    for condition in step.predicates:
        for path in paths_in(condition):
            add_path(node, path)


def case_true(text: Column, root: Node) -> Column:
    """``text`` with element names so changed that no two of ``root`` differ in nothing but their case.

    ``from_xml`` takes names without regard to case, XPath with it. Of names of ``root`` that differ
    so, all but one get another label, here and in the schema; elements that no name of ``root``
    means, but for the case, get a name of their own. Bodies without such names stay as they are.
    Comments and CDATA are left alone. Attributes are not told apart.
    """
    names = sorted(root.names())
    alike: dict[str, list[str]] = defaultdict(list)
    for name in names:
        alike[name.lower()].append(name)
    labels = {n: f"{n}.{i}" for same in alike.values() for i, n in enumerate(same) if i}
    root.relabel(labels)
    for name, label in labels.items():
        text = _renamed(text, re.escape(name), label)
    lettered = [re.escape(n) for n in names if n.lower() != n.upper()]
    if lettered:
        exact = "|".join(lettered)
        other = f"(?!(?:{exact})[\\s/>])(?i:{exact})"
        text = F.when(text.rlike(f"<{_NAME}{other}[\\s/>]"), _renamed(text, other, "$3.other")).otherwise(text)
    return text


def _renamed(text: Column, name: str, new: str) -> Column:
    """``text`` with the tags of elements that match ``name`` renamed; runs from tag to tag, past comments and CDATA."""
    rest = rf"[^<]++|<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|<(?!/?{_NAME}(?:{name})[\s/>])"
    return F.regexp_replace(text, rf"\G((?:{rest})*+)(</?{_NAME})({name})(?=[\s/>])", f"$1$2{new}")


def element_names(texts: Column) -> Column:
    """The elements of an XML body as the distinct paths of names from the root: ``array<string>``, parts joined by slashes.

    Tags are read in order and the path of the open elements is carried along, so it works on bodies
    that are not well-formed too.
    """
    quoted = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')"
    tags = F.regexp_extract_all(texts, F.lit(rf"<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|</?[^\s!?/>]{quoted}*+>"), F.lit(0))
    tags = F.filter(tags, lambda t: ~t.startswith("<!"))

    def step(state: Column, tag: Column) -> Column:
        name = F.regexp_extract(tag, rf"^</?{_NAME}([^\s/>]+)", 1)
        path = F.concat(state["open"], F.lit("/"), name)
        closing, single = tag.startswith("</"), tag.endswith("/>")
        after = F.when(closing, F.regexp_replace(state["open"], "/[^/]*$", "")).when(single, state["open"]).otherwise(path)
        seen = F.when(closing | F.array_contains(state["seen"], path), state["seen"]).otherwise(F.array_append(state["seen"], path))
        return F.struct(after.alias("open"), seen.alias("seen"))

    start = F.struct(F.lit("").alias("open"), F.array().cast("array<string>").alias("seen"))
    return F.aggregate(tags, start, step)["seen"]


def names_of(pages: DataFrame, text: str = "text") -> list[tuple[str, ...]]:
    """The distinct element paths of all bodies of ``pages``, as a schema is inferred: by a job over them."""
    if pages.isStreaming:
        raise ValueError("'//' and '*' in an XPath need the names that the documents have, which a stream cannot tell ahead")
    found = pages.select(F.explode(F.array_distinct(element_names(F.col(text)))).alias("path")).distinct()
    return sorted(tuple(r["path"].strip("/").split("/")) for r in found.toLocalIterator())


def text_of(element: Column, node: Node) -> Column:
    return element if node.is_text else element["_VALUE"]


# --- conditions -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Value:
    """The value of an expression: ``kind`` is nodes (an array of their texts), string, number (NULL: not a number) or boolean."""

    kind: str
    column: Column


@dataclass(frozen=True)
class Context:
    """The element that a condition is for, its place among the elements so far, from 1, and their number."""

    element: Column
    node: Node
    place: Column
    size: Column


_NUMBER = r"^-?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)$"
_WHITE = r"[\x20\x09\x0D\x0A]+"


def _number_of(text: Column) -> Column:
    plain = F.regexp_replace(text, rf"^{_WHITE}|{_WHITE}$", "")
    return F.when(plain.rlike(_NUMBER), plain.try_cast("double"))


def _string(v: Value) -> Column:
    if v.kind == "nodes":
        return F.coalesce(F.get(v.column, F.lit(0)), F.lit(""))
    if v.kind == "number":
        whole = v.column.cast("decimal(38,0)")
        text = F.when(v.column == F.floor(v.column), whole.cast("string")).otherwise(v.column.cast("string"))
        return F.coalesce(text, F.lit("NaN"))
    return v.column if v.kind == "string" else v.column.cast("string")


def _number(v: Value) -> Column:
    if v.kind == "boolean":
        return v.column.cast("double")
    return v.column if v.kind == "number" else _number_of(_string(v))


def _boolean(v: Value) -> Column:
    if v.kind == "nodes":
        return F.size(v.column) > 0
    if v.kind == "string":
        return v.column != ""
    return F.coalesce(v.column != 0, F.lit(False)) if v.kind == "number" else v.column


_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
}
_ARITHMETIC: dict[str, Callable[[Column, Column], Column]] = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b,
    "div": lambda a, b: F.try_divide(a, b), "mod": lambda a, b: F.try_mod(a, b),
}


def _compare(op: str, a: Value, b: Value) -> Column:
    """A comparison as XPath has it: of nodes it holds if it does for any of them."""
    kinds = {a.kind, b.kind}
    if "nodes" in kinds and "boolean" in kinds:
        a, b = (Value("boolean", _boolean(v)) for v in (a, b))
    elif a.kind == "nodes":
        return F.exists(a.column, lambda x: _compare(op, Value("string", x), b))
    elif b.kind == "nodes":
        return F.exists(b.column, lambda x: _compare(op, a, Value("string", x)))
    if op in ("=", "!=") and "boolean" in kinds:
        return _COMPARE[op](_boolean(a), _boolean(b))
    if op in ("=", "!=") and "number" not in kinds:
        return _COMPARE[op](_string(a), _string(b))
    # what is no number equals nothing
    return F.coalesce(_COMPARE[op](_number(a), _number(b)), F.lit(op == "!="))


def _nodes(path: XPath, c: Context) -> Value:
    found, target = select_nodes(c.element, c.node, path.steps)
    if path.attribute:
        return Value("nodes", F.filter(F.transform(found, lambda e: e[f"_{path.attribute}"]), lambda t: t.isNotNull()))
    texts = F.transform(found, lambda e: F.coalesce(text_of(e, target), F.lit("")))
    return Value("nodes", F.filter(texts, lambda t: t != "") if path.own_text else texts)


def _call(name: str, args: list[Value], c: Context) -> Value:
    own = args or [Value("string", F.coalesce(text_of(c.element, c.node), F.lit("")))]
    if name in ("contains", "starts-with"):
        a, b = _string(args[0]), _string(args[1])
        return Value("boolean", a.contains(b) if name == "contains" else a.startswith(b))
    if name in ("true", "false"):
        return Value("boolean", F.lit(name == "true"))
    if name in ("not", "boolean"):
        return Value("boolean", ~_boolean(args[0]) if name == "not" else _boolean(args[0]))
    if name in ("position", "last"):
        return Value("number", (c.place if name == "position" else c.size).cast("double"))
    if name == "number":
        return Value("number", _number(own[0]))
    if name in ("count", "sum"):
        if args[0].kind != "nodes":
            raise ValueError(f"unsupported XPath: {name}() of what is no path")
        add = F.aggregate(args[0].column, F.lit(0.0), lambda s, x: s + _number_of(x))
        return Value("number", F.size(args[0].column).cast("double") if name == "count" else add)
    if name in ("floor", "ceiling", "round"):
        number = _number(args[0])
        rounded = {"floor": F.floor(number), "ceiling": F.ceil(number), "round": F.floor(number + 0.5)}[name]
        return Value("number", rounded.cast("double"))
    if name == "string-length":
        return Value("number", F.length(_string(own[0])).cast("double"))
    if name == "normalize-space":
        return Value("string", F.trim(F.regexp_replace(_string(own[0]), _WHITE, " ")))
    if name == "concat":
        return Value("string", F.concat(*[_string(a) for a in args]))
    if name == "translate":
        return Value("string", F.call_function("translate", *[_string(a) for a in args]))
    if name in ("substring-before", "substring-after"):
        a, b = _string(args[0]), _string(args[1])
        at = F.position(b, a)
        part = F.substring(a, F.lit(1), at - 1) if name == "substring-before" else F.substring(a, at + F.length(b), F.length(a))
        return Value("string", F.when(at > 0, part).otherwise(F.lit("")))
    if name == "substring":
        text, first = _string(args[0]), F.floor(_number(args[1]) + 0.5)
        end = first + F.floor(_number(args[2]) + 0.5) if len(args) > 2 else F.length(text) + 1
        low = F.greatest(first, F.lit(1))
        return Value("string", F.coalesce(F.substring(text, low.cast("int"), F.greatest(end - low, F.lit(0)).cast("int")), F.lit("")))
    return Value("string", _string(own[0]))  # string


def evaluate(expression: object, c: Context) -> Value:
    if isinstance(expression, Literal):
        return Value("string", F.lit(expression.value))
    if isinstance(expression, Number):
        return Value("number", F.lit(expression.value))
    if isinstance(expression, XPath):
        return _nodes(expression, c)
    if isinstance(expression, Union):
        parts = [_nodes(p, c).column for p in expression.paths]
        return Value("nodes", F.concat(*parts) if parts else F.array().cast("array<string>"))
    if isinstance(expression, Call):
        return _call(expression.name, [evaluate(a, c) for a in expression.args], c)
    a, b = evaluate(expression.left, c), evaluate(expression.right, c)
    if expression.name in ("and", "or"):
        return Value("boolean", _boolean(a) & _boolean(b) if expression.name == "and" else _boolean(a) | _boolean(b))
    if expression.name in _COMPARE:
        return Value("boolean", _compare(expression.name, a, b))
    return Value("number", _ARITHMETIC[expression.name](_number(a), _number(b)))


def _holds(condition: object, c: Context) -> Column:
    got = evaluate(condition, c)
    held = got.column == c.place if got.kind == "number" else _boolean(got)
    return F.coalesce(held, F.lit(False))


def _counts(expression: object) -> bool:
    """Whether a condition asks for the number of elements."""
    if isinstance(expression, Operation):
        return _counts(expression.left) or _counts(expression.right)
    return isinstance(expression, Call) and (expression.name == "last" or any(_counts(a) for a in expression.args))


def narrow(elements: Column, node: Node, step: Step) -> Column:
    """The elements for which all conditions of a step hold, each condition counting what the one before left."""
    for condition in step.predicates:
        if isinstance(condition, Number):
            n = condition.value
            elements = F.slice(elements, int(n), 1) if n >= 1 and n == int(n) else F.slice(elements, 1, 0)
        elif _counts(condition):
            # bound once: the condition is worked out for each element
            elements = F.get(F.transform(F.array(elements), partial(_narrowed, node, condition)), F.lit(0))
        else:
            elements = _narrowed(node, condition, elements)
    return elements


def _narrowed(node: Node, condition: object, elements: Column) -> Column:
    size = F.size(elements) if _counts(condition) else F.lit(0)
    return F.filter(elements, lambda e, i: _holds(condition, Context(e, node, i + 1, size)))


# --- elements and texts ---------------------------------------------------------------------


def select_nodes(element: Column, node: Node, steps: tuple[Step, ...]) -> tuple[Column, Node]:
    """All elements the steps lead to, in document order, as an array (never NULL)."""
    if not steps:
        return F.array(element), node
    step, rest = steps[0], steps[1:]
    kid = node.children[step.name]
    kids = narrow(element[kid.label], kid, step)
    if rest:
        target = kid
        for s in rest:
            target = target.children[s.name]
        kids = F.flatten(F.transform(kids, lambda k: select_nodes(k, kid, rest)[0]))
    else:
        target = kid
    return F.coalesce(kids, F.array().cast(f"array<{target.ddl()}>")), target


def select_text(element: Column, node: Node, path: XPath) -> Column:
    """Text of the first node of a relative path in document order, NULL if there is none."""
    found, target = select_nodes(element, node, path.steps)

    def value(e: Column) -> Column:
        return e[f"_{path.attribute}"] if path.attribute else text_of(e, target)

    # The first child at every step is also the first match, if it exists; only else look at all.
    quick, at = element, node
    for step in path.steps:
        quick, at = F.get(quick[at.children[step.name].label], F.lit(0)), at.children[step.name]
    if any(s.predicates for s in path.steps):
        return value(F.get(found, F.lit(0)))
    if len(path.steps) < 2:
        return value(quick)
    return F.coalesce(value(quick), value(F.get(found, F.lit(0))))


def first_of(element: Column, node: Node, paths: tuple[XPath, ...]) -> Column:
    """Text of the first node of the first of the relative ``paths`` that has one."""
    texts = [select_text(element, node, p) for p in paths]
    return F.coalesce(*texts) if texts else F.lit(None).cast("string")
