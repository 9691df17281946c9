"""Reading XPath 1.0: location paths with conditions, as small immutable trees."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace

_TOKEN = re.compile(
    r"\s*(?:(?P<literal>'[^']*'|\"[^\"]*\")|(?P<number>\d+(?:\.\d*)?|\.\d+)|(?P<mark>//|\.\.|::|!=|<=|>=|[/\[\]()@,|=<>+*.$-])"
    r"|(?P<name>[^\W\d][\w.\-]*(?::[^\W\d][\w.\-]*)?))"
)
#: Operators from the loosest to the tightest.
_LEVELS = (("or",), ("and",), ("=", "!="), ("<", "<=", ">", ">="), ("+", "-"), ("*", "div", "mod"))
#: Functions and how many arguments they take at least and at most.
FUNCTIONS = {
    "not": (1, 1), "true": (0, 0), "false": (0, 0), "boolean": (1, 1), "number": (0, 1), "string": (0, 1), "count": (1, 1),
    "sum": (1, 1), "position": (0, 0), "last": (0, 0), "contains": (2, 2), "starts-with": (2, 2), "concat": (2, 99),
    "string-length": (0, 1), "normalize-space": (0, 1), "substring": (2, 3), "substring-before": (2, 2), "substring-after": (2, 2),
    "translate": (3, 3), "floor": (1, 1), "ceiling": (1, 1), "round": (1, 1),
}


@dataclass(frozen=True)
class Literal:
    value: str


@dataclass(frozen=True)
class Number:
    value: float


@dataclass(frozen=True)
class Call:
    name: str
    args: tuple = ()


@dataclass(frozen=True)
class Operation:
    name: str
    left: object
    right: object


@dataclass(frozen=True)
class Step:
    """Child elements of a name, or all descendants (``deep``); ``*`` is any name. ``.`` is no step."""

    name: str
    predicates: tuple = ()
    deep: bool = False


@dataclass(frozen=True)
class XPath:
    """A location path; ``attribute`` or ``own_text`` if it ends in ``@attribute`` or ``text()``."""

    absolute: bool
    steps: tuple[Step, ...]
    attribute: str | None = None
    own_text: bool = False


@dataclass(frozen=True)
class Union:
    paths: tuple[XPath, ...]


class _Reader:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        while at < len(text.rstrip()):
            found = _TOKEN.match(text, at)
            if found is None:
                self.refuse(f"'{text[at:]}'")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def refuse(self, what: str) -> None:
        raise ValueError(f"unsupported XPath '{self.text}': {what}")

    def peek(self, ahead: int = 0) -> str | None:
        """The next token as written; literals keep their quotes."""
        at = self.at + ahead
        return self.tokens[at][1] if at < len(self.tokens) else None

    def kind(self) -> str | None:
        return self.tokens[self.at][0] if self.at < len(self.tokens) else None

    def take(self, *wanted: str) -> str | None:
        if self.kind() != "literal" and self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            self.refuse(f"'{wanted}' expected" + (f" at '{self.peek()}'" if self.peek() else ""))

    def expression(self, level: int = 0) -> object:
        if level == len(_LEVELS):
            return self.unary()
        left = self.expression(level + 1)
        while op := self.take(*_LEVELS[level]):
            left = Operation(op, left, self.expression(level + 1))
        return left

    def unary(self) -> object:
        if self.take("-"):
            return Operation("-", Number(0.0), self.unary())
        first = self.primary()
        if self.peek() != "|" or self.kind() == "literal":
            return first
        paths = [first]
        while self.take("|"):
            paths.append(self.primary())
        if not all(isinstance(p, XPath) for p in paths):
            self.refuse("only paths can be joined by '|'")
        return Union(tuple(paths))

    def primary(self) -> object:
        kind, text = self.kind(), self.peek()
        if kind == "literal":
            self.at += 1
            return Literal(text[1:-1])
        if kind == "number":
            self.at += 1
            return Number(float(text))
        if self.take("("):
            inner = self.expression()
            self.need(")")
            return inner
        if kind == "name" and self.peek(1) == "(" and text != "text":
            self.at += 2
            args = []
            while not self.take(")"):
                if args:
                    self.need(",")
                args.append(self.expression())
            least, most = FUNCTIONS.get(text, (1, 0))
            if not least <= len(args) <= most:
                self.refuse(f"function '{text}'")
            return Call(text, tuple(args))
        return self.path()

    def path(self) -> XPath:
        deep = bool(self.take("//"))
        absolute = deep or bool(self.take("/"))
        steps: list[Step] = []
        while True:
            if self.take("@"):
                if self.kind() != "name" or deep:
                    self.refuse("an attribute name expected")
                self.at += 1
                return XPath(absolute, tuple(steps), local(self.tokens[self.at - 1][1]))
            if self.peek() == "text" and self.peek(1) == "(":
                self.at += 2
                self.need(")")
                if deep:
                    self.refuse("a name expected behind '//'")
                return XPath(absolute, tuple(steps), own_text=True)
            if not self.take("."):
                if self.peek() == ".." or self.peek(1) == "::":
                    self.refuse("only steps down are known")
                if self.kind() != "name" and self.peek() != "*":
                    if absolute and not steps and not deep and self.peek() is None:
                        return XPath(True, ())
                    self.refuse("a step expected" + (f" at '{self.peek()}'" if self.peek() else ""))
                name = local(self.peek())
                self.at += 1
                predicates = []
                while self.take("["):
                    predicates.append(self.expression())
                    self.need("]")
                steps.append(Step(name, tuple(predicates), deep))
                deep = False
            elif deep:
                self.refuse("a name expected behind '//'")
            if self.take("//"):
                deep = True
            elif not self.take("/"):
                return XPath(absolute, tuple(steps))


def local(name: str) -> str:
    """A name without its prefix, which does not count."""
    return name.split(":")[-1]


def parse_paths(path: str) -> tuple[XPath, ...]:
    """The location paths, joined by ``|``, that ``path`` names; anything else is refused with a ``ValueError``."""
    reader = _Reader(path.strip())
    found = reader.expression()
    if reader.peek() is not None:
        reader.refuse(f"'{reader.peek()}'")
    paths = found.paths if isinstance(found, Union) else (found,)
    if not all(isinstance(p, XPath) for p in paths):
        reader.refuse("it is no path")
    for p in paths:
        if any(not inner_relative(q) for s in p.steps for q in s.predicates):
            reader.refuse("conditions must start at the element they are for")
    return paths


def absolute_path(path: str) -> str:
    """A path as from the root of the document, where a path may be given without its first slash."""
    text = path.strip()
    return text if text.startswith("//") else "/" + text.lstrip("/")


def inner_relative(expression: object) -> bool:
    return all(not p.absolute and all(inner_relative(q) for s in p.steps for q in s.predicates) for p in paths_in(expression))


def paths_in(expression: object) -> list[XPath]:
    """The paths that an expression reads at the element it is for."""
    if isinstance(expression, XPath):
        return [expression]
    if isinstance(expression, Union):
        return list(expression.paths)
    if isinstance(expression, Call):
        return [p for a in expression.args for p in paths_in(a)]
    if isinstance(expression, Operation):
        return [*paths_in(expression.left), *paths_in(expression.right)]
    return []


def is_open(path: XPath) -> bool:
    """Whether a path leaves names open, so that only the documents tell what it leads to."""
    return any(s.deep or s.name == "*" or any(is_open(p) for q in s.predicates for p in paths_in(q)) for s in path.steps)


def expand(path: XPath, names: Iterable[tuple[str, ...]], at: tuple[str, ...] = ()) -> tuple[XPath, ...]:
    """The paths of plain child steps that ``path`` stands for among ``names``, the elements that documents have.

    ``names`` has each element's path of names from the root, ``at`` is where a relative path starts.
    """
    names = sorted(names)
    start = () if path.absolute else at
    found: list[tuple[tuple[Step, ...], tuple[str, ...]]] = [((), start)]
    for step in path.steps:
        onward = []
        for steps, here in found:
            if not step.deep and step.name != "*":
                places = [(*here, step.name)]
            else:
                below = [n for n in names if n[: len(here)] == here and len(n) > len(here)]
                places = [n for n in below if (step.deep or len(n) == len(here) + 1) and step.name in ("*", n[-1])]
            for place in places:
                between = tuple(Step(n) for n in place[len(here) : -1])
                kept = tuple(_closed(q, names, place) for q in step.predicates)
                onward.append(((*steps, *between, Step(place[-1], kept)), place))
        found = onward
    return tuple(replace(path, steps=steps) for steps, _ in found)


def _closed(expression: object, names: list[tuple[str, ...]], at: tuple[str, ...]) -> object:
    if isinstance(expression, XPath):
        return expand(expression, names, at)[0] if not is_open(expression) else Union(expand(expression, names, at))
    if isinstance(expression, Union):
        return Union(tuple(x for p in expression.paths for x in expand(p, names, at)))
    if isinstance(expression, Call):
        return Call(expression.name, tuple(_closed(a, names, at) for a in expression.args))
    if isinstance(expression, Operation):
        return Operation(expression.name, _closed(expression.left, names, at), _closed(expression.right, names, at))
    return expression
