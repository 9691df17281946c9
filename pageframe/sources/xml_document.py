"""XPath on the one document that a page walker holds, to find its next page and whether it is empty."""

from __future__ import annotations

import math
import operator
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable

from pageframe.functions.xpath_syntax import Call, Literal, Number, Operation, Union, XPath, parse_paths

_COMPARE: dict[str, Callable] = {
    "=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
_ARITHMETIC: dict[str, Callable] = {
    "+": operator.add, "-": operator.sub, "*": operator.mul,
    "div": lambda a, b: a / b if b else math.nan, "mod": lambda a, b: math.fmod(a, b) if b else math.nan,
}


def texts_at(text: str, path: str) -> list[str | None]:
    """Texts of all nodes at a path from the root of a document; ``None`` for an element without text."""
    top = ET.Element("document")
    top.append(ET.fromstring(text))  # noqa: S314
    for e in top.iter():
        e.tag = e.tag.rpartition("}")[2]
        e.attrib = {k.rpartition("}")[2]: v for k, v in e.attrib.items()}
    return [t for p in parse_paths(path) for t in _select(top, p)]


def _select(start: ET.Element, path: XPath) -> list[str | None]:
    found = [start]
    for step in path.steps:
        onward: dict[int, ET.Element] = {}
        for parent in [x for e in found for x in e.iter()] if step.deep else found:
            kids = [k for k in parent if step.name in ("*", k.tag)]
            for condition in step.predicates:
                kids = [k for i, k in enumerate(kids, 1) if _holds(_value(condition, k, i, len(kids)), i)]
            onward |= {id(k): k for k in kids}
        found = list(onward.values())
    if path.attribute:
        return [e.attrib[path.attribute] for e in found if path.attribute in e.attrib]
    texts = [(e.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in e) for e in found]
    return [t for t in texts if t] if path.own_text else texts


def _holds(value: object, place: int) -> bool:
    return value == place if isinstance(value, float) else _boolean(value)


def _boolean(v: object) -> bool:
    return bool(v) and v == v


def _string(v: object) -> str:
    if isinstance(v, list):
        return v[0] if v else ""
    if isinstance(v, bool):
        return str(v).lower()
    return str(int(v)) if isinstance(v, float) and v == v and v == int(v) else str(v)


def _number(v: object) -> float:
    if isinstance(v, (bool, float)):
        return float(v)
    text = _string(v).strip(" \t\r\n")
    return float(text) if re.fullmatch(r"-?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)", text) else math.nan


def _compare(op: str, a: object, b: object) -> bool:
    if isinstance(a, list) and isinstance(b, bool) or isinstance(b, list) and isinstance(a, bool):
        a, b = _boolean(a), _boolean(b)
    elif isinstance(a, list):
        return any(_compare(op, x, b) for x in a)
    elif isinstance(b, list):
        return any(_compare(op, a, x) for x in b)
    if op in ("=", "!=") and (isinstance(a, bool) or isinstance(b, bool)):
        return _COMPARE[op](_boolean(a), _boolean(b))
    if op in ("=", "!=") and isinstance(a, str) and isinstance(b, str):
        return _COMPARE[op](a, b)
    return _COMPARE[op](_number(a), _number(b))


def _value(x: object, e: ET.Element, place: int, size: int) -> object:
    """Nodes as a list of texts, else a string, float or bool."""
    if isinstance(x, (Literal, Number)):
        return x.value
    if isinstance(x, XPath):
        return [t or "" for t in _select(e, x)]
    if isinstance(x, Union):
        return [t or "" for p in x.paths for t in _select(e, p)]
    if isinstance(x, Operation):
        a, b = (_value(y, e, place, size) for y in (x.left, x.right))
        if x.name in ("and", "or"):
            return _boolean(a) and _boolean(b) if x.name == "and" else _boolean(a) or _boolean(b)
        return _compare(x.name, a, b) if x.name in _COMPARE else float(_ARITHMETIC[x.name](_number(a), _number(b)))
    assert isinstance(x, Call)
    args = [_value(a, e, place, size) for a in x.args]
    own = args[0] if args else e.text or ""
    s = [_string(a) for a in args]
    return {
        "position": lambda: float(place), "last": lambda: float(size), "true": lambda: True, "false": lambda: False,
        "not": lambda: not _boolean(own), "boolean": lambda: _boolean(own), "number": lambda: _number(own), "string": lambda: _string(own),
        "count": lambda: float(len(own)), "sum": lambda: float(sum(map(_number, own))), "contains": lambda: s[1] in s[0],
        "starts-with": lambda: s[0].startswith(s[1]), "concat": lambda: "".join(s), "string-length": lambda: float(len(_string(own))),
        "normalize-space": lambda: " ".join(_string(own).split()), "floor": lambda: _whole(math.floor, _number(own)),
        "ceiling": lambda: _whole(math.ceil, _number(own)), "round": lambda: _whole(math.floor, _number(own) + 0.5),
        "substring-before": lambda: s[0].partition(s[1])[0] if s[1] in s[0] else "", "substring-after": lambda: s[0].partition(s[1])[2],
        "substring": lambda: _part(s[0], *map(_number, args[1:])),
        "translate": lambda: s[0].translate({ord(c): s[2][i : i + 1] or None for i, c in reversed(list(enumerate(s[1])))}),
    }[x.name]()


def _whole(to: Callable[[float], int], number: float) -> float:
    return float(to(number)) if math.isfinite(number) else number


def _part(text: str, first: float, length: float = math.inf) -> str:
    if not math.isfinite(first):
        return ""
    low = math.floor(first + 0.5)
    high = low + (math.floor(length + 0.5) if math.isfinite(length) else len(text) + abs(low) + 1)
    return text[max(0, low - 1) : max(0, high - 1)]
