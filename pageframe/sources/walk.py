"""Fetching the pages of one seed, page by page, where the next URL is in the last response."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from urllib.parse import quote_plus, urljoin, urlsplit

from pageframe.functions.paths import split_path
from pageframe.functions.urls import ABSOLUTE_URL, INDEX_PLACEHOLDER, NEXT_LINK
from pageframe.functions.xpath_syntax import absolute_path
from pageframe.operators.errors import DEFAULT_STRATEGY, SEND, SKIP, STOP, STRATEGIES, SUCCESS
from pageframe.options import (
    CUSTOM,
    INCREMENT_INDEX,
    LINK_IN_BODY,
    LINK_IN_HEADER,
    TOKEN_IN_BODY,
    SourceOptions,
    compile_next_url,
)
from pageframe.plans.next_url import Headers
from pageframe.sources.transport import Answer, Transport, send
from pageframe.sources.xml_document import texts_at


@dataclass(frozen=True)
class Response:
    """A row of the response table."""

    seed: str
    page_no: int
    url: str
    status: int
    headers: dict[str, list[str]]
    body: bytes

    def as_tuple(self) -> tuple:
        return (self.seed, self.page_no, self.url, self.status, self.headers, self.body)


def strategy_for(status: int, rules: list[tuple[str, str]]) -> str:
    return next((s for pattern, s in rules if re.fullmatch(pattern, str(status))), DEFAULT_STRATEGY)


def fetch(options: SourceOptions, transport: Transport, url: str) -> Answer:
    """One page with retries; a status whose handling is to stop fails the job."""
    rules = options.rules
    body = options.request_body.encode() if options.request_body is not None else None
    answer = send(
        transport,
        options.http_method.upper(),
        url,
        options.headers,
        body,
        max(options.connect_timeout_s, options.read_timeout_s),
        lambda status: strategy_for(status, rules),
        lambda strategy: STRATEGIES[strategy][0],
        options.retry_policy.lower(),
        options.linear_retry_interval_s,
        options.max_retry_duration_s,
    )
    handling = STRATEGIES[answer.strategy][1]
    if handling == STOP:
        text = answer.body.decode("utf-8", "replace")
        raise RuntimeError(f"'{url}' answered {answer.status}: {text}")
    if handling in (SKIP, SEND) and not options.supports_skipping_pages:
        raise RuntimeError(f"a page cannot be skipped with pagination type '{options.pagination}'")
    return answer


def _json_at(document: object, path: str | None) -> tuple[object, bool]:
    """Value where a slash path ends or meets a non-object, and whether it was there."""
    for part in split_path(path):
        if not isinstance(document, dict):
            return document, True
        if part not in document:
            return None, False
        document = document[part]
    return document, True


def _xml_at(text: str, path: str) -> list[str | None]:
    return texts_at(text, absolute_path(path))


def is_empty(options: SourceOptions, body: bytes) -> bool:
    """True if a good page has no entries. A page that cannot be read has one: its error."""
    text = body.decode("utf-8", "replace")
    try:
        if options.page_format == "json":
            return _json_at(json.loads(text), options.result_path)[0] == []
        if options.page_format == "xml":
            return not _xml_at(text, options.result_path)
    except Exception:  # an unreadable body is reported by the parser
        return False
    if options.page_format == "blob":
        return False
    n = len(re.split(r"\r\n|\r|\n", text)) - (1 if text == "" or text[-1] in "\r\n" else 0)
    return n - int(options.csv_skip_first_row and options.page_format in ("csv", "tsv")) <= 0


def link_in_body(options: SourceOptions, body: bytes, path: str) -> str | None:
    text = body.decode("utf-8", "replace")
    if options.page_format == "xml":
        return next(iter(_xml_at(text, path)), None) or None
    value, there = _json_at(json.loads(text), path)
    if not there or value is None:
        return None
    if isinstance(value, (dict, list)):
        raise ValueError(f"the value at '{path}' is expected to be a primitive")
    return value if isinstance(value, str) else json.dumps(value)


def following_url(options: SourceOptions, url: str, answer: Answer) -> str | None:
    """The next URL by the rule of the pagination type; index pages are numbered elsewhere."""
    kind, first = options.pagination, options.url
    if kind == LINK_IN_HEADER:
        links = answer.headers.get("link") or [""]
        found = re.search(NEXT_LINK, links[0])
        return found.group(1) or None if found else None
    if kind == CUSTOM:
        last = {name: values[-1] for name, values in answer.headers.items() if values}
        return compile_next_url(options.custom_next_url)(url, answer.body.decode("utf-8", "replace"), Headers(last))
    if STRATEGIES[answer.strategy][1] != SUCCESS:
        return None
    if kind == LINK_IN_BODY:
        link = link_in_body(options, answer.body, options.next_page_field_path)
        if not link or re.match(ABSOLUTE_URL, link):
            return link or None
        parts = urlsplit(first)
        return f"{parts.scheme}://{parts.netloc}{link}" if link.startswith("/") and link[:2] != "//" else urljoin(url, link)
    if kind == TOKEN_IN_BODY:
        token = link_in_body(options, answer.body, options.next_page_token_path)
        if not token:
            return None
        base, mark, fragment = first.partition("#")
        joint = "" if base[-1] in "?&" else ("&" if "?" in base else "?")
        return f"{base}{joint}{quote_plus(options.next_page_url_parameter)}={quote_plus(token)}{mark}{fragment}"
    return None


@dataclass(frozen=True)
class Cursor:
    """Position in a page sequence: the next page to read, as an index or as a URL.

    ``done`` marks a page that has no successor yet: a later read starts by asking it again
    for its next link, without giving out the page a second time, unless changed pages are
    to be given out again and its digest is another one now.
    """

    page_no: int = 0
    url: str | None = None
    done: bool = False
    digest: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


def page_url(options: SourceOptions, cursor: Cursor) -> str | None:
    if options.pagination != INCREMENT_INDEX:
        return cursor.url or options.url
    index = options.start_index + cursor.page_no * options.index_increment
    if options.max_index is not None and index > options.max_index:
        return None
    return options.url.replace(INDEX_PLACEHOLDER, str(index))


def readable(options: SourceOptions, body: bytes) -> bool:
    """False if the parser can take nothing from a page, so that it can never be an empty one."""
    text = body.decode("utf-8", "replace")
    try:
        if options.page_format == "json":
            _json_at(json.loads(text), options.result_path)
        if options.page_format == "xml":
            document(text)
    except Exception:
        return False
    return True


def walk(
    options: SourceOptions,
    transport: Transport,
    start: Cursor,
    max_pages: int | None = None,
    seconds: float | None = None,
    stop_on_empty: bool = True,
) -> Iterator[tuple[Response | None, Cursor]]:
    """Pages from ``start`` on, each with the cursor behind it.

    Stops in front of a page without entries (unless ``stop_on_empty`` is off), where there is no next
    URL, and at the page or time limit. An index without a maximum ends only with an empty page; if
    a page of it cannot be read, it may never come, so the walk fails there if errors stop the read,
    and else ends behind that page. Yields ``None`` for a re-read page whose successor was asked for.
    """
    cursor, given, deadline = start, 0, None if seconds is None else time.monotonic() + seconds
    first = True
    open_end = options.pagination == INCREMENT_INDEX and options.max_index is None
    while (max_pages is None or given < max_pages) and (deadline is None or time.monotonic() < deadline):
        url = page_url(options, cursor)
        if url is None:
            return
        if not first and options.wait_between_pages_ms > 0:
            time.sleep(options.wait_between_pages_ms / 1000)
        first = False
        answer = fetch(options, transport, url)
        good = STRATEGIES[answer.strategy][1] == SUCCESS
        if good and stop_on_empty and is_empty(options, answer.body):
            return
        lost = good and open_end and not readable(options, answer.body)
        if lost and options.entry_handling == STOP:
            raise RuntimeError(f"the page at '{url}' cannot be read")
        digest = hashlib.sha256(answer.body).hexdigest() if options.reemit_on_change else None
        again = cursor.done and digest == cursor.digest
        no = cursor.page_no - 1 if cursor.done else cursor.page_no
        page = None if again else Response(options.url, no, url, answer.status, answer.headers, answer.body)
        if options.pagination == INCREMENT_INDEX:
            cursor = Cursor(cursor.page_no + 1)
            yield page, cursor
            if lost:
                return
        else:
            onward = following_url(options, url, answer)
            cursor = Cursor(no + 1, onward or url, not onward, None if onward else digest)
            yield page, cursor
            if not onward:
                return
        given += page is not None
