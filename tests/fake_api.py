"""Transports for tests: pure functions, and receivers that write what they get to files."""

from __future__ import annotations

import json
import time
import uuid
from pathlib import Path

from pageframe.sources.transport import Transport


def paged(n_pages: int, per_page: int = 2, link: str | None = None) -> Transport:
    """``?page=i`` gives records; pages from ``n_pages`` on are empty. ``link`` names how pages are chained."""

    def answer(method, url, headers, body, timeout_s):
        base, _, query = url.partition("?")
        i = int(query.removeprefix("page=") or 0) if query else 0
        items = [{"v": i * per_page + k, "m": method} for k in range(per_page)] if i < n_pages else []
        content, names = {"items": items}, {"content-type": ["application/json"]}
        following = f"{base}?page={i + 1}" if i + 1 < n_pages else None
        if link == "header" and following:
            names["link"] = [f'<{following}>; rel="next"']
        if link == "body":
            content["next"] = following
        return 200, names, json.dumps(content).encode()

    return answer


def from_folder(folder: str, link: str = "header") -> Transport:
    """An API whose number of pages stands in a file, so that pages can be added between polls."""

    def answer(method, url, headers, body, timeout_s):
        n = int((Path(folder) / "n_pages").read_text())
        log = Path(folder) / "log"
        log.mkdir(exist_ok=True)
        (log / f"{time.time_ns()}-{uuid.uuid4().hex}").write_text(url)
        return paged(n, link=link)(method, url, headers, body, timeout_s)

    return answer


def failing_first(folder: str, times: int, status: int = 503, then: Transport | None = None) -> Transport:
    """Refuses every URL ``times`` times, then answers."""

    def answer(method, url, headers, body, timeout_s):
        seen = Path(folder) / uuid.uuid5(uuid.NAMESPACE_URL, url).hex
        seen.mkdir(parents=True, exist_ok=True)
        if len(list(seen.iterdir())) < times:
            (seen / uuid.uuid4().hex).write_text("")
            if status == 0:
                raise ConnectionRefusedError("refused")
            return status, {}, b"busy"
        return (then or paged(3))(method, url, headers, body, timeout_s)

    return answer


def recorder(folder: str, status: int = 200) -> Transport:
    """Writes every request to a file of its own."""

    def answer(method, url, headers, body, timeout_s):
        Path(folder).mkdir(parents=True, exist_ok=True)
        request = {"method": method, "url": url, "headers": dict(headers), "body": body.decode() if body is not None else None}
        (Path(folder) / uuid.uuid4().hex).write_text(json.dumps(request))
        code = 409 if body and b"refuse" in body else status
        return code, {}, b""

    return answer


def requests(folder: str) -> list[dict]:
    return [json.loads(f.read_text()) for f in sorted(Path(folder).iterdir())]


def with_gap(empty: int) -> Transport:
    """Pages without an end, but for one empty page."""

    def answer(method, url, headers, body, timeout_s):
        i = int(url.partition("page=")[2])
        return 200, {}, json.dumps({"items": [] if i == empty else [{"v": i}]}).encode()

    return answer


def unreadable(method, url, headers, body, timeout_s):
    """An API that answers 200 with what is no JSON, for ever."""
    return 200, {}, b"oops"
