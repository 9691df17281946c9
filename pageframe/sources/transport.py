"""Sending one request. Everything that touches the outside is behind a transport callable.

A transport is ``(method, url, headers, body, timeout_s) -> (status, headers, body)``. Data source
options are text, so a transport is named as ``module:callable``, or handed over with
:func:`pack`.
"""

from __future__ import annotations

import base64
import importlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import cloudpickle

Headers = dict[str, list[str]]
Transport = Callable[[str, str, Mapping[str, str], bytes | None, float], tuple[int, Headers, bytes]]
# Fixed value: first wait of the exponential retry policy.
FIRST_WAIT_S = 0.5


def http(method: str, url: str, headers: Mapping[str, str], body: bytes | None, timeout_s: float) -> tuple[int, Headers, bytes]:
    """One request over HTTP; every status is an answer, only I/O failures raise."""
    request = urllib.request.Request(url, data=body, headers=dict(headers), method=method)
    try:
        answer = urllib.request.urlopen(request, timeout=timeout_s or None)  # noqa: S310
    except urllib.error.HTTPError as e:
        answer = e
    with answer:
        names: Headers = {}
        for name, value in answer.headers.items():
            names.setdefault(name.lower(), []).append(value)
        return answer.status, names, answer.read()


def pack(transport: Transport) -> str:
    """A callable as an option value."""
    return "pickled:" + base64.b64encode(cloudpickle.dumps(transport)).decode()


def unpack(name: str | None) -> Transport:
    if not name or name == "http":
        return http
    if name.startswith("pickled:"):
        return cloudpickle.loads(base64.b64decode(name.removeprefix("pickled:")))
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


@dataclass(frozen=True)
class Answer:
    status: int
    headers: Headers
    body: bytes
    strategy: str
    attempts: int


def send(
    transport: Transport,
    method: str,
    url: str,
    headers: Mapping[str, str],
    body: bytes | None,
    timeout_s: float,
    strategy_of: Callable[[int], str],
    retryable: Callable[[str], bool],
    policy: str,
    interval_s: float | None,
    max_duration_s: float,
    sleep: Callable[[float], None] = time.sleep,
    clock: Callable[[], float] = time.monotonic,
) -> Answer:
    """Send a request until its status is not retryable or the retry budget is used up.

    An I/O failure is retryable within the same budget; if it lasts, it is raised.
    """
    started, wait, attempts = clock(), FIRST_WAIT_S, 0
    while True:
        attempts += 1
        failure: Exception | None = None
        answer = None
        try:
            status, names, content = transport(method, url, headers, body, timeout_s)
            answer = Answer(status, names, content, strategy_of(status), attempts)
        except OSError as e:
            failure = e
        if answer is not None and not retryable(answer.strategy):
            return answer
        pause = wait if policy == "exponential" else float(interval_s or 0)
        wait *= 2
        if clock() - started + pause > max_duration_s:
            if answer is not None:
                return answer
            raise ConnectionError(f"Failed to load the page {url}") from failure
        sleep(pause)
