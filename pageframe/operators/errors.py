"""Status rules, entry routing and the resolution of attempt logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageframe.functions.typed import quote

# Entry handlings, and per status strategy (retry?, handling after the retries).
SUCCESS, SKIP, SEND, STOP = "success", "skipOnError", "sendToError", "stopOnError"
HANDLINGS = (SUCCESS, SKIP, SEND, STOP)
STRATEGIES: dict[str, tuple[bool, str]] = {
    "Success": (False, SUCCESS),
    "Fail": (False, STOP),
    "Skip": (False, SKIP),
    "Send to error": (False, SEND),
    "Retry and fail": (True, STOP),
    "Retry and skip": (True, SKIP),
    "Retry and send to error": (True, SEND),
}
DEFAULT_STRATEGY = "Fail"
# No status code reaches this number.
STATUS_SPAN = 100_000

ERROR_TYPE = "struct<code int, message string, body string, body_bytes binary>"


def make_error(code: str | int, message: str, body: str, body_bytes: str = "CAST(NULL AS BINARY)") -> str:
    """SQL for an error record; ``body_bytes`` is the body of pages that are bytes, else NULL."""
    return f"named_struct('code', CAST({code} AS INT), 'message', {message}, 'body', {body}, 'body_bytes', {body_bytes})"


def strategy_of(status: str, rules: Sequence[tuple[str, str]]) -> str:
    """SQL for the strategy of the first rule whose expression matches the whole status code."""
    whens = [f"WHEN CAST({status} AS STRING) RLIKE {quote(f'^(?:{pattern})$')} THEN {quote(name)}" for pattern, name in rules]
    return " ".join(["CASE", *whens, "ELSE", quote(DEFAULT_STRATEGY), "END"]) if whens else quote(DEFAULT_STRATEGY)


def with_strategy(responses: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``strategy``, ``should_retry`` and ``after_retry`` to each response."""
    retried = ", ".join(quote(name) for name, (retry, _) in STRATEGIES.items() if retry)
    after = " ".join(f"WHEN {quote(name)} THEN {quote(handling)}" for name, (_, handling) in STRATEGIES.items())
    return responses.selectExpr("*", f"{strategy_of('status', rules)} AS strategy").selectExpr(
        "*", f"strategy IN ({retried}) AS should_retry", f"CASE strategy {after} END AS after_retry"
    )


def status_error(body_bytes: str = "CAST(NULL AS BINARY)") -> str:
    """SQL for the error of a page whose status was no success: the status as code, the body as text."""
    message = """concat('Request failed with \\'', status, '\\' http status code. Body is \\'', text, '\\'')"""
    return make_error("status", message, "text", body_bytes)


IS_GOOD = "error IS NULL"
IS_SENT = f"error IS NOT NULL AND handling = {quote(SEND)}"


def keep_or_stop(parsed: DataFrame, keep: str) -> DataFrame:
    """Entries that are to be kept; the first entry that is to stop the job fails it.

    Check and condition are one expression in a filter: as a projection the check could be
    pruned away, and as a second filter it might see no bad entry any more.
    """
    text = "concat('page ', url, ' entry ', entry_no, ': ', error.message)"
    return parsed.filter(
        f"CASE WHEN error IS NOT NULL AND handling = {quote(STOP)} THEN CAST(raise_error({text}) AS BOOLEAN) ELSE {keep} END"
    )


@dataclass(frozen=True)
class Routed:
    """Good records and the records sent to the error output, both filters over ``parsed``."""

    parsed: DataFrame
    positions: bool = False

    @cached_property
    def records(self) -> DataFrame:
        return good_records(self.parsed, self.positions)

    @cached_property
    def errors(self) -> DataFrame:
        return sent_errors(self.parsed)


def good_records(parsed: DataFrame, positions: bool = False) -> DataFrame:
    columns = ["seed", "page_no", "entry_no"] if positions else []
    return keep_or_stop(parsed, IS_GOOD).select(*columns, "record.*")


def sent_errors(parsed: DataFrame) -> DataFrame:
    return keep_or_stop(parsed, IS_SENT).select(
        "seed", "page_no", "entry_no", "url", "error.code", "error.message", "error.body", "error.body_bytes"
    )


def with_outcome(parsed: DataFrame) -> DataFrame:
    """Both outputs in one frame, told apart by ``outcome``: ``record`` or ``error``."""
    kept = keep_or_stop(parsed, f"({IS_GOOD}) OR ({IS_SENT})")
    return kept.selectExpr("*", f"CASE WHEN {IS_GOOD} THEN 'record' ELSE 'error' END AS outcome")


def route(parsed: DataFrame, positions: bool = False, observation: Observation | None = None) -> Routed:
    """Split parsed entries three ways: good ones, ones sent to error; skipped ones are left out.

    Both outputs are filters over one frame, so this adds no shuffle. With ``observation``
    the numbers of good, sent and skipped entries are reported as a side result of the job.
    """
    if observation is not None:
        bad = F.col("error").isNotNull()
        parsed = parsed.observe(
            observation,
            F.count_if(~bad).alias("n_records"),
            F.count_if(bad & (F.col("handling") == SEND)).alias("n_sent"),
            F.count_if(bad & (F.col("handling") == SKIP)).alias("n_skipped"),
        )
    return Routed(parsed, positions)


def write_routed(parsed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write both outputs in one pass over the pages, as partitions ``outcome=record|error``.

    Two writes of two filters would parse every body twice.
    """
    with_outcome(parsed).write.mode(mode).partitionBy("outcome").parquet(path)


def resolve_attempts(
    attempts: DataFrame, rules: Sequence[tuple[str, str]], max_retry_duration_s: float, keys: Sequence[str] = ("url",)
) -> DataFrame:
    """Final status per URL from a log ``(url, attempt, elapsed_s, status)`` of fetch attempts.

    Attempts go on until the first status that is not retryable or until the retry budget is
    used up; then the last status within the budget stands. The first attempt always counts.
    ``attempt`` is the one whose status stands. All parts are min/max aggregates, so they
    combine before the shuffle.
    """
    in_budget = F.expr(f"elapsed_s <= {float(max_retry_duration_s)}D OR attempt = 1")
    # attempt and status as one number: the least and greatest of it aggregate by hashing
    outcome = F.col("attempt").cast("bigint") * STATUS_SPAN + F.col("status")
    marked = with_strategy(attempts, rules)
    picked = marked.groupBy(*keys).agg(
        F.min(F.when(in_budget & ~F.col("should_retry"), outcome)).alias("final"),
        F.max(F.when(in_budget, outcome)).alias("last"),
    )
    resolved = picked.select(
        *keys,
        F.expr(f"coalesce(final, last) DIV {STATUS_SPAN} AS attempt"),
        F.expr(f"CAST(coalesce(final, last) % {STATUS_SPAN} AS INT) AS status"),
        F.col("final").isNull().alias("timed_out"),
    )
    return with_strategy(resolved, rules).select(*keys, "attempt", "status", "strategy", "after_retry", "timed_out")
