"""What the page formats share: one exploded row per entry, then a record or an error.

Conditions are SQL text over the columns of the page: one call to the JVM each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pageframe.functions.typed import quote
from pageframe.operators.errors import ERROR_TYPE, SUCCESS, make_error, status_error
from pageframe.operators.responses import KEYS

PAGE = (*KEYS, "after_retry")
# Fixed value: message of an entry whose required fields were not all found.
NOT_ALL_FOUND = "Couldn't find all required fields in the record"
IS_SUCCESS = f"after_retry = {quote(SUCCESS)}"
NO_ERROR = f"CAST(NULL AS {ERROR_TYPE})"


def page_problem(*unreadable: tuple[str, str], body_bytes: str = "CAST(NULL AS BINARY)") -> str:
    """SQL for the error of a whole page: a status that was no success, or a body that cannot be
    read, given as conditions with their reasons."""
    whens = [f"WHEN NOT ({IS_SUCCESS}) THEN {status_error(body_bytes)}"]
    whens += [f"WHEN {condition} THEN {make_error(0, quote(reason), 'text')}" for condition, reason in unreadable]
    return " ".join(["CASE", *whens, "END"])


def explode_entries(pages: DataFrame, *carry: str) -> DataFrame:
    """One row per entry of ``items``; a page with a problem becomes one row without an entry."""
    items = "CASE WHEN page_error IS NOT NULL THEN array(NULL) ELSE items END"
    return pages.selectExpr(*PAGE, *carry, "page_error", f"posexplode({items}) AS (entry_no, entry)")


def line_error(body: str, reason: str) -> str:
    message = f"concat('Cannot convert line \\'', {body}, '\\' to a record. Reason: ', {reason})"
    return make_error(0, message, body)


def missing_error(url: str) -> str:
    """SQL for the error of a page that is due but was not captured."""
    return make_error(0, f"concat('Failed to load the page ', {url})", "CAST(NULL AS STRING)")


def first_reason(reasons: list[tuple[str, str]]) -> str:
    """SQL for the text of the first condition that holds."""
    whens = [f"WHEN {condition} THEN {quote(text)}" for condition, text in reasons]
    return " ".join(["CASE", *whens, "ELSE 'unknown'", "END"])


def finish(
    df: DataFrame, schema: T.StructType, entry_error: str, handling: str, values: list[str], keeps_partial: bool = False
) -> DataFrame:
    """``record`` or ``error`` per entry, with the handling that applies to an error.

    With ``keeps_partial`` errors of code 1 still carry the converted record.
    """
    record = ", ".join(f"{quote(f.name)}, {v}" for v, f in zip(values, schema, strict=True))
    keep = "error IS NULL OR error.code = 1" if keeps_partial else "error IS NULL"
    outcome = (
        f"named_struct('entry_no', CAST(entry_no AS BIGINT), 'record', CASE WHEN {keep} THEN named_struct({record}) END, "
        f"'error', error, 'handling', CASE WHEN {IS_SUCCESS} THEN {quote(handling)} ELSE after_retry END)"
    )
    # The outcome is generated, not projected: a filter on ``error`` would else be pushed below
    # the projection with a second copy of all that ``error`` is made of.
    judged = df.selectExpr("*", f"CAST(coalesce(page_error, {entry_error}) AS {ERROR_TYPE}) AS error")
    return judged.selectExpr(*KEYS, f"inline(array({outcome}))")
