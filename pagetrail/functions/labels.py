"""Code-to-label maps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: labels by code ----------------------------------------
CHROMIUM_TRANSITIONS = {
    0: "LINK",
    1: "TYPED",
    2: "BOOKMARK",
    3: "AUTO_SUBFRAME",
    4: "MANUAL_SUBFRAME",
    5: "GENERATED",
    6: "AUTO_TOPLEVEL",
    7: "FORM_SUBMIT",
    8: "RELOAD",
    9: "KEYWORD",
    10: "KEYWORD_GENERATED",
}
CHROMIUM_SUMMARY_CODES = (0, 1, 2, 7, 8, 9)
DOWNLOAD_STATES = {0: "IN_PROGRESS", 1: "COMPLETE", 2: "CANCELLED", 3: "INTERRUPTED"}
FIREFOX_VISIT_TYPES = {
    1: "LINK",
    2: "TYPED",
    3: "BOOKMARK",
    4: "EMBED",
    5: "REDIRECT_PERM",
    6: "REDIRECT_TEMP",
    7: "DOWNLOAD",
    8: "FRAMED_LINK",
    9: "RELOAD",
}
CORE_TRANSITION_MASK = 255
# --------------------------------------------------------------------------


def _lookup(code: Column, labels: dict[int, str], otherwise: Column) -> Column:
    entries = ", ".join(f"{value}L, '{label}'" for value, label in labels.items())
    return F.coalesce(F.element_at(F.expr(f"map({entries})"), code), otherwise)


def _numbered(prefix: str) -> Callable[[Column], Column]:
    """``PREFIX(code)``; a NULL code stays NULL because concat does."""
    return lambda code: F.concat(F.lit(f"{prefix}("), code.cast("string"), F.lit(")"))


def chromium_transition(transition: Column) -> Column:
    code = transition.bitwiseAND(CORE_TRANSITION_MASK)
    return _lookup(code, CHROMIUM_TRANSITIONS, _numbered("OTHER")(code))


def chromium_transition_group(transition: Column) -> Column:
    """The coarser summary labels; every other code, and NULL, is OTHER."""
    coarse = {code: CHROMIUM_TRANSITIONS[code] for code in CHROMIUM_SUMMARY_CODES}
    return _lookup(transition.bitwiseAND(CORE_TRANSITION_MASK), coarse, F.lit("OTHER"))


def download_state(state: Column) -> Column:
    return _lookup(state, DOWNLOAD_STATES, _numbered("UNKNOWN")(state))


def firefox_visit_type(visit_type: Column) -> Column:
    return _lookup(visit_type, FIREFOX_VISIT_TYPES, _numbered("OTHER")(visit_type))


def firefox_visit_type_group(visit_type: Column) -> Column:
    return _lookup(visit_type, FIREFOX_VISIT_TYPES, F.lit("OTHER"))
