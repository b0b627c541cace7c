"""Category cascade and risk flag (CAS1, CAS2): substring tests, first hit wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.text import as_col
from newslake.operators.match import BRAND_KEYWORDS, COMPETITORS, any_substring

# The analyzer's classification keyword lists.
REGULATION_KEYWORDS = ["regulation", "gesetz", "bafin", "aufsicht", "gesetzgebung", "compliance"]
PLATFORM_KEYWORDS = ["plattform", "platform", "credit", "lending", "neobank", "fintech", "origination"]
FUNDING_KEYWORDS = ["funding", "investment", "capital", "fund"]
PARTNERSHIP_KEYWORDS = ["partnership", "collaboration", "alliance", "cooperation"]
INSOLVENCY_KEYWORDS = ["insolvency", "restructuring", "default", "bankruptcy", "liquidation", "debt"]

# Cascade order and labels (first matching group wins).
DEFAULT_CASCADE = [
    ("exaloan_reputation", BRAND_KEYWORDS),
    ("competitor", COMPETITORS),
    ("regulation", REGULATION_KEYWORDS),
    ("funding", FUNDING_KEYWORDS),
    ("partnership", PARTNERSHIP_KEYWORDS),
    ("insolvency_risk", INSOLVENCY_KEYWORDS),
    ("platform", PLATFORM_KEYWORDS),
]
UNKNOWN = "unknown"


def classify(text: Column | str, cascade: list[tuple[str, list[str]]] = DEFAULT_CASCADE, default: str = UNKNOWN) -> Column:
    """Label of the first group with any term occurring in ``lower(text)`` (a CASE WHEN chain)."""
    low = F.lower(as_col(text))
    expr = None
    for label, terms in cascade:
        cond = any_substring(low, terms)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def insolvency_risk(content: Column | str, terms: list[str] = INSOLVENCY_KEYWORDS) -> Column:
    """True when any insolvency term occurs in the lowercased *content* (not the title)."""
    return any_substring(F.lower(F.coalesce(as_col(content), F.lit(""))), terms)


__all__ = [
    "DEFAULT_CASCADE", "FUNDING_KEYWORDS", "INSOLVENCY_KEYWORDS", "PARTNERSHIP_KEYWORDS",
    "PLATFORM_KEYWORDS", "REGULATION_KEYWORDS", "UNKNOWN", "classify", "insolvency_risk",
]
