"""DuckDB SQL fragments for the oracle queries (same semantics as the Spark columns)."""

from __future__ import annotations

from newslake.functions.text import PY_WHITESPACE, boundary_pattern

# A SQL expression evaluating to the whitespace set of ``str.strip()``.
WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
WS_CLASS = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in PY_WHITESPACE) + "]"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS})"


def title_from(content: str) -> str:
    return f"(CASE WHEN length({content}) > 120 THEN substring({content}, 1, 120) || '…' ELSE {content} END)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(rows: list[tuple], cols: list[str]) -> str:
    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, str):
            return lit(x)
        return repr(x)

    body = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def word_match(hay: str, alias: str, boundary: str = "lenient") -> str:
    """``contains`` prefilter plus the RE2 class form of the whole-word pattern."""
    return f"(contains({hay}, {lit(alias)}) AND regexp_matches({hay}, {lit(boundary_pattern(alias, boundary, 're2'))}))"


def any_contains(hay: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({hay}, {lit(t)})" for t in terms) + ")" if terms else "FALSE"


def list_filter_contains(hay: str, terms: list[str]) -> str:
    arr = "[" + ", ".join(lit(t) for t in terms) + "]"
    return f"list_filter({arr}::VARCHAR[], lambda x: contains({hay}, x))"


ARTICLES_CTE = f"""
art0 AS (
  SELECT doc_id AS id, doc_id AS seq, source, lang,
         'doc://' || CAST(doc_id AS VARCHAR) AS url,
         {strip("coalesce(text, '')")} AS content
  FROM documents
),
art AS (SELECT *, {title_from('content')} AS title FROM art0),
pub AS (SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published_at FROM events)
"""
