"""String column functions shared by the operators (all built-in Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` removes (``str.isspace()``), so stripped values
# match the semantics of the landed data's producers. Spark's plain ``trim`` removes only
# U+0020; ``trim(col, chars)`` removes any of these.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A "word" character as in Python's Unicode ``\w``: letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_CLASS = r"[^\p{L}\p{N}_]"

# Tokens for statistics (sentiment, keyword ranking, language id).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# Sentence breaks for keyword ranking.
SENTENCE_SPLIT = r"[.!?\n]+"

ELLIPSIS = "…"

_REGEX_META = set("\\.^$|?*+()[]{}")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(as_col(c), F.lit(PY_WHITESPACE))


def nonempty(c: Column | str) -> Column:
    """NULL for ``''`` -- the building block of ``a or b`` fallback chains."""
    return F.nullif(as_col(c), F.lit(""))


def or_chain(*cols: Column | str) -> Column:
    """Python ``a or b or c`` over strings: the first non-empty operand, else the last as is."""
    cs = [as_col(c) for c in cols]
    return F.coalesce(*[nonempty(c) for c in cs[:-1]], cs[-1])


def regex_escape(term: str) -> str:
    """Escape regex metacharacters; valid for both Java regex and RE2."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in term)


def _is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def boundary_pattern(term: str, boundary: str = "lenient", dialect: str = "java") -> str:
    """Whole-word pattern for ``term`` (already lowercased) under a boundary policy.

    ``python``: the literal ``\\b<term>\\b`` rule -- an edge that is a non-word character
    needs a *word* character next to it. ``lenient``: an edge that is a non-word character
    needs nothing. A word-character edge always needs a non-word neighbour (or text end).

    ``dialect='java'`` uses lookarounds (Spark); ``'re2'`` uses consuming classes, which is
    equivalent for "does it match" tests (DuckDB oracle).
    """
    if boundary not in ("lenient", "python"):
        raise ValueError(f"unknown boundary policy {boundary!r}")
    body = regex_escape(term)
    if not term:
        return body
    first_word, last_word = _is_word_char(term[0]), _is_word_char(term[-1])
    if dialect == "java":
        left = f"(?<!{WORD_CLASS})" if first_word else (f"(?<={WORD_CLASS})" if boundary == "python" else "")
        right = f"(?!{WORD_CLASS})" if last_word else (f"(?={WORD_CLASS})" if boundary == "python" else "")
    elif dialect == "re2":
        left = f"(^|{NON_WORD_CLASS})" if first_word else (WORD_CLASS if boundary == "python" else "")
        right = f"({NON_WORD_CLASS}|$)" if last_word else (WORD_CLASS if boundary == "python" else "")
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    return left + body + right


def tokens(c: Column | str) -> Column:
    """Word tokens (letters/digits runs) in text order."""
    return F.regexp_extract_all(as_col(c), F.lit(TOKEN_PATTERN), 0)


def lower_tokens(c: Column | str) -> Column:
    return tokens(F.lower(as_col(c)))


def _class_ranges(chars: str) -> str:
    """A regex character class for ``chars``, consecutive code points merged into ranges."""
    cps = sorted({ord(ch) for ch in chars})
    parts, start = [], cps[0]
    for prev, cur in zip(cps, cps[1:] + [None]):
        if cur != prev + 1:
            parts.append(f"\\x{{{start:X}}}" if start == prev else f"\\x{{{start:X}}}-\\x{{{prev:X}}}")
            start = cur
    return "[" + "".join(parts) + "]"


WHITESPACE_RUN = _class_ranges(PY_WHITESPACE) + "+"


def whitespace_split(c: Column | str) -> Column:
    """Python ``str.split()``: split on runs of Unicode whitespace, no empty tokens."""
    return F.array_remove(F.split(strip(c), WHITESPACE_RUN), "")


# German transliteration of umlauts and sharp s.
GERMAN_TRANSLITERATION = [
    ("Ä", "Ae"), ("ä", "ae"),
    ("Ö", "Oe"), ("ö", "oe"),
    ("Ü", "Ue"), ("ü", "ue"),
    ("ß", "ss"),
]


def transliterate_de(c: Column | str) -> Column:
    """Replace German umlauts and sharp s by two-letter ASCII spellings (1 -> 2 chars)."""
    out = as_col(c)
    for src, dst in GERMAN_TRANSLITERATION:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def truncate_title(content: Column, limit: int = 120) -> Column:
    """First ``limit`` characters plus an ellipsis when longer, else the content."""
    return F.when(F.length(content) > limit, F.concat(F.substring(content, 1, limit), F.lit(ELLIPSIS))).otherwise(content)


def strip_markup_blocks(html: Column | str) -> Column:
    """Drop ``script``/``style`` blocks and comments before tag-level matching."""
    return F.regexp_replace(
        as_col(html), r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", ""
    )


# The named references that prose and links use; the ampersand comes last.
NAMED_REFERENCES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&hellip;", "…"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&amp;", "&"),
]


def _code_point(ref: Column) -> Column:
    """The character of a numeric reference's digits (decimal, or hex behind an x), NULL if none."""
    number = F.when(ref.rlike("^[xX]"), F.conv(F.substr(ref, F.lit(2)), 16, 10)).otherwise(ref).cast("long")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0")), "UTF-32"))


def decode_references(c: Column | str) -> Column:
    """Decode HTML character references: numeric ones and those of ``NAMED_REFERENCES``."""
    numeric = r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def piece(p: Column, i: Column) -> Column:
        ref = F.regexp_extract(p, numeric, 1)
        ch = F.when((i > 0) & (ref != ""), _code_point(ref))
        return F.when(ch.isNotNull(), F.concat(ch, F.substr(p, F.length(ref) + 2))).when(
            i > 0, F.concat(F.lit("&#"), p)).otherwise(p)

    def decoded(text: Column) -> Column:
        out = F.when(text.contains("&#"), F.array_join(F.transform(F.split(text, "&#"), piece), "")).otherwise(text)
        for ref, ch in NAMED_REFERENCES:
            out = F.replace(out, F.lit(ref), F.lit(ch))
        return F.when(text.contains("&"), out).otherwise(text)

    # The text is a lambda variable: what it is made from is computed once, not once a reference.
    return F.get(F.transform(F.array(as_col(c)), decoded), 0)


def strip_tags(c: Column | str) -> Column:
    """Remove tags, decode character references, strip."""
    return strip(decode_references(F.regexp_replace(as_col(c), r"<[^>]*>", "")))
