"""Text column functions, all built-in regex expressions (JVM side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values for clean_text: C0 and C1 controls plus DEL are dropped; ':' becomes
# ' -'; then leading/trailing whitespace is stripped with Python's (Unicode-wide)
# notion of whitespace. Controls are removed first, so the remaining blanks are
# the ones below.
# ---------------------------------------------------------------------------
CONTROL_CHARS = r"[\x00-\x1f\x7f-\x9f]"
COLON = ":"
COLON_REPLACEMENT = " -"
UNICODE_BLANKS = r"[ \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# Leading blanks, or trailing blanks matched only from the *start* of a blank run (the
# lookbehind): a plain ``blanks+\z`` is retried at every position inside a long inner
# run of blanks, which is quadratic in the run length (40k blanks: minutes per row).
_BLANK = UNICODE_BLANKS[:-1]  # the class without its '+'
_STRIP_ENDS = rf"\A{_BLANK}+|(?<!{_BLANK}){_BLANK}+\z"

# Word characters for keyword search: letters and digits of any script.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def clean_text(text: Column) -> Column:
    """Index content from raw text.

    null/empty -> ''; controls (including newlines, so lines are glued) removed;
    ':' -> ' -'; Unicode whitespace stripped at both ends.
    """
    no_controls = F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL_CHARS, "")
    no_colons = F.regexp_replace(no_controls, COLON, COLON_REPLACEMENT)
    return F.regexp_replace(no_colons, _STRIP_ENDS, "")


def key_value_pairs(text: Column, line_sep: str = "\n", kv_sep: str = ": ") -> Column:
    """``Key: value`` lines -> ARRAY<STRUCT<key, value>>.

    Splits each line at the first separator only, so values such as URLs keep their
    colons. An array (not a map) keeps repeated keys instead of failing on them.
    """
    lines = F.filter(F.split(F.trim(text), line_sep), lambda l: F.length(F.trim(l)) > 0)
    return F.transform(
        lines,
        lambda l: F.struct(
            F.trim(F.split(l, kv_sep, 2)[0]).alias("key"),
            F.trim(F.get(F.split(l, kv_sep, 2), 1)).alias("value"),  # null where the line has no separator
        ),
    )


def key_value(pairs: Column, key: str) -> Column:
    """Value of the last line with the given key (null when absent)."""
    hits = F.filter(pairs, lambda p: p["key"] == F.lit(key))
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def tokenize(text: Column) -> Column:
    """Lower-cased word tokens of the whole text (empty strings removed).

    ``array_remove`` rather than a ``filter`` lambda: higher-order functions are
    interpreted, built-in array functions are compiled with the rest of the stage.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_SPLIT), "")
