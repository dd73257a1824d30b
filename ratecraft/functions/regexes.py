"""Named regular expressions and regex operators.

Matching follows the reference's ``re.match``: anchored at the start of the
string (a prefix match), expressed as ``^(?:pattern)`` for Spark's find-based
``rlike`` / ``regexp_extract``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's named patterns, in its order.  Five are
# changed for Java regex (Q15), each change noted beside the pattern:
#   mobile_au, mobile_nz, file_documents — the alternation is grouped so that
#   ^ and $ bind to every branch; mobile_nz — the literal "{2-5}" is {2,5};
#   file_documents — the stray "(pdf)?g" branch is read as "pdf";
#   has_non_word, non_word_non_space — word and space classes are spelled out,
#   as Java's \w and \s know ASCII only.
PATTERNS = {
    "email": r"^([a-zA-Z0-9_\-\.']+)@((\[[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.)|(([a-zA-Z0-9\-]+\.)+))([a-zA-Z]{2,10}|[0-9]{1,3})(\]?)$",
    "time_24h": r"^[0-9]{2}:[0-9]{2}$",
    "mobile_au": r"^(?:([+][0-9]{2}[0-9]{9})|([0-9]{10}|([0-9]{4}[ ]{1}[0-9]{3}[ ]{1}[0-9]{3})|([+][0-9]{2}[0-9]{3}[ ]{1}[0-9]{3}[ ]{1}[0-9]{3})))$",
    "mobile_nz": r"^(?:([+][0-9]{2}[0-9]{6,9})|([0-9]{8,11}|([0-9]{3}[ ]{1}[0-9]{3}[ ]{1}[0-9]{2,5})|([+][0-9]{3}[ ]{1}[0-9]{3}[ ]{1}[0-9]{2,5})))$",
    "file_csv": r"^.+\.[cC][sS][vV]$",
    "file_text": r"^.+\.[tT][xX][tT]$",
    "file_excel_any": r"^.+\.[xX][lL][sS]([xX])?$",
    "file_xls": r"^.+\.[xX][lL][sS]$",
    "file_xlsx": r"^.+\.[xX][lL][sS][xX]$",
    "file_pdf": r"^.+\.[pP][dD][fF]$",
    "file_doc": r"^.+\.[dD][oO][cC]([xX])?$",
    "file_images": r"^.+\.(([jJ][pP]([eE])?[gG])|([pP][nN][gG])|([gG][iI][fF])|([bB][mM][pP]))$",
    "file_documents": r"^.+\.(?:[pP][dD][fF]|[xX][lL][sS]([xX])?|[dD][oO][cC]([xX])?|([tT][xX][tT]))$",
    "has_upper": r"[A-Z]",
    "has_lower": r"[a-z]",
    "has_digit": r"[0-9]",
    "has_non_word": r"[^\p{L}\p{N}_]",
    "punctuation_symbol": r"[\'\"\?\!\(\)\.\;\:]",
    "non_word_non_space": r"[^\p{L}\p{N}_\s\p{Z}]",
}

# The e-mail pattern without its anchors, for finding every address in a text.
EMAIL_FIND = PATTERNS["email"][1:-1]


def anchored(pattern: str) -> str:
    return pattern if pattern.startswith("^") else f"^(?:{pattern})"


def matches(c: Column, pattern: str) -> Column:
    """``re.match`` semantics (prefix match)."""
    return c.rlike(anchored(pattern))


def find_all(c: Column, pattern: str, group: int = 0) -> Column:
    """Every non-overlapping match, left to right."""
    return F.regexp_extract_all(c, F.lit(pattern), group)


def match_groups(c: Column, pattern: str, groups: list[int]) -> list[Column]:
    """Capture groups of a prefix match ('' when a group did not take part)."""
    p = anchored(pattern)
    return [F.regexp_extract(c, p, g) for g in groups]


def scorecard(cases: DataFrame, pattern: str, string_col: str = "string",
              expected_col: str = "expected") -> DataFrame:
    """Pass count of should-match / should-skip strings for one pattern."""
    ok = matches(F.col(string_col), pattern) == F.col(expected_col)
    return cases.agg(F.count_if(ok).alias("passed"), F.count(F.lit(1)).alias("total"))


def capture_scorecard(cases: DataFrame, pattern: str, n_groups: int, string_col: str = "string",
                      expected_col: str = "expected", groups_col: str = "groups") -> DataFrame:
    """As C35; a matched string also needs its capture groups to equal the
    expected array (when one is given)."""
    got = F.array(*match_groups(F.col(string_col), pattern, list(range(1, n_groups + 1))))
    m = matches(F.col(string_col), pattern)
    ok = F.when(F.col(expected_col) & m,
                F.col(groups_col).isNull() | (got == F.col(groups_col))) \
        .otherwise(m == F.col(expected_col))
    return cases.agg(F.count_if(ok).alias("passed"), F.count(F.lit(1)).alias("total"))
