"""Review tags → 0/1 labels, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's sets for right results.
# Tags are compared after normalize_tag (lower case, no blanks, '-' or '_').
MALWARE_TAGS = ["malware", "malicious", "confirmedmalware"]
BENIGN_TAGS = ["falsepositive", "benign", "clean", "nonmalware", "legit", "whitelisted"]
UNREVIEWED_TAGS = ["unreviewed", "unknown", "pendingreview", "needsreview", "unverified"]
# Values accepted by the opt-in numeric_labels mode (not in the reference).
NUMERIC_POSITIVE = ["1", "true"]
NUMERIC_NEGATIVE = ["0", "false"]
# ---------------------------------------------------------------------------

POLICIES = ("drop", "benign", "malicious", "separate")

# (?U) makes \s Unicode-aware, so NBSP and U+3000 count as blanks, as they do
# for Python's str.strip() and re's \s.
_EDGE_BLANKS = r"(?U)^\s+|\s+$"
_TAG_NOISE = r"(?U)[\s\-_]+"


def strip_blanks(c: Column) -> Column:
    """Strip Unicode white space at both ends (``trim`` strips only U+0020)."""
    return F.regexp_replace(c.cast("string"), _EDGE_BLANKS, "")


def normalize_tag(c: Column) -> Column:
    """Strip, lower-case, then delete every run of blanks, '-' and '_'."""
    return F.regexp_replace(F.lower(strip_blanks(c)), _TAG_NOISE, "")


def tag_class(tag: Column, numeric_labels: bool = False) -> Column:
    """'malware' | 'benign' | 'unreviewed' | 'other' for a normalized tag.

    Order matters and follows the reference: malware, benign, unreviewed.
    """
    mal = tag.isin(MALWARE_TAGS)
    ben = tag.isin(BENIGN_TAGS)
    if numeric_labels:
        mal = mal | tag.isin(NUMERIC_POSITIVE)
        ben = ben | tag.isin(NUMERIC_NEGATIVE)
    return (F.when(mal, F.lit("malware"))
            .when(ben, F.lit("benign"))
            .when(tag.isin(UNREVIEWED_TAGS), F.lit("unreviewed"))
            .otherwise(F.lit("other")))


def tag_label(tag: Column, policy: str = "drop", numeric_labels: bool = False) -> Column:
    """0/1 label under an unreviewed policy; null means 'not a labelled row'.

    Unknown tags fall to 0, as in the reference.
    """
    if policy not in POLICIES:
        raise ValueError(f"unreviewed policy must be one of {POLICIES}, got {policy!r}")
    cls = tag_class(tag, numeric_labels)
    unrev = {"benign": F.lit(0), "malicious": F.lit(1)}.get(policy, F.lit(None))
    return (F.when(cls == "malware", F.lit(1))
            .when(cls == "benign", F.lit(0))
            .when(cls == "unreviewed", unrev)
            .otherwise(F.lit(0))).cast("int")
