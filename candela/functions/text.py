"""Recipient address predicates and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candela.schemas import EMAIL_PATTERN

# The source tests a whole-string match.  Java's ``$`` also matches before a
# final line break, so the Spark form anchors on the true end ``\z`` instead.
EMAIL_FULL_MATCH = EMAIL_PATTERN[:-1] + r"\z"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Blank as the JVM's String.trim sees it: only characters up to U+0020.
BLANK = r"^[\x00-\x20]*\z"


def email_reason(col: str | Column) -> Column:
    """NULL for a valid address, else ``'null'``, ``'blank'`` or ``'pattern'``."""
    c = _c(col)
    return (
        F.when(c.isNull(), F.lit("null"))
        .when(c.rlike(BLANK), F.lit("blank"))
        .when(~c.rlike(EMAIL_FULL_MATCH), F.lit("pattern"))
    )


def is_valid_email(col: str | Column) -> Column:
    return F.coalesce(email_reason(col).isNull(), F.lit(False))


def email_user(col: str | Column) -> Column:
    """Part before the first ``@`` (NULL when there is no ``@``)."""
    parts = F.split(_c(col), "@", 2)
    return F.when(F.size(parts) == 2, parts[0])


def email_domain(col: str | Column) -> Column:
    """Part after the first ``@`` (NULL when there is no ``@``)."""
    parts = F.split(_c(col), "@", 2)
    return F.when(F.size(parts) == 2, parts[1])
