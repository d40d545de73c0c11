"""What a logged statement is, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, comments and the opening of version comments before a statement; `/*!NNNNN` opens real text.
LEADING = r"^(?:\s+|/\*![0-9]*|/\*(?s:.*?)\*/|(?:#|-- |--\t)[^\n]*\n)*+"
#: What is left when a comment has no end.
UNENDED = r"^(?:/\*|#|-- |--\t)"


def statement_start(query: Column) -> Column:
    """The text from the statement's first word on; empty if a comment before it has no end."""
    rest = F.regexp_replace(query, LEADING, "")
    return F.when(rest.rlike(UNENDED), F.lit("")).otherwise(rest)


def is_ddl(query: Column) -> Column:
    return statement_start(query).rlike(r"(?i)^(?:create|alter|drop|truncate|rename)")


def query_kind(query: Column) -> Column:
    """begin, commit, rollback, ddl or other."""
    text = F.upper(F.regexp_replace(statement_start(query), r"\s*;*\s*$", ""))
    return (
        F.when(text.isin("BEGIN", "START TRANSACTION"), "begin")
        .when(text == "COMMIT", "commit")
        .when(text == "ROLLBACK", "rollback")
        .when(text.rlike("^XA (?:START|BEGIN)"), "begin")
        .when(text.rlike("^(?:CREATE|ALTER|DROP|TRUNCATE|RENAME)"), "ddl")
        .otherwise("other")
    )


def opens_transaction(query: Column) -> Column:
    """Whether the last two words are START TRANSACTION: the statement's rows and commit follow it."""
    return query.rlike(r"(?i)(?:^|\s)start\s+transaction\s*;*\s*$")
