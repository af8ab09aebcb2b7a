"""Expressions that take a raw message apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unix_lines(text: Column) -> Column:
    """CRLF and CR become LF (plain replaces: no regular expression over the whole text)."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def without_tail(text: Column) -> Column:
    """The text without its empty lines at the end."""
    return F.rtrim(text, F.lit("\n"))


def header_block(text: Column) -> Column:
    """Lines before the first empty line; a line of blanks does not end the headers."""
    return F.when(text.startswith("\n"), F.lit("")).otherwise(F.substring_index(text, "\n\n", 1))


def after_head(text: Column, head: Column) -> Column:
    """What follows the header block, from the empty line on.

    ``text`` must come from :func:`without_tail`.
    """
    return F.substr(text, F.length(head) + 1)


def body_lines(rest: Column) -> Column:
    """The rest with its last line ended again; empty if there is no text."""
    return F.when(rest == "", rest).otherwise(F.concat(rest, F.lit("\n")))


def unfold(head: Column) -> Column:
    """Join each line that starts with a space or tab to the line before it."""
    return F.regexp_replace(head, r"\n(?=[ \t])", "")


def header(head: Column, name: str) -> Column:
    """Value of the first line ``name: value`` whose trimmed value is not empty, else null.

    The name is matched as written: case-sensitive and at the start of a line.
    """
    value = rf"(?:\A|\n){name}:[\x00-\x09\x0b-\x20]*+([^\x00-\x20](?:[^\n]*[^\x00-\x20])?)"
    return F.nullif(F.regexp_extract(head, value, 1), F.lit(""))
