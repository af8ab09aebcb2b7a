"""Text expressions with the exact split, trim and tokenising rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters up to and including the space, which the wide
# trim strips; and the characters of a word token.
BLANKS = "".join(chr(code) for code in range(0x21))
NON_WORD = r"\W+"


def wide_trim(text: Column) -> Column:
    """Strip every character up to U+0020 at both ends (``F.trim`` strips spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def split_dropping_tail(text: Column, separator: str) -> Column:
    """Split at a one-character separator and drop the empty parts at the end.

    Inner empty parts stay.  The empty text gives one empty part, and a text of
    separators only gives none.
    """
    head = F.rtrim(text, F.lit(separator))
    nothing = F.array().cast("array<string>")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(head == "", nothing)
        .otherwise(F.split(head, "[" + separator + "]"))
    )


def recipients(to: Column) -> Column:
    """Recipient list of a ``To`` value: split, wide trim, lower case."""
    return F.transform(split_dropping_tail(to, ","), lambda part: F.lower(wide_trim(part)))


def recipients_verbatim(to: Column) -> Column:
    """Recipient list in the SQL flavour: empty parts and case stay, only spaces are trimmed."""
    return F.transform(F.split(to, ","), lambda part: F.trim(part))


def clean_body(text: Column) -> Column:
    """Delete apostrophes and turn every run of non-word characters into one space.

    Not trimmed, and the case is kept.  Word characters are the ASCII letters,
    digits and the underscore.
    """
    return F.regexp_replace(F.replace(text, F.lit("'"), F.lit("")), NON_WORD, " ")


def domain_of(address: Column) -> Column:
    """What follows the last ``@``; the whole text if there is none.  Case is kept."""
    return F.regexp_replace(address, ".*@", "")


def sentiment_tokens(body: Column) -> Column:
    """Lower-case word tokens as the scorer sees them (an empty token may be first or last).

    A cleaned body is split as it is.
    """
    clean = body.rlike(r"\A[\w ]*+\z") & ~body.contains("  ")
    return F.split(F.lower(F.when(clean, body).otherwise(F.regexp_replace(body, NON_WORD, " "))), " ")


def keyword_tokens(body: Column) -> Column:
    """Lower-case tokens between white space, each wide-trimmed (some may be empty).

    A text whose only blanks are spaces, as every cleaned body, takes a plain
    split without any trim.  One match of the whole text is several times faster than
    a search that tries every place anew.
    """
    lower = F.lower(body)
    trimmed = F.transform(F.split(lower, r"\s+"), wide_trim)
    return F.when(~body.rlike(r"\A[^\x00-\x1f]*+\z"), trimmed).otherwise(F.split(lower, " "))


def first_sentence_words(body: Column) -> Column:
    """Words of the first sentence; null (not an error) when there is none.

    A cleaned body holds no sentence mark and so is one sentence.
    """
    return F.get(F.sentences(body), F.lit(0))


def sql_literals(words: list[str]) -> str:
    """Comma-separated string literals, for one ``IN (...)`` list parsed in one go."""
    return ", ".join("'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'" for word in words)
