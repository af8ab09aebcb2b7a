"""License scans: an exact set-similarity join of text blocks with license templates.

A text's words are cut into overlapping blocks that are long enough to hold any template
of their kind whole.  A block meets a template if it holds a given share of the
template's different words (containment).  Words are ordered by the number of documents
that hold them, rarest first.  A pair that reaches the share must have its first common
word early in both orders, so only a few rare words of each template are looked up
(prefix filter), in blocks with enough words (length filter), at places that leave enough
words to come (positional filter).  Pairs that pass are counted in full.

Templates that are phrases need all of their words, and then their places: the words one
after the other.  Only built-in functions run.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import ASCII_LOWER, ASCII_UPPER, written

#: Runs of ASCII letters, digits and all characters beyond ASCII, of either case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of which one block of phrases answers for the beginnings.
PHRASE_STRIDE = 32


@dataclass(frozen=True)
class Template:
    """``containment``: the share of the different words that a block must hold.  A phrase
    must stand word by word; ``base`` templates are those that a contract fixes."""

    label: str
    text: str
    containment: float = 1.0
    phrase: bool = True
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(ASCII_UPPER, ASCII_LOWER)))

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def need(self) -> int:
        """Different words that a block must hold at least."""
        return max(1, math.ceil(self.containment * len(self.tokens) - 1e-9))


BASE_TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
#: Names of further licenses, and what their notices say.
ADDED_TEMPLATES = (
    Template("gpl", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("cc-by-sa", "cc by sa"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the software",
        0.8,
        phrase=False,
    ),
    Template(
        "apache-2",
        "Unless required by applicable law or agreed to in writing, software distributed under the license is "
        "distributed on an as is basis, without warranties or conditions of any kind, either express or implied. "
        "See the license for the specific language governing permissions and limitations under the license.",
        0.8,
        phrase=False,
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the gnu "
        "general public license as published by the free software foundation, either version 3 of the license, "
        "or at your option any later version.",
        0.8,
        phrase=False,
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
        0.8,
        phrase=False,
    ),
)
TEMPLATES = BASE_TEMPLATES + ADDED_TEMPLATES

FOUND = "label string, base boolean, places bigint, first_word bigint, last_word bigint, score double"


@dataclass(frozen=True)
class _Kind:
    """Blocks for templates of about one length: a block answers for ``stride`` beginnings
    and reaches over the longest template that begins there."""

    name: str
    templates: tuple[tuple[int, Template], ...]
    stride: int

    @property
    def reach(self) -> int:
        return self.stride + max(len(t.words) for _, t in self.templates) - 1

    @property
    def vocabulary(self) -> list[str]:
        return sorted({w for _, t in self.templates for w in t.words})

    @property
    def least(self) -> int:
        return min(t.need for _, t in self.templates)


def _kinds(templates: tuple[Template, ...]) -> list[_Kind]:
    numbered = list(enumerate(templates))
    phrases = tuple((i, t) for i, t in numbered if t.phrase)
    notices = tuple((i, t) for i, t in numbered if not t.phrase)
    out = [_Kind("phrases", phrases, PHRASE_STRIDE)] if phrases else []
    if notices:
        out.append(_Kind("notices", notices, max(len(t.words) for _, t in notices)))
    return out


def _lower(word: Column) -> Column:
    """A-Z alone is lower-cased: a word of which more would change keeps its other case,
    and can't equal a template's word, which is ASCII."""
    lower = F.lower(word)
    return F.when(F.octet_length(lower) == F.octet_length(word), lower).otherwise(word)


def blocks(words: Column, kind: _Kind) -> Column:
    """Blocks with enough words of the templates: ``block``, and of those words ``at`` (places
    in the block) and ``token``."""
    count = F.ceil(F.size(words) / kind.stride).cast("int")
    inside = F.lit(kind.vocabulary)

    def block(k: Column) -> Column:
        part = F.slice(words, k * kind.stride + 1, F.lit(kind.reach))
        cells = F.filter(
            F.transform(part, lambda w, at: F.struct(at.alias("at"), w.alias("token"))),
            lambda cell: cell["token"].isin(kind.vocabulary),
        )
        return F.struct(k.alias("block"), cells.alias("cells"))

    every = F.when(F.arrays_overlap(words, inside), F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    made = F.transform(every, block)
    return F.filter(made, lambda b: F.size(F.array_distinct(b["cells"]["token"])) >= kind.least)


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> DataFrame:
    """A stored row for each row of ``docs``, without its text: ``n_words``, the templates' words
    that it holds, and its blocks of each kind."""
    new = {"n_words", "found", "vocabulary", "__row", text.lower(), *[kind.name for kind in _kinds(templates)]}
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in new]
    vocabulary = sorted({w for t in templates for w in t.words})
    words = F.regexp_extract_all(F.coalesce(docs[f"`{text}`"], F.lit("")), F.lit(WORD), F.lit(0))
    # A generator of one row: the words are made once, not again for each use in a lambda.
    once = docs.select(*kept, F.inline(F.array(F.struct(F.transform(words, _lower).alias("__words")))))
    return written(
        once.select(
            *kept,
            F.monotonically_increasing_id().alias("__row"),
            F.size("__words").cast("long").alias("n_words"),
            F.array_distinct(F.filter("__words", lambda w: w.isin(vocabulary))).alias("vocabulary"),
            *[blocks(F.col("__words"), kind).alias(kind.name) for kind in _kinds(templates)],
        )
    )


def token_order(rows: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """The templates' words, those of the fewest documents first: one row a word is collected."""
    counts = rows.select(F.explode("vocabulary").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    held = {row["token"]: row["n"] for row in counts.collect()}
    return sorted({w for t in templates for w in t.words}, key=lambda w: (held.get(w, 0), w))


def _index(spark, kind: _Kind, order: list[str]) -> DataFrame:
    """The prefix words of each template: those of which a block with enough words has one."""
    place = {w: i for i, w in enumerate(order)}
    entries = []
    for number, template in kind.templates:
        tokens = sorted(template.tokens, key=place.__getitem__)
        for p, token in enumerate(tokens[: len(tokens) - template.need + 1]):
            entries.append((token, number, p, len(tokens), template.need, tokens, template.words))
    schema = "token string, template int, p int, size int, need int, tokens array<string>, words array<string>"
    return spark.createDataFrame(entries, schema)


def candidates(rows: DataFrame, kind: _Kind, order: list[str]) -> DataFrame:
    """Pairs of a block and a template that reach the template's containment, each once:
    ``__row``, ``block``, ``template``, ``overlap``, ``size``, ``words`` and the block's ``cells``."""
    index = _index(rows.sparkSession, kind, order)
    ordered = F.lit([w for w in order if w in set(kind.vocabulary)])
    prefix = sorted({row["token"] for row in index.select("token").collect()})
    block = rows.select("__row", F.inline(kind.name))
    tokens = block.withColumn("tokens", F.filter(ordered, lambda w: F.array_contains(F.col("cells.token"), w)))
    # The block's own prefix: with fewer words to come, no template can be reached.
    early = F.slice("tokens", F.lit(1), F.size("tokens") - kind.least + 1)
    marks = F.filter(
        F.transform(early, lambda w, q: F.struct(q.alias("q"), w.alias("token"))), lambda m: m["token"].isin(prefix)
    )
    looked_up = tokens.select("__row", "block", "cells", F.col("tokens").alias("held"), F.inline(marks))
    met = looked_up.join(F.broadcast(index), "token")  # as many rows as the templates have words, at most
    passed = met.where(F.size("held") >= F.col("need")).where(
        1 + F.least(F.col("size") - F.col("p") - 1, F.size("held") - F.col("q") - 1) >= F.col("need")
    )
    overlap = F.size(F.array_intersect("held", "tokens"))
    full = passed.withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
    # Met through several words, a pair is taken at its first common word alone.
    first = F.get(F.array_intersect("tokens", "held"), F.lit(0)) == F.col("token")
    return full.where(first).select("__row", "block", "template", "overlap", "size", "words", "cells")


def places(pairs: DataFrame, kind: _Kind) -> DataFrame:
    """Where a phrase's words stand one after the other: ``starts``, counted from the text's
    first word; a place belongs to the block in whose stride it begins."""

    def stands(i: Column) -> Column:
        cell = F.get("cells", i)
        follow = F.transform("words", lambda w, d: (F.get("cells", i + d)["at"] == cell["at"] + d) & (F.get("cells", i + d)["token"] == w))
        return (cell["at"] < kind.stride) & F.forall(follow, lambda ok: F.coalesce(ok, F.lit(False)))

    begins = F.filter(F.sequence(F.lit(0), F.size("cells") - 1), stands)
    starts = F.transform(begins, lambda i: F.col("block").cast("long") * kind.stride + F.get("cells", i)["at"])
    return pairs.withColumn("starts", starts).where(F.size("starts") > 0)


def _summed(pairs: DataFrame) -> DataFrame:
    """One row for each document and template."""
    return pairs.groupBy("__row", "template").agg(
        F.sum(F.size("starts")).alias("places"),
        F.min(F.array_min("starts")).alias("first_word"),
        F.max(F.array_max("starts")).alias("last_word"),
        F.max(F.col("overlap") / F.col("size")).alias("score"),
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> DataFrame:
    """``docs`` without its text, ``n_words``, and ``found``: for each template that it meets, in
    the templates' order, a struct ``FOUND``.

    ``places`` counts where a phrase stands, or the blocks that reach a notice's
    containment; ``first_word`` and ``last_word`` are the smallest and the greatest
    beginning, in words from 0 (of a notice: of its block); ``score`` is the greatest
    containment.  The new columns replace columns of their names.

    A null or empty text has no words and finds nothing.  Whole texts are cut into
    blocks, however long; repeated rows each have their own, equal, result, and an
    empty table gives no rows.  Templates without any word raise ``ValueError``.
    """
    if not all(t.words for t in templates):
        raise ValueError("a template has no words")
    rows = scanned(docs, templates, text)
    order = token_order(rows, templates)
    parts = []
    for kind in _kinds(templates):
        pairs = candidates(rows, kind, order)
        block_start = F.array(F.col("block").cast("long") * kind.stride)
        parts.append(_summed(places(pairs, kind) if kind.name == "phrases" else pairs.withColumn("starts", block_start)))
    kept = [f"`{c}`" for c in rows.columns if c not in {"__row", "vocabulary", *[kind.name for kind in _kinds(templates)]}]
    none = F.expr(f"cast(array() as array<struct<{_typed(FOUND)}>>)")
    if not parts:
        return rows.select(*kept, none.alias("found"))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    labels, bases = F.lit([t.label for t in templates]), F.lit([t.base for t in templates])
    cell = F.struct(
        "template", F.get(labels, F.col("template")).alias("label"), F.get(bases, F.col("template")).alias("base"),
        "places", "first_word", "last_word", "score",
    )
    # At most one cell a template.
    found = every.groupBy("__row").agg(F.array_sort(F.collect_list(cell)).alias("__found"))
    shown = F.transform("__found", lambda c: F.struct(*[c[n].alias(n) for n in ("label", "base", "places", "first_word", "last_word", "score")]))
    return rows.join(found, "__row", "left").select(*kept, F.coalesce(shown, none).alias("found"))


def _typed(fields: str) -> str:
    return ", ".join(": ".join(field.split()) for field in fields.split(","))
