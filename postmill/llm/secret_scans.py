"""Secret scans with an incremental ledger of blobs.

Texts are addressed by their SHA-256, so every historical version and every path with
the same content is one blob.  A blob is scanned once for each version of the rules;
the ledger remembers the pairs, and findings are joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import written


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost first without overlap, of which those stay whose
    ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int
    least: int


#: The base rules, in the order of the digest; then those that the method adds.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),  # the same as all runs of one and more, then 24 and more
)
#: What may stand between the lines of a key: white space, escaped line ends, quotes and the like.
_BETWEEN = r"""(?:[\s"'`>,;|#*]|\\[nrt])"""
#: A key to its END line; if that is missing, its headers and base64 lines, the last of
#: which may be short.  All loops are possessive, so that no text makes them go back.
_PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:{_BETWEEN}*+(?:(?:Proc-Type|DEK-Info|Version|Comment):[^\r\n\\]*+|[A-Za-z0-9+/=]{{20,}}+))++"
    rf"(?:{_BETWEEN}++[A-Za-z0-9+/=]{{1,19}}+(?=\s*$|[\r\n\"'`\\]))?"
    rf"|{_BETWEEN}*+[A-Za-z0-9+/=]{{1,19}}+(?=\s*$)"
    r"|)"
)
ADDED_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    SecretRule("private_key", _PRIVATE_KEY, 0, 1),
    SecretRule("credentials", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]*+:([^\s/:@]{3,}+)@", 1, 3),
)
RULES = BASE_RULES + ADDED_RULES
RULE_VERSION = "1.1"

SPAN = "struct<start: bigint, rank: int, kind: string, end: bigint>"
LEDGER_SCHEMA = f"blob string, rule_version string, spans array<{SPAN}>"


def rule_spans(text: Column, rule: SecretRule, rank: int) -> Column:
    """Spans (start, rank, kind, end) of one rule, in code points, end exclusive.

    The text is split at the matches: a match begins after all pieces and matches
    before it.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
    matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m))
    steps = F.arrays_zip(
        F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), matches.alias("match"), kept.alias("kept")
    )
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("spans")),
        lambda so_far, step: F.struct(
            (so_far["at"] + step["piece"] + step["match"]).alias("at"),
            F.when(
                step["kept"] >= rule.least,
                F.concat(
                    so_far["spans"],
                    F.array(
                        F.struct(
                            (so_far["at"] + step["piece"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"),
                            (so_far["at"] + step["piece"] + step["match"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(so_far["spans"])
            .alias("spans"),
        ),
        lambda end: end["spans"],
    )
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    return F.when(F.coalesce(text.rlike(rule.pattern), F.lit(False)), walked).otherwise(none)


def text_spans(text: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """All spans of a text, by start and then by the order of the rules."""
    return F.array_sort(F.concat(*[rule_spans(text, rule, rank) for rank, rule in enumerate(rules)]))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_new(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    text: str = "text",
    rules: tuple[SecretRule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Ledger rows of the blobs that have not been scanned with this version of the rules.

    Copies of a blob are combined before the shuffle, so repeated rows, and different paths
    or versions of one text, give one row.  A null text is the empty blob; an empty table,
    or one whose blobs are all in the ledger, gives no rows.  Only the column ``text`` is
    read.  The rows are stored, as the ledger's next part: append them to it.
    """
    blobs = versions.select(
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"), blob_of(F.col(f"`{text}`")).alias("blob")
    ).dropDuplicates(["blob"])
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    found = blobs.select(
        "blob", F.lit(rule_version).alias("rule_version"), text_spans(F.col("content"), rules).alias("spans")
    )
    return written(found)


def with_findings(
    paths: DataFrame, ledger: DataFrame, text: str = "text", rule_version: str = RULE_VERSION
) -> DataFrame:
    """``paths`` (or versions) and the ``spans`` found in their content.

    The new column replaces one of its name, whatever the case; other columns may have any
    name but ``__blob`` and ``__spans``.  A null text is empty; texts without findings have
    an empty array; equal texts, whatever their path, have equal spans, repeated rows
    included.  An empty table gives no rows.
    """
    found = ledger.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0))
    found = found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    kept = [f"`{c}`" for c in paths.columns if c.lower() != "spans"]
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    joined = paths.withColumn("__blob", blob_of(F.col(f"`{text}`"))).join(found, "__blob", "left")
    return joined.select(*kept, F.coalesce("__spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mask."""
    walked = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda so_far, span: F.struct(
            F.when(span["start"] < so_far["at"], so_far["out"])
            .otherwise(
                F.concat(
                    so_far["out"],
                    F.substring(text, (so_far["at"] + 1).cast("int"), (span["start"] - so_far["at"]).cast("int")),
                    F.lit(mask),
                )
            )
            .alias("out"),
            F.greatest(so_far["at"], span["end"]).alias("at"),
        ),
    )
    rest = F.substring(text, (walked["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(walked["out"], rest)).otherwise(text)


def mask_documents(docs: DataFrame, ledger: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with masked texts and no other change; texts without findings stay as they are."""
    probe = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("probed"))
    found = with_findings(probe, ledger, "probed")
    clean = masked(F.col("probed"), F.col("spans"), mask)
    return found.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
