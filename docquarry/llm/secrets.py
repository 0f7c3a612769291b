"""Secret scans: patterns of known secrets, and strings whose sliding-window entropy is high.

A candidate string is a run of 20 or more base64 or hex characters. A window of ``WINDOW`` characters
slides over it; the window's character counts change by one character in and one out, and so does
``sum(c * log2(c))``, from which Shannon's entropy follows. The threshold depends on the character
class of the candidate (hex or base64). Candidates that an allow-list names are suppressed, and words
that it names are no part of a candidate.

Everything is a DataFrame expression over one row: no shuffle, no Python on the executors.

Defined results: a null or empty text holds no secrets. Repeated rows are reported once each. Columns
of the input other than the text pass through untouched; the operator's own columns replace input
columns of the same name. Long texts are scanned whole. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Pattern(NamedTuple):
    """A regular expression; the match counts if its ``group`` has ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# The published patterns of the scan.
PATTERNS = (
    Pattern(
        "assign",
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Pattern("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs of 32 or more: a shorter run never counts, so the regex itself may demand the length.
    Pattern("hex", r"[0-9a-f]{32,}", 0, 32),
)

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
HEX_ONLY = r"^[0-9A-Fa-f]+$"
# Bits per character that a window must reach.
THRESHOLDS = {"hex": 3.0, "base64": 3.9}
# Whole candidates that are no secrets: strings without a digit or without a letter (words, rules,
# numbers), and identifiers in UUID form.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
# Runs of the digits or the alphabet, and stated examples, in either case: candidates end before them and
# begin anew after them, so a key next to one is still found.
ALLOWED_WORDS = ("0123456789", "abcdefghij", "example")
# c * log2(c) in millionths, as integers, so that sums do not depend on their order.
WEIGHTS = [round(c * math.log2(c) * 1_000_000) if c else 0 for c in range(WINDOW + 1)]

SPANS = "array<struct<start:int,end:int,value:int>>"


def most_weight(bits: float) -> int:
    """The largest weight sum of a window with at least that entropy."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * 1_000_000)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, regex: str, group: int) -> Column:
    """The leftmost non-overlapping matches: start, end (code points) and the length of the group.

    The texts between the matches and the matches themselves, laid end to end, give the places.
    """

    def places(parts: Column) -> Column:
        zipped = F.arrays_zip(parts["gaps"], parts["hits"], parts["groups"])

        def place(state: Column, item: Column) -> Column:
            start = state["at"] + F.length(item["gaps"])
            end = start + F.coalesce(F.length(item["hits"]), F.lit(0))
            span = F.struct(start.alias("start"), end.alias("end"), F.length(item["groups"]).alias("value"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(zipped, empty, place, lambda s: F.filter(s["out"], lambda x: x["value"].isNotNull()))

    parts = F.struct(
        F.split(text, regex, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("groups"),
    )
    return F.when(text.rlike(regex), _bound(parts, places)).otherwise(F.array().cast(SPANS))


def _labelled(spans: Column, kind: str, order: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: s["value"] >= least)


def dense_window(candidate: Column) -> Column:
    """First start and last end of the windows whose entropy reaches the class's threshold, or nulls."""
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    limit = F.when(candidate.rlike(HEX_ONLY), most_weight(THRESHOLDS["hex"])).otherwise(
        most_weight(THRESHOLDS["base64"])
    )

    def slide(bound: Column) -> Column:
        codes = bound["codes"]

        def step(state: Column, place: Column) -> Column:
            code = F.get(codes, place)
            gone = F.coalesce(F.get(codes, place - WINDOW), F.lit(-1))
            n_in, n_out = F.get(state["counts"], code), F.get(state["counts"], gone)
            counts = F.transform(
                state["counts"],
                lambda n, j: n + (j == code).cast("int") - (j == gone).cast("int"),
            )
            grown = F.get(weights, n_in + 1) - F.get(weights, n_in)
            shrunk = F.get(weights, n_out) - F.get(weights, n_out - 1)
            weight = state["weight"] + F.when(code == gone, 0).otherwise(grown - F.coalesce(shrunk, F.lit(0)))
            dense = (place >= WINDOW - 1) & (weight <= bound["limit"])
            return F.struct(
                counts.alias("counts"),
                weight.alias("weight"),
                F.coalesce(state["first"], F.when(dense, place - (WINDOW - 1))).alias("first"),
                F.coalesce(F.when(dense, place + 1), state["last"]).alias("last"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), 128).alias("counts"),
            F.lit(0).cast("long").alias("weight"),
            F.lit(None).cast("int").alias("first"),
            F.lit(None).cast("int").alias("last"),
        )
        places = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(places, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    codes = F.transform(F.split(candidate, "(?!$)", -1), F.ascii)
    return _bound(F.struct(codes.alias("codes"), limit.cast("long").alias("limit")), slide)


def dense_spans(text: Column) -> Column:
    """Spans of high entropy in candidates that the allow-list does not name."""
    allowed = "|".join(f"(?:{rule})" for rule in ALLOWED)
    # Blanks of the same length instead of allowed words keep all places.
    open_text = text
    for word in ALLOWED_WORDS:
        open_text = F.regexp_replace(open_text, f"(?i){word}", " " * len(word))
    # A candidate's text is cut out by place, so only candidates that stay are cut.
    hits = located(open_text, CANDIDATE, 0)

    def judged(span: Column) -> Column:
        value = F.substring(text, span["start"] + 1, span["value"])
        dense = F.when(~value.rlike(allowed), dense_window(value))
        return F.struct(
            (span["start"] + dense["first"]).alias("start"),
            (span["start"] + dense["last"]).alias("end"),
            span["value"].alias("value"),
        )

    return F.filter(F.transform(hits, judged), lambda s: s["start"].isNotNull())


def find_secrets(docs: DataFrame, text: str = "text", patterns: tuple[Pattern, ...] = PATTERNS) -> DataFrame:
    """Add ``n_<kind>`` per pattern, ``base_spans`` and ``secret_spans``: arrays of (start, order, end, kind).

    ``secret_spans`` also holds the spans of kind ``entropy``.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = {}
    for order, pattern in enumerate(patterns):
        spans = _long_enough(located(body, pattern.regex, pattern.group), pattern.least)
        found[pattern.kind] = _labelled(spans, pattern.kind, order)
    found["entropy"] = _labelled(dense_spans(body), "entropy", len(patterns))
    # One column for the spans by kind, of a name that the input does not have.
    own = "spans"
    while own in docs.columns:
        own += "_"
    rows = docs.withColumn(own, F.struct(*[spans.alias(kind) for kind, spans in found.items()]))
    base = F.array_sort(F.concat(*[F.col(own)[p.kind] for p in patterns]))
    rows = rows.withColumns(
        {f"n_{p.kind}": F.size(F.col(own)[p.kind]).cast("long") for p in patterns}
        | {"base_spans": base, "secret_spans": F.array_sort(F.concat(base, F.col(own)["entropy"]))}
    )
    return rows.drop(own)


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", length: str | None = None) -> DataFrame:
    """Replace every secret by a mark; overlapping spans go together, null texts stay null, other columns too.

    ``length`` names a column that holds the number of characters and is set anew where the text changes.
    """
    found = find_secrets(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).cast("string").alias("body")), "body")

    def put(state: Column, span: Column) -> Column:
        between = F.substring(F.col("body"), state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col("body"), state["at"] + 1, F.length("body") - state["at"]))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.when(F.size("secret_spans") > 0, F.aggregate("secret_spans", start, put, rest)).otherwise(F.col("body"))
    rows = found.select("row", clean.alias("clean"), (F.size("secret_spans") > 0).alias("changed"))
    columns = {c: F.col("row")[c] for c in docs.columns} | {text: F.col("clean")}
    if length in columns:
        kind = docs.schema[length].dataType
        columns[length] = F.when(F.col("changed"), F.length("clean").cast(kind)).otherwise(columns[length])
    return rows.select(*[column.alias(name) for name, column in columns.items()])
