"""Secret scans: fixed patterns plus sliding-window Shannon entropy, in Spark expressions only.

Base kinds are leftmost non-overlapping matches of a pattern that pass a least
length. The method then looks at candidate strings, maximal runs of one
character class. A window of ``WINDOW`` characters slides over each candidate;
the count of every symbol changes by one as a character enters or leaves, and
with it the sum of ``c * log2(c)`` over the counts, so the entropy

    H = log2(WINDOW) - sum(c * log2(c)) / WINDOW

costs one table look-up per step. Windows with H at or above the class's
threshold are hot; overlapping or touching hot windows make one span. The table
holds ``c * log2(c)`` in units of 2^-20 bits as integers, so sums are exact and
do not depend on the order of the steps.

Suppressed: spans of candidates that an allow-list pattern matches (words
without digits, numbers, UUIDs, checksums with a prefix, placeholders), and spans
inside a base span, which is reported already. Base spans always stay.

Everything is local to a row: no shuffle, nothing gathered, so a hot source or a
very long text costs its own length only. Defined results: a null or empty text
has no spans; repeated rows are separate rows; ``doc_id`` may be null; other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import text_or_empty

WINDOW = 20
UNIT = 1 << 20

# base kinds, fixed values: name, pattern, group whose length counts, least length, and
# strings of which a text with a match holds one. Runs of one class say their least
# length in the pattern, so that shorter runs (every letter a to f) are no matches.
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     2, 12, (":", "=")),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18, ("AKIA",)),
    ("hex", r"[0-9a-f]{16,}", 0, 16, ()),
)


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters: spans get ``kind``; ``threshold`` is in bits per character."""

    kind: str
    alphabet: str
    pattern: str
    threshold: float

    @property
    def bound(self) -> int:
        """Largest sum of ``c * log2(c)`` (in units) of a hot window."""
        return math.floor((math.log2(WINDOW) - self.threshold) * WINDOW * UNIT)


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# about what 20 random characters of the class reach: 3.3 bits (hex), 4.0 (base64)
CLASSES = (
    CharacterClass("hex_entropy", _DIGITS + "abcdefABCDEF", f"[0-9A-Fa-f]{{{WINDOW},}}", 3.0),
    CharacterClass("base64_entropy", _DIGITS + _LOWER + _UPPER + "+/_-", f"[A-Za-z0-9+/_-]{{{WINDOW},}}", 3.75),
)

# candidates that are no secrets; a pattern has to match somewhere in the candidate
ALLOW = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)^(md5|sha1|sha256|sha384|sha512)[-_]",
    r"(?i)example|sample|placeholder|dummy|changeme|x{8}",
    r"^[a-z]+([/_-][a-z]+)*[/_-]?[0-9]{0,4}$",
)

_BLOCK = 256
STEP = 512


def _starts(lengths: Column) -> Column:
    """Running sums before each element, in blocks so that no step copies a long list."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
    nothing = F.array().cast("array<int>")

    def run(values: Column, first: Column) -> Column:
        return F.aggregate(
            values, F.struct(first.alias("at"), nothing.alias("out")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    sums = F.transform(blocks, lambda v: F.aggregate(v, F.lit(0), lambda a, x: a + x))
    return F.when(F.size(lengths) > 0, F.flatten(F.zip_with(blocks, run(sums, F.lit(0)), run))).otherwise(nothing)


def _spans(df: DataFrame, text: str, pattern: str, group: int, out: str, where: Column | None = None) -> DataFrame:
    """``out``: an array of (s, e, hit) with every match of ``pattern``; ``hit`` is the text of
    ``group``. Text positions come from the pieces between the matches, in code points.
    ``where`` is a cheap test that every text with a match passes."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    df = df.withColumn("_all", hits if where is None else F.when(where, hits).otherwise(none))
    some = F.size("_all") > 0
    df = df.withColumn("_hits", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)
                       if group else F.col("_all"))
    df = df.withColumn("_gaps", F.when(some, F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size("_all")),
                                                         F.length)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_sizes", F.transform("_all", F.length))
    df = df.withColumn("_at", _starts(F.zip_with("_gaps", "_sizes", lambda g, n: g + n)))
    return df.withColumn(out, F.transform(
        F.arrays_zip("_at", "_gaps", "_sizes", "_hits"),
        lambda x: F.struct((x["_at"] + x["_gaps"]).alias("s"), (x["_at"] + x["_gaps"] + x["_sizes"]).alias("e"),
                           x["_hits"].alias("hit")))).drop("_all", "_hits", "_gaps", "_sizes", "_at")


SPAN = "struct<s:int,e:int>"


def _with_span(out: Column, s: Column, e: Column) -> Column:
    return F.concat(out, F.array(F.struct(s.alias("s"), e.alias("e"))))


def _hot_windows(symbols: Column, at: Column, n_symbols: int, bound: int) -> Column:
    """Spans (s, e) from position ``at`` on, covered by hot windows over ``symbols`` (alphabet
    indexes): those whose sum of ``c * log2(c)`` is at most ``bound``."""
    table = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("bigint") for c in range(WINDOW + 1)])

    def slide(a: Column, i: Column) -> Column:
        # i characters are in; the one that leaves (if any) has index i - 1 - WINDOW
        enters = F.get(symbols, i - 1)
        leaves = F.when(i > WINDOW, F.get(symbols, i - 1 - WINDOW)).otherwise(F.lit(-1))
        gone = F.get(a["counts"], leaves)
        had = F.get(a["counts"], enters) - (enters == leaves).cast("int")
        total = (a["total"] + F.coalesce(F.get(table, gone - 1) - F.get(table, gone), F.lit(0).cast("bigint"))
                 + F.get(table, had + 1) - F.get(table, had))
        counts = F.transform(a["counts"], lambda c, k: c + (k == enters).cast("int") - (k == leaves).cast("int"))
        closes = a["hot"] & (i - 1 - WINDOW > a["e"])  # the last window was hot and starts a new span
        return F.struct(
            counts.alias("counts"), total.alias("total"),
            ((i >= WINDOW) & (total <= bound)).alias("hot"),
            F.when(closes, i - 1 - WINDOW).otherwise(a["s"]).alias("s"),
            F.when(a["hot"], i - 1).otherwise(a["e"]).alias("e"),
            F.when(closes & (a["e"] >= 0), _with_span(a["out"], a["s"], a["e"])).otherwise(a["out"]).alias("out"))

    def last(a: Column) -> Column:
        n = F.size(symbols)
        closes = a["hot"] & (n - WINDOW > a["e"])
        out = F.when(closes & (a["e"] >= 0), _with_span(a["out"], a["s"], a["e"])).otherwise(a["out"])
        s, e = F.when(closes, n - WINDOW).otherwise(a["s"]), F.when(a["hot"], n).otherwise(a["e"])
        return F.when(e >= 0, _with_span(out, s, e)).otherwise(out)

    zero = F.struct(F.array_repeat(F.lit(0), n_symbols).alias("counts"), F.lit(0).cast("bigint").alias("total"),
                    F.lit(False).alias("hot"), F.lit(-1).alias("s"), F.lit(-1).alias("e"),
                    F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.transform(F.aggregate(F.sequence(F.lit(1), F.size(symbols)), zero, slide, last),
                       lambda y: F.struct((at + y["s"]).alias("s"), (at + y["e"]).alias("e")))


def _merged(spans: Column) -> Column:
    """Ordered spans, those that overlap or touch made one."""
    def add(a: Column, x: Column) -> Column:
        joins = x["s"] <= a["e"]
        return F.struct(
            F.when(joins, a["s"]).otherwise(x["s"]).alias("s"), F.greatest(a["e"], x["e"]).alias("e"),
            F.when(joins | (a["e"] < 0), a["out"]).otherwise(_with_span(a["out"], a["s"], a["e"])).alias("out"))

    zero = F.struct(F.lit(-1).alias("s"), F.lit(-1).alias("e"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(spans, zero, add, lambda a: F.when(a["e"] >= 0, _with_span(a["out"], a["s"], a["e"]))
                       .otherwise(a["out"]))


def _entropy_spans(df: DataFrame, candidates: str, c: CharacterClass, out: str) -> DataFrame:
    """``out``: the hot spans of the ``candidates`` (s, e, hit). Long candidates are taken in
    pieces of ``STEP`` windows, so that the sliding state stays small."""
    symbols = F.transform(candidates, lambda x: F.struct(
        x["s"].alias("s"),
        F.transform(F.split(x["hit"], ""), lambda ch: F.instr(F.lit(c.alphabet), ch) - 1).alias("sym")))
    pieces = F.flatten(F.transform("_symbols", lambda x: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x["sym"]) - WINDOW) / STEP).cast("int")),
        lambda b: F.struct((x["s"] + b * STEP).alias("s"),
                           F.slice(x["sym"], b * STEP + 1, F.lit(STEP + WINDOW - 1)).alias("sym")))))
    hot = F.flatten(F.transform("_pieces", lambda x: _hot_windows(x["sym"], x["s"], len(c.alphabet), c.bound)))
    df = df.withColumn("_symbols", symbols).withColumn("_pieces", pieces).withColumn("_hot", hot)
    return df.withColumn(out, _merged(F.col("_hot"))).drop("_symbols", "_pieces", "_hot")


def _kind(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(order).alias("k"), x["e"].alias("e"),
                                                 F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def _at_least(n: int):
    return lambda x: F.length(x["hit"]) >= n


def _matches_any(value: Column, patterns: tuple[str, ...]) -> Column:
    return F.array_contains(F.array(F.lit(False), *[value.rlike(p) for p in patterns]), True)


def find_secrets(docs: DataFrame, text_col: str = "text", classes: tuple[CharacterClass, ...] = CLASSES,
                 allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with two more columns, ``_base`` and ``_found``: arrays of (s, k, e, kind) with
    the spans of the base kinds and those the entropy windows add. Positions are
    code points of the whole text, ends are exclusive."""
    df = docs.withColumn("_text", text_or_empty(text_col))
    base = []
    for k, (kind, pattern, group, least, needs) in enumerate(BASE_KINDS):
        holds = reduce(operator.or_, [F.contains("_text", F.lit(x)) for x in needs]) if needs else None
        df = _spans(df, "_text", pattern, group, f"_{kind}", holds)
        df = df.withColumn(f"_{kind}", _kind(F.filter(f"_{kind}", _at_least(least)), kind, k))
        base.append(f"_{kind}")
    df = df.withColumn("_base", F.concat(*base))
    found = []
    for k, c in enumerate(classes, len(BASE_KINDS)):
        df = _spans(df, "_text", c.pattern, 0, "_runs")
        df = df.withColumn("_runs", F.filter("_runs", lambda x: ~_matches_any(x["hit"], allow)))
        df = _entropy_spans(df, "_runs", c, f"_{c.kind}")
        df = df.withColumn(f"_{c.kind}", _kind(F.col(f"_{c.kind}"), c.kind, k))
        found.append(f"_{c.kind}")
    df = df.withColumn("_found", F.filter(F.concat(*found), lambda x: ~F.exists(
        F.col("_base"), lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"]))))
    return df.drop("_text", "_runs", *found)


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: the counts and the digest of the base spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", *[F.size(f"_{kind}").cast("bigint").alias(f"n_{kind}") for kind, *_rest in BASE_KINDS],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.concat("_base", "_found")).alias("spans"))
