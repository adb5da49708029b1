"""Secret scans: fixed patterns and windows of high entropy, in built-in functions only.

Base kinds (assign, access, hex) are patterns; their matches are found left to
right without overlap. A regular expression that consumes the gap before each
match gives gaps and matches; running sums of their lengths are the places.

The method adds the kind ``entropy``: a candidate is a whole run of at least
``WINDOW`` characters that keys are written with. It has a character class
(hexadecimal, upper case and digits, or mixed); a window slides over it and
the Shannon entropy of its characters is kept up by counts: the character that
enters and the one that leaves change sum(c * log2 c) by a table look-up each.
Windows whose entropy reaches the class's threshold form spans. The counts are
one string, a character per slot, in which two slots change at each step.

The allow-list judges the pieces of a candidate, not the candidate: pieces are
its runs of letters and digits (a UUID is one piece); words, also joined in
camel case or numbered, numbers, UUIDs and examples are harmless. A span stays
if at least ``LEAST_ODD`` of its characters lie in other pieces, so a key in one
run with a path or a name is found and a path of words is not. Spans that
touch a base span are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import text_of

# Fixed patterns: kind, pattern, shortest accepted length, the group it counts in.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 4),
    ("access", r"AKIA[A-Z0-9]+", 16, 2),
    ("hex", r"[0-9a-f]{32,}", 32, 2),
)
KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
RUN = r"[A-Za-z0-9+/_=-]"
CANDIDATE = RUN + "{%d,}" % WINDOW
#: Bits a character in a window of 20: hexadecimal, upper case and digits, mixed.
THRESHOLDS = {"hex": 2.95, "upper": 3.25, "mixed": 3.55}
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
#: What a candidate is cut into: UUIDs, runs of letters and digits, runs of joining characters.
PIECE = _UUID + r"|[A-Za-z0-9]+|[+/_=-]+"
#: A piece that matches one of these as a whole is no secret.
HARMLESS = (
    r"[+/_=-]+",
    r"[A-Z]+[0-9]{0,4}",
    r"[0-9]+",
    _UUID,
    r".*(?:EXAMPLE|example|XXXXXX|xxxxxx).*",
)
#: So is a word, also in camel case, also numbered: letters of this form in which no capital
#: stands without a small letter behind it (of random keys of 20 letters under 2% look so).
WORDY, SHORT_HUMP = r"[A-Za-z]*[0-9]{0,4}", r"[A-Z](?:[A-Z0-9]|$)"
#: A candidate that matches this as a whole is the well-known example of a key.
EXAMPLE = r".*EXAMPLEKEY"
#: Characters of a span that must lie in pieces that are not harmless.
LEAST_ODD = 10
#: Slots of the counts: the characters of a candidate lie between + and z.
FIRST, SLOTS = ord("+"), ord("z") - ord("+") + 1


def matches(text: Column, pattern: str, guard: str | None = None, measured: int = 2) -> Column:
    """array<struct<start, end, value, size>> of the leftmost matches without overlap;
    size is the length of group ``measured`` counted with the gap as 1 and the match as 2."""
    whole = F.lit(r"\G((?s:.*?))(" + pattern + ")")
    parts = F.arrays_zip(
        F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, whole, F.lit(2)).alias("hit"),
        F.regexp_extract_all(text, whole, F.lit(measured)).alias("part"))
    none = F.array().cast("array<struct<start:int,end:int,value:string,size:int>>")

    def place(acc, x):
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["hit"].alias("value"), F.char_length(x["part"]).alias("size")))).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), place, lambda acc: acc["out"])
    return F.when(text.rlike(guard or pattern), found).otherwise(none)


def hot_spans(value: Column, window: int = WINDOW) -> Column:
    """array<struct<a, b>>: the stretches of ``value`` covered by windows of high entropy."""
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    limit = (F.when(value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$"), THRESHOLDS["hex"])
             .when(value.rlike("^[0-9A-Z]+$"), THRESHOLDS["upper"]).otherwise(THRESHOLDS["mixed"]))
    most = (math.log2(window) - limit) * window  # sum(c log2 c) of a hot window is at most this
    none = F.array().cast("array<struct<a:int,b:int>>")

    def scan(codes: Column) -> Column:
        def held(counts, slot):
            return F.ascii(F.substr(counts, slot + 1, F.lit(1))) - ord("A")

        def put(counts, slot, n):
            return F.overlay(counts, F.char(n + ord("A")), slot + 1)

        def entered(acc, slot):
            return let(held(acc["counts"], slot), lambda n: F.struct(
                put(acc["counts"], slot, n + 1).alias("counts"), (acc["sum"] + F.get(weight, n + 1) - F.get(weight, n)).alias("sum")))

        def left(now, slot):
            return let(held(now["counts"], slot), lambda n: F.struct(
                put(now["counts"], slot, n - 1).alias("counts"), (now["sum"] + F.get(weight, n - 1) - F.get(weight, n)).alias("sum")))

        def spans(acc, i):
            now = let(entered(acc, F.get(codes, i)), lambda e: F.when(i < window, e).otherwise(left(e, F.get(codes, i - window))))
            a, b = i - (window - 1), i + 1
            last = F.get(acc["out"], F.size(acc["out"]) - 1)
            return let(now, lambda n: F.struct(
                n["counts"].alias("counts"), n["sum"].alias("sum"),
                F.when((i < window - 1) | (n["sum"] > most), acc["out"])
                .when((F.size(acc["out"]) > 0) & (last["b"] >= a), F.concat(
                    F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(F.struct(last["a"].alias("a"), b.alias("b")))))
                .otherwise(F.concat(acc["out"], F.array(F.struct(a.alias("a"), b.alias("b"))))).alias("out")))

        start = F.struct(F.lit("A" * SLOTS).alias("counts"), F.lit(0.0).alias("sum"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, spans, lambda acc: acc["out"])

    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - FIRST)
    return let(codes, scan)


def odd_pieces(value: Column) -> Column:
    """array<struct<a, b>>: the pieces of ``value`` that are not harmless."""
    none = F.array().cast("array<struct<a:int,b:int>>")
    known = "^(?:" + "|".join(HARMLESS) + ")$"

    def place(acc, x):
        end = acc["at"] + F.char_length(x)
        harmless = x.rlike(known) | (x.rlike("^" + WORDY + "$") & ~x.rlike(SHORT_HUMP))
        return F.struct(end.alias("at"), F.when(harmless, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
            acc["at"].alias("a"), end.alias("b"))))).alias("out"))

    return F.aggregate(F.regexp_extract_all(value, F.lit(PIECE), F.lit(0)), F.struct(F.lit(0).alias("at"), none.alias("out")),
                       place, lambda acc: acc["out"])


def _odd_length(pieces: Column, a: Column, b: Column) -> Column:
    """Characters of the pieces that lie from ``a`` to ``b``."""
    return F.aggregate(pieces, F.lit(0), lambda n, p: n + F.greatest(F.lit(0), F.least(p["b"], b) - F.greatest(p["a"], a)))


def _long_enough(found: Column, least: int) -> Column:
    return F.filter(found, lambda m: m["size"] >= least)


def _labelled(found: Column, kind: str, number: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        m["value"].alias("value")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, found: array<struct<start, kind_no, end, kind, value>> by start, then kind.

    Starts and ends are code points, ends exclusive. Null and empty texts have
    no spans; texts may be of any length (a candidate is scanned once, with state of
    fixed size beside its spans); repeated rows and ties give equal rows; a null id stays null; an
    empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    for kind, pattern, least, group in BASE:
        rows = rows.withColumn(kind, _long_enough(matches(F.col("text"), pattern, measured=group), least))
    runs = F.filter(matches(F.col("text"), CANDIDATE), lambda m: ~m["value"].rlike("^" + EXAMPLE + "$"))
    judged = F.transform(runs, lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), odd_pieces(m["value"]).alias("odd")))
    candidates = F.filter(judged, lambda m: _odd_length(m["odd"], F.lit(0), F.char_length(m["value"])) >= LEAST_ODD)
    rows = rows.withColumn("candidates", candidates)
    base = F.concat(*[_labelled(F.col(kind), kind, i) for i, (kind, *_) in enumerate(BASE)])
    rows = rows.select("doc_id", "candidates", F.sort_array(base).alias("base"))
    hot = F.flatten(F.transform("candidates", lambda m: F.transform(F.filter(
        hot_spans(m["value"]), lambda s: _odd_length(m["odd"], s["a"], s["b"]) >= LEAST_ODD), lambda s: F.struct(
        (m["start"] + s["a"]).alias("start"), F.lit(len(BASE)).alias("kind_no"), (m["start"] + s["b"]).alias("end"),
        F.lit("entropy").alias("kind"), F.substring(m["value"], s["a"] + 1, s["b"] - s["a"]).alias("value")))))
    added = F.filter(hot, lambda h: ~F.exists("base", lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"])))
    return rows.select("doc_id", "base", F.when(F.size("candidates") > 0, F.sort_array(F.concat("base", added)))
                       .otherwise(F.col("base")).alias("found"))


def count_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """doc_id and the text with each found span (overlaps merged) replaced by ``mask``. Null and
    empty texts come back empty; repeated rows, null ids and texts of any length as in ``scan``."""
    row = F.struct(F.col(id_col).alias("id"), text_of(text_col).alias("text")).alias("row")
    found = scan(docs.select(row, F.col(text_col).alias("text")), "row", "text").select(
        F.col("doc_id.id").alias("id"), F.col("doc_id.text").alias("text"), "found")

    def cut(acc, s):
        gap = F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
            s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"))

    def rest(acc):
        return F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, F.char_length("text")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return found.select(F.col("id").alias(id_col), F.aggregate("found", start, cut, rest).alias(text_col))
