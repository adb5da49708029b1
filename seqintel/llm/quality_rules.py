"""Quality rules as a short-circuit cascade, in built-in functions only.

Each rule is a condition that a good text meets. On a bounded sample the
cascade measures what each rule costs (seconds to evaluate it alone, the
faster of two runs) and which rows it rejects; it then orders the rules
greedily by rejected share of the rows still alive per cost. A text stops at
the first rule that it fails: the cascade is one CASE expression, whose later
branches are not evaluated. The order changes the work and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import WORD, stored, text_of

#: Rows on which costs and selectivities are estimated (the order depends on them, the verdict does not).
SAMPLE = 2_000
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words and the base measures of each whole text; null is empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    rows = rows.select(
        "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        window_hashes(F.col("words")).alias("grams"))
    repeats = F.size("grams") > F.size(F.array_distinct("grams"))
    return rows.withColumn("n_repeat_words", F.when(repeats, repeated_words(F.col("words"))).otherwise(F.lit(0)).cast("long")).drop("grams")


def window_hashes(words: Column, window: int = WINDOW) -> Column:
    """A hash of each run of ``window`` words; no two equal hashes means no two equal runs."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= window, F.transform(F.sequence(F.lit(1), F.size(h) - window + 1), lambda i: F.xxhash64(
            F.slice(h, i, window)))).otherwise(F.array().cast("array<bigint>")))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words which the text has twice or
    more, compared word by word (for texts in which hashes repeat)."""
    runs = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - window + 1), lambda i: F.struct(
        F.array_join(F.slice(words, i, window), " ").alias("run"), i.alias("at"))))

    def again(s: Column) -> Column:
        def equal(i, j):
            return F.get(s, i)["run"] == F.get(s, j)["run"]

        places = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.coalesce(equal(k, k - 1), F.lit(False))
                          | F.coalesce(equal(k, k + 1), F.lit(False)))
        starts = F.sort_array(F.transform(places, lambda k: F.get(s, k)["at"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda acc, at: F.struct((at + (window - 1)).alias("end"),
                                     (acc["n"] + F.least(F.lit(window), at + (window - 1) - acc["end"])).alias("n")),
            lambda acc: acc["n"])

    return let(runs, again)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stutters(words: Column) -> Column:
    """Words that equal the word before them."""
    return let(words, lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))))


def production_rules() -> dict[str, Column]:
    """The production rules, over the columns of ``measures``."""
    n = F.col("n_words")
    return {
        "few symbols": 10 * F.col("n_symbols") <= n,
        "few repeated lines": 2 * F.col("n_dup_lines") <= F.col("n_lines"),
        "word length": (2 * n <= F.col("word_chars")) & (F.col("word_chars") <= 15 * n),
        "varied words": 10 * F.size(F.array_distinct("words")) >= n,
        "few stutters": 5 * stutters(F.col("words")) <= n,
        "not shouted": 2 * F.regexp_count("text", F.lit("[A-Z]")) <= F.col("word_chars"),
        "few exclamations": 10 * F.regexp_count("text", F.lit("!!")) <= n,
        "words have letters": 10 * F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))) >= 6 * n,
    }


def order_rules(some: DataFrame, rules: Mapping[str, Column]) -> list[str]:
    """Names of ``rules`` in the order of rejection per cost on the rows of ``some``."""
    patterns = some.groupBy(*[F.coalesce(c, F.lit(False)).alias(str(i)) for i, c in enumerate(rules.values())]).count().collect()

    def seconds(column: Column) -> float:
        def run():
            began = time.perf_counter()
            some.agg(F.count(F.when(column, 1))).collect()
            return time.perf_counter() - began
        return min(run() for _ in range(2))

    floor = seconds(F.lit(True))
    cost = {name: max(seconds(c) - floor, 1e-4) for name, c in rules.items()}
    place = {name: i for i, name in enumerate(rules)}
    left, order = [(tuple(r)[:-1], r["count"]) for r in patterns], []
    while len(order) < len(rules):
        alive = max(1, sum(n for _, n in left))

        def gain(name):
            return sum(n for ok, n in left if not ok[place[name]]) / alive / cost[name]

        best = max((x for x in rules if x not in order), key=lambda x: (gain(x), -cost[x]))
        order.append(best)
        left = [(ok, n) for ok, n in left if ok[place[best]]]
    return order


def cascade(order: list[str], rules: Mapping[str, Column]) -> Column:
    """False at the first rule in ``order`` that is not met (or is null), else true."""
    verdict = F.lit(True)
    for name in reversed(order):
        verdict = F.when(F.coalesce(rules[name], F.lit(False)), verdict).otherwise(F.lit(False))
    return verdict


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: Mapping[str, Column] | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed and kept.

    A null or empty text has no words, fails the base and is not kept. Repeated
    rows get equal verdicts; a null id stays null; an empty table gives an
    empty result. Columns other than the named ones are not read.
    """
    given = production_rules() if rules is None else rules
    rows = measures(docs, id_col, text_col)
    share = min(1.0, 1.2 * sample / max(docs.count(), 1))
    # the sample is measured once and stored: a filter on measures would be pushed into their expressions
    some = stored(spark, measures(docs.sample(share, seed=0).limit(sample), id_col, text_col), "rules-sample")
    order = order_rules(some.filter(~base_failed()), given)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(cascade(order, given)).alias("kept"))

