"""Term matching (C1) as an index join: which terms of a table occur in which texts.

A text is cut into blocks of ``n`` characters. A key of at least 2n - 1
characters, wherever it occurs, covers one whole block, and that block begins
at one of ``n`` neighbouring places of the key. So the key is filed under the
``n`` grams at neighbouring places, those that the fewest keys share; a text's
distinct blocks meet that index, and one ``contains`` settles each candidate.
Keys of 5 characters and more go by blocks of 3, of 3 and 4 by blocks of 2,
shorter ones by single characters. All of it is built-in expressions and
joins, no Python and no dictionary in the driver.

Texts are read in overlapping pieces, so a very long text is not one row of
grams. The index is broadcast in parts of bounded size, each a pass over the
texts; hits come back under a digest of the text, so neither null nor repeated
ids matter and copies of a text count once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX

#: Characters of a text that one row of grams covers (the longest key overlaps into the next).
PIECE = 1 << 15
#: Bytes of keys and values that are broadcast at once.
BLOCK_BYTES = 8 << 20


def prepared_keys(terms: DataFrame, whole_word: bool = False) -> DataFrame:
    """(key, values) from a term table (idx, term, technique).

    Terms are normalised; of equal normalised terms the one with the largest
    idx counts, as when a dictionary entry is overwritten. Keys are squashed
    (or framed by spaces for whole words), equal ones have their techniques
    united and sorted; empty ones and null terms are left out.
    """
    named = terms.select("idx", TX.normalize_term("term").alias("name"), "technique").where("name <> ''")
    last = named.groupBy("name").agg(F.max("idx").alias("idx"))
    key = F.concat(F.lit(" "), "name", F.lit(" ")) if whole_word else F.replace("name", F.lit(" "), F.lit(""))
    rows = named.join(last, ["name", "idx"], "left_semi").select(key.alias("key"), "technique")
    return rows.where(F.trim("key") != "").groupBy("key").agg(F.sort_array(F.collect_set("technique")).alias("values"))


def block_size(key: Column) -> Column:
    return F.when(F.char_length(key) >= 5, 3).when(F.char_length(key) >= 3, 2).otherwise(1)


def blocks(text: Column, sizes: list[int]) -> Column:
    """The distinct blocks of the given sizes; for size 1 all distinct characters."""
    def cut(n):
        return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{n}}}"), F.lit(0)))

    def characters(twos):
        return F.array_distinct(F.split(F.array_join(twos, ""), ""))

    found = [cut(3)] if 3 in sizes else []
    if 1 in sizes:
        found.append(TX.let(cut(2), lambda twos: F.concat(twos, characters(twos))))
    elif 2 in sizes:
        found.append(cut(2))
    return found[0] if len(found) == 1 else F.array_distinct(F.concat(*found))


def gram_index(keys: DataFrame) -> DataFrame:
    """(gram, key, values): each key under the neighbouring grams that the fewest keys share."""
    sized = keys.select("key", block_size(F.col("key")).alias("n"))
    at = sized.select("key", "n", F.explode(F.sequence(F.lit(1), F.char_length("key") - F.col("n") + 1)).alias("place")).withColumn(
        "gram", F.substr("key", "place", "n"))
    shared = at.groupBy("gram").agg(F.count_distinct("key").alias("keys"))
    per = at.join(shared, "gram").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("place", "gram", "keys"))).alias("grams"))
    runs = F.transform(F.sequence(F.lit(1), F.size("grams") - F.col("n") + 1), lambda i: F.struct(
        F.aggregate(F.slice("grams", i, F.col("n")), F.lit(0).cast("long"), lambda acc, g: acc + g["keys"]).alias("load"), i.alias("i")))
    best = per.select("key", "n", "grams", F.array_min(runs)["i"].alias("i"))
    filed = best.select("key", F.explode(F.array_distinct(F.transform(F.slice("grams", F.col("i"), F.col("n")), lambda g: g["gram"]))).alias("gram"))
    return filed.join(keys, "key").select("gram", "key", "values")


def pieces(text: Column, overlap: int) -> Column:
    """array<string>: the text in stretches of ``PIECE`` characters, each with ``overlap`` more behind it."""
    whole = F.lit(rf"(?s)\G(.{{1,{PIECE}}})(?=(.{{0,{overlap}}}))")
    return TX.let(text, lambda t: F.zip_with(F.regexp_extract_all(t, whole, F.lit(1)), F.regexp_extract_all(t, whole, F.lit(2)), lambda a, b: F.concat(a, b)))


def hits(texts: DataFrame, digest: str, text: Column, keys: DataFrame) -> DataFrame:
    """Distinct (digest, key, values) of the keys contained in ``text``."""
    size, longest, sizes = keys.agg(
        F.sum(3 * (F.octet_length("key") + F.octet_length(F.array_join("values", "")) + 32)), F.max(F.char_length("key")),
        F.collect_set(block_size(F.col("key")))).first()
    if not sizes:
        return texts.select(digest, F.lit("").alias("key"), F.array().cast("array<string>").alias("values")).where(F.lit(False))
    cut = texts.select(digest, F.explode(pieces(text, longest - 1)).alias("__piece"))
    cut = cut.select(digest, "__piece", F.explode(blocks(F.col("__piece"), sizes)).alias("gram"))
    index, parts = gram_index(keys), -(-size // BLOCK_BYTES)
    found = [cut.join(F.broadcast(index.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part)), "gram")
             .where(F.contains("__piece", "key")).select(digest, "key", "values") for part in range(parts)]
    return reduce(DataFrame.unionByName, found).dropDuplicates([digest, "key"])


def with_found(df: DataFrame, raw: Column, prepare, keys: DataFrame, out_col: str) -> DataFrame:
    """``df`` with ``out_col``: array<struct<key, values>> of the keys in ``prepare(raw)``.

    A null text counts as empty and holds nothing; equal texts share one look-up.
    Rows without a hit get an empty array. The hits of one text are at most the
    table's keys.
    """
    text = F.coalesce(raw, F.lit(""))
    own = df.withColumn("__digest", F.sha2(text, 256))
    found = hits(df.select(F.sha2(text, 256).alias("__digest"), text.alias("__text")), "__digest", prepare(F.col("__text")), keys)
    per = found.groupBy("__digest").agg(F.collect_list(F.struct("key", "values")).alias("__found"))
    none = F.array().cast("array<struct<key:string,values:array<string>>>")
    return own.join(per, "__digest", "left").withColumn(out_col, F.coalesce("__found", none)).drop("__digest", "__found")


def values_of(found: str | Column) -> Column:
    """Sorted distinct values of an array<struct<key, values>>."""
    found = F.col(found) if isinstance(found, str) else found
    return F.sort_array(F.array_distinct(F.flatten(F.transform(found, lambda x: x["values"]))))
