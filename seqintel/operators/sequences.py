"""Author sequences (D5-D8), technique -> phase (B21 / C3), positions (E1),
hold-out of the last element (E2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dictionaries as D
from ..functions import text as TX


# -- B21: array form (map lookup inside codegen) ----------------------------
def technique_phase_map(mapping: dict | None = None) -> Column:
    m = D.TECHNIQUE_PHASE if mapping is None else mapping
    pairs = []
    for k, v in m.items():
        pairs += [F.lit(k), F.lit(int(v))]
    return F.create_map(*pairs)


def phase_of(techniques, mapping: dict | None = None, default: int = D.DEFAULT_PHASE) -> Column:
    """Max over the list of (exact code, else base code before the last
    '.'); none known, or an empty list -> default."""
    m = technique_phase_map(mapping)

    def one(t):
        base = F.when(F.instr(t, ".") > 0,
                      F.regexp_extract(t, r"^(.*)\.[^.]*$", 1)).otherwise(t)
        return F.coalesce(F.element_at(m, t), F.element_at(m, base))

    best = F.array_max(F.transform(TX._c(techniques), one))
    return F.coalesce(best, F.lit(default)).cast("int")


# -- C3: join form ----------------------------------------------------------
def phase_by_join(exploded: DataFrame, tech_phase: DataFrame, key_cols: list[str],
                  tech_col: str = "technique", default: int = D.DEFAULT_PHASE) -> DataFrame:
    """Exact left join, then base-code left join, coalesce, max per key.
    ``tech_phase`` is a fixed-size dimension (tens of rows): broadcast."""
    tp = F.broadcast(tech_phase.select(F.col("technique").alias("_t1"), F.col("phase_id").alias("_p1")))
    tb = F.broadcast(tech_phase.select(F.col("technique").alias("_t2"), F.col("phase_id").alias("_p2")))
    e = exploded.withColumn("_base", F.when(F.instr(tech_col, ".") > 0, F.regexp_extract(
        tech_col, r"^(.*)\.[^.]*$", 1)).otherwise(F.col(tech_col)))
    j = e.join(tp, e[tech_col] == tp["_t1"], "left").join(tb, F.col("_base") == tb["_t2"], "left")
    return j.groupBy(*key_cols).agg(
        F.coalesce(F.max(F.coalesce("_p1", "_p2")), F.lit(default)).cast("int").alias("phase"))


# -- E1 ---------------------------------------------------------------------
def chronological_position(df: DataFrame, author_col: str = "author",
                           order: tuple[str, ...] = ("ts", "message_id")) -> DataFrame:
    """1-based position of each post inside its author, by (ts, id)."""
    w = Window.partitionBy(author_col).orderBy(*order)
    return df.withColumn("pos", F.row_number().over(w).cast("long"))


# -- D5 / D6 / D7 -----------------------------------------------------------
def author_sequences(posts: DataFrame, fields: list[str], author_col: str = "author",
                     ts_col: str = "ts", id_col: str = "message_id") -> DataFrame:
    """Per author, the list of post structs in time order (NULL time
    dropped; NULL author -> the fixed unknown name). Built with a partial
    ``collect_list`` and a sort of the array, so no window holds the group."""
    p = posts.where(F.col(ts_col).isNotNull()).withColumn(
        author_col, F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)))
    st = F.struct(F.col(ts_col).alias("ts"), F.col(id_col).alias("message_id"),
                  *[F.col(f) for f in fields if f not in (ts_col, id_col)])
    return p.groupBy(author_col).agg(F.array_sort(F.collect_list(st)).alias("posts"))


def author_post_counts(posts: DataFrame, author_col: str = "author", ts_col: str = "ts") -> DataFrame:
    """(author, n_posts) of the sequences D5 would build, without building them."""
    return posts.where(F.col(ts_col).isNotNull()).groupBy(
        F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)).alias(author_col)).agg(
        F.count(F.lit(1)).cast("long").alias("n_posts"))


def count_metadata(counts: DataFrame, min_len: int = D.MIN_SEQUENCE) -> DataFrame:
    """D7 from ``author_post_counts``."""
    return counts.agg(F.count(F.lit(1)).cast("long").alias("total_authors"),
                      F.count_if(F.col("n_posts") >= min_len).cast("long").alias("valid_authors"),
                      F.lit(min_len).cast("long").alias("min_len"))


def phase_posts(posts: DataFrame, author_col: str = "author", ts_col: str = "ts", id_col: str = "message_id",
                tech_col: str = "techniques", mapping: dict | None = None, default: int = D.DEFAULT_PHASE) -> DataFrame:
    """(author, ts, id, phase): the posts that make up the D8 sequences, one per row."""
    kept = posts.where(F.col(ts_col).isNotNull() & (F.coalesce(F.size(tech_col), F.lit(0)) > 0))
    return kept.select(F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)).alias("author"), F.col(ts_col).alias("ts"),
                       F.col(id_col).alias("id"), phase_of(F.col(tech_col), mapping, default).alias("phase"))


def valid_sequences(seqs: DataFrame, min_len: int = D.MIN_SEQUENCE) -> DataFrame:
    """Keep authors with at least ``min_len`` posts."""
    return seqs.where(F.size("posts") >= min_len)


def sequence_metadata(seqs: DataFrame, min_len: int = D.MIN_SEQUENCE) -> DataFrame:
    """Total authors, valid authors, minimum length."""
    return seqs.agg(F.count(F.lit(1)).alias("total_authors"),
                    F.count_if(F.size("posts") >= min_len).alias("valid_authors")).select(
        F.col("total_authors").cast("long"), F.col("valid_authors").cast("long"),
        F.lit(min_len).cast("long").alias("min_len"))


# -- D8 ---------------------------------------------------------------------
def phase_sequences(posts: DataFrame, author_col: str = "author", ts_col: str = "ts",
                    id_col: str = "message_id", tech_col: str = "techniques",
                    include_without_techniques: bool = False,
                    mapping: dict | None = None, default: int = D.DEFAULT_PHASE) -> DataFrame:
    """Posts -> ``(author, seq ARRAY<INT>, n_dropped)``; posts without
    techniques are dropped unless asked, posts without a time always (they
    have no place in a sequence); authors left empty disappear."""
    p = posts.where(F.col(ts_col).isNotNull()).withColumn("_has", F.coalesce(F.size(tech_col), F.lit(0)) > 0).withColumn(
        author_col, F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)))
    keep = F.col("_has") if not include_without_techniques else F.lit(True)
    st = F.struct(F.col(ts_col).alias("ts"), F.col(id_col).alias("id"),
                  phase_of(F.coalesce(F.col(tech_col), F.array().cast("array<string>")),
                       mapping, default).alias("phase"))
    g = p.groupBy(author_col).agg(
        F.array_sort(F.collect_list(F.when(keep, st))).alias("_s"),
        F.count_if(~keep).alias("n_dropped"))
    return (g.where(F.size("_s") > 0)
            .select(author_col, F.transform("_s", lambda e: e["phase"]).alias("seq"),
                    F.col("n_dropped").cast("long")))


def phase_sequence_counters(posts: DataFrame, author_col: str = "author",
                            tech_col: str = "techniques") -> DataFrame:
    """D8 counters: kept posts, dropped posts, authors kept / dropped."""
    per = posts.groupBy(author_col).agg(
        F.count_if(F.coalesce(F.size(tech_col), F.lit(0)) > 0).alias("kept"),
        F.count_if(F.coalesce(F.size(tech_col), F.lit(0)) == 0).alias("dropped"))
    return per.agg(F.sum("kept").cast("long").alias("posts_kept"),
                   F.sum("dropped").cast("long").alias("posts_dropped"),
                   F.count_if(F.col("kept") > 0).cast("long").alias("authors_kept"),
                   F.count_if(F.col("kept") == 0).cast("long").alias("authors_dropped"))


# -- E2 ---------------------------------------------------------------------
def hold_out_last(seqs: DataFrame, seq_col: str = "seq") -> DataFrame:
    """truth = last element, history = all but last; length >= 2."""
    return (seqs.where(F.size(seq_col) >= 2)
            .withColumn("truth", F.element_at(seq_col, -1))
            .withColumn("history", F.slice(seq_col, 1, F.size(seq_col) - 1)))


def technique_fixture(spark: SparkSession, events: DataFrame) -> DataFrame:
    """fx_techniques: events -> (user_id, ts, event_id, techniques) by
    (event_type, k % 3) from the fixed table in FIXTURES.md."""
    k = F.get_json_object("props", "$.k").cast("long")
    r = k % 3
    et = F.col("event_type")

    def arr(*xs):
        return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")

    techs = (F.when(et == "view", F.when(r == 2, arr("T1583.001")).otherwise(arr("T1046")))
             .when(et == "signup", F.when(r == 0, arr("T1566")).when(r == 1, arr("T1566", "T1190"))
                   .otherwise(arr("T1189")))
             .when(et == "click", F.when(r == 0, arr("T1190")).when(r == 1, arr("T1547.001", "T1190"))
                   .otherwise(arr("T1059.001")))
             .when(et == "purchase", F.when(r == 0, arr("T1071.001")).when(r == 1, arr("T1003.003"))
                   .otherwise(arr("T1005")))
             .when(et == "error", F.when(r == 2, arr("T1005", "T1046")).otherwise(arr()))
             .otherwise(arr()))
    return events.select(F.col("user_id").cast("string").alias("author"), F.col("ts").cast("timestamp").alias("ts"),
                         F.col("event_id").cast("string").alias("message_id"),
                         "event_id", "event_type", "value", techs.alias("techniques"))
