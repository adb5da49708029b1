"""Scalar text functions (B1-B19) as built-in Spark Column expressions.

All of these stay inside whole-stage codegen: no Python UDF is involved.
Each function takes and returns ``Column``s so it composes in ``select`` /
``withColumn`` and is pushed through Catalyst like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dictionaries as D

# Python's ``str`` whitespace set (what ``\s`` matches in a Python str pattern),
# written out so the JVM regex (whose ``\s`` is ASCII-only) agrees with it.
WS = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS_RUN = WS + "+"
# The same set split for speed on the JVM: the non-ASCII members are mapped
# to a space with ``translate`` (a per-char lookup), after which the
# predefined ASCII ``\s`` class (space, \t, \n, \x0B, \f, \r) covers the rest.
# A single big range class is ~3x slower in java.util.regex.
EXOTIC_WS = "".join(chr(c) for c in [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                      0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def _ascii_ws(c) -> Column:
    return F.translate(c, EXOTIC_WS, " " * len(EXOTIC_WS))


def collapse_ws(c) -> Column:
    """Runs of (Python) whitespace -> one space."""
    return F.regexp_replace(_ascii_ws(c), r"\s+", " ")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Catalyst inlines projected expressions into higher-order-function lambdas
    (CollapseProject sees one reference), which would re-evaluate an expensive
    input once per array element; binding it through a one-element
    ``transform`` keeps it a single evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


#: Words of a block and of a piece of text that token places are counted in.
BLOCK, PIECE = 4096, 16


def runs_of(text, word: str, most: int) -> Column:
    """array<struct<start, part>>: ``text`` up to its last word, cut behind every ``most`` words (runs of
    ``word``, the inside of a character class). Places are in code points and cost one sum per part."""
    parts = F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(rf"\G(?:[^{word}]*+[{word}]++){{1,{most}}}+"), 0)

    def placed(p):
        ends = F.aggregate(p, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.char_length(x))))
        return F.arrays_zip(F.slice(ends, 1, F.size(p)).alias("start"), p.alias("part"))

    return let(parts, placed)


def start_in(piece, word: str, i) -> Column:
    """Place of the ``i``-th word (from 0) of a piece, in code points."""
    words = F.regexp_extract_all(_c(piece), F.lit(rf"[{word}]+|[^{word}]+"), 0)
    gap_first = F.regexp_extract(_c(piece), rf"^[^{word}]", 0) != ""
    return F.char_length(F.array_join(F.slice(words, 1, 2 * _c(i) + F.when(gap_first, 1).otherwise(0)), ""))


# B1 -----------------------------------------------------------------------
def normalize_url(url, marker: str = ".onion") -> Column:
    """Cut at '#', then '?', trim; NULL without the marker or on a skipped
    static suffix; prefix ``http://`` when no scheme is present."""
    u = F.trim(F.regexp_replace(
        F.substring_index(F.substring_index(_c(url), "#", 1), "?", 1),
        f"^{WS}+|{WS}+$", ""))  # URLs are short: the full class is fine
    skipped = None
    for suf in D.SKIPPED_URL_SUFFIXES:
        cond = u.endswith(suf)
        skipped = cond if skipped is None else (skipped | cond)
    has_scheme = u.startswith("http://") | u.startswith("https://")
    return (F.when(~u.contains(marker) | skipped, F.lit(None).cast("string"))
            .when(has_scheme, u)
            .otherwise(F.concat(F.lit("http://"), u)))


# B2 -----------------------------------------------------------------------
def _attr_value(html, attr: str) -> Column:
    # value of the first element carrying exactly this attribute (quoted or bare)
    pat = r"(?i)[\s'\"]" + attr.replace("-", r"\-") + r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    m = F.regexp_extract(html, pat, 0)
    return F.when(m == "", F.lit(None)).otherwise(
        F.coalesce(F.nullif(F.regexp_extract(html, pat, 1), F.lit("")),
                   F.nullif(F.regexp_extract(html, pat, 2), F.lit("")),
                   F.regexp_extract(html, pat, 3)))


def infer_thread_id(url, html=None) -> Column:
    """``thread_<n>`` from the URL, else from a thread attribute, else a URL hash."""
    url = _c(url)
    from_url = F.nullif(F.regexp_extract(url, D.THREAD_URL_PATTERN, 1), F.lit(""))
    parts = [from_url]
    if html is not None:
        parts += [_attr_value(_c(html), a) for a in D.THREAD_ATTRIBUTES]
    parts.append(F.substring(F.sha1(url), 1, 16))
    return F.concat(F.lit("thread_"), F.coalesce(*parts))


# B3 / B4 ------------------------------------------------------------------
def message_id(url, raw_id, idx) -> Column:
    return F.concat(F.lit("msg_"), F.substring(
        F.sha1(F.concat_ws("|", _c(url), _c(raw_id).cast("string"), _c(idx).cast("string"))), 1, 16))


def parent_id(url, parent_raw) -> Column:
    p = _c(parent_raw).cast("string")
    return F.when(p.isNotNull() & (p != ""), F.concat(F.lit("msg_"), F.substring(
        F.sha1(F.concat_ws("|", _c(url), p)), 1, 16)))


# B5 -----------------------------------------------------------------------
def parse_timestamp_or_null(raw, extra_iso: bool = False) -> Column:
    """First of the fixed formats that parses the trimmed text, else NULL."""
    r = F.trim(_c(raw))
    fmts = list(D.TIMESTAMP_FORMATS) + (["y-M-d'T'H:m:s[.SSSSSS]'Z'"] if extra_iso else [])
    return F.coalesce(*[F.try_to_timestamp(r, F.lit(f)) for f in fmts])


# B6 / B7 ------------------------------------------------------------------
def fingerprint_text(c) -> Column:
    """lower, collapse whitespace runs to one space, trim; NULL -> ''."""
    return F.trim(collapse_ws(F.lower(F.coalesce(_c(c), F.lit("")))))


def content_fingerprint(body, title, user, thread) -> Column:
    return F.sha1(F.concat_ws("|", fingerprint_text(body), fingerprint_text(title),
                              fingerprint_text(user), F.coalesce(_c(thread), F.lit(""))))


# B8 - B11 -----------------------------------------------------------------
def anonymize_text(c, salt: str = D.ANON_SALT) -> Column:
    """For each PII pattern in order: find all matches in the current text and
    replace every occurrence of each by ``LABEL_<sha256(salt:match)[:16]>``.
    Literal ``replace`` (not regexp) so matches inside longer strings go too."""
    col = _c(c)
    out = col
    for label, pat in D.PII_PATTERNS:
        out = let(out, _pass(pat, label, salt))
    return F.when(col.isNull() | (col == ""), col).otherwise(out)


# A pattern can only match when its literal part is present; the guard is a
# cheap substring scan that skips the regex on texts without it.
PII_GUARDS = {"email": "@", "ipv4": ".", "onion": ".onion"}


def _pass(pat: str, label: str, salt: str):
    def body(v):
        run = F.aggregate(F.regexp_extract_all(v, F.lit(pat), 0), v, _replacer(label, salt))
        g = PII_GUARDS.get(label)
        if g is None:
            return run
        hay = F.lower(v) if label == "onion" else v
        return F.when(F.contains(hay, F.lit(g)), run).otherwise(v)
    return body


def _replacer(label: str, salt: str):
    def step(acc, m):
        return F.replace(acc, m, _token(label, m, salt))
    return step


def _token(label: str, m: Column, salt: str) -> Column:
    return F.concat(F.lit(label.upper() + "_"),
                    F.substring(F.sha2(F.concat(F.lit(salt + ":"), m), 256), 1, 16))


def anonymize_username(c, salt: str = D.ANON_SALT) -> Column:
    col = _c(c)
    return F.when(col.isNull() | (col == ""), col).otherwise(_token("USER", col, salt))


def pii_counts(c) -> list[tuple[str, Column]]:
    """Number of matches of each PII pattern in the text."""
    return [(label, F.size(F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(pat), 0)))
            for label, pat in D.PII_PATTERNS]


# B12 ----------------------------------------------------------------------
ANON_TOKEN_PATTERN = r"\b(" + "|".join(D.ANON_TOKEN_LABELS) + r")_[a-f0-9]{16}\b"

# A run of whitespace, or one other character that is no letter, digit or '_': one pass over the text.
NOT_WORD = r"[^\p{L}\p{N}_](?:(?<=" + WS + ")" + WS + r"*+)?+"


def clean_text(c) -> Column:
    """NULL -> ''; whitespace runs -> ' '; every char that is not a letter,
    digit, '_' or space -> ' ' (not re-collapsed); anonymisation tokens ->
    the fixed marker; strip; lower."""
    t = F.regexp_replace(F.coalesce(_c(c), F.lit("")), NOT_WORD, " ")
    token = D.ANON_TOKEN_REPLACEMENT.replace("[", "\\[").replace("]", "\\]")
    t = let(t, lambda v: F.when(F.contains(v, F.lit("_")), F.regexp_replace(v, ANON_TOKEN_PATTERN, token)).otherwise(v))
    return F.lower(F.trim(t))


# B13 / B14 ----------------------------------------------------------------
def date_parts(ts) -> dict[str, Column]:
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}


def text_length(c) -> Column:
    return F.length(_c(c))


# B18 / B19 ----------------------------------------------------------------
def body_fallback(clean, raw) -> Column:
    return F.coalesce(F.nullif(_c(clean), F.lit("")), F.nullif(_c(raw), F.lit("")), F.lit(""))


def normalize_term(c) -> Column:
    """lower, strip, runs of whitespace / - _ . / -> one space."""
    t = F.regexp_replace(F.lower(_c(c)), f"^{WS}+|{WS}+$", "")
    t = F.regexp_replace(t, r"(?:" + WS + r"|[\-_./])+", " ")
    return F.regexp_replace(t, WS_RUN, " ")


SEPARATORS = WS[:-1] + r"\-_./]"


def squash_term(c) -> Column:
    """Normalised text with separators removed: the one form C1 compares.
    Equal to ``replace(normalize_term(c), ' ', '')`` in one regex pass."""
    return F.regexp_replace(_ascii_ws(F.lower(_c(c))), r"[\s\-_./]+", "")
