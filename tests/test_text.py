"""Hand-written cases for the scalar text functions (FIXTURES.md section 4)."""
import hashlib

from pyspark.sql import functions as F

from seqintel import dictionaries as D
from seqintel.functions import text as TX


def one(spark, expr, value, schema="s STRING"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_url(spark):
    cases = {
        "x.onion": "http://x.onion",
        "http://x.onion/a?b#c": "http://x.onion/a",
        "#x": None,
        "http://x.com": None,
        "http://x.onion/a.PNG": "http://x.onion/a.PNG",
        "x.onion/a.png": None,
    }
    for raw, want in cases.items():
        assert one(spark, TX.normalize_url(F.col("s")), raw) == want, raw
    assert one(spark, TX.normalize_url(F.col("s"), ""), "/rel") == "http:///rel"


def test_thread_id(spark):
    df = spark.createDataFrame(
        [("http://h/thread/12", ""), ("http://h/THREAD=7", ""), ("http://h/part/12", ""),
         ("http://h/x", "<div data-thread-id=\"99\">"), ("http://h/none", "")], "u STRING, h STRING")
    got = [r[0] for r in df.select(TX.infer_thread_id("u", "h")).collect()]
    assert got[:4] == ["thread_12", "thread_7", "thread_12", "thread_99"]
    assert got[4] == "thread_" + hashlib.sha1(b"http://h/none").hexdigest()[:16]


def test_parse_timestamp(spark):
    import datetime as dt
    want = dt.datetime(2024, 1, 2, 3, 4, 5)
    for raw in ["2024-01-02 03:04:05", "2024-1-2 3:4:5", "02-01-2024 03:04:05", "2024/01/02 03:04:05"]:
        assert one(spark, TX.parse_timestamp_or_null(F.col("s")), raw) == want, raw
    assert one(spark, TX.parse_timestamp_or_null(F.col("s")), "2/1/2024 3:04") == dt.datetime(2024, 1, 2, 3, 4)
    for raw in ["2024-01-02T03:04:05Z", "", None, "nonsense"]:
        assert one(spark, TX.parse_timestamp_or_null(F.col("s")), raw) is None, raw


def _token(label, value):
    return f"{label}_" + hashlib.sha256(f"{D.ANON_SALT}:{value}".encode()).hexdigest()[:16]


def test_anonymize(spark):
    assert one(spark, TX.anonymize_text(F.col("s")), "mail a@b.co now") == f"mail {_token('EMAIL', 'a@b.co')} now"
    assert _token("EMAIL", "a@b.co") == "EMAIL_1ed12c9dab48aac0"
    # same address twice -> both replaced; the literal replace also rewrites
    # the match inside the longer address (11.1.1.1 -> 1<token>), as the original does
    out = one(spark, TX.anonymize_text(F.col("s")), "1.1.1.1 and 11.1.1.1 and 1.1.1.1")
    assert out == " and ".join([_token("IPV4", "1.1.1.1"), "1" + _token("IPV4", "1.1.1.1"), _token("IPV4", "1.1.1.1")])
    assert one(spark, TX.anonymize_text(F.col("s")), "999.1.1.1") == "999.1.1.1"
    assert one(spark, TX.anonymize_text(F.col("s")), None) is None
    assert one(spark, TX.anonymize_text(F.col("s")), "") == ""
    onion = "abcdefghijklmnop.onion"
    assert one(spark, TX.anonymize_text(F.col("s")), onion.upper()) == _token("ONION", onion.upper())
    # idempotent
    t = "x a@b.co 10.0.0.1"
    once = one(spark, TX.anonymize_text(F.col("s")), t)
    assert one(spark, TX.anonymize_text(F.col("s")), once) == once


def test_clean_text(spark):
    assert one(spark, TX.clean_text(F.col("s")), "Niño  ¿qué?\tTal\n") == "niño  qué  tal"
    assert one(spark, TX.clean_text(F.col("s")), None) == ""
    assert one(spark, TX.clean_text(F.col("s")), "see EMAIL_0123456789abcdef!") == "see [anonimizado]"
    assert one(spark, TX.clean_text(F.col("s")), "emoji 😀 ok") == "emoji   ok"


def test_fingerprint_insensitive_to_case_and_space(spark):
    a = one(spark, TX.fingerprint_text(F.col("s")), "  Hello \n\t World ")
    b = one(spark, TX.fingerprint_text(F.col("s")), "hello world")
    assert a == b == "hello world"


def test_normalize_and_squash_term(spark):
    assert one(spark, TX.normalize_term(F.col("s")), " Cobalt-Strike ") == "cobalt strike"
    assert one(spark, TX.squash_term(F.col("s")), "Cobalt-Strike") == "cobaltstrike"
    assert one(spark, TX.squash_term(F.col("s")), "LockBit 3.0") == "lockbit30"
