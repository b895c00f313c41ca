import random
import re

import pytest
from pyspark.sql import functions as F

from gritmill.functions import text as T
from gritmill.functions import vector as V


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text, want", [(None, ""), ("A|B_c\\d/e", "a b c d e"), (" x 　 y\x0b\tz ", "x y z"), ("", ""), ("living | room", "living room")])
def test_norm_text(spark, text, want):
    assert one(spark, text, T.norm_text) == want


def test_sql_trim_strips_spaces_but_no_tabs(spark):
    assert one(spark, "  　a\t", T.sql_trim) == "a\t"


@pytest.mark.parametrize("text, terms, want", [
    ("éface xface", ["face"], []), ("face_", ["face"], ["face"]), ("face-on", ["face"], ["face"]), ("a close-up face", ["close-up face", "face"], ["close-up face", "face"]),
    ("maple", ["map"], []), ("some 3d renderings", ["3d render"], ["3d render"]),
])
def test_term_hits(spark, text, terms, want):
    assert one(spark, text, lambda c: T.term_hits(T.norm_text(c), T.tokens(T.norm_text(c)), terms)) == want


def test_substring_hits_ignore_word_ends(spark):
    assert one(spark, "Maple", lambda c: T.substring_hits(c, ["map", "art"])) == ["map"]


def test_token_membership_equals_the_look_around_pattern(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab_é1 -.") for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", F.array_contains(T.tokens(F.col("x")), "ab").alias("hit")).collect()
    assert all(r.hit == bool(re.search(r"(?<!\w)ab(?!\w)", r.x)) for r in rows)


@pytest.mark.parametrize("value", [0.0045, 0.5155, 0.5, 0.1235, 1.0, 0.0])
def test_rounding_is_half_even_on_the_binary_value(spark, value):
    assert one(spark, value, T.round_half_even, "double") == round(value, 3)


@pytest.mark.parametrize("value, want", [("1.5", 1.5), ("", None), ("abc", None), ("1_000", None), ("nan", None)])
def test_number(spark, value, want):
    assert one(spark, value, T.number) == want


@pytest.mark.parametrize("style, value, want", [("runs", 'a/:b  c', "a_b c"), ("each", 'a*?b', "a__b"), ("slashes", "a/b\\c", "a_b_c"), ("runs", "  ", "unknown")])
def test_safe_name(spark, style, value, want):
    assert one(spark, value, lambda c: T.safe_name(c, style)) == want


@pytest.mark.parametrize("value, want", [("", "raw/xx/xx/.png"), ("A", "raw/a/xx/A.png"), ("aBc", "raw/ab/c/aBc.png"), ("abcDE", "raw/ab/cd/abcDE.png")])
def test_shard_path(spark, value, want):
    assert one(spark, value, lambda c: T.shard_path(c, F.lit(".png"))) == want


@pytest.mark.parametrize("value, want", [("http://x/a.JPEG?w=1", ".jpeg"), ("http://x/a", ".jpg"), (None, ".jpg"), ("a.webp", ".webp")])
def test_ext_from_url(spark, value, want):
    assert one(spark, value, T.ext_from_url) == want


def test_unique_spelling(spark):
    assert one(spark, "Cat | cat|Dog| ", T.unique_spelling) == ["Cat", "Dog"]


def test_assemble_text_cuts_by_code_points(spark):
    assert one(spark, "é" * 10, lambda c: T.assemble_text([("a", c), ("b", F.lit("  ")), ("c", F.lit("z"))], 8)) == "a: ééééé"


def test_softmax_and_rank_break_ties_by_order(spark):
    r = spark.range(1).select(V.ranked(F.array(F.lit("b"), F.lit("a")), V.softmax(F.array(F.lit(1.0), F.lit(1.0)))).alias("r")).first().r
    assert [x.label for x in r] == ["b", "a"] and r[0].score == 0.5


def test_strip_and_norm_against_python(spark):
    import re

    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = [s + "a" + s + "|b__c/ \\d" + s for s in spaces] + ["".join(spaces) + "é" + "".join(spaces), "".join(spaces), "", "_|/", "A​B"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.py_strip(F.col("t")).alias("s"), T.norm_text(F.col("t")).alias("n")).collect()
    for r in rows:
        assert r.s == r.t.strip() and r.n == re.sub(r"\s+", " ", re.sub(r"[_/\\]+", " ", r.t.lower().replace("|", " "))).strip()
