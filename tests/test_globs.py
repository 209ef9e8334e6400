import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from lading.functions.globs import glob_included, glob_match, glob_to_regex
from lading.operators.filters import glob_filter


def _kept(spark, keys, exclude, include):
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    return {r.key for r in glob_filter(frame, exclude, include).collect()}


@pytest.mark.parametrize("exclude, include, kept, dropped", [
    (["*.tmp", "temp/*"], [], ["test.txt", "logs/test.txt"], ["test.tmp", "temp/file.txt"]),
    ([], ["*.jpg", "*.png"], ["photo.jpg", "image.png"], ["document.txt"]),
    (["*.tmp", "*.log", "temp/*"], ["*.jpg", "*.png", "images/*"],
     ["photo.jpg", "image.png", "images/test.png"],
     ["document.txt", "test.tmp", "app.log", "temp/file.txt"]),
    (["*.log"], ["logs/*.txt"], ["logs/test.txt", "logs/important.txt"],
     ["test.log", "other/file.txt"]),
    ([], [], ["anything"], []),
])
def test_literal_cases(spark, exclude, include, kept, dropped):
    assert _kept(spark, kept + dropped, exclude, include) == set(kept)


def test_none_means_no_pattern(spark):
    frame = spark.createDataFrame([("a",)], "key string")
    assert frame.filter(glob_included("key", None, None)).count() == 1


PATTERNS = [
    "*", "?", "", "a*", "*a", "a?c", "[abc]", "[!abc]", "[a-c]x", "[!a-c]*", "[", "[]", "[]]",
    "[!]]", "[!]", "[^a]", "[a^]", "[a&&b]", "[a||b]", "[a~~b]", "[[]", "[\\]", "[a-]", "[-a]",
    "[c-a]", "[!c-a]", "[--a]", "[a-c-e]", "[a-c-e-g]", "a.b", "a+b", "(a)", "{a}", "a|b", "$a",
    "^a", "a\\b", "*.t?t", "**", "*/*", "docs/*", "é*", "[é-ü]", "a b", "#a", "a-b", "[a\\-c]",
    "[]-a]", "[!]-a]", "[[-]]", "*\n", "a&b",
]


def test_agrees_with_the_shell_rules_on_random_keys(spark):
    """Hand-picked and random patterns over random keys, newlines and brackets included."""
    rng = random.Random(7)
    letters = "abcdegxzA.-_/[]!^\\&|~ \n+*?(){}$#é"
    patterns = PATTERNS + [
        "".join(rng.choice("ab*?[]!-^\\.&|~c") for _ in range(rng.randint(1, 8)))
        for _ in range(400)
    ]
    keys = ["", "a", "b", "c", "a.b", "test.txt", "docs/x", "a\n", "\n", "]", "[", "\\", "^", "-",
            "&", "|", "~", "é", "ö", "a b", "#a", "a\\b", "a-b"] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(120)]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    wrong = []
    for start in range(0, len(patterns), 60):
        some = patterns[start:start + 60]
        rows = frame.select("key", *[
            glob_match("key", [p]).alias(f"p{i}") for i, p in enumerate(some)]).collect()
        assert len(rows) == len(keys)
        wrong += [
            (p, r.key, r[f"p{i}"]) for r in rows for i, p in enumerate(some)
            if r[f"p{i}"] != fnmatch.fnmatchcase(r.key, p)]
    assert wrong == []


def test_regular_expressions_agree_as_well(spark):
    """The general form, also for the globs that are normally done without it."""
    keys = ["", "a", "ab", "a.b", "docs/x", "x\n", "\n", "test.tmp", "a b"]
    frame = spark.createDataFrame(
        [(p, glob_to_regex(p), k) for p in PATTERNS for k in keys],
        "pattern string, regex string, key string")
    rows = frame.select("pattern", "key", F.rlike("key", F.col("regex")).alias("hit")).collect()
    assert [r for r in rows if r.hit != fnmatch.fnmatchcase(r.key, r.pattern)] == []


def test_simple_globs_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("a",)], "key string").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = glob_filter(stored, ["*.tmp"], ["logs/*", "*mid*"])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Not(StringEndsWith(key,.tmp))" in text and "RLIKE" not in text
