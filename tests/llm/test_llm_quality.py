from __future__ import annotations

import random

from pyspark.sql import functions as F

from parcelspark.llm import quality
import brute


def test_counts_equal_a_plain_version(spark):
    draw = random.Random(3)
    odd = ["a", "b", "the", "é😀", "#", "|x", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x1c", "　"]
    texts = ["".join(draw.choice(odd) for _ in range(draw.randrange(40))) for _ in range(600)]
    texts += [None, "", " \n ", "word " * 30_000, "a b c a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = [c for c in quality.COUNTS if c != "n_lines"]
    for r in quality.measured(df).select("doc_id", *(F.col(f"counts.{c}") for c in names)).collect():
        assert tuple(r)[1:] == brute.quality_counts(texts[r.doc_id]), repr(texts[r.doc_id])[:100]


def prose(seed, n=80):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(3, 8))) for _ in range(n))


def judged(spark, rows, extra="Kept int"):
    df = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {extra}")
    return {r.doc_id: r for r in quality.judged(quality.measured(df).drop("text")).collect()}


def test_outliers_of_their_own_group_go_and_clean_ones_stay(spark):
    rows = [(i, prose(i), "en", "hot" if i % 3 else None, 1) for i in range(300)]
    rows += [(1000, " ".join(w + "$$" for w in prose(9).split()), "en", "hot", 1)]
    rows += [(1001, "short", "en", "hot", 1), (1002, None, None, None, 1), (1003, "x " * 90, "en", "hot", 1)]
    rows += [(1004, " ".join(w * 3 for w in prose(8).split()), "en", "hot", 1)]
    found = judged(spark, rows)
    assert all(found[i].kept for i in range(300))
    assert not any(found[i].kept for i in range(1000, 1005))
    assert [found[i].base_failed for i in range(1000, 1005)] == [False, True, True, True, False]


def test_thresholds_follow_the_group(spark):
    code = lambda i: prose(i, 60) + " " + "{x} | " * 20
    rows = [(i, prose(i), "en", "prose", 1) for i in range(200)] + [(500 + i, code(i), "en", "code", 1) for i in range(200)]
    rows += [(900, code(7).replace("prose", "x"), "en", "prose", 1)]
    found = judged(spark, rows)
    assert all(found[500 + i].base_failed or found[500 + i].kept for i in range(200)) and not found[900].kept


def with_lines(i, lines, doubled):
    """A text of ``lines`` lines of prose, ``doubled`` of them copies of one before."""
    own = [prose(1000 * i + n, 9) for n in range(lines - doubled)]
    return "\n".join(own + own[:doubled])


def test_duplicate_lines_below_half_go_from_a_clean_source(spark):
    rows = [(i, with_lines(i, 20, 0), "en", "clean", 1) for i in range(200)]
    rows += [(500 + i, with_lines(500 + i, 20, 1), "en", "clean", 1) for i in range(3)]
    # 44 percent duplicate lines, of one word each so that few words are repeated.
    odd = [prose(700 + n, 40) for n in range(10)]
    rows += [(900, "\n".join(odd + [w.split()[0] + "z" for w in odd[:4]] * 3), "en", "clean", 1)]
    found = judged(spark, rows)
    assert all(found[i].kept for i in range(200)) and all(found[500 + i].kept for i in range(3))
    assert not found[900].base_failed and not found[900].kept


def test_a_source_full_of_junk_does_not_set_its_own_bounds(spark):
    def junk(i):
        lines = [prose(5000 + 100 * i + n, 60) for n in range(8)]
        return "\n".join(lines + ["menu", "home", "login"] * 5 + ["menu"])

    rows = [(i, with_lines(i, 12, 0), "en", f"s{i % 3}", 1) for i in range(450)]
    rows += [(1000 + i, junk(i), "en", "junk", 1) for i in range(90)]
    rows += [(2000 + i, with_lines(2000 + i, 12, 0), "en", "junk", 1) for i in range(60)]
    found = judged(spark, rows)
    assert all(found[i].kept for i in range(450)) and all(found[2000 + i].kept for i in range(60))
    assert not any(found[1000 + i].base_failed or found[1000 + i].kept for i in range(90))


def test_small_languages_are_judged_by_all_documents(spark):
    rows = [(i, with_lines(i, 12, 0), "en", "s", 1) for i in range(200)]
    rows += [(500 + i, with_lines(500 + i, 12, 0), "xx", "s", 1) for i in range(4)]
    odd = [prose(90 + n, 40) for n in range(8)]
    rows += [(900 + i, "\n".join(odd + ["menu", "home", "login"] * 5), "xx", "s", 1) for i in range(6)]
    found = judged(spark, rows)
    assert all(found[500 + i].kept for i in range(4)) and not any(found[900 + i].kept for i in range(6))


def test_sketches_merge_to_the_sketch_of_all(spark):
    df = spark.createDataFrame([(i, prose(i, 50 + i % 40), "en", f"s{i % 4}") for i in range(200)], "doc_id long, text string, lang string, source string")
    counted = quality.measured(df)
    parts = quality.sketches(counted, "lang", "source").groupBy("lang", "rule", "bin").agg(F.sum("n").alias("n"))
    whole = quality.sketches(counted.withColumn("source", F.lit("all")), "lang", "source").select("lang", "rule", "bin", "n")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_bins_are_exact_below_64_and_close_above(spark):
    for v, b in spark.range(5000).select("id", quality._bin(F.col("id"))).collect():
        assert b <= v and (b == v if v < 64 else v - b < v / 32)


def test_empty_table_and_native_plan(spark):
    assert judged(spark, []) == {}
    plan = quality.measured(spark.range(1).selectExpr("'x' text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
