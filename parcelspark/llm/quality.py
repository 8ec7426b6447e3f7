"""Quality rules whose thresholds follow the corpus: quantile sketches per language and source, then a join and a filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import cols, free, others, stored
from parcelspark.llm.secrets import let

BLANKS = "\t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A measure in whole numbers, and how far beyond the quartiles a document of its group may lie.

    The upper bound is Q3 + ``reach`` * max(Q3 - Q1, ``least_spread``), the lower one likewise below Q1 where
    ``lower`` is set. The least spread keeps a group of nearly equal documents from rejecting small differences.
    Where ``common_spread`` is given, the upper bound is at most what the same formula gives for all sources of the
    language, and for all languages, with that least spread: a source full of junk does not set its own bound.
    """

    name: str
    measure: str
    least_spread: int
    reach: int = 3
    lower: bool = False
    common_spread: int | None = None


# One line that comes twice is no sign of junk, so ``dup_lines`` counts from the second on. Word lengths and symbols differ
# by kind of text, so that a source of code is its own measure.
RULES = (
    Rule("word_length", "(word_chars * 100) div n_words", 50, lower=True),
    Rule("symbols", "(n_symbols * 1000) div word_chars", 10),
    Rule("dup_lines", "(greatest(n_dup_lines - 1L, 0L) * 1000) div n_lines", 30, common_spread=100),
    Rule("repeats", "(n_repeat_words * 1000) div n_words", 50, common_spread=100),
)


def _repeat_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more."""

    def positions(windows: Column) -> Column:
        def repeated(order: Column) -> Column:
            same = lambda a, b: F.get(order, a)["t"] == F.get(order, b)["t"]
            return F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.size(order) - 1),
                    lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
                ),
                lambda j: F.get(order, j)["i"],
            )

        keyed = F.transform(windows, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
        return F.sort_array(let(F.sort_array(keyed), repeated))

    def covered(windows: Column) -> Column:
        counted = F.aggregate(
            positions(windows),
            F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
            lambda acc, p: F.struct(
                (p + 3).alias("upto"), (acc["n"] + p + 3 - F.greatest(acc["upto"], p)).alias("n")
            ),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted)

    return F.when(
        F.size(words) >= 4,
        let(
            F.transform(
                F.slice(words, 1, F.size(words) - 2),
                lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)),
            ),
            covered,
        ),
    ).otherwise(F.lit(0))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``counts``, a struct of ``COUNTS`` over the whole text; a null text has none of anything.

    Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    spaced = F.translate(body, BLANKS, " " * len(BLANKS))
    with_word = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(" " + BLANKS)) != "")
    of_words = let(
        F.array_remove(F.split(spaced, " ", -1), ""),
        lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")),
    )
    of_lines = let(with_word, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    values = lambda w, x: (
        w["n"],
        F.length(F.replace(spaced, F.lit(" "), F.lit(""))),
        F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        x["n"],
        x["dup"],
        w["repeat"],
    )
    return df.select(
        *cols(others(df, "counts")),
        let(
            F.struct(of_words.alias("w"), of_lines.alias("x")),
            lambda s: F.struct(
                *(v.cast("long").alias(c) for c, v in zip(COUNTS, values(s["w"], s["x"])))
            ),
        ).alias("counts"),
    )


def base_failed(counts: str = "counts") -> Column:
    n, repeat = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * repeat > 50 * n)


def _measures() -> Column:
    """The measures of a document that has words, in the order of ``RULES``."""
    import re

    texts = [re.sub("|".join(COUNTS), lambda m: f"counts.{m[0]}", rule.measure) for rule in RULES]
    return F.expr("array(" + ", ".join(f"CASE WHEN counts.n_words > 0 THEN {t} END" for t in texts) + ")")


def _bin(value: Column) -> Column:
    """Start of a value's sketch bin: exact below 64, else its six leading bits, so off by under a thirty-second."""
    rest = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(
        value - value % F.pow(F.lit(2.0), rest.cast("double")).cast("long")
    )


def sketches(candidates: DataFrame, lang: str, source: str) -> DataFrame:
    """A quantile sketch per language, source and rule: (lang, source, rule, bin, n). Sketches merge by adding ``n``
    of equal bins, which is what the map side does before any row is shuffled; a sketch has at most some 2,000 bins."""
    return (
        candidates.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.posexplode(_measures()))
        .groupBy("lang", "source", F.col("pos").alias("rule"), _bin(F.col("col")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    group = Window.partitionBy(*keys, "rule")
    run = sketch.withColumns(
        {"upto": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group)}
    )
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin")))
    return run.groupBy(*keys, "rule").agg(
        at(1).alias("q1"), at(3).alias("q3"), F.max("total").alias("total")
    )


def thresholds(sketch: DataFrame, least_rows: int = 100) -> DataFrame:
    """(lang, source, bounds): ``bounds`` has (rule, low, high) for each rule.

    Quartiles are those of the group if it has ``least_rows`` documents, else those of its language's merged sketches,
    and if that has fewer too, those of all documents.
    """
    own = _quartiles(sketch, ["lang", "source"])
    merged = _quartiles(
        sketch.groupBy("lang", "rule", "bin").agg(F.sum("n").alias("n")), ["lang"]
    ).select(F.col("lang").alias("l"), F.col("rule").alias("r"), F.struct("q1", "q3", "total").alias("of_lang"))
    whole = _quartiles(sketch.groupBy("rule", "bin").agg(F.sum("n").alias("n")), []).select(
        F.col("rule").alias("all_rule"), F.struct("q1", "q3").alias("of_all")
    )
    joined = own.join(merged, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("r"))).join(
        whole, F.col("rule") == F.col("all_rule")
    )
    pick = lambda q: (
        F.when(F.col("total") >= least_rows, F.col(q))
        .when(F.col("of_lang.total") >= least_rows, F.col(f"of_lang.{q}"))
        .otherwise(F.col(f"of_all.{q}"))
    )
    both = joined.select("lang", "source", "rule", pick("q1").alias("q1"), pick("q3").alias("q3"), "of_lang", "of_all")
    params = F.array(
        *(
            F.struct(
                F.lit(r.least_spread).alias("least"),
                F.lit(r.reach).alias("reach"),
                F.lit(r.lower).alias("lower"),
                F.lit(r.common_spread).cast("int").alias("common"),
            )
            for r in RULES
        )
    )[F.col("rule")]
    beyond = lambda q1, q3, least: params["reach"] * F.greatest(q3 - q1, least)
    of_own = beyond(F.col("q1"), F.col("q3"), params["least"])
    of_more = [
        F.when(
            params["common"].isNotNull(),
            F.col(f"{s}.q3") + beyond(F.col(f"{s}.q1"), F.col(f"{s}.q3"), params["common"]),
        )
        for s in ("of_lang", "of_all")
    ]
    # ``least`` passes over the bounds that a rule does not have.
    return both.groupBy("lang", "source").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "rule",
                    F.when(params["lower"], F.col("q1") - of_own).otherwise(F.lit(0)).alias("low"),
                    F.least(F.col("q3") + of_own, *of_more).alias("high"),
                )
            )
        ).alias("bounds")
    )


def judged(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted``, the result of ``measured``, with ``base_failed`` and ``kept``.

    It is written to the shared folder once, with whatever columns it still has, since it is read twice: documents
    that pass the base rules feed the sketches of their language and source; then each document is joined with the
    thresholds of its group (null languages and sources are groups like others) and kept if every measure lies
    within them. The thresholds table has one row per group and is written first, so that Spark knows its size when
    it plans the join and broadcasts it if it is small; else a hot group's rows are split by AQE. No threshold depends on row order or partitioning. An empty table stays
    empty; input columns named like an added column are replaced.
    """
    kept = others(counted, "counts", "base_failed", "kept")
    rows = stored(counted.select(*cols(kept), "counts"), "counted")
    good = rows.where(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), "counts")
    its_lang, its_source, its_bounds = (free(rows, c) for c in ("_lang", "_source", "_bounds"))
    bounds = stored(thresholds(sketches(good, "lang", "source")), "bounds").select(
        F.col("lang").alias(its_lang), F.col("source").alias(its_source), F.col("bounds").alias(its_bounds)
    )
    joined = rows.join(
        bounds, F.col(lang).eqNullSafe(F.col(its_lang)) & F.col(source).eqNullSafe(F.col(its_source)), "left"
    )
    within = let(
        _measures(),
        lambda m: F.forall(
            F.col(its_bounds), lambda b: (F.get(m, b["rule"]) >= b["low"]) & (F.get(m, b["rule"]) <= b["high"])
        ),
    )
    failed = base_failed()
    return joined.select(
        *cols(kept),
        "counts",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(F.coalesce(within, F.lit(False))).alias("kept"),
    )
