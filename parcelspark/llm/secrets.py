"""Secrets in texts: three fixed kinds, and candidate strings whose sliding-window entropy is that of random keys."""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import cols, free, others

# The three base kinds, in the order in which spans at one place are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
# Character classes of candidates, the first that fits: name, pattern of the whole string, window, least bits a
# character, and what the string must hold. Where digits or a case are missing, words, paths and names in code look
# alike, so these classes ask for more bits.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", 24, 2.9, r"^(?=.*[0-9])(?=.*[A-Fa-f])"),
    ("short hex", r"^[0-9A-Fa-f]+$", 20, 2.85, r"^(?=.*[0-9])(?=.*[A-Fa-f])"),
    ("alphanumeric", r"^[0-9A-Za-z]+$", 20, 3.5, r"^(?=(?:.*[0-9]){2})(?=.*[A-Za-z])"),
    ("token", r"^[0-9A-Za-z+/_=-]+$", 20, 3.6, r"^(?=(?:.*[0-9]){2})(?=.*[A-Z])(?=.*[a-z])"),
    ("few digits", r"^[0-9A-Za-z+/_=-]+$", 20, 3.9, r"^(?=.*[A-Z])(?=.*[a-z])"),
    ("letters of one case", r"^[0-9A-Za-z]+$", 20, 3.75, r"[A-Za-z]"),
    ("token of one case", r"^[0-9A-Za-z+/_=-]+$", 20, 3.9, r"[A-Za-z]"),
)
# Never reported by entropy: UUIDs, published sample keys, runs of the alphabet or of digits, data that only repeats.
# These parts are cut out of a candidate; what is left of it is judged. A sample word takes the letters and digits
# it is attached to.
ALLOW = "|".join(
    (
        r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])",
        r"(?<![0-9A-Za-z])[0-9A-Za-z]*?(?i:example|sample|dummy|placeholder|your[_-]?key)[0-9A-Za-z]*+",
        r"(?i:abcdefghij(?:klmnopqrstuvwxyz)?)|0123456789|1234567890",
        r"(.{1,8})\1{3,}+",
    )
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """``merge`` of each number of an array with all before it, for an associative ``merge``.

    Appending to an array copies it, so numbers are run over in pieces of about the square root of their count, and
    then the pieces' last ones: n numbers cost some n * sqrt(n) copies of a word.
    """
    none = F.array().cast("array<long>")

    def through(piece: Column) -> Column:
        follow = lambda acc, x: F.when(F.size(acc) == 0, F.array(x)).otherwise(
            F.concat(acc, F.array(merge(F.get(acc, F.size(acc) - 1), x)))
        )
        return F.aggregate(piece, none, follow)

    def joined(pieces: Column) -> Column:
        return let(
            through(F.transform(pieces, lambda p: F.get(p, F.size(p) - 1))),
            lambda ends: F.flatten(
                F.transform(
                    pieces, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda v: merge(F.get(ends, i - 1), v)))
                )
            ),
        )

    def cut(own: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(own))).cast("int")
        starts = F.sequence(F.lit(1), F.size(own), step)
        return let(F.transform(starts, lambda at: through(F.slice(own, at, step))), joined)

    return let(values.cast("array<long>"), lambda own: F.when(F.size(own) > 0, cut(own)).otherwise(none))


def matches(text: Column, pattern: str) -> Column:
    """(start, end, found) of the leftmost non-overlapping matches, in code points, end exclusive.

    The text between matches, from a split at the same pattern, tells where they start; texts without a match are
    searched once only. The pattern must not match the empty string.
    """
    shape = "array<struct<start:int,end:int,found:string>>"

    def placed(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        lengths = F.zip_with(between, found, lambda b, f: F.length(b) + F.length(f))
        return F.zip_with(
            found,
            running(lengths, lambda a, b: a + b),
            lambda f, end: F.struct((end - F.length(f)).cast("int").alias("start"), end.cast("int").alias("end"), f.alias("found")),
        ).cast(shape)

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(F.array().cast(shape)),
    )


def _times_log(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def dense_part(candidate: Column, window: int, bits: float) -> Column:
    """(start, end) of the part of an ASCII string that windows of ``window`` characters with at least ``bits`` bits of
    Shannon entropy a character cover, or null.

    The window slides by one character; the counts of the one that comes in and the one that goes out change, and
    with them the running sum of n log n, so a step costs the same for any window and at any place.
    """
    return _dense_by(candidate, F.lit(window), F.lit(bits), F.lit(log2(window)))


def _dense_by(candidate: Column, window: Column, bits: Column, most: Column) -> Column:
    return let(
        F.transform(F.split(candidate, ""), lambda letter: F.ascii(letter)), lambda codes: _dense(codes, window, bits, most)
    )


def _dense(codes: Column, window: Column, bits: Column, most: Column) -> Column:
    changed = lambda counts, code, by: F.transform(
        counts, lambda n, i: F.when(i == code, n + F.lit(by)).otherwise(n)
    )
    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("low"),
        F.lit(None).cast("int").alias("high"),
    )

    def step(state: Column, i: Column) -> Column:
        return let(
            F.struct(F.get(codes, i - 1).alias("into"), F.get(codes, i - window - 1).alias("gone")),
            lambda at: moved(state, i, at["into"], at["gone"]),
        )

    def moved(state: Column, i: Column, into: Column, gone: Column) -> Column:
        def leave(now: Column) -> Column:
            n = now["counts"][gone]
            return F.when(
                i > window,
                F.struct(
                    changed(now["counts"], gone, -1).alias("counts"),
                    (now["sum"] - _times_log(n) + _times_log(n - 1)).alias("sum"),
                ),
            ).otherwise(now)

        def enter(now: Column) -> Column:
            n = now["counts"][into]
            return F.struct(
                changed(now["counts"], into, 1).alias("counts"),
                (now["sum"] - _times_log(n) + _times_log(n + 1)).alias("sum"),
            )

        def judged(now: Column) -> Column:
            dense = (i >= window) & (most - now["sum"] / window >= bits)
            return F.struct(
                now["counts"].alias("counts"),
                now["sum"].alias("sum"),
                F.when(dense, F.coalesce(state["low"], i - window)).otherwise(state["low"]).alias("low"),
                F.when(dense, i).otherwise(state["high"]).alias("high"),
            )

        counts = F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"))
        return let(let(counts, leave), lambda left: let(enter(left), judged))

    return F.aggregate(
        F.sequence(F.lit(1), F.size(codes)),
        start,
        step,
        lambda state: F.when(
            state["low"].isNotNull(), F.struct(state["low"].alias("start"), state["high"].alias("end"))
        ),
    )


def _unlisted(candidate: Column) -> Column:
    """(start, found) of the parts of a candidate that the allow-list leaves."""
    shape = "array<struct<start:int,found:string>>"

    def parts(allowed: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(allowed, lambda m: m["end"]))
        starts = F.concat(F.transform(allowed, lambda m: m["start"]), F.array(F.length(candidate)))
        return F.transform(
            F.arrays_zip(ends.alias("low"), starts.alias("high")),
            lambda p: F.struct(
                p["low"].alias("start"), F.substring(candidate, p["low"] + 1, p["high"] - p["low"]).alias("found")
            ),
        ).cast(shape)

    return let(matches(candidate, ALLOW), parts)


def _unlisted_parts(candidates: Column) -> Column:
    """(start, found) of what the allow-list leaves of the candidates of a text."""
    return F.flatten(
        F.transform(
            candidates,
            lambda m: F.transform(
                _unlisted(m["found"]), lambda u: F.struct((m["start"] + u["start"]).alias("start"), u["found"].alias("found"))
            ),
        )
    )


def _dense_spans(parts: Column) -> Column:
    """(start, end) of the dense parts among (start, found)."""

    def dense(found: Column) -> Column:
        rule = F.lit(None).cast("struct<window:int,bits:double,most:double>")
        for _, whole, window, bits, holds in reversed(CLASSES):
            fits = (F.length(found) >= window) & found.rlike(whole) & found.rlike(holds)
            own = F.struct(F.lit(window).alias("window"), F.lit(bits).alias("bits"), F.lit(log2(window)).alias("most"))
            rule = F.when(fits, own).otherwise(rule)
        return let(rule, lambda r: F.when(r.isNotNull(), _dense_by(found, r["window"], r["bits"], r["most"])))

    placed = F.transform(
        parts,
        lambda u: let(
            dense(u["found"]),
            lambda part: F.struct((u["start"] + part["start"]).alias("start"), (u["start"] + part["end"]).alias("end")),
        ),
    )
    return F.filter(placed, lambda m: m["start"].isNotNull())


def _apart(spans: Column, known: Column) -> Column:
    """The ``spans`` that touch no ``known`` one. All are put in order once: what a span could touch is the known one
    that ends last of those before it, and the first of those behind it."""
    marked = F.concat(
        F.transform(known, lambda m: F.struct(m["start"].alias("start"), F.lit(0).alias("new"), m["end"].alias("end"))),
        F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("new"), m["end"].alias("end"))),
    )
    far = 1 << 40

    def sorted_out(order: Column) -> Column:
        ends = running(F.transform(order, lambda m: F.when(m["new"] == 0, m["end"]).otherwise(-1)), F.greatest)
        starts = F.reverse(
            running(F.reverse(F.transform(order, lambda m: F.when(m["new"] == 0, m["start"]).otherwise(F.lit(far)))), F.least)
        )
        free = F.transform(
            F.arrays_zip(order.alias("m"), ends.alias("before"), starts.alias("after")),
            lambda x: F.struct(
                x["m"]["start"].alias("start"),
                x["m"]["end"].alias("end"),
                ((x["m"]["new"] == 1) & (x["before"] <= x["m"]["start"]) & (x["after"] >= x["m"]["end"])).alias("free"),
            ),
        )
        return F.transform(F.filter(free, lambda x: x["free"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    return F.when(
        F.size(spans) > 0, F.when(F.size(known) > 0, let(F.sort_array(marked), sorted_out)).otherwise(spans)
    ).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _kind(spans: Column, rank: int) -> Column:
    return F.transform(
        spans, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))
    )


def scanned(df: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``df`` with ``into``: the sorted array of (start, rank, end), in code points, end exclusive; ``KINDS[rank]`` is
    the kind.

    Base kinds are the leftmost non-overlapping matches of each pattern; an assignment counts if its value has six
    characters or more. An entropy span is added where it touches no base span. A null text is an empty one.
    Built-in functions only, no shuffle; whole texts are searched. A column named ``into`` is replaced.
    """
    kept = others(df, into)
    assigns, accesses, hexes, found, parts, base, added = (
        free(df, f"_{name}") for name in ("assigns", "accesses", "hexes", "found", "parts", "base", "added")
    )
    body = F.coalesce(F.col(text), F.lit(""))
    long_enough = lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= 6
    # A step at a time, since functions in functions would be too deep for the analyzer; Spark runs them as one.
    searched = df.select(
        *cols(kept),
        F.filter(matches(body, ASSIGN), long_enough).alias(assigns),
        matches(body, ACCESS).alias(accesses),
        matches(body, HEX).alias(hexes),
        matches(body, CANDIDATE).alias(found),
    )
    judged = searched.select(
        *cols(kept),
        F.concat(*(_kind(F.col(c), rank) for rank, c in enumerate((assigns, accesses, hexes)))).alias(base),
        _unlisted_parts(F.col(found)).alias(parts),
    ).select(*cols(kept), base, _dense_spans(F.col(parts)).alias(added))
    apart = judged.select(*cols(kept), base, _kind(_apart(F.col(added), F.col(base)), 3).alias(added))
    return apart.select(*cols(kept), F.sort_array(F.concat(base, added)).alias(into))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda m: F.concat_ws(":", kinds[m["rank"]], m["start"].cast("string"), m["end"].cast("string")),
        ),
        ",",
    )


def redacted(df: DataFrame, text: str = "text", by: str = "[SECRET]") -> DataFrame:
    """``df`` with each secret in ``text`` replaced by ``by``, spans that overlap or touch by one. Texts without a
    secret, null ones too, stay as they are."""
    body = F.col(text)

    def cleaned(spans: Column) -> Column:
        return F.aggregate(
            spans,
            F.struct(F.lit(0).alias("at"), F.lit(False).alias("cut"), F.array().cast("array<string>").alias("out")),
            lambda acc, m: F.when(
                acc["cut"] & (m["start"] <= acc["at"]),
                F.struct(F.greatest(acc["at"], m["end"]).alias("at"), acc["cut"].alias("cut"), acc["out"].alias("out")),
            ).otherwise(
                F.struct(
                    m["end"].alias("at"),
                    F.lit(True).alias("cut"),
                    F.concat(
                        acc["out"],
                        F.array(F.substring(body, acc["at"] + 1, m["start"] - acc["at"]), F.lit(by)),
                    ).alias("out"),
                )
            ),
            lambda acc: F.concat(
                F.array_join(acc["out"], ""), F.substring(body, acc["at"] + 1, F.length(body))
            ),
        )

    names = df.columns
    spans = "_spans"
    while spans in names:
        spans += "_"
    return scanned(df, text, spans).select(
        *(
            F.when(F.size(spans) > 0, cleaned(F.col(spans))).otherwise(body).alias(c) if c == text else cols([c])[0]
            for c in names
        )
    )
