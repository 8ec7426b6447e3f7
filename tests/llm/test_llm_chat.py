from __future__ import annotations

import hashlib
import random

import pytest

from parcelspark.llm import chat


def test_escaping_and_parsing_are_exact():
    draw = random.Random(1)
    odd = ["</s>", "[INST]", "\\", "\\\\", "<", "[", "/", "s>", "<s>", "x", "\n", "[ROLE]", " [TEXT] ", "é"]
    for _ in range(4000):
        text = "".join(draw.choice(odd) for _ in range(draw.randrange(9)))
        for role in ("user", "assistant", "system", "tool", None, "a\nb [TEXT] ", text):
            before, after, _ = chat.INST.around(role)
            escaped = chat.INST.escaped(text)
            assert not any(mark in escaped for mark in ("<s>", "</s>", "[INST]", "[/INST]"))
            assert chat.INST.parsed(before + escaped + after) == [(role, text)]


def test_template_needs_usable_control_strings():
    with pytest.raises(ValueError):
        chat.Template(turns={"user": ("<\\x>", "</x>", False)}, moves={}, ends=(), other=("<r> {role} ", "</r>", False))


CASES = {
    1: [("user", "hi"), ("assistant", "there")],
    2: [("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "again")],
    3: [("assistant", "first")],
    4: [("user", None), ("assistant", "</s>[INST] ok [/INST]")],
    5: [("tool", "t"), (None, "n")],
    6: [("user", "x" * 200_000), ("assistant", "é😀" * 50_000)],
}


def table(spark, cases=CASES):
    rows = [(conv, turn, role, text, "z") for conv, turns in cases.items() for turn, (role, text) in enumerate(turns)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, KIND string")


def test_machine_accepts_alternation_that_ends_with_the_assistant(spark):
    found = {r.conv_id: r.valid for r in chat.segments(table(spark)).where("last").collect()}
    assert found == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True}


def test_digests_read_back_from_the_formatted_text(spark):
    found = {r.conv_id: r for r in chat.read_back(chat.segments(table(spark))).collect()}
    assert set(found) == set(CASES)
    for conv, turns in CASES.items():
        said = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
        loss = "".join(text or "" for role, text in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_segments_have_gapless_places_and_flags(spark):
    rows = chat.segments(table(spark)).where("conv_id = 2").orderBy("segment").collect()
    at = 0
    for number, r in enumerate(rows):
        assert (r.segment, r.start) == (number, at)
        assert r.loss == (r.role == "assistant" and r.kind == "text")
        at += len(r.content)


def test_ties_repeats_null_keys_and_empty(spark):
    rows = [(None, 0, "user", "b"), (None, 0, "user", "a"), (None, 0, "user", "a"), (7, None, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r.n_turns for r in chat.read_back(chat.segments(df)).collect()}
    assert found == {None: 3, 7: 1}
    said = [r.content for r in chat.segments(df).where("conv_id IS NULL AND kind = 'text'").orderBy("segment").collect()]
    assert said == ["a", "a", "b"]
    assert chat.segments(df.limit(0)).count() == 0


def test_segments_out_of_place_are_refused(spark):
    written = chat.segments(table(spark)).coalesce(1).sortWithinPartitions("conv_id", "segment").cache()
    whole = {r.conv_id: r.turns_sha256 for r in chat.read_back(written).collect()}
    assert whole == {r.conv_id: r.turns_sha256 for r in chat.read_back(chat.segments(table(spark))).collect()}
    assert chat.read_back(written.limit(0)).count() == 0
    for broken in (
        written.sortWithinPartitions("segment", "conv_id"),
        written.where("NOT (conv_id = 2 AND segment = 3)"),
        written.where("NOT (conv_id = 2 AND last)"),
        written.union(written.where("conv_id = 2")).coalesce(1).sortWithinPartitions("conv_id", "segment"),
    ):
        with pytest.raises(Exception, match="must follow|ends before"):
            chat.read_back(broken).collect()
