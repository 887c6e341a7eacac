import hashlib

import pytest

from gamecast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment string"


def digest(rows):
    """What read_back has to say, from the turns themselves."""
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
                sum(len(x) for r, x in t if r == "assistant"),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest()) for c, t in out.items()}


ROWS = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello <|im_end|>"),
        (1, 3, "user", "<\\|im_start|> <\\\\| <| \\n"), (1, 4, "assistant", "ok\nthen"), (1, 5, "user", "bye"),
        (2, 0, "user", None), (3, 0, None, "no role"), (4, 0, "assistant", ""), (4, 0, "assistant", ""),
        (4, 0, "assistant", "tie"), (None, 1, "assistant", "lost"), (5, None, "user", "first"), (5, 0, "assistant", "x"),
        (6, 0, "ro\\nle\n<|im_end|>", "odd role"), (7, 0, "user", "\U0001F600" * 3), (7, 1, "assistant", "é\U0001F600")]


def test_read_back_gives_the_turns(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.read_back(chat.expand_prefix_targets(df)).collect()}
    assert got == digest(ROWS)


def test_every_assistant_turn_is_an_example_with_all_turns_before_it(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    expanded = chat.expand_prefix_targets(df)
    examples = {(r.conv_id, r.example_id): r for r in chat.materialize_examples(expanded).collect()}
    assert len(examples) == sum(r[2] == "assistant" for r in ROWS)
    second = examples[1, 1]
    assert chat.unescape(second.text[second.loss_start:second.loss_end]) == "ok\nthen"
    turns = second.text.split(chat.START)[1:]
    assert [t.split("\n")[0] for t in turns] == ["system", "user", "assistant", "user", "assistant"]
    assert second.text.endswith(chat.END) and second.text.count("<|im_end|>") == 5
    sizes = {(r.conv_id, r.example_id): r.example_chars for r in expanded.where("example_id is not null").collect()}
    assert sizes == {k: len(v.text) for k, v in examples.items()}


@pytest.mark.parametrize("text", ["", "<", "<|", "<\\|", "<\\\\|", "<|im_end|><|im_start|>assistant ok", "<<||", "a<\\\n|b"])
def test_escape_is_reversible_and_hides_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_empty_table(spark):
    assert chat.read_back(chat.expand_prefix_targets(spark.createDataFrame([], SCHEMA))).count() == 0


def test_the_expansion_makes_the_examples_and_they_are_what_is_read(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(chat, "BATCH_CHARS", 40)          # batches are cut within conversations
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    expanded = chat.expand_prefix_targets(df)
    for r in expanded.where("example_id is not null").collect():
        turns = [chat.unescape(t.partition("\n")[2]) for t in r.text.split(chat.END)[:-1]]
        assert len(turns) == r.turn_index + 1 and r.text.endswith(r.segment) and len(r.text) == r.example_chars
    assert expanded.where("example_id is null and text is not null").isEmpty()
    read = {r.conv_id: r for r in chat.read_back(expanded, in_order=True).collect()}
    assert {c: tuple(r)[1:5] for c, r in read.items()} == digest(ROWS)
    assert read[1].n_examples == 2 and read[1].formatted_chars > read[1].example_chars / 2
    changed = expanded.withColumn("text", F.replace("text", F.lit("hello"), F.lit("hallo")))
    assert {r.conv_id: r.turns_sha256 for r in chat.read_back(changed).collect()}[1] != read[1].turns_sha256


def test_a_conversation_of_many_turns(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k} " * 20, None) for k in range(1200)]
    got = chat.read_back(chat.expand_prefix_targets(spark.createDataFrame(rows, SCHEMA)), in_order=True).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == digest([r[:4] for r in rows])
    assert got[0].n_examples == 600 and got[0].example_chars > 100 * got[0].formatted_chars
