import hashlib

import pytest

from leadpanel.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, valid int"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


NASTY = [
    chat.TRAP, "", "\\", "<\\|", "<<|im_end|>", "a<", "<|im_start|>user\nhi<|im_end|>\n", "\\<|\\\\|", "\n", "é😀 <|", "$1 \\$", "x" * 200_000,
]


@pytest.mark.parametrize("text", NASTY)
def test_texts_come_back(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text)]
    parsed = chat.read_back(chat.format_conversations(table(spark, rows))).first()
    assert [(t["role"], t["text"]) for t in parsed["turns"]] == [("user", text), ("assistant", text)]
    assert parsed["loss_texts"] == [text]
    assert parsed["valid"]
    assert parsed["formatted"].count("<|im_start|>") == 2 and parsed["formatted"].count("<|im_end|>") == 2


def test_digests(spark):
    rows = [(1, 2, "user", "more"), (1, 0, "user", "hé"), (1, 1, "assistant", "😀b"), (1, 3, "assistant", None)]
    row = chat.digests(chat.read_back(chat.format_conversations(table(spark, rows)))).first()
    assert row["n_turns"] == 4 and row["loss_chars"] == 2 and row["valid"]
    assert row["turns_sha256"] == sha("user\nhé\nassistant\n😀b\nuser\nmore\nassistant\n\n")
    assert row["loss_sha256"] == sha("😀b")


@pytest.mark.parametrize("roles, valid", [
    (["user", "assistant"], True),
    (["system", "user", "assistant"], True),
    (["user", "assistant", "tool", "assistant"], True),
    (["user"], False),
    (["assistant", "user"], False),
    (["user", "user", "assistant"], False),
    (["system", "assistant"], False),
    (["user", "assistant", "system"], False),
    (["user", "oracle"], False),
    (["user", None], False),
])
def test_turn_order(spark, roles, valid):
    rows = [(1, at, role, "t") for at, role in enumerate(roles)]
    row = chat.format_conversations(table(spark, rows)).first()
    assert row["valid"] is valid
    parsed = chat.read_back(chat.format_conversations(table(spark, rows))).first()
    assert [t["role"] for t in parsed["turns"]] == [role or "" for role in roles]


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, None, None, None), (None, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
        (3, 0, "ro\nle\\<|x", "t"),
    ]
    parsed = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(chat.format_conversations(table(spark, rows))).collect()}
    assert parsed == {
        None: [("", ""), ("user", "a")], 2: [("user", "a"), ("user", "a"), ("user", "b")], 3: [("ro\nle\\<|x", "t")],
    }


def test_segments_make_up_the_text(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    row = chat.format_conversations(table(spark, rows)).first()
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["a"]


def test_empty_table(spark):
    assert chat.digests(chat.read_back(chat.format_conversations(table(spark, [])))).count() == 0


def test_no_python_in_the_plan(spark):
    df = chat.digests(chat.read_back(chat.format_conversations(table(spark, [(1, 0, "user", "a")]))))
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))
