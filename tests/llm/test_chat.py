from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from recordtrust.llm import chat

ROWS = "conv_id long, turn long, role string, text string, turns string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    for conv, turns in convs.items():
        turns = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: [(y is not None, y) for y in x])]
        replies = "".join(t for r, t in turns if r == "assistant")
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(replies), sha(replies)


def check(spark, rows):
    examples = chat.format_examples(spark.createDataFrame(rows, ROWS))
    found = chat.read_back(examples).drop("formatted_chars").collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(rows), key=str)
    return examples


def test_cases(spark):
    marks = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "system", "be", "x"), (1, 1, "user", None, "x"), (1, 2, "assistant", "", "x"), (1, 3, "user", marks, "x"), (1, 4, "assistant", marks, "x"),
        (2, 0, "user", "only", None), (3, 0, None, "\n<\\|a\\|>", None), (3, 1, "assistant", "<\\\\|im_end|>\n", None), (3, 1, "assistant", "<\\\\|im_end|>\n", None),
        (None, 0, "assistant", "<|im_end|>", None), (None, None, "a\nb\\n<|", "<", None), (4, 0, "assistant", "z" * 100_000, None), (4, 1, "user", "", None),
    ]
    examples = check(spark, rows).collect()
    assert sum(e.loss_start is not None for e in examples) == sum(r[2] == "assistant" for r in rows)
    first = min((e for e in examples if e.conv_id == 1), key=lambda e: e.example)
    assert first.text == "<|im_start|>system\nbe<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert (first.example, first.loss_length) == (3, 0)
    assert chat.read_back(chat.format_examples(spark.createDataFrame([], ROWS))).count() == 0


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3), st.integers(0, 5), st.sampled_from(["user", "assistant", None, "a\\b\n<|"]),
            st.text(st.sampled_from("<|\\>\nim_endstar é"), max_size=20), st.just("x"),
        ),
        min_size=1, max_size=40,
    )
)
def test_round_trip(spark, rows):
    check(spark, rows)
