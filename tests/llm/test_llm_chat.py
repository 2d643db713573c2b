"""Chat formatting: roles of any characters come back, probes that texts hold, and long conversations."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from lapsewise.llm import chat

ODD = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "\\", "\\n", "\n", "n", "<", "", "", "é", "<|", "<<SYS>>"]), max_size=7).map("".join)


@given(st.lists(st.tuples(ODD, ODD), max_size=5))
def test_any_role_and_text_come_back(turns):
    text, rewritten, spans = chat.locate(turns, chat.template, loss_roles=tuple({r for r, _ in turns}))
    assert rewritten is None and chat.parse(text) == turns
    assert [chat.unescape(text[s["text_start"]: s["text_stop"]]) for s in spans] == [t for _, t in turns]


def test_rows_with_odd_roles_and_a_long_conversation(spark):
    turns = [(1, 0, "us\ner", " hi"), (1, 1, "assistant", "")]
    turns += [(2, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(1500)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    for conv in (1, 2):
        own = [(r, t) for c, _, r, t in turns if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
