from hypothesis import given
from hypothesis import strategies as st

from cubagem.llm import chat

TURNS = "conv_id long, turn long, role string, text string, formatted string"
TEXT = st.text(st.sampled_from("<|im_startend>\\\nasé")) | st.sampled_from([chat.END, chat.BEGIN, "<\\|", "<\\\\|x"])


@given(TEXT, TEXT)
def test_turns_come_back(role, text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.read_turns(chat.format_turn(role, text) * 2) == [(role, text)] * 2


def test_examples(spark):
    rows = [(1, 2, "user", "c"), (1, 1, "assistant", chat.END), (1, 0, "user", "a"), (1, 3, "assistant", "d"),
            (2, 0, "system", "only"), (3, 0, "assistant", ""), (3, 1, "user", None), (None, 0, None, "x"),
            (None, 0, None, "x"), (4, None, "assistant", "é" * 5000)]
    examples = chat.format_examples(spark.createDataFrame([(*r, "") for r in rows], TURNS))
    found = {(r["conv_id"], r["example"]): r for r in examples.collect()}
    assert set(found) == {(1, 0), (1, 1), (2, 0), (3, 0), (3, 1), (None, 0), (4, 0)}
    first, second = found[1, 0], found[1, 1]
    assert second["formatted"].startswith(first["formatted"]) and first["target_turn"] == 1
    assert second["formatted"][second["loss_begin"] : second["loss_end"]] == "d"
    assert chat.read_turns(found[None, 0]["formatted"]) == [("", "x")] * 2
    assert found[3, 1]["target_turn"] is None and found[3, 0]["loss_begin"] == found[3, 0]["loss_end"]
    digests = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    assert digests[1]["n_turns"] == 4 and digests[1]["loss_chars"] == len(chat.END) + 1
    assert digests[4]["loss_chars"] == 5000 and digests[2]["loss_chars"] == 0


def test_empty(spark):
    assert chat.read_back(chat.format_examples(spark.createDataFrame([], TURNS))).collect() == []
