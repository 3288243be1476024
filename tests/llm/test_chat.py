from stratalake.llm import chat
from stratalake.llm.common import read_table

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def test_pairs(spark):
    a = [(1, 0, "user", "q"), (1, 1, "assistant", "yes"), (2, 0, "user", "same"), (3, 0, "user", None), (3, 1, None, "x"),
         (4, 0, "assistant", "only here"), (None, 0, "user", "lost"), (6, 0, "user", "é😀"), (6, 1, "assistant", "a"), (6, 1, "assistant", "a")]
    b = [(1, 0, "user", "q"), (1, 1, "assistant", "no"), (1, 2, "user", "why"), (2, 0, "user", "same"), (3, 0, "user", ""), (5, 0, "user", "z"),
         (6, 0, "user", "é😀"), (6, 1, "assistant", "b")]
    got = {r["pair_id"]: r for r in chat.format_pairs(frame(spark, a), frame(spark, b)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    one = got[1]
    assert one["prompt"] == "<|im_start|>user\nq<|im_end|>\n" and one["prompt_turns"] == 1
    learned = lambda t, spans: [t[s["start"] : s["start"] + s["length"]] for s in spans]
    assert learned(one["chosen"], one["chosen_spans"]) == ["yes<|im_end|>\n"]
    assert learned(one["rejected"], one["rejected_spans"]) == ["no<|im_end|>\n"]
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["prompt_turns"] == 1
    assert got[3]["prompt_turns"] == 0 and got[3]["chosen"] == "<|im_start|>user\n<|im_end|>\n<|im_start|>\nx<|im_end|>\n"
    assert got[4]["rejected"] == "" and got[5]["chosen"] == ""
    assert learned(got[6]["chosen"], got[6]["chosen_spans"]) == ["a<|im_end|>\n"] * 2
    assert chat.format_pairs(frame(spark, []), frame(spark, [])).count() == 0


def test_query_on_whole_table(spark):
    conv = read_table(spark, "/root/testdata/sf0.001", "conversations")
    got = chat.format_pairs(conv, chat.with_foreign_reply(conv)).collect()
    turns: dict = {}
    for r in sorted(conv.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert len(got) == len(turns)
    for r in got:
        assert r["prompt"] + r["chosen"] == chat.render(turns[r["pair_id"]])[0]
