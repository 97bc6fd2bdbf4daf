import itertools

import numpy as np
import pytest

from yieldcast.llm import chat_format as C

MARKS = {"user": "User: ", "assistant": "Assistant: ", "system": "System: "}


def chats(rng, words, n=60):
    rows = []
    for c in range(n):
        turns = [("system", 1)] * (c % 5 == 0) + [("user", 1), ("assistant", 3)] * rng.randint(1, 4)
        for t, (role, lines) in enumerate(turns):
            text = "\n".join(" ".join(rng.choices(words, k=rng.randint(3, 25))) for _ in range(lines))
            rows.append((c, t, role, text + ("?" if role == "user" else ".")))
    return rows


@pytest.fixture
def model(spark, rng, words):
    rows = [(c, t, r, MARKS[r] + x) for c, t, r, x in chats(rng, words)] + [(1, 99, None, "x"), (2, 99, "tool", "y")]
    return C.train(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_markers():
    assert C.observe("User: hi there?") == ((2, 1, 1), "hi there?")
    assert C.observe("### Assistant") == ((3, 0, 0), "") and C.observe("[system] x")[0][0] == 1
    assert C.observe("**Human:** x") == ((2, 1, 0), "x") and C.observe("Speaker 2: x")[0][0] == 4
    assert C.observe("<|ai|> x")[0][0] == 3 and C.observe("a dog") == ((0, 1, 0), "a dog") and C.observe("") == ((0, 0, 0), "")


def test_viterbi_in_parts_matches_every_path(model):
    lines = ["User: a b?", "and more", "Speaker: c", "[ai] d e f", "", "why?"]
    scores = C._scores([C.observe(x)[0] for x in lines], model)
    step = np.array(model["step"])

    def worth(path):
        return sum(step[b, s] + scores[k][s] for k, (b, s) in enumerate(zip([C.START, *path], path)))

    best = max(itertools.product(range(C.STATES), repeat=len(lines)), key=worth)
    whole = C._through(scores, model)[C.START]
    assert np.isclose(whole.max(), worth(best))
    assert np.isclose(worth(C._best_states(scores, model, C.START, int(whole.argmax()))), worth(best))
    left, right = C._through(scores[:2], model), C._through(scores[2:], model)
    assert np.allclose((left[:, :, None] + right[None, :C.STATES]).max(axis=1), C._through(scores, model))


def decoded(spark, model, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, seq long, text string, role string")
    return C.format_chats(df, model).collect()


def test_turns_come_back(spark, rng, words, model):
    rows = chats(rng, words, 40)
    got = {(r.conv_id, r.start_seq): r for r in decoded(spark, model, [(c, t, MARKS[r] + x) for c, t, r, x in rows])}
    right = sum((c, t) in got and got[c, t].role == r and got[c, t].text == x for c, t, r, x in rows)
    assert right / len(rows) > 0.95
    r = got[0, 0]
    assert r.rendered == f"<|im_start|>{r.role}\n{r.text}<|im_end|>"


def test_one_long_transcript_decodes_like_a_single_block(spark, rng, words, model, monkeypatch):
    raw = [(1, k, rng.choice(list(MARKS.values()) + ["", "", "Speaker: "]) + " ".join(rng.choices(words, k=rng.randint(0, 9)))) for k in range(90)]
    key = lambda r: (r.start_seq, r.start_line, r.role, r.text)
    monkeypatch.setattr(C, "BLOCK", 1000)
    whole = sorted(map(key, decoded(spark, model, raw)))
    monkeypatch.setattr(C, "BLOCK", 3)
    assert sorted(map(key, decoded(spark, model, raw))) == whole


def test_nulls_repeats_and_empty_table(spark, model):
    got = decoded(spark, model, [(None, 0, "User: x"), (None, None, None), (1, 0, ""), (2, 0, "User: a\nAssistant: b"), (2, 0, "User: a\nAssistant: b")])
    assert sorted(r.text for r in got if r.conv_id == 2) == ["a", "b"]
    assert {r.conv_id for r in got} == {None, 1, 2}
    assert decoded(spark, model, []) == []
