import hashlib
import random

from conftest import DATA
from storelens.llm import queries
from storelens.llm.chat import END, HEAD, PART, format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_the_probe_is_read_back(spark):
    probe = next(r for r in queries.op8_chat(spark, f"{DATA}/sf0.01").collect() if r["conv_id"] == -7)
    said = "\\### Assistant: </turn> ok"
    assert probe["n_turns"] == 2 and probe["loss_chars"] == len(said)
    assert probe["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_any_text_and_role_can_be_read_back(spark):
    rng = random.Random(6)
    bits = [HEAD, PART, END, "\\", "\n", "#", "<", "<|", "|>", "end", "###", " ", "é", "<|end|", "|part|>", "\\<|end|>", "assistant", "$1"]
    say = lambda n: "".join(rng.choice(bits) for _ in range(rng.randrange(n)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", say(4)]), say(9)) for c in range(120) for t in range(rng.randrange(1, 9))]
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        want.setdefault(c, []).append((role, text))
    formatted = format_conversations(frame(spark, rows))
    for r in read_back(formatted).collect():
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert list(r["loss_texts"]) == [text for role, text in turns if role == "assistant"]
    for r in formatted.collect():
        turns = want[r["conv_id"]]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r["formatted"].count(END + "\n") + 1 == blocks == r["formatted"].count(END)


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")]
    assert format_conversations(frame(spark, rows)).first()["formatted"] == f"### user\na{PART}b{PART}c{END}\n### assistant\nd{END}"


def test_corner_rows(spark):
    long = "word " * 50_000
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "z"), (1, 0, "user", "y"), (1, 0, "user", "y"), (2, 0, "assistant", long), (3, 0, "assistant", "")]
    found = {r["conv_id"]: r for r in read_back(format_conversations(frame(spark, rows))).collect()}
    assert [(t["role"], t["text"]) for t in found[1]["turns"]] == [("", ""), ("user", "y"), ("user", "y"), ("user", "z")]
    assert found[2]["loss_texts"] == [long] and found[3]["loss_texts"] == [""]
    assert [(t["role"], t["text"]) for t in found[None]["turns"]] == [("user", "x")]
    assert format_conversations(frame(spark, [])).count() == 0
