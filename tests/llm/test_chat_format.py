import hashlib

from llm import chat_format as C

ROWS = [
    (1, 0, "user", "plain"), (1, 1, "assistant", C.ADDED), (1, 2, "user", None),
    (1, 3, None, "~0 ~1 ~~"), (1, 4, "assistant", "".join(C.CONTROLS) + "~3"),
    (2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"),
    (3, None, "<|turn|>", "x"), (3, 1, "ro<|end|>le", "<|text|>"), (None, 0, "user", ""),
    (4, 0, "assistant", "é🙂" * 30_000), (5, 0, "user", "<|tex"), (5, 1, "user<|", "turn|>")]


def frame(spark, rows):
    full = [(*r, "f", 1) for r in rows]
    return spark.createDataFrame(
        full, "conv_id long, turn long, role string, text string, formatted string, piece int")


def test_round_trip(spark):
    found = {r.conv_id: r for r in C.digests(C.format_conversations(frame(spark, ROWS))).collect()}
    groups = {}
    for conv, turn, role, text in ROWS:
        groups.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    assert set(found) == set(groups)
    for conv, turns in groups.items():
        turns = sorted(turns, key=lambda t: (t[0], t[1] or 0, *t[2:]))
        own = found[conv]
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        lines = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        assert own.round_trip and own.n_turns == len(turns)
        assert own.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert own.loss_chars == len(said)
        assert own.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_only_conflicts_are_escaped(spark):
    out = {r.conv_id: r.formatted for r in C.format_conversations(frame(spark, ROWS)).collect()}
    assert out[2] == "<|turn|>user<|text|>a<|end|>" + "<|turn|>assistant<|text|>b<|end|>" * 2
    assert "[INST]" not in out[1] and "</s>" not in out[1]


def test_broken_output_is_no_turn(spark):
    texts = ["", "<|turn|>user<|text|>a", "<|turn|>user", "<|turn|>user<|text|>[INST]<|end|>"]
    rows = spark.createDataFrame([(t,) for t in texts], "f string")
    from pyspark.sql import functions as F
    got = [r.t for r in rows.select("f", C.reparsed(F.col("f")).alias("t")).collect()]
    assert got == [[], [None], [None], [None]]


def test_added_and_empty(spark):
    none = frame(spark, ROWS).limit(0)
    assert C.format_conversations(none).collect() == []
    only = C.digests(C.format_conversations(C.with_added(none))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in only] == [(-7, 2, len(C.ADDED))]
