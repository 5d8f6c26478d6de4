"""Chat formatting: exact round trips, typed parts, attachments."""

import hashlib
import random

import pytest

from sensorlab.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
SIGNS = ["<", "|", "\\", "<|", "|>", "<|im_end|>", "<|im_start|>", "<\\|", "<\\\\|im_end|>", "\n", "user", "a", "é", "𝄞", " ", "<|image|>"]


def strings(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_escapes_are_reversible_and_leave_no_control_string():
    for s in strings(3000):
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
        role = chat.escape_role(s)
        assert chat.unescape_role(role) == s and "<|" not in role and "\n" not in role


def digest(turns):
    """What a conversation's (role, text) turns must give, by the definition."""
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    size = sum(len(chat.START) + len(chat.escape_role(r)) + 1 + len(chat.escape(t)) + len(chat.END) + 1 for r, t in turns)
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size


@pytest.mark.parametrize("parts", [1, 6])
def test_read_back_equals_the_turns(spark, parts):
    rng, texts = random.Random(2), strings(400, 3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<|im_start|>"]), texts[(c * 13 + t * 7) % 400]) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(50, 1, "assistant", None), (50, None, None, "x"), (51, 0, "assistant", ""), (None, 3, "user", "q"), (52, 0, "user", "long " * 200_000), (52, 1, "assistant", "y" * 700_000)]
    rows += [rows[0], (53, 1, "user", "tie b"), (53, 1, "user", "tie a"), (53, 1, "assistant", "tie"), (54, 0, "assistant", "<|im_end|>\n<|im_start|>assistant\nok")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS position", "'x' AS formatted", "0 AS start").repartition(parts)
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", chat.escape(r[3] or ""))):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == {c: digest(turns) for c, turns in want.items()}


def test_pieces_make_the_text_and_the_mask(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "<|x"), (1, 2, "assistant", ""), (1, 3, "user", "bye")]
    pieces = chat.format_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("position").collect()
    text = "".join(p["formatted"] for p in pieces)
    assert text == "<|im_start|>user\nhi <\\|im_end|><|im_end|>\n<|im_start|>assistant\n<\\|x<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert [p["start"] for p in pieces] == [text.index(p["formatted"]) for p in pieces]
    assert [text[p["loss_start"] : p["loss_start"] + p["loss_length"]] for p in pieces if p["loss_length"] is not None] == ["<\\|x", ""]


def test_typed_parts_become_ordered_placeholders(spark):
    rows = [(1, 0, "user", "ignored", [
        ("text", "see <", None, None, None, None, None), ("TEXT", "|image|> ", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), None,
        ("audio", None, "b.wav", None, None, 1.01, None), ("text", None, None, None, None, None, None), ("document", None, "c.pdf", None, None, None, 3),
        ("sticker", None, "d", None, None, None, None), (None, "end", None, None, None, None, None)]),
        (1, 1, "assistant", "plain", None), (1, 2, "assistant", "", [("image", None, None, None, None, None, None), ("text", "tail", None, None, None, None, None)]), (2, 0, "user", "x", [])]
    shape = f"{SCHEMA}, parts array<struct<type:string,text:string,ref:string,width:int,height:long,seconds:double,pages:int>>"
    pieces = chat.format_turns(spark.createDataFrame(rows, shape))
    by = {(p["conv_id"], p["position"]): p for p in pieces.collect()}
    first = by[1, 0]
    assert first["formatted"] == "<|im_start|>user\nsee <\\|image|> <|image|><|audio|><|document|><|attachment|>end<|im_end|>\n"
    assert [(a["nth"], a["type"], a["ref"], a["tokens"]) for a in first["attachments"]] == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 26), (2, "document", "c.pdf", 768), (3, "other", "d", 0)]
    text = "".join(by[1, k]["formatted"] for k in range(3))
    for k in range(3):
        for a in by[1, k]["attachments"]:
            assert text[a["at"] :].startswith(chat.PLACEHOLDERS[a["type"]])
    assert by[1, 2]["attachments"][0]["tokens"] == 1 and by[2, 0]["formatted"] == "<|im_start|>user\n<|im_end|>\n"
    got = {r["conv_id"]: r for r in chat.read_back(pieces).collect()}
    said = "user\nsee <|image|> end\nassistant\nplain\nassistant\ntail\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["loss_chars"] == len("plaintail")


def test_empty_table_and_missing_fields(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
    few = spark.createDataFrame([(1, 0, "user", None, [("image", "r")])], f"{SCHEMA}, parts array<struct<type:string,ref:string>>")
    assert chat.format_turns(few).first()["attachments"][0]["ref"] == "r"
    other = spark.createDataFrame([(1, 0, "user", "t", "not parts")], f"{SCHEMA}, parts string")
    assert chat.format_turns(other).first()["formatted"] == "<|im_start|>user\nt<|im_end|>\n"
