import hashlib

from cases import plan, rows
from millrace.llm import chat
from millrace.llm.queries import QUERIES, table
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def test_parts_become_placeholders(spark):
    schema = f"conv_id long, turn int, role string, parts array<{chat.PART}>, formatted string"
    picture, sound, odd = ("image", None, "s3/cat.png", 2), ("audio", None, "a.wav", 10), ("hologram", None, "h", None)
    data = [
        (1, 1, "assistant", [("text", "a <b> \\l", None, None), odd, ("text", "</turn>", None, None)], "x"),
        (1, 0, "user", [("text", "see", None, None), picture, sound], "x"),
        (2, 0, None, None, "x"), (2, None, "as>sistant", [("text", None, None, None)], "x"), (None, 0, "assistant", [("text", "é\U0001f600", None, None)], "x"),
        (None, 0, "assistant", [("text", "é\U0001f600", None, None)], "x"),
    ]
    out = chat.format_chats(spark.createDataFrame(data, schema))
    got = {r["conv_id"]: r for r in out.collect()}
    assert got[1]["formatted"] == "<turn:user>see<part:2:image><part:3:audio></turn><turn:assistant>a \\lb\\g \\sl<part:2:hologram>\\l/turn\\g</turn>"
    assert [tuple(a) for a in got[1]["attachments"]] == [(0, 2, "image", "s3/cat.png", 512), (0, 3, "audio", "a.wav", 250), (1, 2, "hologram", "h", 1)]
    assert got[1]["placeholder_tokens"] == 763 and got[2]["placeholder_tokens"] == 0
    assert all(sum(x["chars"] for run in r["runs"] for x in run) == len(r["formatted"]) for r in got.values())
    back = {r["conv_id"]: r for r in chat.read_back(out).collect()}
    assert back[1]["loss_text"] == "a <b> \\l</turn>" and [tuple(t) for t in back[1]["turns"]] == [("user", "see"), ("assistant", "a <b> \\l</turn>")]
    assert [tuple(t) for t in back[2]["turns"]] == [("as>sistant", ""), ("", "")] and back[2]["loss_text"] == ""
    assert back[None]["loss_text"] == "é\U0001f600" * 2
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


def test_query_equals_brute_force_and_is_native(spark):
    turns = {}
    for r in table(spark, SF_DIR, "conversations").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(n, role, "\\### Assistant: </turn> ok") for n, role in enumerate(("user", "assistant"))]
    want = []
    for conv, each in turns.items():
        each.sort()
        said, loss = "".join(f"{r}\n{t}\n" for _, r, t in each), "".join(t for _, r, t in each if r == "assistant")
        chars = sum(len("<turn:></turn>") + len(r) + len(t) + sum(t.count(c) for c in "\\<>") for _, r, t in each)
        want.append((conv, len(each), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    got = QUERIES["op7_typed_parts"](spark, SF_DIR)
    assert rows(got) == sorted(want, key=repr)
    assert not any(word in plan(got) for word in ("Python", "Pandas", "Arrow", "RDD"))


def test_kinds_write_no_marks_and_null_kinds_stay(spark):
    parts = "array<struct<kind string, text string, ref string, units long>>"
    rows_ = [(1, 0, "user", [("text", "see", None, None), ("/turn", None, "a", 1), (None, "x", "b", 2), ("image", None, "c", 2)]), (1, 1, "assistant", [("text", "seen </turn> <part:1:image>", None, None)])]
    chats = chat.format_chats(spark.createDataFrame(rows_, f"conv_id long, turn long, role string, parts {parts}"))
    got = chats.first()
    assert got["formatted"].count("</turn>") == 2 and "<part:2:/turn><part:3:><part:4:image>" in got["formatted"]
    assert [tuple(a) for a in got["attachments"]] == [(0, 2, "/turn", "a", 1), (0, 3, None, "b", 1), (0, 4, "image", "c", 512)]
    back = chat.read_back(chats).first()
    assert [tuple(t) for t in back["turns"]] == [("user", "see"), ("assistant", "seen </turn> <part:1:image>")]
    assert back["loss_text"] == "seen </turn> <part:1:image>"
