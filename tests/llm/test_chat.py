import hashlib
import random

from pagetrail.llm import chat, queries

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    conversations = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] if r[1] is not None else -1)):
        conversations.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in conversations.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len(f"### {chat.escape(r)}:\n{chat.escape(t)}</turn>\n") for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "#", "### ", "<", "</turn>\n", "<image>", ":", "\n", "a", "é"]) for _ in range(rng.randrange(9)))
        role = "".join(rng.choice(["assistant", ":", "\n", "\\", "#"]) for _ in range(rng.randrange(3)))
        made, start, end, attached = chat.segment(role, text)
        assert chat.read_segment(made, start, end) == (role, text, text if role == "assistant" else "")
        assert not attached and made.count("### ") - made.count("\\### ") >= 1


def test_conversation_cannot_be_split_wrongly():
    text = "\\### Assistant: </turn> ok"
    joined = "".join(chat.segment(r, text)[0] for r in ("user", "assistant"))
    assert [m.groups() for m in chat.SEGMENT.finditer(joined)] == [(r, chat.escape(text)) for r in ("user", "assistant")]


def test_parts():
    parts = [
        {"kind": "text", "text": "see <image>: "},
        {"kind": "image", "uri": "a.png", "width": 57, "height": 28},
        {"kind": "audio", "uri": "b.wav", "seconds": 1.02},
        {"kind": "text", "text": None},
        {"kind": "document", "uri": None, "pages": 2},
        {"kind": "text", "text": "end"},
    ]
    made, start, end, attached = chat.segment("assistant", None, parts)
    assert made == "### assistant:\nsee \\<image>\\: <image><audio><document>end</turn>\n"
    assert [(a["kind"], a["uri"], a["tokens"]) for a in attached] == [("image", "a.png", 3), ("audio", "b.wav", 26), ("document", None, 1024)]
    assert all(made[a["offset"] :].startswith(f"<{a['kind']}>") for a in attached)
    assert chat.read_segment(made, start, end)[1:] == ("see <image>: end",) * 2


def test_odd_parts():
    nan, inf = float("nan"), float("inf")
    parts = [None, {"kind": None, "uri": "x"}, {"kind": "video", "uri": "y"}, {"kind": "__init__"}, {"kind": "audio", "seconds": nan}]
    parts += [{"kind": "audio", "seconds": inf}, {"kind": "audio", "seconds": 1e300}, {"kind": "image", "width": -5, "height": 30}]
    parts += [{"kind": "document", "pages": -1}, {"kind": "text", "text": "<unknown> t"}]
    made, start, end, attached = chat.segment("assistant", None, parts)
    assert [(a["kind"], a["tokens"]) for a in attached] == [
        ("unknown", 0), ("unknown", 0), ("unknown", 0), ("audio", 0), ("audio", 0), ("audio", chat.MOST_TOKENS), ("image", 0), ("document", 0)
    ]
    assert chat.read_segment(made, start, end) == ("assistant", "<unknown> t", "<unknown> t")


def test_one_odd_part_does_not_end_the_job(spark):
    schema = f"conv_id bigint, turn bigint, role string, text string, parts array<{chat.PART}>, segment string"
    rows = [
        (1, 0, "user", "t", [None, (None, "a", "u", 1, 1, 1.0, 1), ("text", "said", None, None, None, None, None)], "clash"),
        (1, 1, "assistant", "t", [("audio", None, "u", None, None, float("nan"), None)], "clash"),
        (1, 2, "assistant", "plain", None, "clash"),
        (1, 3, "assistant", "none", [], "clash"),
    ]
    found = chat.formatted(spark.createDataFrame(rows, schema)).orderBy("turn").collect()
    assert [r.segment for r in found] == [
        "### user:\n<unknown>said</turn>\n", "### assistant:\n<audio></turn>\n", "### assistant:\nplain</turn>\n", "### assistant:\n</turn>\n"
    ]
    assert chat.digests(chat.formatted(spark.createDataFrame(rows, schema))).collect()[0].n_turns == 4


def test_operator(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a:b"), (2, 0, None, "x"), (None, None, "assistant", "y" * 200_000)]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} </turn>") for i in range(500)] + [(4, 0, "user", "same")] * 2
    turns = spark.createDataFrame(rows, TURNS)
    found = {r[0]: tuple(r[1:]) for r in chat.digests(chat.formatted(turns)).collect()}
    assert found == plain(rows)
    typed = turns.limit(1).selectExpr("*", f"cast(array(struct('image', null, 'u', 28, 28, null, null)) as array<{chat.PART}>) parts")
    assert chat.formatted(typed).first().attachments[0].tokens == 1
    assert chat.digests(chat.formatted(turns.limit(0))).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    expected = plain([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    assert {r[0]: tuple(r[1:]) for r in queries.chat_digests(spark, sf).collect()} == expected
