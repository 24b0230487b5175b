import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm import chat

TURNS = "conv_id long, turn long, role string, text string, parts_ int, formatted string"


def plain(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    return frame.withColumn("parts", chat.text_part(F.col("text")))


def brute(rows):
    convs = {}
    for r in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = []
    for conv, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        out.append((conv, len(turns),
                    hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 2, "assistant", "b\\-\\+<|end|>\n<|user|>\n"), (1, 0, "system", None), (1, 1, "user", ""),
        (2, 0, "assistant", "x" * 70_000), (2, 0, "assistant", "x" * 70_000), (3, None, None, "<<s>[/INST]"),
        (None, 1, "assistant", "no conversation é🙂"), (None, 0, "we|ird<|role|>\n", "t"),
        (4, 1, "assistant", "tie b"), (4, 1, "assistant", "tie a")]


def test_against_brute_force(spark, monkeypatch):
    got = chat.read_back(chat.format_chat(plain(spark, ROWS))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(ROWS)


def test_long_conversation_goes_on_in_more_rows(spark):
    rows = [(5, i, "assistant" if i % 2 else "user", f"{i} " * 3000) for i in range(200)]
    out = chat.format_chat(plain(spark, rows))
    assert out.count() > 1
    assert sorted(tuple(r)[:5] for r in chat.read_back(out).collect()) == brute(rows)


def test_written_and_read(spark):
    rows = ROWS + [(5, i, "assistant" if i % 2 else "user", f"{i} " * 3000) for i in range(200)]
    got = chat.chat_round_trip(plain(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)


def test_empty(spark):
    assert chat.read_back(chat.format_chat(plain(spark, []))).count() == 0


@given(st.text(alphabet=st.sampled_from("<|>s/[]INTSYS\\-+ a\n")))
def test_escape_round_trip_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)


def test_typed_parts(spark):
    part = dict.fromkeys(f.name for f in chat.PART.fields)
    parts = [part | {"kind": "text", "text": "see "}, part | {"kind": "image", "ref": "a.png", "width": 57, "height": 28},
             None, part | {"text": " and "}, part | {"kind": "audio", "ref": "b.wav", "seconds": 1.5},
             part | {"kind": "document", "ref": "c.pdf", "pages": 2}, part | {"kind": "video", "ref": "d"}]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("parts", T.ArrayType(chat.PART))])
    row, = chat.format_chat(spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", parts[:1]), (1, 2, "user", None)], schema)).collect()
    assert list(chat.parse(row.formatted)) == [
        ("user", "see <|image:1|> and <|audio:2|><|document:3|><|video:4|>"), ("assistant", "see "), ("user", "")]
    assert [(a.kind, a.ref, a.tokens) for a in row.attachments] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1280), ("video", "d", 0)]
    assert all(row.formatted[a.place:].startswith(f"<|{a.kind}:{i + 1}|>") for i, a in enumerate(row.attachments))
    assert [row.formatted[s.start:s.end] for s in row.loss] == ["see "]
