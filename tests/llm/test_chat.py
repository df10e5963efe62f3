from pyspark.sql import functions as F

from bazaarflow.llm import chat

ODD = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|text|>", "\\l\\b\\s \\\\ <[", "", None, "é😀日", "\\", "<|image|>", "a" * 50_000]


def test_round_trip(spark):
    rows = [(1, n, "assistant" if n % 2 else "us<er", t) for n, t in enumerate(ODD)] + [(None, 1, None, "x"), (2, None, "user", "late"), (2, 1, "user", "b"), (2, 1, "user", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("parts", chat.text_part(F.col("text"))).withColumn("place", F.lit(1)).withColumn("end", F.lit("x"))
    found = {
        r.conv_id: r
        for r in chat.format_chats(turns).withColumn("turns", chat.turns_of(F.col("formatted"))).withColumn("learned", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()
    }
    assert [(t.role, t.text) for t in found[1].turns] == [(r, t or "") for _, _, r, t in rows[: len(ODD)]]
    assert found[1].learned == "".join(t or "" for n, t in enumerate(ODD) if n % 2)
    assert [t.text for t in found[2].turns] == ["late", "b", "b"]
    assert found[None].turns[0].role == "" and found[None].learned == ""
    for r in found.values():
        for span in r.loss:
            assert r.formatted[span.end : span.end + len(chat.END)] == chat.END


def test_parts(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 0, "user", [part("text", "see <"), part("image", None, "a.png", 57, 28), part("text", "and"), part("audio", None, "b.wav", None, None, 1.5)]),
        (1, 1, "assistant", [part("text", "ok"), part("document", None, "c.pdf", pages=3), part("other", "kept")]),
        (1, 2, "user", None),
        (1, 3, "user", []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chats(turns).first()
    assert row.formatted == (
        "<|turn|>user<|text|>see \\l<|image|>and<|audio|><|end|><|turn|>assistant<|text|>ok<|document|>kept<|end|>"
        "<|turn|>user<|text|><|end|><|turn|>user<|text|><|end|>"
    )
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in row.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 38), (1, "document", "c.pdf", 768)]
    assert row.attachment_tokens == 809
    assert [row.formatted[s.start : s.end] for s in row.loss] == ["ok<|document|>kept"]
    assert chat.format_chats(turns.limit(0)).count() == 0
