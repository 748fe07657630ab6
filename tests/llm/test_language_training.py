"""Every sampled text reaches its dictionary."""

from presslake.llm import language


def test_all_texts_count_from_begin_to_end(spark):
    name = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:03d}")
    rows = [(i, "en", f"begin{name(i)} " + "word " * 400 + f"end{name(i)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    content = language.train(docs, dictionary_bytes=8000).dictionaries["en"]
    used = [r.doc_id for r in docs.where(~language.held_out(docs.doc_id)).collect()]
    assert len(content) <= 8000 and all(f"{side}{name(i)}".encode() in content for i in used for side in ("begin", "end"))
