"""Rows that every operator must stand: nulls in any column, empty and very long texts, repeats, clashing names."""

LONG = "word " * 40_000 + "Ende " + "x" * 50_000
TEXTS = [
    None, "", " \n\t ", "One two three four five six seven eight.", "One two three four five six seven eight.", LONG, "😀 日本語 text\u0085 end",
    "it's   we'll\n\n<|endoftext|> tail ", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "Released under the MIT License.", "a", "\x00b",
]
CLASHES = [
    "id", "fp", "row", "part", "place", "v", "u", "bin", "file", "path", "key", "node", "root", "again", "fingerprint", "component_id", "n_words",
    "n_hit", "items", "score", "ids", "decoded", "spans", "prediction", "shard", "slot", "license", "start", "n_tokens", "label", "counts", "term",
]


def odd_docs(spark, texts=TEXTS):
    """Documents with a null id, a repeated row, nulls in every column and extra columns named like results and work columns."""
    rows = [(k, t, "en" if k % 2 else None, None if k % 3 == 0 else "src", None if k % 4 == 0 else len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, "One two three four five six seven nine.", None, None, None), (3, texts[3], "en", "src", 40)]
    return spark.createDataFrame(
        [(*r, *["clash"] * len(CLASHES)) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
