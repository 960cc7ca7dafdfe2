"""Small documents with the cases every operator has to define."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, sources=None):
    """A ``documents`` table of texts; ids by position."""
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, None, s, None if t is None else len(t)) for i, (t, s) in enumerate(zip(texts, sources, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def saved(spark, scratch, **tables):
    """A folder with the tables as the queries read them."""
    folder = scratch("tables")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


EDGE_TEXTS = [
    None, "", " ", "\n\n", "word", "a\tb\x0bc\r\nd", "the same words again\nthe same words again", "the same words again\nthe same words again",
    "Größe naïve café 日本語 😀 <|endoftext|> x", "x" * 3000, "one two three " * 400, "▁ odd  spaces \n end ",
]
