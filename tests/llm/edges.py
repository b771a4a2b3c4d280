"""Documents with every awkward case: nulls, empty and long texts, ties, repeats and clashing column names."""

from __future__ import annotations

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, _text string, size int, fingerprint string, "
    "n_words string, score string, block int, at string, key int, value int, _lang string, _drop int"
)
LONG = " ".join(f"word{k % 997}" for k in range(60_000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\r ", "de", "b"),
    (5, "word", "en", "a"),
    (6, LONG, "en", "c"),
    (7, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (7, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (8, "Größe über alles, naïve façade\nGröße\n\nGröße", "de", None),
    (9, "12345 67890 !!! ### $$$", "xx", "b"),
    (None, "no id at all but some words here", "en", "a"),
    (10, "日本語のテキスト 𝕊𝕦𝕣𝕣𝕠𝕘𝕒𝕥𝕖 \u00a0 <s> \\ ▁x", None, "b"),
    (-5, "negative id", "en", "\U0001f600"),
]


def edge_docs(spark, rows=None):
    full = [(i, t, la, s, None if t is None else len(t), "r", "t", 1, "f", "n", "s", 2, "a", 3, 4, "l", 5) for i, t, la, s in (TEXTS if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
