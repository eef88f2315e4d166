"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, n long, piece int, score double, rank int"


def documents(spark, rows):
    """Documents of ``(doc_id, text, source)``, with columns whose names the operators use inside."""
    full = [(i, text, "en", source, len(text or ""), 7, 7, 7, 7, 0.7, 7) for i, text, source in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    words = " ".join(f"wort{i}" for i in range(40))
    return [
        (1, words, "b"),
        (2, words, "b"),  # a copy
        (2, words, "b"),  # the same row again
        (3, "", "a"),
        (4, None, None),
        (None, "one two three", "a"),
        (None, None, None),
        (5, "Ünïcode \U0001f600 don't 12,5% \x1c x", "ä"),
        (6, " \t\n", "a"),
        (7, "lang " * 300_000, "b"),
    ]
