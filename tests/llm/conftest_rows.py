"""Rows that every operator has to take."""

# Nulls, an empty text, repeated rows and ids, ties, a very long text, clashing names.
DOCS = "doc_id long, text string, source string, id long, row string, size int"
BASE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, BASE, "b", 9, "x", 1), (2, BASE.upper(), "b", 9, "x", 1), (3, BASE + " more", "a", 9, "y", 2),
    (4, None, None, None, None, None), (5, "", "a", 1, "", 0), (6, "one two three", "a", 1, "", 0),
    (6, "one two three", "a", 1, "", 0), (7, "One  two\tthree", "c", 1, "", 0), (None, "lone text here", "c", 1, "", 0),
    (8, "long " * 30_000, "b", 1, "", 0), (9, "É is not é", "c", 1, "", 0), (10, "é is not é", "c", 1, "", 0),
]
