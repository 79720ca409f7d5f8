"""Rows that every operator must handle."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and white-space texts, ties, repeated rows, and a long text.
ROWS = [
    (1, "a b c d e f g h i j", "en", "s1", 19),
    (2, "a b c d e f g h i j", "en", "s1", 19),
    (3, "A b C d e f g h i j", None, None, None),
    (3, "A b C d e f g h i j", None, None, None),
    (4, None, "en", "s2", 0),
    (5, "", "en", "s2", 0),
    (None, "one two", "de", "s1", 7),
    (None, "one two", "de", "s1", 7),
    (6, " \t\n", "fr", "s3", 3),
    (7, "word " * 30_000, "fr", "s1", None),
    (8, "é ü 你好 <|endoftext|> İ", "xx", "s1", 20),
]
