"""Rows that every operator on documents must take."""

#: Nulls, no words, ties, repeated rows, long texts.
ODD_TEXTS = [(1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "Ähre Straße naïve"), (6, "x" * 30_000), (7, "a b c d e f " * 5000),
             (8, "the same text as the other row has"), (9, "the same text as the other row has"), (8, "the same text as the other row has"),
             (None, "a row without an id and five words"), (None, None), (10, "\n\n\n"), (11, "line one\nline two\nline three\n\x00\x1f")]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASH = ["size", "leaks", "found", "removed", "n_lines", "target", "node", "copy", "n_words", "score", "_row", "_doc", "_chunks"]
