"""Small documents with every odd case, and extra columns whose names clash
with what operators add."""

DOC_TYPES = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ["row", "size", "taken", "pieces", "kept", "score", "n_lines", "fp", "host", "first"]

ODD_TEXTS = [
    None, "", " \t\n", "word", "two words", "Ünïcödé ǅ 漢字 🙂 text", "one two three", "one two three", "ONE  two\nthree",
    "a" * 5000, "long text of words " * 4000, "tab\tand\x0bvertical\x0cfeed\rreturn", "§ 123 $$$ !!", "Ein Satz auf deutsch.",
]


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source) with n_chars and clashing columns."""
    full = [(i, t, lang, s, len(t) if t is not None else None, *(["x"] * len(CLASHES))) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOC_TYPES + "".join(f", {c} string" for c in CLASHES))


def odd_rows():
    langs, sources = ["en", "de", None], ["s1", "s2", "s1", None]
    rows = [(i, t, langs[i % 3], sources[i % 4]) for i, t in enumerate(ODD_TEXTS)]
    return rows + [rows[6], rows[6], (None, "no id here", "en", "s1"), (None, None, None, None)]
