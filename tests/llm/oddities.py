"""Rows that operators tend to trip over."""


def odd_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = "alpha beta gamma delta. " * 20_000 + "omega"
    base = [
        (1, "the cat sat on the mat and looked at the dog near the door", "en", "a"),
        (2, "the cat sat on the mat and looked at the dog near the door", "en", "a"),
        (2, "the cat sat on the mat and looked at the dog near the door", "en", "a"),
        (3, None, "en", "a"), (4, "", None, None), (5, "   \n\t\n", "de", "b"), (6, long, "en", "b"),
        (7, "der Hund und die Katze sind in dem Haus mit der Maus", "de", "b"),
        (8, "word", "en", None), (9, "12345 67890 !!", None, "c"), (10, "x" * 70_000, "en", "c"),
        (11, "é" * 3 + "\nsame line here now\nsame line here now", "fr", "c"),
        (12, "same line here now\n<|endoftext|> THE END", "fr", "c"), (None, "no id at all here", "en", "a"),
        (None, "no id at all here", "en", "a"), (None, None, None, None)]
    return [(i, t, lang, src, None if t is None else len(t), *[None] * 16) for i, t, lang, src in base]
