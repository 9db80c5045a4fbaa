"""Documents that every operator has to take."""

PROSE = (
    "The river was high in the spring and the old mill at the bend of the road was still "
    "for most of the day while the miller was by the door and looked at the water"
)

#: Null, empty, blank, one word, very long, repeated rows, equal texts, odd characters.
EDGE = [
    (1, PROSE),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\f\r "),
    (5, "word"),
    (6, " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))),
    (7, PROSE),
    (8, PROSE.upper()),
    (9, "Ünïcödé  ▁ 中文 🎉 don't <|endoftext|> a\x1cb c\n\n" + PROSE),
    (None, "no id here but text " + PROSE),
    (11, "the same line of the text\n" * 40),
    (12, "a ### b *** c $$$ " * 20),
    (5, "word"),
]
