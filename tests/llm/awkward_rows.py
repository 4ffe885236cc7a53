"""Documents that operators trip over."""

AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, "a text without an id " * 5), (5, "é ü x " * 30),
    (6, "same words over and over " * 40), (7, "same words over and over " * 40), (7, "same words over and over " * 40),
    (8, "\n\n\n"), (9, "x" * 50_000), (10, "word " * 30_000),
]
