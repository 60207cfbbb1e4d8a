"""Small documents for the tests of the corpus operators."""

import random


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary):x}" for _ in range(n))


EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "no id here, MIT License", "en", "a", None),
    (4, "repeated row " * 60, "en", "b", 780),
    (4, "repeated row " * 60, "en", "b", 780),
    (5, prose(1, 30_000), "de", "b", None),
    (6, "12 34 !!", None, "b", 8),
    (7, "Ünïcode — 漢字 🎉 text", "fr", None, 20),
    (8, " \t\n ", "fr", "c", 4),
]
