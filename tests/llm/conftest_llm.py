"""Texts and tables shared by the tests of this folder."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, label string, h int"


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(words))


def rows_of(texts):
    return [(i, t, "en", f"s{i % 3}", len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]
