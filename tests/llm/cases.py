"""Small tables with every awkward case, and plain reference versions."""

import re

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi "
         "chi psi omega").split()
SCHEMA = "doc_id long, text string, lang string, n_words long, code string, rate double"


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 7))
    return " ".join(out)


def texts() -> list[tuple]:
    """(doc_id, text): nulls, blanks, short and very long texts, copies, near copies and repeated rows."""
    base = sentence(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = sentence(2, 60)
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "one two three"),
        (9, "ONE Two three"), (10, sentence(3, 30_000)), (11, f"{sentence(4, 40)} {passage} {sentence(5, 40)}"),
        (12, f"{sentence(6, 30)}\n{passage}\n{sentence(7, 50)}"), (13, base), (13, base), (None, base), (14, "é ß ñ €"),
        (15, "a b c d e f"), (16, sentence(8, 200)), (17, None), (18, base.upper()),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, None if i == 3 else "en", 7, "x", 0.5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", lower(text))


def alnum(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def shingles(text, n):
    w = spaced(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
