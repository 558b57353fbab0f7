"""Small corpora and brute-force helpers for the operator tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Prose-like texts with copies, near copies, shared passages and odd cases."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnoprstuvwé") for _ in range(rnd.randint(1, 7)))
                  for _ in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    out: list[str | None] = []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 150))]
        if i % 4 == 0 and len(w) > 10:
            w[5:5] = passage
        if i % 5 == 0 and out and out[-1]:
            w = words(out[-1])[:]
            if w:
                w[rnd.randrange(len(w))] = "changed"
        if i % 9 == 0:
            w = [x.upper() + "!!" for x in w]
        out.append(re.sub(r" (\S+) (\S+) ", r" \1\n\2 ", " ".join(w)))
        if i % 11 == 0:
            out.append(out[rnd.randrange(len(out))])
    long = " ".join(rnd.choice(vocabulary) for _ in range(6000))
    return out + [None, "", " \t\n ", "one", "one", "x" * 3000, "a b c", "a B c", long, long + " end",
                  "Line again\nLine again\n\nLine again", "é è 漢字 \U0001F600 ok"]


def rows(values: list[str | None], spread: int = 3) -> list[tuple]:
    """Rows with shuffled, gapped ids; sources by position, one of them null."""
    order = random.Random(7).sample(range(len(values) * spread), len(values))
    return [(i, t, "en", [None, "b", "a", "ß"][k % 4], len(t or ""))
            for k, (i, t) in enumerate(zip(order, values))]


def documents(spark, values=None):
    return spark.createDataFrame(rows(values if values is not None else texts()), SCHEMA)


def odd_documents(spark):
    """Repeated rows, repeated and missing ids, and columns whose names operators use."""
    base = [(1, "alpha beta gamma delta epsilon zeta", "x"),
            (1, "alpha beta gamma delta epsilon zeta", "x"), (1, None, "y"), (2, "", "y"),
            (2, "other words stand here now", None), (None, "nobody owns this text", "x"),
            (None, None, None), (9, "tail", "x")]
    names = ["size", "key", "bucket", "keys", "found", "block", "score", "row", "n_words", "element",
             "copy", "name", "rep", "root", "head", "next_id", "carried", "conv_id", "turn", "role"]
    return spark.createDataFrame(
        [(i, t, s, *[k for k in range(len(names))]) for i, t, s in base],
        "doc_id bigint, text string, source string, " + ", ".join(f"{n} int" for n in names))


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
