"""Small documents with odd cases, and plain versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, bytes string, size long, taken int, "
    "node string, n string, root int, hash int, word string, score string, host string, line string, key string, found int"
)


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts(seed=3, n=60):
    """Random prose, copies, near copies, shared passages and odd texts."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice(["ba", "ke", "li", "tor", "mun", "é", "sch"]) for _ in range(rng.randint(1, 3))) for _ in range(120)]
    say = lambda k: " ".join(rng.choice(stock) for _ in range(k))
    passage = say(30)
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            out.append(rng.choice(out))
        elif out and kind < 0.45:
            parts = rng.choice(out).split(" ")
            for _ in range(rng.randint(1, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(stock)
            out.append(" ".join(parts))
        elif kind < 0.6:
            out.append(f"{say(rng.randint(1, 40))}\n{passage}\n{say(rng.randint(1, 40))}")
        else:
            out.append("\n".join(say(rng.randint(1, 25)) for _ in range(rng.randint(1, 6))))
    odd = ["", None, " \n\t ", "one", "two words", "One  TWO\x0bthree\tfour", "▁ 漢字 😀 ñ \x00 é", "x" * 900, ("long " + passage + " ") * 120]
    return out + odd


def documents(spark, rows=None):
    """Documents whose other columns have the names that operators might use; one row twice, one id null."""
    if rows is None:
        rows = list(enumerate(texts(), 1))
        rows += [rows[0], (None, rows[3][1]), (7, "another text of a known id")]
    langs, sources = ["en", "de", None], ["b", "a", None, "é"]
    data = [
        (i, t, langs[k % 3], sources[k % 4], len(t or ""), 1, "x", 2, 3, "n", "n", 4, 5, "w", "s", "h", "l", "k", 6)
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
