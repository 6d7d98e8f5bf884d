"""Small tables with the awkward cases."""

import random

SCHEMA = "doc_id LONG, text STRING, lang STRING, score DOUBLE, node STRING, kept STRING, copies LONG, block LONG"


def documents(seed=1, n=40):
    """Rows (doc_id, text, ...) with copies, near copies, shared lines, NULLs, blanks, long texts and repeated rows."""
    rand = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Émile", "naïve", "it's", "x,y", "日本", "12.5"]
    line = lambda k: " ".join(rand.choice(words) for _ in range(k))
    shared = [line(14) for _ in range(3)]
    texts = []
    for _ in range(n):
        lines = [line(rand.randrange(1, 30)) for _ in range(rand.randrange(1, 6))]
        if rand.random() < 0.4:
            lines.insert(rand.randrange(len(lines) + 1), rand.choice(shared))
        texts.append("\n".join(lines))
    base = line(200).split()
    for k in range(12):
        near = list(base)
        for _ in range(k):
            near[rand.randrange(200)] = "changed"
        texts.append(" ".join(near))
    texts += [texts[0], texts[0].upper(), texts[3] + " ", None, "", " \n\t ", "one", "two  words", "two words", line(9000)]
    rows = [(i * 3, t, "en", 0.5, "n", "k", 7, 1) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[1], "en", None, None, None, None, None), (None, "alone here", *[None] * 6)]
    rand.shuffle(rows)
    return rows


def frame(spark, rows=None, parts=5):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
