"""Small documents with what is awkward: nulls, no words, one word, copies, near copies, a long text,
repeated rows, and columns whose names the operators use themselves."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, u long, key string, "
    "score string, n string, ids string, shard string, size string, _text string, secrets string"
)
WORDS = "the of and to in that it is was for on with as are this by from or an be".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    made = [draw.choice(WORDS) + draw.choice(["", "ing", "ed", "er", "ly"]) for _ in range(words)]
    return " ".join(made)


def changed(text: str, places: list[int]) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = "changed"
    return " ".join(words)


LONG = prose(1, 120)
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "ONE"),
    (6, "one two three four"),
    (7, LONG),
    (8, LONG),
    (9, LONG.upper()),
    (10, changed(LONG, [60])),
    (11, changed(LONG, [5, 60, 110])),
    (12, changed(LONG, [5, 20, 40, 60, 80, 100])),
    (13, prose(2, 80)),
    (14, prose(3, 9)),
    (15, prose(3, 9) + " end"),
    (16, "word " * 400),
    (17, prose(4, 6_000)),
    (18, "Ünïcödé ñandú 日本語 😀 \x0b tab\tline\r\nend"),
    (19, prose(5, 60) + " " + LONG + " " + prose(6, 60)),
    (13, prose(2, 80)),
    (None, LONG),
]


def rows(texts=TEXTS):
    return [
        (i, t, None if (i or 0) % 5 == 0 else "en", None if (i or 0) % 7 == 0 else "s", len(t or ""),
         i, "k", "x", "y", "z", "a", "b", "c", "d")
        for i, t in texts
    ]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(rows(texts), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
