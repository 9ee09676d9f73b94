"""Spelling variants against a plain version in Python."""

import random
import re
import zlib
from collections import Counter

import __spark_entry__ as entry
from fixtures import TEXTS, documents, none

from reviewlib.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if h % 31 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            if len(low) >= 7:
                counts[low] += 1
    vocab = {w: n for w, n in counts.items() if n >= 2}
    out = {}
    for w, n in vocab.items():
        ns = [(vocab[v], v) for v in vocab if near(w, v)]
        top = min(ns, key=lambda x: (-x[0], x[1])) if ns else None
        form = top[1] if top and top[0] >= 10 * n else None
        out[w] = [form, n, len(ns), top[0] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return {(w, f, r, n, k, fn) for w, (f, r, n, k, fn) in out.items()}


def variants(draw, word, count):
    out = []
    for _ in range(count):
        i = draw.randrange(len(word))
        op = draw.choice("idr")
        ch = draw.choice("abcxyzéß")
        out.append(word[:i] + ch + word[i:] if op == "i" else word[:i] + word[i + 1 :] if op == "d" else word[:i] + ch + word[i + 1 :])
    return out


def corpus(seed=1):
    draw = random.Random(seed)
    stems = ["standard", "variation", "hollowness", "ÉCOLEMENT", "dartboards", "aaaaaaaa", "abcdefghi"]
    rows, i = [], 0
    for stem in stems:
        low = stem.lower() if stem.isascii() else stem
        words = [low] * 40 + variants(draw, low, 30) + variants(draw, low, 5) * 3
        draw.shuffle(words)
        for p in range(0, len(words), 7):
            rows.append((i, " ".join(words[p : p + 7]) + " Standard,x" + ("9" * (i % 3))))
            i += 1
    return rows + [(None, "standard standard"), (i, None), (i + 1, "")]


def test_near_words_equal_brute_force(spark):
    draw = random.Random(3)
    base = ["".join(draw.choice("abcd") for _ in range(draw.randrange(2, 9))) for _ in range(400)]
    vocab = sorted(set(base))
    df = spark.createDataFrame([(w, draw.randrange(1, 50)) for w in vocab], "word string, n long")
    ns = dict(df.collect())
    for chunk in (4096, 7):
        got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(df, chunk=chunk).collect()}
        for w in vocab:
            partners = [v for v in vocab if near(w, v)]
            top = min(partners, key=lambda v: (-ns[v], v)) if partners else None
            assert got[w] == (len(partners), ns[top] if top else None, top), w


def test_query_equals_the_plain_version(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in entry.queries()["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    want = plain(rows)
    assert got == want
    assert any(r[1] for r in want) and any(r[2] != r[0] for r in want)


def test_awkward_rows(spark, tmp_path):
    documents(spark, TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in entry.queries()["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == plain(TEXTS)


def test_no_rows(spark, tmp_path):
    none(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert entry.queries()["op12_spelling_variants"](spark, str(tmp_path)).count() == 0
