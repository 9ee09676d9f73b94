import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import LONG, TEXTS, changed, documents, none, prose

from reviewlib.llm import decontamination, ngram_jaccard
from reviewlib.llm.components import components
from reviewlib.llm.words import Coder, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def grams(text, width=5):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def linked(texts, percent=80):
    """(id, shingles, component) of each row, by comparing all pairs."""
    sets = [(i, grams(t)) for i, t in texts]
    group = {i: i for i, _ in sets if i is not None}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is None or j is None or i >= j or not a or not b:
                continue
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                low, high = sorted((find(i), find(j)))
                group[high] = low
    key = lambda r: (r[0] is None, r[0] or 0)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=key)


def found(spark_rows):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in spark_rows.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_words_and_shingles():
    texts = [t for _, t in TEXTS] + ["x" * 600_000 + " y " + prose(9, 90_000)]
    got = []
    for group in Coder().groups(pa.array(texts)):
        for k, a in enumerate(zip(group.bounds[:-1], group.bounds[1:])):
            own = zip(group.starts[slice(*a)], group.ends[slice(*a)])
            got.append([bytes(group.data[s:e]).decode().translate(LOWER) for s, e in own])
    assert got == [words(t) for t in texts]
    sizes = [len(s) for group in Coder().groups(pa.array(texts)) for s in shingles(group)]
    assert sizes == [len(grams(t)) for t in texts]


def test_equal_words_have_equal_codes_anywhere():
    group = next(Coder().groups(pa.array(["a bc a", "BC d a"])))
    codes = group.codes.tolist()
    assert codes[0] == codes[2] == codes[5] and codes[1] == codes[3]
    assert len(set(codes)) == 3


def test_awkward_documents(spark):
    assert found(ngram_jaccard.similar_documents(documents(spark))) == linked(TEXTS)


def test_no_documents(spark):
    assert ngram_jaccard.similar_documents(none(spark)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_near_copies_against_all_pairs(spark, seed):
    """Families of near copies of all sizes around the limit, and a passage that many share."""
    draw = np.random.default_rng(seed)
    shared = prose(77, 40)
    texts = []
    for family in range(12):
        base = prose(100 * seed + family, int(draw.integers(4, 200)))
        for _ in range(12):
            n = len(base.split(" "))
            places = draw.choice(n, min(n, int(draw.integers(0, 1 + n // 15))), replace=False)
            text = changed(base, places.tolist())
            texts.append((len(texts), text + (" " + shared if draw.random() < 0.3 else "")))
    assert found(ngram_jaccard.similar_documents(documents(spark, texts))) == linked(texts)


def test_many_near_copies_in_small_blocks(spark, monkeypatch):
    """Members of a key meet in whatever blocks they are dealt to."""
    monkeypatch.setattr(ngram_jaccard, "_BLOCK", 4)
    monkeypatch.setattr(ngram_jaccard, "_ROWS", 2)
    draw = np.random.default_rng(5)
    base = prose(500, 90)
    texts = [(i, changed(base, draw.choice(90, 4, replace=False).tolist())) for i in range(60)]
    assert found(ngram_jaccard.similar_documents(documents(spark, texts))) == linked(texts)


def test_keys_of_many_documents_over_rows(spark, monkeypatch):
    """A key of more documents than a row holds, some of them in other components."""
    monkeypatch.setattr(ngram_jaccard, "_MEMBERS", 3)
    draw = np.random.default_rng(6)
    base = prose(501, 90)
    texts = [(i, changed(base, draw.choice(90, 5, replace=False).tolist())) for i in range(50)]
    assert found(ngram_jaccard.similar_documents(documents(spark, texts))) == linked(texts)


@pytest.mark.parametrize("groups", [3, 900])
def test_keys_are_sent_in_few_bytes(groups):
    draw = np.random.default_rng(groups)
    keys = [draw.integers(0, 2**64, 100, dtype=np.uint64) for _ in range(4_000)]
    ids = [np.full(100, 3 * i + 10**12) for i in range(4_000)]
    tags = [np.full(100, 64 * (i % 5) + 7, np.int32) for i in range(4_000)]
    sent = ngram_jaccard._sent(keys, ids, tags, groups)
    assert sent.nbytes < 6 * 400_000
    seen = set()
    for row in sent.to_pylist():
        key = np.frombuffer(row["keys"], np.uint32)
        id = np.cumsum(ngram_jaccard._unpacked(row["steps"], len(key), np.int64))
        tag = ngram_jaccard._unpacked(row["tags"], len(key), np.int32)
        seen |= {(row["group"], *x) for x in zip(key.tolist(), id.tolist(), tag.tolist())}
    expected = zip(*(np.concatenate(x).tolist() for x in (keys, ids, tags)))
    assert seen == {(k % groups, k // groups % 2**32, i, t) for k, i, t in expected}


@pytest.mark.parametrize("n", [1, 4, 5, 9, 20, 63, 64, 65, 200, 2_000])
def test_similar_sets_share_as_many_keys_as_the_tag_says(n):
    draw, bands = np.random.default_rng(n), ngram_jaccard.Bands(80)
    for _ in range(20):
        one = np.unique(draw.integers(1, 2**63, n, dtype=np.uint64))
        differ = int(draw.integers(0, bands.differ(2 * n) + 1))
        gone = int(draw.integers(0, differ + 1))
        other = np.unique(np.append(one[gone:], draw.integers(1, 2**63, differ - gone, dtype=np.uint64)))
        common = len(np.intersect1d(one, other))
        if not common or 100 * common < 80 * (len(one) + len(other) - common) or gone == differ == 0:
            continue
        keys = [{t % 64: (t // 64, set(k.tolist())) for t, k in bands.keys(s)} for s in (one, other)]
        both = keys[0].keys() & keys[1].keys()
        assert both
        best = max(len(keys[0][b][1] & keys[1][b][1]) - max(keys[0][b][0], keys[1][b][0]) for b in both)
        assert best >= 0
        apart = np.bitwise_count((ngram_jaccard._sketch(one) ^ ngram_jaccard._sketch(other)).view(np.uint64))
        assert apart.sum() <= len(one) + len(other) - 2 * common


def test_components(spark):
    draw = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(500, 640)]
    group = {x: x for e in edges for x in e}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        group[high] = low
    want = {x: find(x) for x in group if find(x) != x}
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r.u: r.c for r in components(df).collect()} == want
    assert components(df.filter("false")).collect() == []


def contained(texts, items):
    sets = defaultdict(list)
    for i, t in texts:
        if i is not None:
            sets[i].append(words(t))
    out = set()
    for item, text in items:
        own = grams(text)
        if item is None or not own:
            continue
        width = len(next(iter(own)))
        for i, many in sets.items():
            there = {tuple(w[k : k + width]) for w in many for k in range(len(w) - width + 1)}
            if 100 * len(own & there) >= 80 * len(own):
                out.add((i, item, len(own), len(own & there)))
    return out


ITEMS = [
    (1, LONG), (2, " ".join(LONG.split(" ")[10:40])), (3, "one two"), (4, "ONE"), (5, ""), (6, None),
    (7, prose(50, 40)), (8, prose(50, 40)), (9, changed(" ".join(LONG.split(" ")[50:90]), [20])),
    (10, "word word word word word word"), (None, LONG), (11, "日本語 😀"),
]


def test_contained_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.contained_items(documents(spark), items).collect()
    assert Counter(map(tuple, got)) == Counter(contained(TEXTS, ITEMS))


def test_contained_items_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.contained_items(none(spark), items).collect() == []
    assert decontamination.contained_items(documents(spark), items.filter("false")).collect() == []


def test_passages_around_the_limit(spark):
    """Items inside long documents with more and more words changed."""
    texts, items = [], []
    for k in range(12):
        item = prose(900 + k, 30 + k)
        items.append((k, item))
        for cut in range(0, 6):
            body = changed(item, [3 + 5 * c for c in range(cut)])
            texts.append((100 * k + cut, prose(k, 300) + " " + body + " " + prose(k + 40, 300)))
    got = decontamination.contained_items(
        documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert set(map(tuple, got)) == contained(texts, items)
