"""Grouped split: whole groups on a side, quotas met within the stated bound."""

import random
from collections import Counter, defaultdict

from reviewlib.operators import split
from reviewlib.plans.queries import QUERIES

LABELS = ("negative", "neutral", "positive")


def rows(seed=1):
    draw = random.Random(seed)
    out, i = [], 0
    sizes = [900] + [draw.randrange(1, 40) for _ in range(400)] + [120, 80]
    for g, size in enumerate(sizes):
        lean = draw.random()
        for _ in range(size):
            label = "positive" if draw.random() < lean else draw.choice(LABELS)
            out.append((i, f"a{g}", label))
            i += 1
    out += [(i + k, None, "neutral") for k in range(30)] + [(i + 40, "a1", "unknown"), (i + 41, "a1", None)]
    return out


def test_groups_whole_and_quotas_near(spark):
    data = rows()
    df = spark.createDataFrame(data, "review_id long, author string, label string")
    got = split.grouped_split(df, "author", "label", "review_id", large=100).collect()
    assert len(got) == sum(1 for r in data if r[2] in LABELS)
    sides = defaultdict(set)
    for r in got:
        sides[r["author"] or f"row{r['review_id']}"].add(r["split"])
    assert all(len(s) == 1 for s in sides.values())
    per = Counter((r["split"], r["label"]) for r in got)
    totals = Counter(r["label"] for r in got)
    for label in LABELS:
        for side, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
            miss = abs(per[(side, label)] - share * totals[label])
            assert miss <= 0.05 * totals[label] + 40, (side, label, miss)


def test_nothing_known(spark):
    df = spark.createDataFrame([(1, "a", None)], "review_id long, author string, label string")
    assert split.grouped_split(df, "author", "label", "review_id").count() == 0


def test_query(spark):
    got = QUERIES["grouped_split"](spark, "/root/testdata/sf0.01").collect()
    assert got and all(r["authors_on_two_sides"] == 0 for r in got)
    assert {r["split"] for r in got} <= {"train", "val", "test"}
