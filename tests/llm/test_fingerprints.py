"""SimHash fingerprints, the edited-text query and the block-table search against plain versions."""

import hashlib
import random

import regex
import xxhash
from fixtures import TEXTS, documents, none, prose
from pyspark.sql import functions as F

from reviewlib.llm import neighbours, simhash

M = (1 << 64) - 1


def mix(x):
    x ^= x >> 30
    x = (x * 0xBF58476D1CE4E5B9) & M
    x ^= x >> 27
    x = (x * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def rotl(x, r):
    return ((x << r) | (x >> (64 - r))) & M


def plain_fingerprint(text):
    words = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())]
    if not words:
        return 0
    grams = [words[i : i + 3] for i in range(len(words) - 2)] or [(words + [0, 0])[:3]]
    feats = [mix(((a * 0x9E3779B97F4A7C15) & M) ^ rotl(b, 21) ^ rotl(c, 42)) for a, b, c in grams]
    bits = [sum(1 if f >> j & 1 else -1 for f in feats) > 0 for j in range(64)]
    value = sum(1 << j for j, on in enumerate(bits) if on)
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    made = simhash.add_fingerprints(df.withColumn("_h", simhash.word_hashes(F.col("text"))), {"fp": "_h"})
    return dict(made.select("i", "fp").collect())


def test_fingerprints_are_the_plain_ones(spark):
    texts = [t for _, t in TEXTS] + ["a", "a b", "a b c", "Ünï 12 x", "...", "x " * 3000]
    found = fingerprints_of(spark, texts)
    for i, t in enumerate(texts):
        assert found[i] == plain_fingerprint(t), (i, t and t[:40])


def test_equal_texts_equal_fingerprints_and_empty_ones_zero(spark):
    found = fingerprints_of(spark, [prose(1, 50), prose(1, 50), None, "", " ;; "])
    assert found[0] == found[1] and found[2] == found[3] == found[4] == 0


def test_near_texts_have_near_fingerprints(spark):
    base = prose(9, 400)
    words = base.split(" ")
    words[200] = "changed"
    found = fingerprints_of(spark, [base, " ".join(words), prose(10, 400)])
    near = bin(found[0] ^ found[1]).count("1")
    far = bin(found[0] ^ found[2]).count("1")
    assert near <= 8 < far


def test_next_rows_cyclic_with_ties_and_one_row(spark):
    rows = [(i % 7, f"t{i}") for i in range(60)] + [(None, "n1"), (None, "n2"), (3, "t3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = [F.col("doc_id").isNull(), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)), F.col("text")]
    got = neighbours.with_next(df, order, ["text"]).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {}
    for i, r in enumerate(ordered):
        want.setdefault(r, []).append(ordered[(i + 1) % len(ordered)][1])
    seen = {}
    for r in got:
        seen.setdefault((r["doc_id"], r["text"]), []).append(r["next_text"])
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    lone = neighbours.with_next(df.limit(1), order, ["text"]).collect()
    assert lone[0]["next_text"] == lone[0]["text"]
    assert neighbours.with_next(df.limit(0), order, ["text"]).count() == 0


def test_within_is_the_brute_force_count(spark):
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(40)]
    fps = []
    for b in base:
        fps.append(b)
        for _ in range(draw.randrange(0, 6)):
            flip = b
            for _ in range(draw.randrange(0, 6)):
                flip ^= 1 << draw.randrange(64)
            fps.append(flip)
    fps += fps[:10]  # copies
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed] + [(None,)], "fp long")
    got = {r["fp"]: (r["n"], r["n_near"]) for r in simhash.within(df, radius=3, chunk=3).collect()}
    for f in set(signed):
        n = signed.count(f)
        near = sum(1 for g in signed if g != f and bin((f ^ g) & M).count("1") <= 3)
        assert got[f] == (n, near)


def test_block_tables_are_never_broadcast(spark):
    # sized as their input before the array of keys is cut into rows, they would pass for small
    near = simhash.within(spark.range(50).select(F.xxhash64("id").alias("fp")))
    assert near.count() == 50
    plan = near._jdf.queryExecution().executedPlan().toString().split("\n")
    joins = [line for line in plan if "Join [t#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_query_on_awkward_rows(spark, tmp_path):
    import __spark_entry__ as entry

    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["op11_simhash"](spark, str(tmp_path)).collect()
    assert len(got) == len(TEXTS)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == 16
    by_id = {r["doc_id"]: r for r in got}
    for i, (d, t) in enumerate(ordered):
        if d in (13, None):
            continue  # repeated ids: their order among themselves is by text hash
        nxt = ordered[(i + 1) % len(ordered)][1] or ""
        t = t or ""
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        assert by_id[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), d
        assert by_id[d]["n_chars"] == len(t)
        assert int(by_id[d]["edited_fingerprint"], 16) == plain_fingerprint(edited) & M
    assert by_id[7]["n_near"] >= 1  # 8 is a copy of 7
    assert entry.queries()["op11_simhash"].__name__ == "op11_simhash"


def test_no_rows(spark, tmp_path):
    import __spark_entry__ as entry

    none(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert entry.queries()["op11_simhash"](spark, str(tmp_path)).count() == 0
