"""The Merkle manifest against a plain version in Python."""

import hashlib
import zlib
from collections import Counter

import __spark_entry__ as entry
from fixtures import TEXTS, documents, none, prose


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, s, l, n, t):
    return H("".join(enc(v) for v in (d, s, l, n, t)))


def tree(digests):
    """Root and, per leaf, the (left, right) pairs up to it."""
    paths = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    level = list(digests)
    while len(level) > 1:
        nxt, grouped = [], []
        for p in range(0, len(level), 3):
            run = level[p : p + 3]
            for k in range(len(run)):
                for i in members[p + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            nxt.append(H("".join(run)))
            grouped.append([i for k in range(len(run)) for i in members[p + k]])
        level, members = nxt, grouped
    return level[0], paths


def fold(start, path):
    for left, right in path:
        start = H(left + start + right)
    return start


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, lows = {}, {}
    for s in names:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        sub, paths = tree([leaf(*r) for r in members])
        subroots[s] = sub
        lows[s] = list(zip(members, paths))
    root, tops = tree([subroots[s] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in lows[s]:
            full = path + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            start = leaf(*r[:4], r[4].replace("\n", "")) if bad else leaf(*r)
            folded = fold(start, full)
            proof = H("".join(a + b for a, b in full))
            out.append((r[0], leaf(*r), subroots[s], root, proof, folded, folded == root))
    return out


def run(spark, tmp_path, texts, sources=None):
    docs = documents(spark, texts)
    if sources:
        from pyspark.sql import functions as F

        docs = docs.withColumn("source", F.element_at(F.lit(sources), (F.abs(F.hash("text")) % len(sources) + 1).cast("int")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()]
    got = entry.queries()["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    return Counter(tuple(r) for r in got), Counter(plain(rows))


def test_awkward_rows_equal_the_plain_version(spark, tmp_path):
    texts = TEXTS + [(i, prose(i, 5) + "\nx\n") for i in range(100, 140)] + [(150, "a\nb")] * 3
    got, want = run(spark, tmp_path, texts)
    assert got == want
    assert any(not v for *_, v in got) and any(v for *_, v in got)


def test_many_sources_and_a_null_one(spark, tmp_path):
    texts = [(i, prose(i, 3) + ("\n" if i % 3 else "")) for i in range(200)] + [(None, "z"), (None, None)]
    got, want = run(spark, tmp_path, texts, sources=[None, "a", "b", "é", "B", "a b"])
    assert got == want


def test_one_row_is_its_own_root(spark, tmp_path):
    got, want = run(spark, tmp_path, [(4, "one")])
    assert got == want
    (row,) = got
    assert row[1] == row[2] == row[3] and row[6]


def test_no_rows(spark, tmp_path):
    none(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert entry.queries()["op13_merkle_manifest"](spark, str(tmp_path)).count() == 0
