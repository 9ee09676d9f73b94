"""The pipeline stage by stage against plain versions, and the registered queries."""

import re
import sys
from pathlib import Path

import pytest
import sentencepiece
from fixtures import LONG, changed, documents, prose, rows
from test_joins import contained, linked

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, duck
from reviewlib.llm import pieces

SF = "/root/testdata/sf0.001"


def junk(seed):
    return " ".join(f"{w}###" for w in prose(seed, 60).upper().split(" "))


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the tables that the pipeline reads."""
    item = prose(700, 40)
    texts = [(i, prose(i, 30 + i % 50)) for i in range(1, 90)] + [(i, junk(i)) for i in range(100, 140)]
    texts += [
        (200, LONG), (201, changed(LONG, [60])), (202, LONG), (203, prose(8, 60) + " " + item + " end"),
        (204, prose(9, 40) + ' token = "0123456789abcdef0123456789abcdef01234567" ' + prose(10, 30)),
        (205, prose(11, 80)), (205, prose(11, 80)), (206, None), (None, prose(12, 70)),
    ]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 100), 0) for i, t in texts if i and i < 130]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path), item


def as_pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ids(pairs):
    return sorted((i for i, _ in pairs), key=lambda i: (i is None, i or 0))


def test_stages(spark, tables):
    sf, item = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, as_pairs(docs)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        df = stage(spark, docs, sf)
        assert df.columns == columns, name
        path = f"{sf}/stage{k}"
        df.write.parquet(path)
        docs = spark.read.parquet(path)
        after = as_pairs(docs)
        if k == 0:
            want = [p for p in before if p[0] is None or not 100 <= p[0] < 140]
            gone = set(ids(want)) - set(ids(after))
            assert not {i for i in ids(after) if i and 100 <= i < 140} and gone <= {206}
        elif k == 1:
            out = {i for i, _, c in linked(before) if i != c and i is not None}
            assert out == {201, 202} and ids(after) == ids(p for p in before if p[0] not in out)
        elif k == 2:
            out = {i for i, *_ in contained(before, [(1, item)])}
            assert out == {203} and ids(after) == ids(p for p in before if p[0] not in out)
        else:
            pattern = re.compile(r'token = "[0-9a-f]+')
            want = [(i, t and pattern.sub("[secret]", t)) for i, t in before]
            assert sorted(after, key=str) == sorted(want, key=str)
            assert all(r.n_chars == len(r.text or "") or r.text is None for r in docs.collect())
        before = after
    sp = sentencepiece.SentencePieceProcessor(model_proto=open(
        __import__("public_tokenizers").path(corpus_pipeline.MODEL), "rb").read())
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted((str(r.doc_id), r.ids) for r in final) == sorted(
        (str(i), sp.encode(t or "")) for i, t in before
    )
    whole = corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens").collect()
    assert sorted(map(str, whole)) == sorted(
        str(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id", "n_tokens").collect()
    )


def test_pipeline_of_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_query_for_each_operator():
    names = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [q for q in entry.queries() if re.match(r"op\d+_", q)])
def test_query(spark, name):
    sql = entry.oracle_sql().get(name)
    assert compare(spark, duck(SF), SF, name, entry.queries()[name], sql) is None


def test_fixture_rows_fit_their_schema():
    assert len(rows()[0]) == 14 and pieces.CharMap(b"").longest(b"x", 0) is None
