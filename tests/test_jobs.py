import tempfile

import pandas as pd
import pytest

from reviewlib import sources
from reviewlib.functions.patterns import DumpFormat
from reviewlib.operators import labeling
from reviewlib.plans import jobs
from reviewlib.scratch import scratch_dir
from reviewlib.streaming import label_stream, parse_stream, preprocess_stream

RAW = """name|rating|number_of_photos|message
ana|4,5|2|Pão bom! http://a.b
bia||0|Voltarei sempre. Comida: 2/5 / Serviço: 5/5 / Ambiente: 4/5
caio||1|nada a dizer
duda|3/5|0|
enzo|98|0|lugar bonito
"""


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "r.csv").write_text(RAW)
    return str(tmp_path / "raw" / "r.csv")


def written(path, **kw):
    return pd.concat(pd.read_csv(p, **kw) for p in sorted(path.glob("*.csv")))


def test_label_job(spark, raw, tmp_path):
    counts = jobs.label_job(spark, raw, str(tmp_path / "out"))
    out = written(tmp_path / "out").set_index("name")
    assert out.index.tolist() == ["ana", "enzo"]
    assert out.rating_num.tolist() == [4.5, 4.9] and set(out.label) == {"positive"}
    assert out.message["ana"] == "Pão bom! / / a.b"
    assert counts == {"rows_in": 5, "rows_usable": 2, "negative": 0, "neutral": 0, "positive": 2}


def test_label_job_with_raw_ratings(spark, raw, tmp_path):
    jobs.label_job(spark, raw, str(tmp_path / "out"), ratings_from="raw")
    out = written(tmp_path / "out").set_index("name")
    assert out.rating_num["bia"] == 4.0 and out.message["bia"] == "Voltarei sempre."


def test_unknown_rating_source(spark, raw):
    with pytest.raises(ValueError):
        labeling.label_reviews(sources.read_reviews(spark, raw), ratings_from="x")


def test_costly_cleaning_happens_once(spark, raw):
    df = labeling.label_reviews(sources.read_reviews(spark, raw))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Comida:") == 1


def test_preprocess_job(spark, raw, tmp_path):
    assert jobs.preprocess_job(spark, raw, str(tmp_path / "out")) == 5
    out = written(tmp_path / "out", dtype=str, keep_default_na=False)
    assert len(out) == 5 and len(out.columns) == 12
    assert out.number_of_photos_clean.tolist() == ["2", "0", "1", "0", "0"]
    assert out.message_clean[0] == "pão bom!"
    with pytest.raises(FileNotFoundError):
        jobs.preprocess_job(spark, str(tmp_path / "nope.csv"), str(tmp_path / "out"))


def test_parse_job(spark, tmp_path):
    text = "Ana 12 avaliações·3 fotos 4/5 bom | Bia 1 avaliação ok"
    for encoding in ("UTF-8", "ISO-8859-1"):
        (tmp_path / "d.txt").write_bytes(text.encode(encoding))
        out = tmp_path / encoding
        jobs.parse_job(spark, str(tmp_path / "d.txt"), str(out), DumpFormat(encoding=encoding))
        got = written(out, sep="|", dtype=str).fillna("").sort_values("name")
        assert got.values.tolist() == [["Ana", "4.0/5", "3", "4/5 bom  /"], ["Bia", "", "", "ok"]]


def test_eda_job(spark, raw, tmp_path):
    report = jobs.eda_job(spark, str(tmp_path / "raw"), str(tmp_path / "preview"))
    assert report.rows.count() == 5
    assert {r["column"]: r.nulls for r in report.null_counts.collect()}["message"] == 1
    assert [r.rating for r in report.rating_distribution.collect()] == [98.0]
    assert sum(r["n"] for r in report.words_histogram.collect()) == 5
    assert report.words_by_rating.count() == 1
    assert [r.name for r in report.top_authors.collect()] == ["ana", "bia", "caio", "duda", "enzo"]
    assert {r.name for r in report.suspects.collect()} == {"ana", "caio", "duda", "enzo"}
    assert report.duplicates.count() == 0
    assert report.describe.count() == 5
    assert written(tmp_path / "preview").columns.tolist() == [
        "name", "rating", "number_of_photos_norm", "len_chars", "len_words", "has_url", "message"]


def test_eda_job_with_odd_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name|name|a.b|\nana|x|1|2\n")
    with pytest.warns(UserWarning):
        report = jobs.eda_job(spark, str(tmp_path), str(tmp_path / "p"))
    assert [r["column"] for r in report.null_counts.collect()] == [
        "name", "name.1", "a.b", "Unnamed: 3", "__source_file"]
    assert report.describe.count() == 5
    assert [r.name for r in report.top_authors.collect()] == ["ana"]


def test_eda_job_without_files(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert jobs.eda_job(spark, str(tmp_path), str(tmp_path / "p")) is None


class Session:
    """What ``scratch_dir`` asks a session for."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = self
        self.master = master


def test_scratch_dir_is_under_the_sessions_folder():
    shared = {"spark.checkpoint.dir": "hdfs://x/y/"}
    first, second = (scratch_dir(Session("yarn", **shared)) for _ in range(2))
    assert first != second and first.startswith("hdfs://x/y/")
    assert scratch_dir(Session("local[4]")).startswith(tempfile.gettempdir())
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            scratch_dir(Session(master))


def test_streams_take_new_files_once(spark, tmp_path):
    dumps, reviews = tmp_path / "dumps", tmp_path / "reviews"
    labels, cleaned = tmp_path / "labels", tmp_path / "cleaned"
    dumps.mkdir()

    def run():
        parse_stream(spark, str(dumps), str(reviews), str(tmp_path / "c1")).awaitTermination()
        label_stream(spark, str(reviews), str(labels), str(tmp_path / "c2")).awaitTermination()
        preprocess_stream(spark, str(reviews), str(cleaned), str(tmp_path / "c3")).awaitTermination()
        return (
            {(r.name, r.label) for r in spark.read.parquet(str(labels)).collect()},
            sorted(r.name_clean for r in spark.read.parquet(str(cleaned)).collect()),
        )

    (dumps / "1.txt").write_text("Ana 12 avaliações 5/5 bom | Bia 1 avaliação ok")
    assert run() == ({("Ana", "positive")}, ["ana", "bia"])
    (dumps / "2.txt").write_text("Caio 1 avaliação 1/5 ruim")
    assert run() == ({("Ana", "positive"), ("Caio", "negative")}, ["ana", "bia", "caio"])
    assert run() == ({("Ana", "positive"), ("Caio", "negative")}, ["ana", "bia", "caio"])
