import warnings

import pandas as pd
import pytest

from reviewlib import sources

HEADER = "name|rating|number_of_photos|message\n"


def cells(df):
    return [tuple(r) for r in df.collect()]


def test_irregular_records_read_as_pandas_does(spark, tmp_path):
    text = (
        "﻿" + HEADER + "ana|4/5|1|bom\n"
        "curta|3/5\n"
        "\n"
        'longa|1|2|3|4\n'
        "longa6|1|2|3||5\n"
        "longa6b|1|2|3||\n"
        'citada|5|0|"um | dois"\n'
        'aspas|5|0|"ele disse ""oi | x"" e foi"\n'
        'linhas|5|0|"um\ndois"\n'
        "na|NA|N/A|null\n"
        "vazia|||\n"
    )
    path = tmp_path / "r.csv"
    path.write_text(text)
    want = pd.read_csv(path, sep="|", engine="python", encoding="utf-8-sig", dtype=str, on_bad_lines="skip")
    got = sources.read_reviews(spark, str(path))
    assert got.columns == list(want.columns)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert sorted(cells(got), key=str) == sorted(rows, key=str)
    assert got.count() == len(want)
    assert got.select("name").count() == len(want)


def test_other_column_order_and_extra_column(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id|message|name|rating|number_of_photos\n1|oi|ana|3|0\n")
    got = sources.read_reviews(spark, str(tmp_path / "r.csv"))
    assert got.columns == ["id", "message", "name", "rating", "number_of_photos"]
    assert cells(got) == [("1", "oi", "ana", "3", "0")]


def test_missing_file_and_column(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_reviews(spark, str(tmp_path / "nope.csv"))
    (tmp_path / "r.csv").write_text("name|rating|message\nana|4|x\n")
    with pytest.raises(ValueError, match="number_of_photos"):
        sources.read_reviews(spark, str(tmp_path / "r.csv"))
    with pytest.raises(KeyError):
        sources.read_reviews(spark, str(tmp_path / "r.csv"), error=KeyError)


def test_labeled_reader(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text('message,label\n"a, b",positive\nc\n')
    assert sorted(cells(sources.read_labeled(spark, str(path))), key=str) == [
        ("a, b", "positive"), ("c", None)]
    with pytest.raises(ValueError, match="text"):
        sources.read_labeled(spark, str(path), "text", "label")
    path.write_text("message,label\na,b,c\n")
    with pytest.raises(Exception, match="too many fields"):
        sources.read_labeled(spark, str(path)).collect()


def test_reviews_round_trip(spark, tmp_path):
    rows = [(" ana ", "4/5", "1", 'a | b "c" \\ d'), ("b", None, "", "um\ndois\n"), ("c", "é", "2", "x")]
    df = spark.createDataFrame(rows, "name string, rating string, number_of_photos string, message string")
    out = str(tmp_path / "out")
    sources.write_reviews(df, out)
    want = [tuple(None if v in ("", None) else v for v in r) for r in rows]
    assert sorted(cells(sources.read_reviews(spark, out)), key=str) == sorted(want, key=str)
    parts = sorted((tmp_path / "out").glob("*.csv"))
    again = pd.concat(pd.read_csv(p, sep="|", dtype=str) for p in parts)
    back = [tuple(None if pd.isna(v) else v for v in r) for r in again.itertuples(index=False)]
    assert sorted(back, key=str) == sorted(want, key=str)


def test_raw_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,message\nana,oi\n", encoding="utf-8")
    (tmp_path / "b.csv").write_bytes("name,message\nbê,olá\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("name;rating\nc, d e;3\nx, y, z;4\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("name,message\nlonga,1,2;3;4\n", encoding="utf-8")
    (tmp_path / "e.csv").write_bytes("name,message\né,1,2\n".encode("latin-1"))
    (tmp_path / "f.csv").write_text("﻿name,message\nbom,\n", encoding="utf-8")
    (tmp_path / "skip.txt").write_text("not,this\n")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        df = sources.load_raw_reviews(spark, str(tmp_path))
    got = {r["__source_file"]: (r.name, r.message, r.rating)
           for r in df.collect() if r.name != "x, y, z"}
    assert got == {
        "a.csv": ("ana", "oi", None),
        "b.csv": ("bê", "olá", None),
        "c.csv": ("c, d e", None, "3"),
        "f.csv": ("bom", None, None),
    }
    left_out = " ".join(str(w.message) for w in caught)
    assert "d.csv" in left_out and "e.csv" in left_out


def test_fallback_for_one_file(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("name,message\nbê,olá\n".encode("latin-1"))
    assert cells(sources.read_with_fallback(spark, str(tmp_path / "b.csv"))) == [("bê", "olá")]
    (tmp_path / "c.csv").write_text("name;rating\nc, d e;3\n", encoding="utf-8")
    assert cells(sources.read_with_fallback(spark, str(tmp_path / "c.csv"))) == [("c, d e", "3")]
    (tmp_path / "d.csv").write_text("name,message\nlonga,1,2;3;4\n", encoding="utf-8")
    with pytest.raises(ValueError, match="d.csv"):
        sources.read_with_fallback(spark, str(tmp_path / "d.csv"))
    with pytest.raises(FileNotFoundError):
        sources.read_with_fallback(spark, str(tmp_path / "e.csv"))


def test_empty_folder(spark, tmp_path):
    with pytest.warns(UserWarning, match="no CSV"):
        df = sources.load_raw_reviews(spark, str(tmp_path))
    assert df.columns == [] and df.count() == 0


def test_preview(spark, tmp_path):
    df = spark.createDataFrame([("m", "n", 1)], "message string, name string, other int")
    assert sources.preview(df).columns == ["name", "message"]
    assert sources.write_preview(df, str(tmp_path / "p"))
    assert not sources.write_preview(df.limit(0), str(tmp_path / "q"))
    assert not sources.write_preview(df.select("other"), str(tmp_path / "q"))
    assert not (tmp_path / "q").exists()


def test_files_with_columns_in_other_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name|rating|number_of_photos|message\nana|1|2|oi\n")
    (tmp_path / "b.csv").write_text("\nmessage|name|rating|number_of_photos\nhello|bia|4|1\n")
    (tmp_path / "c.csv").write_text("\n\n")
    rows = sources.read_reviews(spark, str(tmp_path)).orderBy("name")
    got = rows.select("name", "rating", "number_of_photos", "message").collect()
    assert [tuple(r) for r in got] == [("ana", "1", "2", "oi"), ("bia", "4", "1", "hello")]
    (tmp_path / "d.csv").write_text("name|rating\nx|1\n")
    with pytest.raises(ValueError):
        sources.read_reviews(spark, str(tmp_path))


def test_quotes_inside_a_field_hide_no_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'name|rating|number_of_photos|message\na"b|1|2|x"y|extra|more\nc"d|1|2|z"w\n'
        '"e|""f"|1|2|"g ""|"" h"\n""|1|2|"i"|j\n'
    )
    got = sources.read_reviews(spark, str(tmp_path)).orderBy("name").collect()
    assert [tuple(r) for r in got] == [('c"d', "1", "2", 'z"w'), ('e|"f', "1", "2", 'g "|" h')]


def test_blank_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("\n \n")
    (tmp_path / "c.csv").write_text("")
    with pytest.warns(UserWarning, match="c.csv"):
        got = sources.load_raw_reviews(spark, str(tmp_path)).collect()
    assert [(r.x, r.y) for r in got] == [("1", "2")]
    for name in ("b.csv", "c.csv"):
        with pytest.raises(ValueError):
            sources.read_with_fallback(spark, str(tmp_path / name))
        with pytest.raises(ValueError):
            sources.read_reviews(spark, str(tmp_path / name))
