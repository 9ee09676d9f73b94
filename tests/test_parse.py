import pytest
import random
import re

from pyspark.sql import functions as F

from reviewlib import sources
from reviewlib.functions import normalize_dump
from reviewlib.functions.patterns import DumpFormat
from reviewlib.operators import parse
from reviewlib.operators.ranking import first_per_group, running_total

FIELDS = ["name", "rating", "number_of_photos", "message"]


def parsed(spark, dump, **kw):
    df = spark.createDataFrame([(1, dump)], "id int, dump string")
    return [tuple(r) for r in parse.parse_dumps(df, **kw).orderBy("review_no").select(*FIELDS).collect()]


def test_fields(spark):
    dump = "Ana Local Guide· 12 avaliações·34 fotos Comida: 4,5/5 Ambiente: 4/5 bom | Bia 1 avaliação ok"
    assert parsed(spark, dump) == [
        ("Ana", "4.2/5", "34", "Comida: 4,5/5 Ambiente: 4/5 bom  /"),
        ("Bia", "", "", "ok"),
    ]


def test_rating_in_owner_reply_counts(spark):
    dump = "Ana 2 avaliações bom Ofner - Perdizes (proprietário) obrigado 5/5"
    assert parsed(spark, dump) == [("Ana", "5.0/5", "", "bom")]


def test_no_range_check(spark):
    assert parsed(spark, "Ana 2 avaliações 7/5") == [("Ana", "7.0/5", "", "7/5")]


def test_name_starts_after_line_end_or_separator(spark):
    assert parsed(spark, "intro\nAna 2 avaliações x")[0][0] == "Ana"
    assert parsed(spark, "intro | Ana 2 avaliações x")[0][0] == "Ana"
    assert parsed(spark, "intro Ana 2 avaliações x")[0][0] == "intro Ana"


def test_comment_without_header_goes_to_the_review_before(spark):
    dump = "perdido | Ana 2 avaliações um | dois | Bia 3 avaliações três"
    assert parsed(spark, dump) == [("Ana", "", "", "um  /  dois  /"), ("Bia", "", "", "três")]


def test_one_photo_is_no_photo_count(spark):
    assert parsed(spark, "Ana 2 avaliações·1 foto oi") == [("Ana", "", "", "·1 foto oi")]


def test_header_over_two_lines_and_upper_case(spark):
    assert parsed(spark, "Ana\r\nLocal Guide·\r\n2 AVALIAÇÕES·5 FOTOS oi") == [("Ana", "", "5", "oi")]


def test_two_headers_on_one_line(spark):
    assert parsed(spark, "Ana 2 avaliações oi Bia 3 avaliações tchau") == [
        ("Ana", "", "", ""),
        ("oi Bia", "", "", "tchau"),
    ]


def test_no_header(spark):
    df = spark.createDataFrame([(1, "nada | aqui"), (2, None)], "id int, dump string")
    out = parse.parse_dumps(df)
    assert out.columns == ["id", "review_no", *FIELDS] and out.count() == 0


def test_find_headers(spark):
    df = spark.createDataFrame([("Ana 2 avaliações·7 fotos x | Bia 1 avaliação",)], "t string")
    (row,) = df.select(parse.find_headers("t").alias("h")).collect()
    assert [tuple(h) for h in row.h] == [("Ana", "2", "7"), ("Bia", "1", "")]


def test_own_header(spark):
    fmt = DumpFormat(header=r" +([0-9]+) reviews(?: ([0-9]+) photos)?", noise=())
    assert parsed(spark, "Ann 2 Reviews 3 photos good", fmt=fmt) == [("Ann", "", "3", "good")]


def _random_comment(rng):
    bits = ["Ana 2 avaliações", "Bia Local Guide· 3 avaliação·4 fotos", "bom", "4/5", "|", "\n", "\r\n",
            " ", "  ", "x 5 avaliações·1 foto", "Comida: 3,5/5", "||", "\t", "9", "avaliações"]
    return "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 9)))


def test_headers_and_bodies(spark):
    """Where a name can and cannot start, one case each: headers, then messages."""
    cases = {
        "Zé 5 avaliações bom": ([("Zé", "5", "")], ["bom"]),
        " 5 avaliações": ([], []),
        "  5 avaliações": ([("", "5", "")], [""]),
        "\n  5 avaliações": ([("", "5", "")], [""]),
        "a\n\n 5 avaliações": ([("a", "5", "")], [""]),
        "a 5 avaliações 6 avaliações": ([("a", "5", "")], ["6 avaliações"]),
        "a 5 avaliações  6 avaliações": ([("a", "5", ""), ("", "6", "")], ["", ""]),
        "a 1 2 avaliações": ([("a 1", "2", "")], [""]),
        "Rui Local Guide· 7 AVALIAÇÕES·2 fotos sim": ([("Rui", "7", "2")], ["sim"]),
        "x | Eva 1 avaliação·1 foto não\nIvo 2 avaliações já": (
            [("Eva", "1", ""), ("Ivo", "2", "")], ["·1 foto não", "já"]),
        "a 1 avaliação um | dois": ([("a", "1", "")], ["um  /  dois"]),
        "sem nada": ([], []),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string")
    text = df.select("i", normalize_dump("s").alias("dump"))
    found = text.orderBy("i").select(parse.find_headers("dump")).collect()
    assert [[tuple(h) for h in r[0]] for r in found] == [h for h, _ in cases.values()]
    bodies = {}
    for r in sorted(parse.parse_dumps(text).collect(), key=lambda r: (r.i, r.review_no)):
        bodies.setdefault(r.i, []).append(r.message)
    assert [bodies.get(i, []) for i in range(len(cases))] == [b for _, b in cases.values()]


def test_comments_parse_like_their_dump(spark):
    """Separately parsed comments against the joined dump, block borders everywhere."""
    rng = random.Random(7)
    rows = [(s, i, _random_comment(rng)) for s in range(40) for i in range(rng.randint(1, 12))]
    rows += [(99, 0, "só texto"), (99, 1, "mais texto")]
    df = spark.createDataFrame(rows, "source int, ord long, comment string").withColumn(
        "block", F.shiftright("ord", 2)
    )
    df = df.withColumn("comment", F.btrim("comment", F.lit(" \n\r\t"))).filter("comment <> ''")
    joined = df.groupBy("source").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "comment"))), lambda x: x.comment),
            " | ",
        ).alias("dump")
    )
    whole = sorted(map(tuple, parse.parse_dumps(joined).collect()))
    for block in (None, "block", "ord"):
        apart = parse.parse_comments(df, block=block).select("source", "review_no", *FIELDS)
        assert sorted(map(tuple, apart.collect())) == whole
    assert len(whole) > 100


def test_null_source_is_a_source(spark):
    df = spark.createDataFrame(
        [(None, 0, "Ana 2 avaliações um"), (None, 1, "dois"), ("a", 0, "Bia 3 avaliações x")],
        "source string, ord long, comment string",
    )
    got = {(r.source, r.name, r.message) for r in parse.parse_comments(df).collect()}
    assert got == {(None, "Ana", "um  /  dois"), ("a", "Bia", "x")}


def test_running_total_restarts_from_block_totals(spark):
    rows = [(g, i, (i * 7 + g) % 3) for g in (1, 2) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, i long, step int").withColumn("b", F.shiftright("i", 3))
    got = {(r.g, r.i): r.t for r in running_total(df, ["g"], "b", ["i"], "step", "t").collect()}
    for g in (1, 2):
        total = 0
        for i in range(50):
            total += (i * 7 + g) % 3
            assert got[g, i] == total


def test_first_per_group(spark):
    df = spark.range(0, 60_000, 3).select(F.col("id").alias("ord"), (F.col("id") % 2).alias("g"))
    got = first_per_group(df, "g", "ord", 8_000)
    assert {(r.g, r["n"], r.top) for r in got.groupBy("g").agg(
        F.count("*").alias("n"), F.max("ord").alias("top")).collect()} == {
        (0, 8_000, 7_999 * 6), (1, 8_000, 7_999 * 6 + 3)}


def test_dump_files_round_trip(spark, tmp_path):
    rows = [("s1", i, f"A{i} {i} avaliações texto\n{i}") for i in range(5_000)] + [
        ("s2", 0, " B 1 avaliação x "), ("s2", 1, "  "), ("s2", 2, "resto")]
    df = spark.createDataFrame(rows, "source string, ord long, comment string")
    out = str(tmp_path / "dumps")
    sources.write_dumps(df, out)
    files = {p.parent.name: p.read_text() for p in (tmp_path / "dumps").glob("source=s2/*.txt")}
    assert files == {"source=s2": " B 1 avaliação x | resto |"}

    pieces = sources.read_dump_pieces(spark, f"{out}/*/*.txt", source="folder")
    got = parse.parse_comments(pieces, "source_file", block="block").collect()
    first = sorted((r.review_no, r.name, r.message) for r in got if "s1" in r.source_file)
    last = {4_999: ""}
    assert first == [(i + 1, f"A{i}", f"texto {i}{last.get(i, '  /')}") for i in range(5_000)]
    assert [r.message for r in got if "s2" in r.source_file] == ["x  /  resto"]

    capped = sources.dump_comments(df, max_comments=20)
    assert capped.groupBy("source").count().orderBy("source").collect() == [("s1", 20), ("s2", 2)]


def test_large_file_is_read_in_splits(spark, tmp_path):
    text = " | ".join(f"A{i} {i} avaliações texto {i} | solto {i}" for i in range(5_000))
    (tmp_path / "d.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        pieces = sources.read_dump_pieces(spark, str(tmp_path / "d.txt"))
        assert pieces.select("block").distinct().count() > 5
        apart = parse.parse_comments(pieces, "source_file", block="block")
        whole = parse.parse_dumps(sources.read_dumps(spark, str(tmp_path / "d.txt")))
        assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, whole.collect()))
        assert apart.count() == 5_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_latin1_dump(spark, tmp_path):
    (tmp_path / "d.txt").write_bytes("Ana 2 avaliações é".encode("latin-1"))
    fmt = DumpFormat(encoding="ISO-8859-1")
    df = parse.parse_dumps(sources.read_dumps(spark, str(tmp_path / "d.txt"), fmt))
    assert [r.message for r in df.collect()] == ["é"]
    pieces = sources.read_dump_pieces(spark, str(tmp_path / "d.txt"), fmt)
    assert [r.comment for r in pieces.collect()] == ["Ana 2 avaliações é"]
    with pytest.raises(ValueError):
        sources.read_dump_pieces(spark, str(tmp_path / "d.txt"), DumpFormat(encoding="UTF-16"))


def test_page_elements(spark):
    html = (
        '<div class="c">um <b>dois</b>\ntrês</div><div class="d">não</div>'
        '<div class="c"> </div><div  class="c" id="x">quatro</div><div class="c">cinco</div>'
    )
    df = spark.createDataFrame([(html,), (None,)], "html string")
    got = [r[0] for r in df.select(sources.page_elements("html", "c", max_comments=2)).collect()]
    assert got == [["um dois três", "quatro"], None]
    every = [r[0] for r in df.select(sources.page_elements("html", "c")).collect()]
    assert every == [["um dois três", "quatro", "cinco"], None]
