"""Elements of pages by balanced tags, against stated texts and against the recursive SQL."""

import duckdb
from pyspark.sql import functions as F

from reviewlib.plans.oracles import ORACLES
from reviewlib.plans.queries import QUERIES
from reviewlib.sources import page_elements
from reviewlib.sources.pages import elements

PAGES = [
    '<div class="bwb7ce">Ana 3 avaliações <div>muito <b>bom</b></div> resposta fim</div>',
    "<div data-x=\"1\" class=\"bwb7ce\">a</div><div class='bwb7ce'>b &amp; c</div><div class=bwb7ce>d</div>"
    '<div class="bwb7ce x">not this</div><div data-class="bwb7ce">nor this</div>',
    '<div class="bwb7ce">outer <div class="bwb7ce">inner</div> tail</div></div><div class="bwb7ce">  </div>'
    '<script>x="</div>"</script><!-- <div class="bwb7ce">hidden</div> --><div class="bwb7ce">open',
    None,
    "",
    '<<div class="bwb7ce">x<y</div>',
    '<DIV CLASS="bwb7ce">line<br>break<p>para</p>end</DIV>',
    '<div class="bwb7ce">' + "word " * 20_000 + "</div>",
]


def test_whole_texts_of_nested_and_odd_elements(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "i int, html string")
    got = dict(df.select("i", page_elements("html")).collect())
    assert got[0] == ["Ana 3 avaliações muito bom resposta fim"]
    assert got[1] == ["a", "b & c", "d"]
    assert got[2] == ["outer inner tail", "inner", "open"]
    assert got[3] is None and got[4] == []
    assert got[5] == ["x<y"]
    assert got[6] == ["line break para end"]
    assert got[7] == [" ".join(["word"] * 20_000)]
    firsts = dict(df.select("i", page_elements("html", max_comments=1)).collect())
    assert firsts[2] == ["outer inner tail"]


def test_every_element_of_a_tag(spark):
    df = spark.createDataFrame([("<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>",)], "html string")
    (row,) = df.select(elements("html", "li", None)).collect()
    assert row[0] == ["a b", "b", "c"]


def test_queries_equal_the_recursive_sql(spark, tmp_path):
    spark.createDataFrame(list(enumerate(PAGES[:7] + [p.replace("bwb7ce", "ad") for p in PAGES[:7] if p]))
                          + [(50, "<article><h1>T</h1><p>x &lt; y<article>in</article></p></article>")],
                          "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    for name in ("page_elements", "page_articles"):
        want = sorted(con.execute(ORACLES[name]).fetchall())
        got = sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
        assert got == want, name
        assert got
