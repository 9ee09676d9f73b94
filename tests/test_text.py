import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from reviewlib import functions as R
from reviewlib.functions import patterns as P


def apply(spark, fn, values):
    """``fn`` of each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_strip_takes_what_python_strips(spark):
    every = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"{chr(c)}a{chr(c)}" for c in every]
    assert apply(spark, R.strip, texts) == [t.strip() for t in texts]


def test_whitespace_pattern_is_pythons(spark):
    every = [chr(c) for c in range(1, 0x3100)]
    found = apply(spark, lambda c: c.rlike(P.unicode(f"[{P.WS}]")), every)
    assert found == [c.isspace() for c in every]


def test_basic_clean(spark):
    cases = {
        "\tLoja em https://loja.pt/a?b=1  ABERTA \n\n ver HTTPS://X.Y e http://z.w/q ": (
            "loja em aberta ver https://x.y e"
        ),
        None: "",
        "HTTP://UPPER.case stays": "http://upper.case stays",
        "a  b\x1cc": "a b c",
        "ÉCLAIR": "éclair",
        "": "",
    }
    assert apply(spark, R.basic_clean, cases) == list(cases.values())


@pytest.mark.parametrize(
    "text,expected",
    [
        (" sol  /\tlua ", "sol / lua"),
        ("24/7", "24 / 7"),
        ("Demorou muito. Comida: 1,5/5 / Serviço: 2/5 / Ambiente: 3/5", "Demorou muito."),
        ("bom COMIDA: 3/5 e mais", "bom"),
        ("bom\nComida: 3/5\n", "bom"),
        # not on the last line: stays
        ("bom\nComida: 3/5\nfim", "bom Comida: 3 / 5 fim"),
        # slashes are spaced before links go, so the host stays
        ("mapa: http://m.n fim", "mapa: / / m.n fim"),
        ("só 😀❤️ isso ⭐", "só isso"),
        (None, ""),
        (" \n ", ""),
    ],
)
def test_clean_message(spark, text, expected):
    assert apply(spark, R.clean_message, [text]) == [expected]


def test_clean_message_keeps_emojis_when_told(spark):
    assert apply(spark, lambda c: R.clean_message(c, strip_emojis=False), ["a 😀  b"]) == ["a 😀 b"]


def test_links_over_several_lines(spark):
    text = "um https://a.pt/b\ndois\t\thttp://c.pt\n\ntrês httpx"
    assert apply(spark, R.clean_message, [text]) == ["um / / a.pt / b dois / / c.pt três"]


def test_remove_emojis_by_block(spark):
    gone = [0x1F300, 0x1F64F, 0x1F6FF, 0x1F77F, 0x1F7FF, 0x1F8FF, 0x1F9FF, 0x1FA6F, 0x1FAFF,
            0x2600, 0x27BF, 0x2B00, 0x2BFF, 0xFE0F, 0x1F1E6, 0x1F1FF]
    kept = [0x25FF, 0x27C0, 0x2AFF, 0x2C00, 0xFE0E, 0x1F2FF, 0x1FB00, 0x1F650, 0x1F67F, 0x20AC]
    assert apply(spark, R.remove_emojis, [f"a{chr(c)}b" for c in gone]) == ["ab"] * len(gone)
    assert apply(spark, R.remove_emojis, [chr(c) for c in kept]) == [chr(c) for c in kept]


def test_nfkc_of_every_character_and_of_combinations(spark):
    every = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every[i : i + 64]) for i in range(0, len(every), 64)]
    texts += ["é", "ﬁm", "①", "½", "ｆｕｌｌ", "plain", "açaí", None, "", "Å̧"]
    expected = [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
    assert apply(spark, R.nfkc, texts) == expected


def test_stable_class_is_stable():
    stable = [*range(0xA0), *range(0xA1, 0xA8), 0xA9, *range(0xAB, 0xAF), 0xB0, 0xB1, 0xB6, 0xB7,
              0xBB, *range(0xBF, 0x132)]
    text = "".join(map(chr, stable))
    assert unicodedata.normalize("NFKC", text) == text


def test_clean_model_text(spark):
    df = spark.createDataFrame(
        [("Oi @user_1 veja http://a.b/c #tag-x ﬁm",), ("@é #ção-2",), (None,)], "m string"
    )
    got = [r.m for r in R.clean_model_text(df, "m").collect()]
    assert got == ["Oi   veja     fim", "", None]


def test_words_lengths_links(spark):
    texts = ["um dois três\n", "", None, "x http://a", "HTTPS://B", "http:/a"]
    assert apply(spark, R.word_count, texts) == [3, 0, 0, 2, 1, 1]
    assert apply(spark, R.text_length, texts) == [13, 0, 0, 10, 9, 7]
    assert apply(spark, R.has_url, texts) == [False, False, False, True, True, False]
    assert apply(spark, R.text_length, ["😀é"]) == [2]


def test_dump_text(spark):
    assert apply(spark, R.normalize_dump, ["a\r\nb\rc|d \n|\t|e"]) == ["a\nb\nc | d |  | e"]
    assert apply(spark, R.sanitize_field, [" a|b "]) == ["a / b"]
    noisy = "x  PASSE O CURSOR PARA REAGIR\t y\n\n\nOfner -  Perdizes (Proprietário) ok\nz "
    assert apply(spark, R.clean_dump_message, [noisy]) == ["x y\nz"]
    assert apply(spark, R.flatten_comment, [" a\nb "]) == ["a b"]


def test_own_noise(spark):
    fmt = P.DumpFormat(noise=(P.owner_reply("Café Sol"),))
    got = apply(spark, lambda c: R.clean_dump_message(c, fmt), ["bom café sol (proprietário) ok"])
    assert got == ["bom"]


def test_long_texts_do_not_blow_up(spark):
    words = "palavra " * 60_000
    texts = [words, "12 " * 100_000, "| " * 100_000, '"' * 100_000, "x" * 500_000, "1" * 2_000]
    for fn in (R.basic_clean, R.clean_message, R.normalize_dump, R.clean_dump_message,
               R.word_count, R.message_ratings, R.extract_rating_text):
        assert len(apply(spark, fn, texts)) == len(texts)
