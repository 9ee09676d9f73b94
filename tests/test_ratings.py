import math

import pandas as pd
import pytest

from reviewlib import functions as R
from test_text import apply


def test_parse_rating(spark):
    cases = {
        "1.9/5": 1.9, "2,3/5": 2.3, "4/5": 4.0, "5,0": 5.0, "0": 0.0, "3.1": 3.1, "1": 1.0,
        None: None, "": None, "40": 2.0, "100,0": 5.0, "61": 61 / 20.0, "4321": 5.0,
        "5.5": 5.5 / 20, "10/10": 0.5, "-3": 3.0, "nota 4": 4.0, "n/d": None, "  2 ": 2.0,
    }
    assert apply(spark, R.parse_rating, cases) == list(cases.values())


def test_message_ratings(spark):
    cases = {
        "sala 2,5/5, quarto 1/5; vista 4/5": [2.5, 1.0, 4.0],
        "de 3.3/5 para 2/5": [3.3, 2.0],
        "nada aqui": [],
        "0/5 antes, 5/5 agora": [0.0, 5.0],
        "9/5 e 5,1/5": [],
        None: [],
        "": [],
        "3/50": [3.0],
        "2,1  / 5": [2.1],
    }
    assert apply(spark, R.message_ratings, cases) == list(cases.values())


def test_median(spark):
    texts = ["1/5 5/5 2/5", "1/5 2/5", "4/5", "nada", None]
    got = apply(spark, lambda c: R.rating_median(R.message_ratings(c)), texts)
    assert got == [2.0, 1.5, 4.0, None, None]


def test_labels(spark):
    cases = {"4.0": "positive", "5": "positive", "3.9999": "neutral", "2.0": "negative",
             "1.5": "negative", "2.0001": "neutral", "3": "neutral", None: None}
    got = apply(spark, lambda c: R.rating_label(c.cast("double")), cases)
    assert got == list(cases.values())


def test_rating_text(spark):
    cases = {
        "Comida: 4,5/5 Ambiente: 4/5": "4.2/5",  # 4.25 rounds to even, as %.1f does
        "7/5": "7.0/5",
        "3/50 4/5x": "",
        "3/5é": "",
        "x 3 / 5.": "3.0/5",
        "1/5 2/5 2/5": "1.7/5",
        "": "",
        "12345/5": "12345.0/5",
    }
    assert apply(spark, R.extract_rating_text, cases) == list(cases.values())


@pytest.mark.parametrize("mean", [0.05, 0.15, 0.25, 0.35, 2.45, 4.25, 4.35, 4.45, 3.95])
def test_rating_text_rounds_binary_values(spark, mean):
    assert apply(spark, R.extract_rating_text, [f"{mean}/5"]) == [f"{mean:.1f}/5"]


def test_coerce_rating_is_to_numeric(spark):
    cells = ["4.7/5", " 3 ", "inf", "Infinity", "-inf", "0x1A", "1e3", "4.7d", "+5", "1_000", "NaN",
             "", "  ", "5.", "  .5", ".", "1e", "1,5", "true", "87", "2.0f", "1e-2", "-0.5"]
    want = pd.to_numeric(pd.Series(cells, dtype=object), errors="coerce")
    got = apply(spark, R.coerce_rating, cells)
    for cell, g, w in zip(cells, got, want):
        assert (g is None and math.isnan(w)) or g == w, cell


def test_photos(spark):
    cases = {"": "0", None: "0", " 10 ": "10", "2.0": "2", "3.00": "3", "abc": "0", "-1": "0",
             "1.5": "0", "007": "007", "1\n": "1"}
    assert apply(spark, R.normalize_photos, cases) == list(cases.values())
