"""The sentiment classifier: TF-IDF of words into multinomial logistic regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.patterns import LABELS, PUNCTUATION
from reviewlib.functions.text import clean_model_text
from reviewlib.operators.split import class_weights, decode_label, encode_label

_TEXT = "_text"


@dataclass(frozen=True)
class TrainConfig:
    """Training settings."""

    text_col: str = "message"
    label_col: str = "label"
    id_col: str = "review_id"
    seed: int = 42
    num_words: int = 20_000
    val_size: float = 0.15
    test_size: float = 0.15
    class_weight: bool = True
    max_iter: int = 20
    reg_param: float = 0.01
    tol: float = 1e-5


def _tokens_sql() -> str:
    """The rule of ``vocabulary.tokens`` as SQL text, which is what a saved model keeps."""
    punctuation = PUNCTUATION.replace("'", r"\x27")
    lower = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bare = f"regexp_replace({lower}, r'{punctuation}', '')"
    return f"filter(split({bare}, r'[\\t-\\r ]+'), t -> t != '')"


def word_cutter() -> SQLTransformer:
    """The stage from ``_text`` to ``_tokens``."""
    return SQLTransformer(statement=f"SELECT *, {_tokens_sql()} AS _tokens FROM __THIS__")


def classifier_stages(cfg: TrainConfig = TrainConfig()) -> Pipeline:
    """Untrained stages over ``_tokens``, ``label_id`` and ``weight``. The vocabulary holds at
    most ``num_words - 2`` words, which bounds the model and what the driver sees of it."""
    return Pipeline(
        stages=[
            CountVectorizer(
                inputCol="_tokens", outputCol="_counts", vocabSize=cfg.num_words - 2
            ),
            IDF(inputCol="_counts", outputCol="features"),
            LogisticRegression(
                family="multinomial",
                labelCol="label_id",
                weightCol="weight",
                maxIter=cfg.max_iter,
                regParam=cfg.reg_param,
                tol=cfg.tol,
            ),
        ]
    )


def train_classifier(
    train: DataFrame,
    cfg: TrainConfig = TrainConfig(),
    cleaned: bool = False,
    scratch: str | None = None,
) -> PipelineModel:
    """Fit on labelled rows. ``cleaned`` says that the text column is already model text. Several
    passes run over the words; with ``scratch``, a folder that does not exist yet, texts are cut once
    and their words kept there meanwhile."""
    rows = train.select(
        F.col(cfg.text_col).alias(_TEXT), encode_label(cfg.label_col).alias("label_id")
    )
    if not cleaned:
        rows = clean_model_text(rows, _TEXT)
    rows = rows.filter(F.col(_TEXT).isNotNull() & F.col("label_id").isNotNull())
    if cfg.class_weight:
        # one row per label
        weights = class_weights(train, cfg.label_col).select("label_id", "weight")
        rows = rows.join(F.broadcast(weights), "label_id")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    rows = rows.withColumn("label_id", F.col("label_id").cast("double"))
    cut = word_cutter()
    words = cut.transform(rows).drop(_TEXT)
    if scratch:
        words.write.parquet(scratch)
        words = train.sparkSession.read.schema(words.schema).parquet(scratch)
    fitted = classifier_stages(cfg).fit(words)
    return PipelineModel([cut, *fitted.stages])


def predict_proba(
    model: PipelineModel | None, df: DataFrame, text: str = "message", cleaned: bool = False
) -> DataFrame:
    """``df`` plus ``p``, the class probabilities in label order."""
    if model is None:
        raise ValueError("no model: train or load one first")
    rows = df.withColumn(_TEXT, F.coalesce(F.col(text), F.lit("")))
    scored = model.transform(rows if cleaned else clean_model_text(rows, _TEXT))
    return scored.select(*df.columns, vector_to_array("probability").alias("p"))


def most_likely(p: Column | str, labels: Sequence[str] = LABELS) -> Column:
    """Label of the largest probability, the lowest id among equals."""
    c = F.col(p) if isinstance(p, str) else p
    return decode_label(F.array_position(c, F.array_max(c)) - 1, labels)


def predict_labels(
    model: PipelineModel | None, df: DataFrame, text: str = "message", cleaned: bool = False
) -> DataFrame:
    """``df`` plus ``p`` and ``pred``."""
    return predict_proba(model, df, text, cleaned).withColumn("pred", most_likely("p"))
