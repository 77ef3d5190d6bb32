"""Language of a text from averaged hashed subword embeddings and a linear softmax.

The letters of a text, in lower case, are cut into n-grams of 1 to 4 characters with
word ends; each is hashed to one of ``BUCKETS`` embeddings. Their mean goes through a
linear layer and a softmax. Both layers are learned by stochastic gradient descent in
numpy on the driver, from a bounded sample: at most ``PER_LANGUAGE`` documents of each
language, ``SAMPLE_ROWS`` in all, ``SAMPLE_CHARS`` characters of each. Since the layers
are linear, their product (a row of logits for each bucket) is all that predictions
need: a table of fixed size, sent to the workers once.

A part of the sample is kept out of training. On it a temperature is fitted, so that
scores are probabilities, and the rejection bound: the score that all but ``ALPHA`` of
the rightly predicted texts reach, but at most one half, so that a text goes only if
its best language is less likely than all others together.

Cases: null or a text without letter gives ``und`` with score 0, rejected. Whole texts
are read, in pieces of ``PIECE`` characters. Rows without language teach nothing; if
no row teaches, every text is ``und``. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from bookpipe.llm.common import release, ship, text_or_empty

BUCKETS = 1 << 15
DIM = 16
EPOCHS = 4
RATE = 0.5
PER_LANGUAGE = 400
SAMPLE_ROWS = 20_000
#: Portions of a language that are ranked each by itself before all of it is.
PORTIONS = 32
SAMPLE_CHARS = 2_000
ALPHA = 0.001
PIECE = 1 << 20
UNKNOWN = "und"
PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])
LETTERS = regex.compile(r"\p{L}+")


class Model(NamedTuple):
    languages: list[str]
    #: (BUCKETS, languages): embeddings times the linear layer.
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def buckets(letters: str) -> np.ndarray:
    """Bucket of each 1- to 4-gram of a string of lower-case words with spaces around them."""
    points = np.frombuffer(letters.encode("utf-32-le"), dtype="<u4")
    found, grams = [], np.full(len(points), 0x9E3779B1, dtype="<u4")
    for n in range(4):
        if len(points) <= n:
            break
        grams = (grams[: len(points) - n] ^ points[n:]) * np.uint32(0x01000193)
        mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        found.append(mixed >> np.uint32(17))
    return np.concatenate(found) if found else np.zeros(0, dtype="<u4")


def pieces(text: str) -> Iterator[np.ndarray]:
    """Buckets of a whole text, by pieces that overlap so that no gram is lost or counted twice but for single ones at seams."""
    for at in range(0, len(text), PIECE):
        words = LETTERS.findall(text[at : at + PIECE].lower())
        if words:
            yield buckets(" " + " ".join(words) + " ")


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def mean_logits(model: Model, text: str) -> np.ndarray | None:
    total, count = np.zeros(len(model.languages)), 0
    for found in pieces(text):
        total += model.logits.take(found, axis=0).sum(axis=0, dtype="float64")
        count += len(found)
    return total / count + model.bias if count else None


def predict_one(model: Model, text: str | None) -> tuple[str, float]:
    logits = mean_logits(model, text) if text and model.languages else None
    if logits is None:
        return UNKNOWN, 0.0
    scores = softmax(logits / model.temperature)
    best = int(scores.argmax())
    return model.languages[best], float(scores[best])


def sample(docs: DataFrame, teaches: Column) -> list:
    """The bounded training sample: rows (lang, text), in a fixed order."""
    rows = docs.where(teaches & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64("doc_id")
    # First within portions of a language, so that no task sorts what every scan task keeps of a frequent one.
    portion = F.pmod(F.spark_partition_id(), F.lit(PORTIONS)).alias("_portion")
    in_portion = Window.partitionBy("lang", "_portion").orderBy("_order", "doc_id")
    chosen = (
        rows.select("doc_id", "lang", order.alias("_order"), portion)
        .withColumn("_rank", F.row_number().over(in_portion))
        .where(F.col("_rank") <= PER_LANGUAGE)
        .withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_order", "doc_id")))
        .where(F.col("_rank") <= PER_LANGUAGE)
        .orderBy("_rank", "_order", "doc_id", "lang")
        .limit(SAMPLE_ROWS)
    )
    start = F.pmod(F.col("_order"), F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1))) + 1
    # At most SAMPLE_ROWS ids: a bound that does not grow with the corpus.
    texts = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    cut = texts.select("lang", "_order", F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
    return cut.orderBy("_order", "text", "lang").limit(SAMPLE_ROWS).collect()


def train(rows: list, seed: int = 7) -> Model:
    """Learn from (lang, text) rows; one in five is kept for calibration."""
    languages = sorted({row["lang"] for row in rows})
    n = len(languages)
    if not n:
        return Model([], np.zeros((1, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    place = {lang: i for i, lang in enumerate(languages)}
    taught, kept = [], []
    for i, row in enumerate(rows):
        text, y = row["text"], place[row["lang"]]
        if i % 5 == 4:
            kept.append((text, y))
            continue
        parts = [text]
        for length in (20, 100):
            at = int(rng.integers(0, max(1, len(text) - length)))
            parts.append(text[at : at + length])
        for part in parts:
            found = list(pieces(part))
            if found:
                ids, counts = np.unique(np.concatenate(found), return_counts=True)
                taught.append((ids, (counts / counts.sum()).astype("float32"), y))
    embed = (rng.random((BUCKETS, DIM), dtype="float32") - 0.5) / DIM
    linear, bias = np.zeros((DIM, n), dtype="float32"), np.zeros(n, dtype="float32")
    steps, step = max(1, EPOCHS * len(taught)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(taught)):
            ids, weights, y = taught[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = weights @ embed[ids]
            error = softmax(hidden @ linear + bias)
            error[y] -= 1
            back = linear @ error
            linear -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            embed[ids] -= (rate * len(ids) ** 0.5) * np.outer(weights, back)
    model = Model(languages, (embed @ linear).astype("float32"), bias.astype("float64"), 1.0, 0.0)
    return calibrate(model, kept)


def calibrate(model: Model, kept: list[tuple[str, int]]) -> Model:
    scored = [(logits, y) for text, y in kept if (logits := mean_logits(model, text)) is not None]
    if not scored:
        return model
    logits, right = np.array([x for x, _ in scored]), np.array([y for _, y in scored])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 120))
    loss = [-np.log(softmax(logits / t)[np.arange(len(right)), right] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    scores = softmax(logits / temperature)
    reached = np.sort(scores.max(axis=1)[scores.argmax(axis=1) == right])
    bound = float(reached[int(ALPHA * len(reached))]) if len(reached) else 0.0
    return model._replace(temperature=temperature, reject_below=min(bound, 0.5))


def fit(docs: DataFrame, teaches: Column | None = None) -> Model:
    """Train on the rows of ``docs`` (doc_id, text, lang) for which ``teaches`` holds."""
    model = train(sample(docs, F.lit(True) if teaches is None else F.coalesce(teaches, F.lit(False))))
    release()
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tuple(model))

    @F.pandas_udf(PREDICTION)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*sent.value)
        for texts in batches:
            yield pd.DataFrame([predict_one(known, t) for t in texts], columns=["lang_pred", "score"])
            release()

    with_it = docs.withColumn("_predicted", predicted(text_or_empty(text)))
    out = with_it.withColumn("lang_pred", F.col("_predicted.lang_pred")).withColumn("score", F.col("_predicted.score"))
    rejected = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.reject_below)
    return out.withColumn("rejected", rejected).drop("_predicted")


def held_out() -> Column:
    """Rows that teach nothing: crc32 of the id as text, modulo five, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def held_out_predictions(docs: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text", "lang"), ~held_out())
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, unchanged."""
    model = fit(docs.select("doc_id", "text", "lang"), ~held_out())
    # Whole rows go along as one column, so that columns of the same names as predictions stay as they are.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return predict(rows, model).where(~F.col("rejected")).select("_row.*")
