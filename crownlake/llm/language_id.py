"""Language identification by a small convolutional network over bytes.

Filters of widths two, three and four run over the one-hot bytes of
fixed-length windows; their largest values over a window go through a softmax
layer. Windows overlap by three bytes, so every byte sequence of a text is in
a window, and a text's language is that of the mean of its windows' class
probabilities, weighted by their bytes. Training is plain numpy on the driver, on at most ``train_rows``
labelled texts spread evenly over the languages by a hash of the id; a text
gives a few windows at hashed places of a stretch of at most ``SAMPLE_CHARS``
code points. The trained tables are a few megabytes at
most, whatever the corpus, and go to the tasks with the function.

For inference the filters' weights are summed beforehand per pair of bytes, so
one look-up stands for two positions of all filters.

Defined cases: a null text, and one without a letter, is ``und`` with score 0.
If there is no labelled training row, every text is ``und`` with score 0;
``recognised`` then lets all texts with a letter pass. Rows
with a null ``doc_id`` are not trained on. Repeated rows get the same answer.
An empty table gives an empty result. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import prepare, texts, utf8_bytes

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
STRIDE = WINDOW - max(WIDTHS) + 1
TRAIN_ROWS = 2400
WINDOWS_PER_ROW = 2
CHUNK = 64  # windows at a time: their activations stay within the cache
PAD = 0
UNDETERMINED = "und"
CONFIDENCE = 0.3  # the filter drops a text whose best language stays below this
SAMPLE_CHARS = 4096  # code points of a training row, from a hashed place on


def crc_text(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


@dataclass
class Model:
    """``filters``: of each width, its weights as (position, byte, filter)."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Summed weights per pair of bytes: of the first two positions (all widths), and of the next two (widths over two)."""
        w2, w3, w4 = self.filters
        first = np.concatenate([w[0][:, None, :] + w[1][None, :, :] for w in (w2, w3, w4)], axis=2)
        none = np.zeros((1, 256, FILTERS), np.float32)
        second = np.concatenate([w3[2][:, None, :] + none, w4[2][:, None, :] + w4[3][None, :, :]], axis=2)
        return first.reshape(65536, -1).astype(np.float32), second.reshape(65536, -1).astype(np.float32)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window in ``data``, its bytes (at most WINDOW), and the text that it belongs to."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))
    of = np.repeat(np.arange(len(sizes)), counts)
    rank = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[of] + rank * STRIDE, np.minimum(WINDOW, sizes[of] - rank * STRIDE), of


def window_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Windows as rows, short ones padded."""
    padded = np.concatenate([data, np.full(WINDOW, PAD, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]
    return np.where(np.arange(WINDOW) < lengths[:, None], rows, PAD) if (lengths < WINDOW).any() else rows


def pooled(rows: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Largest value of each filter over each window (before bias), from the tables of ``Model.pairs``."""
    codes = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
    a = first[codes[:, :STRIDE]]
    a[:, :, FILTERS:] += second[codes[:, 2 : STRIDE + 2]]
    return a.max(axis=1)


def strongest(rows: np.ndarray, filters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """As ``pooled``, from the filters themselves, with the place of each largest value."""
    a = np.concatenate([sum(w[j][rows[:, j : j + STRIDE]] for j in range(len(w))) for w in filters], axis=2)
    where = a.argmax(axis=1)
    return np.take_along_axis(a, where[:, None, :], axis=1)[:, 0], where


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 8, rate: float = 0.01, seed: int = 3) -> Model:
    """Fit the network to windows with Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    k, units = len(languages), FILTERS * len(WIDTHS)
    filters = [rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    model = Model(languages, filters, np.zeros(units, np.float32), rng.normal(0, 0.1, (units, k)).astype(np.float32), np.zeros(k, np.float32))
    params = [*model.filters, model.bias, model.dense, model.dense_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // CHUNK)):
            x, y = rows[at], labels[at]
            top, where = strongest(x, model.filters)
            hidden = np.maximum(top + model.bias, 0)
            delta = softmax(hidden @ model.dense + model.dense_bias)
            delta[np.arange(len(y)), y] -= 1
            delta /= len(y)
            back = (delta @ model.dense.T) * (hidden > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                grad = np.zeros((w, 256, FILTERS), np.float32)
                for j in range(w):
                    seen = np.take_along_axis(x, where[:, part] + j, axis=1)
                    np.add.at(grad[j], (seen, np.arange(FILTERS)[None, :]), back[:, part])
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def sample(docs: DataFrame, train_rows: int) -> pd.DataFrame:
    """At most ``train_rows`` labelled texts, as evenly over the languages as they come."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return pd.DataFrame({"doc_id": [], "lang": [], "text": []})
    quota = -(-train_rows // len(counts))
    share = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A little over the quota of each language passes; the limit then cuts in hash order.
    bar = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        bar = F.when(F.col("lang") == lang, F.lit(min(1.0, 1.1 * quota / n))).otherwise(bar)
    spare = F.greatest(F.length("text") - F.lit(SAMPLE_CHARS), F.lit(0)) + 1
    stretch = F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id", F.lit("stretch")), spare) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    return labelled.where(share < bar).select("doc_id", "lang", stretch.alias("text")).orderBy(share / bar, "doc_id").limit(train_rows).toPandas()


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Train on the labelled rows of ``docs`` (doc_id, text, lang); None if there are none."""
    rows = sample(docs, train_rows).sort_values(["doc_id", "text"])
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    data, offsets = utf8_bytes(pa.array(rows["text"].tolist(), pa.string()))
    starts, lengths, of = cut_windows(data, offsets)
    rng = np.random.default_rng(11)
    order = rng.permutation(len(of))
    rank = pd.Series(of[order]).groupby(of[order]).cumcount().to_numpy()
    keep = np.sort(order[rank < WINDOWS_PER_ROW])
    labels = rows["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()
    return train(window_bytes(data, starts[keep], lengths[keep]), labels[of[keep]], languages)


def probabilities(model: Model, tables: tuple[np.ndarray, np.ndarray], batch: pa.Array) -> np.ndarray:
    """Class probabilities of each text of a string array without nulls."""
    data, offsets = utf8_bytes(batch)
    starts, lengths, of = cut_windows(data, offsets)
    out = np.zeros((len(batch), len(model.languages)))
    padded = np.concatenate([data, np.full(WINDOW, PAD, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)
    position = np.arange(WINDOW)
    for at in range(0, len(starts), CHUNK):
        part = slice(at, at + CHUNK)
        rows = np.where(position < lengths[part, None], views[starts[part]], PAD)
        hidden = np.maximum(pooled(rows, *tables) + model.bias, 0)
        np.add.at(out, of[part], softmax(hidden @ model.dense + model.dense_bias) * np.maximum(lengths[part, None], 1))
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-12)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with two more columns, ``lang_pred`` and ``score``; only ``text`` is read."""
    prepare(docs.sparkSession)
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang string, score double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        tables = own.pairs()
        for batch in batches:
            p = probabilities(own, tables, batch.fill_null(""))
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            names = pa.array([own.languages[i] for i in best], pa.string())
            yield pa.StructArray.from_arrays([names, pa.array(p[np.arange(len(best)), best], pa.float64())], ["lang", "score"])

    # Called non-deterministic, so that a filter on the result and the result itself share one evaluation.
    lettered, once = has_letter(F.col("text")), predict.asNondeterministic()
    found = docs.withColumn("__found", once(F.coalesce(F.col("text"), F.lit(""))))
    return found.withColumns(
        {
            "lang_pred": F.when(lettered, F.col("__found.lang")).otherwise(F.lit(UNDETERMINED)),
            "score": F.when(lettered, F.col("__found.score")).otherwise(F.lit(0.0)),
        }
    ).drop("__found")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_text(doc_id) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; rows whose id's crc32 leaves 2 by 4 are not trained on."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(plain.where(~held_out(F.col("doc_id"))), train_rows)
    found = identify(texts(docs), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, train_rows: int = TRAIN_ROWS, confidence: float = CONFIDENCE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns; a null ``lang`` is filled with the prediction.

    Null, empty and letterless texts go, and those of which no language reaches ``confidence``. Without a single
    labelled row there is no model: then texts with letters stay as they are.
    """
    report_columns = docs.columns
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(plain.where(~held_out(F.col("doc_id"))), train_rows)
    if model is None:
        return docs.where(has_letter(F.col("text")))
    found = identify(docs.select(*[F.col(c).alias(f"__{c}") for c in report_columns], F.col("text")), model)
    lang = F.coalesce(F.col("__lang"), F.col("lang_pred"))
    return found.where(has_letter(F.col("text")) & (F.col("score") >= confidence)).select(
        *[(lang if c == "lang" else F.col(f"__{c}")).alias(c) for c in report_columns]
    )
