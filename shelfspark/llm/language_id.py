"""Language identification: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes that overlap by the widest filter less one, so every
stretch a filter can see lies in a window; the last window is filled up with zeros. Filters of several ``WIDTHS`` run
over a batch of windows at once (a filter is a table of weights for each byte at each place), each is max-pooled over its
window, and a softmax turns the maxima into a probability of each language. A text's probabilities are the means over its
windows, weighted by their letters (ASCII letters and bytes of longer characters): the whole text counts, however long.

*Learning.* Only texts and languages of rows that are not held out are used (crc32 of the id as text, modulo ``FOLDS``,
is not 0): at most ``TRAIN_ROWS`` rows of each language, drawn by a hash of id and text, equal ones once, and of their
windows at most ``TRAIN_WINDOWS`` for each language, drawn by a hash from all parts of the texts. Filters and softmax
are learned together by Adam.

A text that is null or has no letter is ``und`` with score 0; so is every text where nothing can be learned (no language
given). Among equal probabilities the language first in order of code points wins. A null id is not held out. Repeated
rows are scored row by row; rows that repeat a text under several languages teach all of them. Columns of the input named
like a result are replaced; the others stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import slices

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 16
TRAIN_ROWS, TRAIN_WINDOWS = 1000, 1500
EPOCHS, BATCH, RATE = 4, 64, 0.02
FOLDS = 5
UNKNOWN = "und"
STEP = WINDOW - max(WIDTHS) + 1
_TOGETHER = 256
_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def windows(data: bytes) -> np.ndarray:
    """The windows of a text as rows; one for an empty text."""
    count = max(1, -(-(len(data) - max(WIDTHS) + 1) // STEP))
    room = np.zeros((count - 1) * STEP + WINDOW, np.uint8)
    room[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(room, WINDOW)[::STEP]


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Bytes of each window without the filling."""
    return WINDOW - (rows[:, ::-1] != 0).argmax(1)


class LanguageNetwork:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.weights = np.zeros((len(WIDTHS) * FILTERS, len(languages)), np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self._pairs: list[list[np.ndarray]] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_pairs": None}

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.weights + self.bias
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    @staticmethod
    def _blank(response: np.ndarray, lengths: np.ndarray, width: int) -> None:
        """Places whose bytes reach into the filling do not count, but for the first."""
        short = np.flatnonzero(lengths < WINDOW)
        if len(short):
            past = np.arange(response.shape[1])[None, :] > np.maximum(lengths[short] - width, 0)[:, None]
            response[short] = np.where(past[:, :, None], -np.inf, response[short])

    # --- learning

    def fit(self, rows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> LanguageNetwork:
        """``rows``: windows; ``labels``: positions in ``languages``."""
        parameters = [*self.tables, self.weights, self.bias]
        first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
        rng, step = np.random.default_rng(seed), 0
        shares = np.bincount(labels, minlength=len(self.languages))
        weight = (len(labels) / (len(self.languages) * np.maximum(shares, 1)))[labels].astype(np.float32)
        for epoch in range(epochs):
            for batch in np.array_split(rng.permutation(len(rows)), -(-len(rows) // BATCH)):
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for p, g, m, v in zip(parameters, self._slopes(rows[batch], labels[batch], weight[batch]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self

    def _slopes(self, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        lengths, tops, places = _lengths(rows), [], []
        for table, width in zip(self.tables, WIDTHS, strict=True):
            n = WINDOW - width + 1
            response = table[0][rows[:, :n]]
            for k in range(1, width):
                response += table[k][rows[:, k : n + k]]
            self._blank(response, lengths, width)
            at = response.argmax(1)
            tops.append(np.take_along_axis(response, at[:, None], 1)[:, 0])
            places.append(at)
        pooled = np.concatenate(tops, 1)
        slope = self._softmax(pooled)
        slope[np.arange(len(rows)), labels] -= 1
        slope *= (weight / len(rows))[:, None]
        down = slope @ self.weights.T
        out = []
        for i, (table, width) in enumerate(zip(self.tables, WIDTHS, strict=True)):
            g, at = np.zeros_like(table), places[i]
            mine = down[:, i * FILTERS : (i + 1) * FILTERS]
            line, column = np.arange(len(rows))[:, None], np.broadcast_to(np.arange(FILTERS), at.shape)
            for k in range(width):
                np.add.at(g[k], (rows[line, at + k], column), mine)
            out.append(g)
        return [*out, pooled.T @ slope, slope.sum(0)]

    # --- scoring: weights of two neighbouring bytes are looked up at once

    def _ready(self) -> list[list[np.ndarray]]:
        if self._pairs is None:
            self._pairs = [
                [
                    (t[k][:, None] + t[k + 1][None, :]).reshape(-1, FILTERS) if k + 1 < w else t[k]
                    for k in range(0, w, 2)
                ]
                for t, w in zip(self.tables, WIDTHS, strict=True)
            ]
        return self._pairs

    def window_probabilities(self, rows: np.ndarray) -> np.ndarray:
        two = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        lengths, tops = _lengths(rows), []
        for lookups, width in zip(self._ready(), WIDTHS, strict=True):
            n = WINDOW - width + 1
            response = None
            for k, lookup in enumerate(lookups):
                place = two if len(lookup) > 256 else rows
                part = lookup.take(place[:, 2 * k : 2 * k + n], axis=0)
                response = part if response is None else np.add(response, part, out=response)
            self._blank(response, lengths, width)
            tops.append(response.max(1))
        return self._softmax(np.concatenate(tops, 1)).astype(np.float64)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """A row of probabilities for each text; texts share batches of windows."""
        sums, weights = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def score() -> None:
            rows, owner = np.concatenate(held), np.concatenate(owners)
            for a in range(0, len(rows), _TOGETHER):
                part = rows[a : a + _TOGETHER]
                weight = _IS_LETTER[part].sum(1) + 1e-9
                np.add.at(sums, owner[a : a + _TOGETHER], self.window_probabilities(part) * weight[:, None])
                np.add.at(weights, owner[a : a + _TOGETHER], weight)
            held.clear()
            owners.clear()

        for k, text in enumerate(texts):
            cut = windows(text)
            for a in range(0, len(cut), 4 * _TOGETHER):  # a long text is not copied as a whole
                held.append(cut[a : a + 4 * _TOGETHER])
                owners.append(np.full(len(held[-1]), k))
                if sum(map(len, held)) >= _TOGETHER:
                    score()
        if held:
            score()
        return sums / weights[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [k for k, t in enumerate(texts) if self.languages and t and _LETTER.search(t)]
        if known:
            p = self.probabilities([texts[k].encode("utf-8", "surrogatepass") for k in known])
            for k, best, top in zip(known, p.argmax(1), p.max(1), strict=True):
                lang[k], score[k] = self.languages[best], min(float(top), 1.0)
        return lang, score


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    rows: int = TRAIN_ROWS, train_windows: int = TRAIN_WINDOWS,
) -> LanguageNetwork:
    """Learn from rows of ``docs`` that are not held out."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("h")
    )
    share = F.pmod("h", F.lit(1 << 30)) / (1 << 30)
    shares = known.groupBy("lang").agg(F.count("*").alias("n"))  # a row for each language
    # About twice the rows wanted of each language, and of those the first by hash
    some = known.join(F.broadcast(shares), "lang").where(share < F.lit(2.0 * rows) / F.col("n") + 1e-6)
    some = some.groupBy("lang", "h").agg(F.first("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    some = some.withColumn("k", F.row_number().over(first)).where(F.col("k") <= rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for name, h, body in zip(*(batch[c].to_pylist() for c in ("lang", "h", "text")), strict=True):
                parts = windows(body.encode("utf-8", "surrogatepass"))
                for a in range(0, len(parts), 4096):
                    some = parts[a : a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), pa.array([h] * len(some)), pa.array(np.arange(a, a + len(some))), pa.array([r.tobytes() for r in some], pa.binary())],
                        ["lang", "h", "number", "data"],
                    )

    pieces = some.select("lang", "h", "text").mapInArrow(cut, "lang string, h long, number long, data binary")
    drawn = Window.partitionBy("lang").orderBy(F.xxhash64("h", "number"), "h", "number")
    sample = (
        pieces.withColumn("k", F.row_number().over(drawn))
        .where(F.col("k") <= train_windows)
        .select("lang", "k", "data")
        .toPandas()
        .sort_values(["lang", "k"])
    )
    languages = sorted(set(sample["lang"]))
    network = LanguageNetwork(languages)
    if len(languages) < 2:
        return network
    place = {name: k for k, name in enumerate(languages)}
    data = np.frombuffer(b"".join(map(bytes, sample["data"])), np.uint8).reshape(len(sample), WINDOW)
    return network.fit(data, sample["lang"].map(place).to_numpy())


def identify_languages(docs: DataFrame, network: LanguageNetwork, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred string`` and ``score double``."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some 200 kB and a few bytes for each language

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": lang, "score": score})

    found = docs.withColumn("_found", identify(F.col(text)))
    return found.withColumn("lang_pred", F.col("_found.lang_pred")).withColumn("score", F.col("_found.score")).drop("_found")
