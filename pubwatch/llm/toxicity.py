"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text; the other on toxic text, of which it is
shown the words whose stems recur there and hardly in ordinary texts, once for each place where they
stand (whole windows of toxic text are ordinary for the most part, and a dictionary of them tells the
classes apart less well). The toxic side compresses with both, the ordinary side with its own alone, so a
window gets shorter on the toxic side only by what it shares with toxic text. Ordinary windows that gain
nonetheless join the ordinary dictionary. The gains of a text's windows are summed up in nine numbers, and
a logistic fit on them calibrates the threshold, made on texts that the dictionaries have not seen.

Only the fit uses labels, on a bounded sample; every text is scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise

STEPS = (2, 3, 4, 5)
STEMS = (4, 5, 6, 7, 8, 10, 12)


@dataclass(frozen=True)
class FitParams:
    """Bounds of the sample: texts per class, windows per text; sizes in bytes and words.

    A stem tells toxic text apart if ``least`` sampled toxic texts have it, and ``contrast`` times as
    large a share of them as of ordinary ones.
    """

    toxic_texts: int = 2000
    ordinary_texts: int = 6000
    windows_per_text: int = 64
    window: int = 24
    dictionary: int = 131_072
    toxic_dictionary: int = 32_768
    least: int = 6
    contrast: float = 8.0
    folds: int = 5
    ridge: float = 0.1


def windows(text: str, size: int) -> list[bytes]:
    """Runs of ``size`` words, lower-cased, one space apart; the last may be shorter."""
    words = text.lower().split()
    return [f" {' '.join(words[i : i + size])} ".encode() for i in range(0, len(words), size)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Tables that hold every position of the dictionary; frames without anything of fixed size."""
    params = zstandard.ZstdCompressionParameters(
        window_log=20,
        chain_log=21,
        hash_log=17,
        search_log=7,
        min_match=4,
        target_length=64,
        strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary)


def _trained(size: int, samples: list[bytes]) -> bytes:
    """Content of a trained dictionary; samples too few to train one are it themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))


@dataclass
class Model:
    """Dictionaries and calibration; without both classes in the sample, the score is constant."""

    window: int
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    shift: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    constant: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def gains(self, pieces: list[bytes]) -> np.ndarray:
        """Bytes that each window saves on the toxic side."""
        if "_sides" not in self.__dict__:
            self._sides = _compressor(self.ordinary).compress, _compressor(self.toxic + self.ordinary).compress
        plain, both = self._sides
        return np.array([len(plain(p)) - len(both(p)) for p in pieces], dtype=float)

    def features(self, text: str) -> list[float]:
        gains = self.gains(windows(text, self.window))
        if not len(gains):
            gains = np.zeros(1)
        counts = [float((gains >= s).sum()) for s in STEPS]
        shares = [counts[1] / len(gains), counts[2] / len(gains)]
        top = float(np.sort(gains)[-3:].mean())
        return [float(gains.mean()), float(gains.max()), top, *np.log1p(counts).tolist(), *shares]

    def probability(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.constant)
        scaled = (features - np.array(self.shift)) / np.array(self.scale)
        z = scaled @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: Column) -> Column:
        """Column of scores, 0 to 1; a NULL text counts as empty, an empty one is scored like any."""
        model = self

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                rows = [model.features(t) if model.weights else [] for t in texts]
                yield pd.Series(model.probability(np.array(rows)), dtype=float)

        return scored(F.coalesce(text, F.lit("")))


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a NULL id is held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _stems(words: set[bytes]) -> set[bytes]:
    """How words start, in several lengths, and whole."""
    return {w[:n] for w in words for n in STEMS if n <= len(w)} | words


def _telling(toxic: list[set[bytes]], plain: list[set[bytes]], params: FitParams) -> set[bytes]:
    """Stems that recur in toxic texts and hardly in ordinary ones; arguments are the words per text."""
    support = Counter(s for words in toxic for s in _stems(words))
    support = {s: n for s, n in support.items() if n >= params.least and len(s) >= STEMS[0]}
    other = Counter(s for words in plain for s in _stems(words) if s in support)
    return {
        s for s, n in support.items()
        if n / len(toxic) >= params.contrast * (other[s] + 0.5) / (len(plain) + 1)
    }


def _dictionaries(texts: list[tuple[int, list[bytes]]], params: FitParams) -> Model:
    """Train a dictionary on ordinary text and one on what sets toxic text apart from it."""
    words = [(label, [w for p in pieces for w in p.split()]) for label, pieces in texts]
    toxic = [set(ws) for label, ws in words if label]
    plain = [set(ws) for label, ws in words if not label]
    telling = _telling(toxic, plain, params)
    shown = {w for ws in toxic for w in ws if not telling.isdisjoint(_stems({w}))}
    ordinary = [w + b" " for label, ws in words if not label for w in dict.fromkeys(ws)]
    marked = [b" " + w + b" " for label, ws in words if label for w in ws if w in shown]
    model = Model(
        params.window, _trained(params.dictionary, ordinary), _trained(params.toxic_dictionary, marked) + b" "
    )
    pieces = [p for label, ps in texts if not label for p in ps]
    for part in (pieces[::2], pieces[1::2]):
        hard = [p for p, gain in zip(part, model.gains(part), strict=True) if gain >= STEPS[0]]
        model = Model(params.window, b"".join(dict.fromkeys(hard)) + model.ordinary, model.toxic)
    return model


def _calibrated(model: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> Model:
    model.shift, model.scale = x.mean(0).tolist(), (x.std(0) + 1e-9).tolist()
    z = np.column_stack([(x - model.shift) / model.scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - ridge * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    model.weights = w.tolist()
    return model


def fit(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams()) -> Model:
    """Learn from the texts with a label that are not held out.

    At most ``toxic_texts`` and ``ordinary_texts`` of them are looked at, chosen by a hash of their
    id; two thirds train the dictionaries (``windows_per_text`` evenly spaced windows each), one
    third calibrates on whole texts. Labels that are NULL or contradict each other, and labels of
    no or repeated documents' other texts, carry no weight beyond the rows that they join.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), params.folds))
        .groupBy("doc_id")
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("other"))
        .where("toxic = other")
        .drop("other")
    )
    known = materialise(known, "toxic-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [
        known.where(F.col("toxic") == label).orderBy(*order).limit(most)
        for label, most in ((1, params.toxic_texts), (0, params.ordinary_texts))
    ]
    # at most toxic_texts + ordinary_texts ids
    picked = materialise(chosen[0].unionByName(chosen[1]), "toxic-picked")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    sample = docs.select("doc_id", text).join(F.broadcast(picked), "doc_id")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    sample = materialise(sample.withColumn("calibrates", third), "toxic-sample")

    @F.pandas_udf("array<binary>")
    def some_windows(texts: pd.Series) -> pd.Series:
        def spaced(t: str) -> list[bytes]:
            pieces = windows(t, params.window)
            if len(pieces) > params.windows_per_text:
                at = np.linspace(0, len(pieces) - 1, params.windows_per_text).astype(int)
                pieces = [pieces[i] for i in at]
            return pieces

        return texts.map(spaced)

    rows = sample.where("not calibrates").select("doc_id", "toxic", some_windows("text").alias("pieces"))
    rows = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["pieces"]))
    distinct = {(r["toxic"], tuple(map(bytes, r["pieces"]))) for r in rows}
    texts = [(label, list(pieces)) for label, pieces in sorted(distinct)]
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len({label for label, _ in texts}) < 2:
        return Model(params.window, constant=min(share, 0.49) if counts.get(0) else share)
    model = _dictionaries(texts, params)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(model.features)

    checked = sample.select("doc_id", "toxic", "calibrates", measured("text").alias("x")).collect()
    checked = sorted(checked, key=lambda r: (r["doc_id"], r["x"]))  # sums in one order at every run
    unseen = [r for r in checked if r["calibrates"]]
    if len({r["toxic"] for r in unseen}) == 2:
        checked = unseen
    y = np.array([r["toxic"] for r in checked], dtype=float)
    x = np.array([r["x"] for r in checked])
    # the sample favours toxic texts; weights restore their share among the labels
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return _calibrated(model, x, y, weight, params.ridge)


def score_documents(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams()) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on), per row of ``docs``.

    * A NULL text counts as empty; empty texts get the score of a text without any gain.
    * A very long text is scored whole, window by window.
    * A NULL id is held out. Rows are scored one by one, so repeated rows get equal scores.
    * Without labels of both classes the score is their share, and below 0.5 if any is ordinary.
    * An empty table gives an empty result; other columns are neither read nor returned.
    """
    score = fit(docs, labels, params).score(F.col("text"))
    scored = docs.select("doc_id", held_out(F.col("doc_id"), params.folds).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams()) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, with all their columns."""
    score = fit(docs, labels, params).score(F.col("text"))
    return docs.where(score < 0.5)
