"""Toxicity by compression distance.

Two zstandard dictionaries share one base trained on ordinary text. The toxic one also
ends in a part trained on toxic text: the words of toxic training documents that hold a byte
5-gram (word borders included) found in a far greater share of a toxic document's distinct
words than of an ordinary one's. The share counts words, not documents, so a root that ordinary
text also has now and then, or that only one language has, still shows; a repeated line counts once a
document. Every window (a word, long words in overlapping cuts) is compressed with both, and
the difference of the two lengths is its distance. A fixed preamble, which both dictionaries hold, stands on both
sides of a window: zstandard stores very short inputs raw and does not search an input's
last bytes, and with the preamble the lengths differ by the window alone.

A document's features are its greatest distances and the numbers of windows beyond
thresholds; a logistic calibration, cross-fitted on training documents, turns them into a
score.

Training reads a bounded sample of labelled rows: per class at most ``SAMPLE`` documents
(those of least id hash) of at most ``SAMPLE_CHARS`` characters. Scoring reads every whole
text, one pass without a shuffle.

Cases: null or empty texts have no window and get the score of no evidence; rows that repeat
a doc_id are scored each for itself; labels that are null or not 0/1 are ignored; without
training rows of both classes every score is 0; an empty table gives an empty result; other
columns are carried in one struct.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as Z
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, fold, sole_cache, text_of, text_rows, texts

SAMPLE = 3000
SAMPLE_CHARS = 20_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
GRAM = 5
#: A gram is hot if its share of the words of toxic documents is so many times that of ordinary ones; which of
#: these ratios is used is chosen by cross-fitting inside the training rows.
HOT = (2, 4, 8, 16)
ORDINARY_BYTES, TOXIC_BYTES = 32768, 4096
_PAD = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ#%&=+<>[]{}~^_|`@!0123456789"
_WINDOW, _STEP = 48, 36
_CACHE_MAX = 400_000
_LIMITS = (3, 4, 6)
PARAMETERS = Z.ZstdCompressionParameters(
    format=Z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, strategy=Z.STRATEGY_LAZY,
    min_match=5, window_log=17, hash_log=16, chain_log=16, search_log=6, target_length=64)


def windows(text: str) -> list[bytes]:
    out = []
    for w in text.encode().lower().split():
        if len(w) <= _WINDOW:
            out.append(w)
        else:
            out.extend(w[i:i + _WINDOW] for i in range(0, len(w) - _WINDOW + _STEP, _STEP))
    return out


class Distance:
    """Window distances: length with the ordinary dictionary minus length with the toxic one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self._size = [Z.ZstdCompressor(dict_data=Z.ZstdCompressionDict(raw + _PAD, dict_type=Z.DICT_TYPE_RAWCONTENT),
                                       compression_params=PARAMETERS).compress for raw in (ordinary, ordinary + toxic)]
        self._cache: dict[bytes, int] = {}

    def of(self, window: bytes) -> int:
        data = _PAD + b" " + window + b" " + _PAD
        return len(self._size[0](data)) - len(self._size[1](data))

    def features(self, text: str) -> list[float]:
        ws, cache = windows(text), self._cache
        if len(cache) > _CACHE_MAX:
            cache.clear()
        for w in set(ws).difference(cache):
            cache[w] = self.of(w)
        d = np.fromiter(map(cache.__getitem__, ws), np.int16, len(ws))
        top = np.sort(np.partition(d, len(d) - 3)[-3:]) if len(d) > 3 else np.sort(np.concatenate([np.zeros(3, np.int16), d]))[-3:]
        return [*top.astype(float), *(np.log1p((d >= n).sum()) for n in _LIMITS), np.log1p(len(d))]


def _content(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary trained on the samples; too few to train on: the samples themselves."""
    try:
        return Z.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except Z.ZstdError:
        return b"".join(samples)[-size:]


def _grams(word: bytes) -> set[bytes]:
    """The grams of a word with its borders."""
    w = b" " + word + b" "
    return {w[i:i + GRAM] for i in range(len(w) - GRAM + 1)}


def _count(texts: list[str]) -> tuple[Counter, Counter, int]:
    """For each gram the words (distinct in their document) and the documents that hold it, and the number of words."""
    in_words, in_docs, n = Counter(), Counter(), 0
    for t in texts:
        words = set(t.encode().lower().split())
        found = Counter(g for w in words for g in _grams(w))
        in_words.update(found)
        in_docs.update(found.keys())
        n += len(words)
    return in_words, in_docs, n


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first weight is the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionaries(positive: list[str], negative: list[str], seed: int, ratio: float) -> tuple[bytes, bytes]:
    """The ordinary base and the toxic part, trained on ordinary text and on the toxic texts' words with hot grams."""
    (in_tox, in_docs, n_tox), (in_plain, _, n_plain) = _count(positive), _count(negative)
    least = max(3, 0.005 * len(positive))
    hot = {g for g, c in in_tox.items() if in_docs[g] >= least and c * n_plain >= ratio * (in_plain[g] + 1) * n_tox}
    words = [b" " + w + b" " for t in positive for w in windows(t) if not hot.isdisjoint(_grams(w))]
    runs = [b" ".join(ws[i:i + 12]) for t in negative for ws in [t.encode().lower().split()] for i in range(0, len(ws), 12)]
    rng = random.Random(seed)
    rng.shuffle(words)
    rng.shuffle(runs)
    return (_content(runs[:100_000], ORDINARY_BYTES, 64),
            _content([b"".join(words[i:i + 4]) for i in range(0, min(len(words), 200_000), 4)], TOXIC_BYTES, 24))


def fit(samples: list[str], toxic: list[int], seed: int = 7, parts: int = 3) -> Model | None:
    """Dictionaries and calibration from labelled texts; None without both classes.

    The calibration sees every text only through dictionaries trained on the other parts, and the ratio
    of hot grams with the least log loss of such a calibration is taken."""
    label: dict[str, int] = {}
    for t, y in zip(samples, toxic):  # copies count once, as toxic if one of them is
        label[t] = max(y, label.get(t, 0))
    pairs = sorted(label.items())
    random.Random(seed).shuffle(pairs)
    positive, negative = [t for t, y in pairs if y], [t for t, y in pairs if not y]
    if not positive or not negative:
        return None
    best = None
    for ratio in HOT:
        x, y = [], []
        for part in range(parts):
            rest = [[t for i, t in enumerate(ts) if i % parts != part] or ts for ts in (positive, negative)]
            distance = Distance(*_dictionaries(*rest, seed, ratio))
            for label, ts in ((1.0, positive), (0.0, negative)):
                x += [distance.features(t) for t in ts[part::parts]]
                y += [label] * len(ts[part::parts])
        x, y = np.array(x), np.array(y)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        weights = _logistic((x - mean) / scale, y)
        p = np.clip(1 / (1 + np.exp(-((x - mean) / scale @ weights[1:] + weights[0]))), 1e-9, 1 - 1e-9)
        loss = -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
        if best is None or loss < best[0]:
            best = (loss, ratio, mean, scale, weights)
    _, ratio, mean, scale, weights = best
    return Model(*_dictionaries(positive, negative, seed, ratio), mean, scale, weights)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on labelled rows outside the held-out fold: at most ``sample`` a class, of at most ``sample_chars`` characters."""
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
             .filter(fold("id", FOLDS) != HELD_OUT).groupBy("id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("id"), "id"]
    picked = known.filter("y = 1").orderBy(*order).limit(sample).unionByName(known.filter("y = 0").orderBy(*order).limit(sample))
    rows = (docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
            .join(F.broadcast(picked), "id")  # at most 2 * sample ids
            .filter(F.length("text") <= sample_chars).select("text", "y").collect())
    return fit([r["text"] for r in rows], [r["y"] for r in rows])


_LOADED: dict[bytes, Distance] = {}


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``id, score`` (0 to 1) per row, and ``row`` with ``carry``."""
    source, place = text_rows(docs, id_col, text_col, carry)
    kept = [c for c in source.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("toxicity", _LOADED.clear)
        if model is not None and model.ordinary + model.toxic not in _LOADED:
            _LOADED.clear()
            _LOADED[model.ordinary + model.toxic] = Distance(model.ordinary, model.toxic)
        for b in batches:
            if model is None or not b.num_rows:
                p = np.zeros(b.num_rows)
            else:
                distance = _LOADED[model.ordinary + model.toxic]
                p = model.probability(np.array([distance.features(t) for t in texts(b, place)]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(p)], [*kept, "score"])

    return source.mapInArrow(run, source.drop("text").withColumn("score", F.lit(0.0)).schema)


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns without those that score ``THRESHOLD`` or more, by a model trained on ``labelled``."""
    model = train(labelled, labels, id_col, text_col)
    return score(docs, model, id_col, text_col, carry=True).filter(F.col("score") < THRESHOLD).select("row.*")
