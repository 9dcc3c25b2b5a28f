"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text: ordinary content, and the
same content followed by text that marks toxic documents. A window is compressed
with both; the bytes the second dictionary saves over the first are its gain. A
document's gains, held against thresholds, give a few features, and a logistic
calibration on other labelled documents turns them into a score.

A window is one blank-delimited word followed by a fixed carrier that both
dictionaries hold: a few bytes alone are below what zstandard compresses at all, and
neighbouring words would add their own chance differences of the two dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_RANGE, class_sample, cut, quota, spread

SEED = 5  # of the sample's hash
CARRIER = b"|#0q7Zk2~Vx9^Jw4=Lm8;Rt6?Bn3!Hd5"
GAINS = (2, 3, 4, 5, 6)  # thresholds whose exceedances are counted
MEMO = 150_000


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split() if text else []


class Gains:
    """Gains of windows under a pair of dictionaries, with a bounded memo."""

    def __init__(self, ordinary: bytes, toxic: bytes, level: int):
        def compressor(content):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            return zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                            write_content_size=False, write_dict_id=False).compress
        self._plain, self._marked = compressor(ordinary + CARRIER), compressor(ordinary + toxic + CARRIER)
        self._memo: dict[bytes, int] = {}

    def __call__(self, word: bytes) -> int:
        got = self._memo.get(word)
        if got is None:
            window = b" " + word + b" " + CARRIER
            got = len(self._plain(window)) - len(self._marked(window))
            if len(word) <= 64:
                if len(self._memo) >= MEMO:
                    self._memo.clear()
                self._memo[word] = got
        return got

    def features(self, text: str | None) -> list[float]:
        words = words_of(text)
        if not words:
            return [0.0] * (len(GAINS) + 3)
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        gain = np.array([self(w) for w in counts])
        times = np.array(list(counts.values()))
        top = np.sort(gain)[::-1][:3].clip(0)
        rate = [np.sqrt(times[gain >= g].sum() / len(words)) * 10 for g in GAINS]
        return [float(top[0]), float(top.sum() / 3), *map(float, rate), float(np.log1p(len(words)))]


@dataclass
class ToxicityModel:
    """Dictionaries, feature scales and calibrated weights; bounded in size."""
    ordinary: bytes
    toxic: bytes
    level: int
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant

    def score(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word, toxic, ordinary``: in how many documents of each label a word occurs."""
    def run(batches):
        seen: dict[bytes, list[int]] = {}

        def flush():
            yield pd.DataFrame({"word": list(seen), "toxic": [v[1] for v in seen.values()],
                                "ordinary": [v[0] for v in seen.values()]})
            seen.clear()

        for batch in batches:
            for t, label in zip(batch["text"], batch["label"]):
                for w in set(words_of(t)):
                    if len(w) <= 64:
                        seen.setdefault(w, [0, 0])[label] += 1
                if len(seen) > MEMO:
                    yield from flush()
        yield from flush()

    return (rows.mapInPandas(run, "word binary, toxic long, ordinary long").groupBy("word")
            .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-regularised logistic weights (Newton steps) of rows that count ``times``; the constant is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (times * (p - y)) + keep * w
        h = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(keep) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, text: str = "text", label: str = "toxic", sample_rows: int = 24_000,
        toxic_words: int = 800, ordinary_words: int = 20_000, least_score: float = 4.0,
        least_lift: float = 10.0, level: int = 6, labels: DataFrame | None = None,
        doc_id: str = "doc_id") -> ToxicityModel | float:
    """Dictionaries and calibration from labelled rows (label 1 toxic, 0 ordinary).

    Rows with another or no label are left out. About ``sample_rows`` distinct texts are
    read closely: every text of a label with few, else an equal number of each label, by a
    hash of the text. Three quarters of each label's choose the dictionaries' content, the
    rest calibrates, weighed back to the labels' numbers of distinct texts. Toxic content
    are the ``toxic_words`` words whose document frequency under label 1 exceeds the
    expected one most (``least_score`` standard deviations and ``least_lift`` times
    at least). Spark counts; bounded lists and the sample's distinct rows of features
    reach the driver. A text with very many copies counts once per label.
    With ``labels``, ``label`` is a column of that table (a row per ``doc_id``); only ids and
    hashes are joined with it, and texts of the sample alone move.
    Without both labels the result is the share of toxic rows, a constant score.
    """
    full = F.xxhash64(F.col(text), F.lit(SEED)).alias("full")
    if labels is None:
        rows = docs.select(F.col(text).alias("text"), F.col(label).alias("label"), full)
    else:
        marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        rows = docs.select(F.col(doc_id).alias("doc_id"), full).join(marked, "doc_id")
    rows = rows.filter(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("int"))
    found = (rows.groupBy("label")
             .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("full").alias("texts")).collect())
    n, toxic_n = sum(r.n for r in found), sum(r.n for r in found if r.label)
    if not n or not toxic_n or toxic_n == n:
        return toxic_n / n if n else 0.0
    sizes = {r.label: r.texts for r in found}
    most = quota(list(sizes.values()), sample_rows)
    share = {c: min(1.0, most / k) for c, k in sizes.items()}
    picked = class_sample(rows, "label", sizes, most)
    if labels is not None:  # about sample_rows rows of ids and hashes are broadcast
        picked = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), full)
                  .join(F.broadcast(picked), ["doc_id", "full"]).dropDuplicates(["label", "full"]))
    sample = cut(spread(picked, "full").select("text", "label", "h"), "toxicsample")
    half = F.when(F.col("label") == 1, F.lit(int(share[1] * 0.75 * HASH_RANGE))).otherwise(
        F.lit(int(share[0] * 0.75 * HASH_RANGE)))
    learn, hold = sample.filter(F.col("h") < half), sample.filter(F.col("h") >= half)
    n1, n0 = learn.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    n1, n0 = n1 or 0, n0 or 0
    counts = _word_counts(learn).persist()
    try:
        expect = (F.col("ordinary") + 0.5) * (n1 / max(n0, 1))
        marked = (counts.filter("toxic >= 3")
                  .withColumn("z", (F.col("toxic") - expect) / F.sqrt(expect + 1))
                  .filter((F.col("z") >= least_score) & (F.col("toxic") >= least_lift * expect))
                  .orderBy(F.desc("z"), "word").limit(toxic_words).collect())
        common = counts.filter("ordinary > 0").orderBy(F.desc("ordinary"), "word").limit(ordinary_words).collect()
    finally:
        counts.unpersist()
    windows = [b" " + bytes(r.word) + b" " for r in common]
    try:
        ordinary = zstandard.train_dictionary(16_384, windows * (1 if len(windows) > 2000 else 8)).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        ordinary = b"".join(windows)[-16_384:]
    # the strongest come last: zstandard reaches the end of a dictionary most cheaply
    toxic = b"".join(b" " + bytes(r.word) + b" " + CARRIER[:6] for r in reversed(marked))

    width = len(GAINS) + 3

    def features(batches):
        gains = Gains(ordinary, toxic, level)
        for batch in batches:
            x = np.array([gains.features(t) for t in batch["text"]]).reshape(-1, width)
            yield pd.DataFrame({"x": list(x), "label": batch["label"].to_numpy()})

    # copies have equal features: one row with its number, however many there are
    got = (hold.select("text", "label").mapInPandas(features, "x array<double>, label int")
           .groupBy("x", "label").agg(F.count(F.lit(1)).alias("n")).collect())
    x = np.array([r.x for r in got]).reshape(-1, width)
    y, times = (np.array([r[c] for r in got], dtype=float) for c in ("label", "n"))
    if not len(y) or y.min() == y.max():
        return toxic_n / n
    order = np.lexsort([*x.T, y])  # the same weights in whatever order rows arrive
    x, y, times = x[order], y[order], times[order]
    seen = times.sum()
    times /= np.where(y == 1, share[1], share[0])
    times *= seen / times.sum()
    mean = np.average(x, axis=0, weights=times)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=times)) + 1e-9
    return ToxicityModel(ordinary, toxic, level, mean, scale, _logistic((x - mean) / scale, y, times))


def score(docs: DataFrame, model: ToxicityModel | float, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the toxicity ``score`` (0 to 1) of every whole text.

    A null or empty text gets the score of a text without windows. Equal texts get
    equal scores. An existing column of that name is replaced.
    """
    if not isinstance(model, ToxicityModel):
        return docs.withColumn(column, F.lit(float(model)))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # under 100 kB
    width = len(GAINS) + 3

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        gains = Gains(m.ordinary, m.toxic, m.level)
        for texts in batches:
            x = np.array([gains.features(t) for t in texts]).reshape(-1, width)
            yield pd.Series(m.score(x))

    return docs.withColumn(column, run(F.col(text)))
