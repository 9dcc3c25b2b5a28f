"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import class_sample, quota, spread

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SEED = 17  # of the sample's hash
CHUNK = 1 << 16  # characters hashed at a time, so that long texts need bounded memory

_LETTER: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        table = np.zeros(0x110000, dtype=bool)
        for c in range(0x32400):  # planes beyond hold no letters
            table[c] = chr(c).isalpha()
        _LETTER = table
    return _LETTER


def letter_codes(text: str | None) -> np.ndarray:
    """Lower-cased code points; runs of anything but letters become one blank.
    Empty if there is no letter."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    keep = letter_table()[codes]
    if not keep.any():
        return np.zeros(0, dtype=np.uint32)
    codes = np.where(keep, codes, np.uint32(32))
    codes = np.concatenate([[np.uint32(32)], codes, [np.uint32(32)]])
    gap = codes == 32
    return codes[~(gap & np.concatenate([[False], gap[:-1]]))]


def gram_buckets(codes: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of the orders, as uint16/32 numbers."""
    out = []
    for n in ORDERS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, dtype=np.uint64)
        for j in range(n):
            h = (h ^ codes[j:len(codes) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def pieces(codes: np.ndarray):
    """Overlapping pieces of a long text that together hold each n-gram of the
    highest order once (shorter ones of an overlap twice)."""
    step, over = CHUNK, max(ORDERS) - 1
    for a in range(0, max(1, len(codes) - over), step):
        yield codes[a:a + step + over]


def _count_grams(text: str | None) -> np.ndarray | None:
    codes = letter_codes(text)
    if not len(codes):
        return None
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for part in pieces(codes):
        total += np.bincount(gram_buckets(part), minlength=1 << BUCKET_BITS)
    return total


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = 20_000,
        alpha: float = 0.5, max_langs: int = 512) -> tuple[list[str], np.ndarray]:
    """Learned languages (sorted) and their log-probability matrix (buckets x langs).

    ``docs`` holds the training rows; rows with null lang are left out. All of them
    name the languages; about ``sample_rows`` of their distinct texts are read closely:
    every text of a language with few, and an equal number of each other language, picked
    by a hash of the text. The counts are summed by Spark; only ``langs x 65,536`` sums
    reach the driver, and over ``max_langs`` languages is an error. No training rows: no
    languages.
    """
    rows = (docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
            .withColumn("full", F.xxhash64("text", F.lit(SEED))))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count_distinct("full").alias("n"))
             .limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages to learn")
    names = sorted(sizes)
    rows = spread(class_sample(rows, "lang", sizes, quota(list(sizes.values()), sample_rows)), "full")

    def count(batches):
        sums: dict[str, np.ndarray] = {}

        def flush():
            for name, c in sums.items():
                at = c.nonzero()[0]
                yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": c[at]})
            sums.clear()

        for batch in batches:
            for name, t in zip(batch["lang"], batch["text"]):
                c = _count_grams(t)
                if c is None:
                    c = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
                if name in sums:
                    sums[name] += c
                else:
                    sums[name] = c
                if len(sums) > 64:
                    yield from flush()
        yield from flush()

    counted = (rows.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).persist())
    try:
        sums = counted.toPandas()
    finally:
        counted.unpersist()
    matrix = np.zeros((1 << BUCKET_BITS, max(1, len(names))), dtype=np.float64)
    place = {name: i for i, name in enumerate(names)}
    if len(sums):
        matrix[sums["bucket"].to_numpy(), [place[x] for x in sums["lang"]]] = sums["n"]
    matrix += alpha
    return names, np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, names: list[str], matrix: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior under equal priors).

    Null texts and texts without letters get ``und`` and score 0; so does every
    text if no language was learned. Whole texts are scored, in bounded pieces.
    Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((list(names), matrix))  # bounded: max_langs x 65,536 floats

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        langs, logp = model.value
        out = []
        for t in texts:
            codes = letter_codes(t) if langs else ()
            if not len(codes):
                out.append(("und", 0.0))
                continue
            total = np.zeros(len(langs))
            for part in pieces(codes):
                # sparse scoring: only the text's own buckets are read
                total += logp[gram_buckets(part)].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            out.append((langs[best], float(1.0 / np.exp(total - total[best]).sum())))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    scored = docs.withColumn("__lang", run(F.col(text)))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return scored.select(*kept, "__lang.lang_pred", "__lang.score")
