"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed 1- to 3-grams of the lower-case text: term frequencies per order, times
the inverse document frequency over all training documents. Weights are trained by the
follow-the-regularised-leader rule with an elastic-net penalty (McMahan 2011), which leaves many of them at
exactly zero, and the probabilities are then calibrated by a temperature on documents kept apart for that.

Training documents have a language and ``crc32(doc_id) % 4 != 2``. Document frequencies are counted over all of
them; the model is fitted on at most ``SAMPLE`` of them, or one for each
language if there are more languages, equally many of each, chosen by a hash of ``doc_id`` and text.

NULL text and text without a letter are ``und``, with score 1. Rows may repeat; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripstrata.llm import words as W

U64 = np.uint64
BITS = 12
SIZE = 1 << BITS
ORDERS = (1, 2, 3)
SAMPLE = 6000
EPOCHS, STEPS = 4, 1500  # passes, and updates at least
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 1e-4


def term_frequencies(texts: list[str]) -> np.ndarray:
    """Shares of each hashed n-gram in its order, one row per text."""
    joined = "".join(texts).lower() if len(texts) > 1 else texts[0].lower()
    parts = [x.lower() for x in texts]
    sizes = np.array([len(x) for x in parts])
    if sizes.sum() != len(joined):
        joined = "".join(parts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64) * SIZE, sizes)
    out = np.zeros(len(texts) * SIZE, np.float32)
    h = np.zeros(len(codes), np.uint32)
    for order in ORDERS:
        if len(codes) < order:
            break
        n = len(codes) - order + 1
        h = (h[:n] * np.uint32(0x01000193)) ^ (codes[order - 1 :] * np.uint32(0x9E3779B1))
        bucket = ((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)).astype(np.int64)
        inside = owner[:n] == owner[order - 1 :]
        counts = np.bincount((owner[:n] + bucket)[inside], minlength=len(out))
        total = np.repeat(np.maximum(sizes - order + 1, 1), SIZE)
        out += (counts / total).astype(np.float32)
    return out.reshape(len(texts), SIZE)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(tf) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def _frequency_rows(batches):
    counts, docs = np.zeros(SIZE, np.int64), 0
    for piece in W.pieces(batches, budget=1 << 19):
        counts += (term_frequencies(piece.column("text").to_pylist()) > 0).sum(axis=0)
        docs += piece.num_rows
    yield pa.RecordBatch.from_pydict({"term": np.arange(SIZE + 1), "n": np.append(counts, docs)})


def _sample_rows(batches):
    for piece in W.pieces(batches, budget=1 << 19):
        tf = term_frequencies(piece.column("text").to_pylist())
        yield pa.RecordBatch.from_pydict(
            {
                "lang": piece.column("lang"),
                "part": piece.column("part"),
                "tf": pa.array([x.astype("<f2").tobytes() for x in tf], pa.binary()),
            }
        )


def fit(x: np.ndarray, y: np.ndarray, classes: int, l1: float = L1, batch: int = 32) -> np.ndarray:
    """Weights (terms and a bias by classes) after some passes of FTRL-proximal."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    z, n = np.zeros((x.shape[1], classes)), np.zeros((x.shape[1], classes))

    def weights():
        step = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / step)

    random = np.random.default_rng(7)
    for _ in range(max(EPOCHS, -(-STEPS * batch // max(len(x), 1)))):
        order = random.permutation(len(x))
        for lo in range(0, len(x), batch):
            rows = order[lo : lo + batch]
            w = weights()
            p = softmax(x[rows] @ w)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = x[rows].T @ p / len(rows)
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
            z += g - sigma * w
            n += g * g
    return weights()


def repeated(y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rows to learn from, those of rare languages so often that each has an eighth of the mean."""
    count = np.bincount(y[rows], minlength=int(y.max()) + 1)
    mean = len(rows) / np.count_nonzero(count)
    times = np.ceil(mean / (8 * np.maximum(count, 1))).astype(int)
    return np.repeat(rows, times[y[rows]])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss."""
    tried = np.exp(np.linspace(-4, 2, 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def shares(counts: dict[str, int], sample: int = SAMPLE) -> tuple[int, dict[str, float]]:
    """How many documents of each language are sampled, and the share of its documents drawn for that.

    Every language gets an equal part of the sample, at least one. So many are drawn that fewer than that
    part, or none, come out with a probability below 10^-20, whatever the counts; where all are needed, all.
    """
    quota = max(1, sample // max(1, len(counts)))
    return quota, {lang: min(1.0, (4 * quota + 64) / n) for lang, n in counts.items()}


def _sampled(train: DataFrame) -> DataFrame:
    """Of each language the documents with the smallest hashes of id and text, at most the quota.

    The draw leaves a few thousand of all documents to be ranked. Repeated rows have one hash, and
    no more of them than the quota leave a task.
    """
    counts = {row["lang"]: row["n"] for row in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota, share = shares(counts)
    if not counts:
        return train.withColumn("draw", F.lit(0).cast("long"))
    limits = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, s * 2.0**63)])
    draw = F.xxhash64("doc_id", "text", F.lit("sample")).bitwiseAND(F.expr(f"{(1 << 63) - 1}L"))
    drawn = train.withColumn("draw", draw).where(F.col("draw") <= limits[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return drawn.withColumn("place", place).where(F.col("place") <= quota)


def predict_language(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs(doc_id, text, lang)``."""
    spark = docs.sparkSession
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
    )
    train = plain.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
    counted = (
        train.select("text")
        .mapInArrow(_frequency_rows, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    found = np.zeros(SIZE + 1)
    found[counted["term"].to_numpy(int)] = counted["n"].to_numpy(float)
    docs_seen = found[SIZE]
    idf = np.log((1 + docs_seen) / (1 + found[:SIZE])) + 1
    idf = idf.astype(np.float32)

    sample = (
        _sampled(train)
        .select("lang", F.pmod("draw", F.lit(5)).alias("part"), "text")
        .mapInArrow(_sample_rows, "lang string, part long, tf binary")
        .toPandas()
    )
    langs = sorted(set(sample["lang"]))
    model = None
    if langs:
        tf = np.stack([np.frombuffer(b, "<f2") for b in sample["tf"]]).astype(np.float32)
        x = weighted(tf, idf)
        y = np.searchsorted(np.array(langs, object).astype(str), sample["lang"].astype(str))
        apart = (sample["part"] == 0).to_numpy()
        if apart.all() or not apart.any():
            apart = np.zeros(len(y), bool)
        apart &= np.isin(y, y[~apart])
        rows = repeated(y, np.flatnonzero(~apart))
        w = fit(x[rows], y[rows], len(langs))
        check = apart if apart.any() else ~apart
        t = temperature(x[check] @ w[:-1] + w[-1], y[check])
        model = spark.sparkContext.broadcast((langs, idf, w.astype(np.float32) / np.float32(t)))

    def rows(batches):
        for piece in W.pieces(batches, budget=1 << 19):
            texts = piece.column("text").to_pylist()
            langs, idf, w = model.value if model else ([], None, None)
            letters = np.array([any(map(str.isalpha, x)) for x in texts], bool)
            names, scores = np.full(len(texts), "und", object), np.ones(len(texts))
            if langs and letters.any():
                known = np.flatnonzero(letters)
                x = weighted(term_frequencies([texts[k] for k in known]), idf)
                p = softmax((x @ w[:-1] + w[-1]).astype(np.float64))
                names[known] = np.array(langs, object)[p.argmax(axis=1)]
                scores[known] = p.max(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    "held_out": piece.column("held_out"),
                    "lang_pred": pa.array(names.tolist(), pa.string()),
                    "score": pa.array(scores, pa.float64()),
                }
            )

    return plain.select("doc_id", "held_out", "text").mapInArrow(
        rows, "doc_id long, held_out boolean, lang_pred string, score double"
    )
