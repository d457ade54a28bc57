"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives (quality 1) and unlabelled texts teach a logistic model on hashed byte trigrams and
character-class shares. The risk is prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); while the second part is
negative, its gradient is turned round. The class prior comes from the labels of the learning folds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.langid import held_out

HASHED = 256
# Classes of bytes, each a share of the text.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".", b",;:", b"!", b"?", b"|", b"#$%&*@", b"\"'`", b"()[]{}<>", b"+-=/\\_~^")
_CODE = np.full(256, len(CLASSES) + 1, dtype=np.int64)
_CODE[:128] = len(CLASSES)  # other ASCII, then other bytes
for _i, _c in enumerate(CLASSES):
    _CODE[list(_c)] = _i
N_CLASSES = len(CLASSES) + 2
WIDTH = HASHED + N_CLASSES + 4
PIECE = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Shares under a root, so that rare signs count; empty and null texts are all zero but for one mark."""
    out = np.zeros(WIDTH)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        out[-1] = 1.0
        return out
    grams, shares = np.zeros(HASHED), np.zeros(N_CLASSES)
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE + 2].astype(np.uint32)
        shares += np.bincount(_CODE[piece[:PIECE]], minlength=N_CLASSES)
        if len(piece) > 2:
            h = (piece[:-2] * np.uint32(0x9E3779B1) ^ piece[1:-1] * np.uint32(0x85EBCA77) ^ piece[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
            grams += np.bincount((h >> np.uint32(24)).astype(np.int64) % HASHED, minlength=HASHED)
    words = text.split()
    lines = text.split("\n")
    out[:HASHED] = np.sqrt(grams / max(1.0, grams.sum()))
    out[HASHED : HASHED + N_CLASSES] = np.sqrt(shares / len(data))
    out[-4] = len(set(words)) / max(1, len(words))
    out[-3] = len(set(lines)) / len(lines)
    out[-2] = min(1.0, len(data) / max(1, len(words)) / 20)
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -10, 10) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.02, decay: float = 1e-3) -> QualityModel:
    """Gradient descent (Adam, whole batches) on the non-negative risk with the logistic loss."""
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.where(scale > 1e-3, scale, 1e-3)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    p, u = np.clip(p, -10, 10), np.clip(u, -10, 10)
    w, b = np.zeros(p.shape[1]), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        plus = np.append(p.T @ (sp - 1), (sp - 1).sum()) * prior / len(p)
        minus = np.append(u.T @ su, su.sum()) / len(u) - np.append(p.T @ sp, sp.sum()) * prior / len(p)
        grad = -minus if negative < 0 else plus + minus
        grad[:-1] += decay * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        step = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return QualityModel(mean, scale, w, b)


def fit(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 12000) -> QualityModel | None:
    """Model from documents (doc_id, text, held_out) and labels (doc_id, quality) outside the held-out fold.

    `positives` and `unlabelled` bound the rows that are fitted (those first by a hash of their id, then of their
    text, so a rerun takes the same; rows that repeat both count once); the prior is the share of positives among all labels of the learning folds, kept off
    0 and 1. None where there is no positive.
    """
    learning = docs.where(~F.col("held_out"))
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(~held_out("doc_id", 3, 1))
    n, good = known.agg(F.count("*"), F.sum(F.col("quality").cast("int"))).first()
    if not good:
        return None
    prior = min(0.98, max(0.02, good / n))
    order = F.xxhash64(F.lit("quality"), "doc_id")

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tobytes())

    learning = learning.where("doc_id is not null").withColumn("_t", F.xxhash64("text"))

    def rows(ids: DataFrame, most: int) -> np.ndarray:
        # Ids and text hashes first, texts of the few chosen ones after; rows equal in both are one.
        given = learning.select("doc_id", "_t").join(ids.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "_t"])
        chosen = F.broadcast(given.orderBy(order, "doc_id", "_t").limit(most))
        texts = learning.join(chosen, ["doc_id", "_t"], "left_semi").dropDuplicates(["doc_id", "_t"]).select("doc_id", "_t", vector("text").alias("v"))
        got = sorted((r["doc_id"], r["_t"], bytes(r["v"])) for r in texts.collect())
        return np.frombuffer(b"".join(v for _, _, v in got)).reshape(-1, WIDTH)

    p, u = rows(known.where("quality = 1"), positives), rows(learning, unlabelled)
    return fit_nnpu(p, u, prior) if len(p) and len(u) else None


def score(docs: DataFrame, model: QualityModel | None, text: str = "text", name: str = "score") -> DataFrame:
    """Input columns and the score under `name`. Without a model every score is 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(None if model is None else astuple(model))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = None if sent.value is None else QualityModel(*sent.value)
        for texts in batches:
            if known is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(known.score(np.stack([features(t) for t in texts])))

    return docs.withColumn(name, scored(F.col(f"`{text}`")))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    Only the text is scored. Null and empty texts get one common score. Rows without a label, labels without a
    document, null and repeated labels (the lower one holds) are allowed; rows that repeat an id are scored
    each by their own text. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id, 3, 1).alias("held_out"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("quality"))
    return score(rows, fit(rows, known)).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
