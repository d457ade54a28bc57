"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are summed up over all learning rows: in numpy per Arrow batch, then by Spark. The
matrix of log probabilities (languages x buckets, both bounded) goes to all tasks, which score batches of
texts from the n-grams that occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
LONGEST = 3
PIECE = 1 << 20
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def hashed_ngrams(text: str, buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of 1 to `longest` code points, piece by piece for a long text."""
    for at in range(0, max(len(text), 1), PIECE):
        # A piece begins with the end of the one before it; n-grams that lie in there are not counted again.
        back = min(at, longest - 1)
        code = np.frombuffer(text[at - back : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        value = np.zeros(len(code), dtype=np.uint32)
        for n in range(1, longest + 1):
            if len(code) < n:
                break
            value = (value[: len(code) - n + 1] + np.uint32(n)) * _FACTORS[(n - 1) % 3] ^ code[n - 1 :] * np.uint32(0x27D4EB2F)
            mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            hashed = ((mixed ^ (mixed >> np.uint32(12))) % np.uint32(buckets)).astype(np.int64)
            yield hashed[max(0, back - n + 1) :]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def ngram_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """text, lang -> lang, bucket, n over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}

        def add(langs: list[str]) -> None:
            for lang in langs:
                mine = total.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                mine += np.bincount(np.concatenate(waiting.pop(lang)), minlength=buckets)

        for batch in batches:
            held = 0
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                for part in hashed_ngrams(text.as_py(), buckets):
                    waiting.setdefault(lang, []).append(part)
                    held += len(part)
                if held > PIECE:
                    add(list(waiting))
                    held = 0
            add(list(waiting))
            # Many languages would fill memory: hand on what there is.
            if len(total) > 64:
                yield from sent(total)
                total.clear()
        yield from sent(total)

    def sent(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in total.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(n[used])], ["lang", "bucket", "n"])

    partial = rows.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, buckets: int = BUCKETS, smoothing: float = 0.5, most: int = 500) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log probabilities per bucket (float32), from rows of text and lang.

    `most` bounds the languages, and with `buckets` the size of what is collected and sent to the tasks.
    """
    counts = ngram_counts(rows, buckets)
    langs = sorted(r[0] for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(langs) > most:
        raise ValueError(f"more than {most} languages")
    per_lang = counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("c"))
    table = np.full((len(langs), buckets), smoothing)
    for row in per_lang.toLocalIterator():
        table[langs.index(row["lang"]), [c["bucket"] for c in row["c"]]] += [c["n"] for c in row["c"]]
    # Same prior for every language: a text's own n-grams decide.
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, text: str = "text") -> DataFrame:
    """Input columns and lang_pred, score (posterior of the predicted language).

    Null text, and text without a letter, is `und` with score 0; so is everything when nothing was learned. Ties
    go to the first language by name. Repeated rows get equal results; each row is scored whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        by_bucket = sent.value
        names, values = [], []
        for t in texts:
            if not langs or t is None or not has_letter(t):
                names.append(UNKNOWN)
                values.append(0.0)
                continue
            total = np.zeros(len(langs))
            for part in hashed_ngrams(t, by_bucket.shape[0]):
                if len(part) > 4 * by_bucket.shape[0] // max(1, len(langs)):
                    n = np.bincount(part, minlength=by_bucket.shape[0])
                    used = np.flatnonzero(n)
                    total += n[used].astype(np.float64) @ by_bucket[used]
                else:
                    total += by_bucket[part].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            names.append(langs[best])
            values.append(float(1 / np.exp(total - total[best]).sum()))
        return pd.DataFrame({"lang_pred": names, "score": values})

    found = docs.withColumn("_found", score(F.col(f"`{text}`")))
    return found.select(*[f"`{c}`" for c in docs.columns], "_found.lang_pred", "_found.score")


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether a row is kept from learning; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))) % folds == fold


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from text and non-null lang of the other folds."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held_out(doc_id, folds, fold).alias("held_out"))
    langs, table = fit(rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang"))
    return predict(rows.select("doc_id", "text", "held_out"), langs, table).select("doc_id", "held_out", "lang_pred", "score")
