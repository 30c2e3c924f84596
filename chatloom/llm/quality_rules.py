"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text, and rules on repeats.

Two multinomials over hashed n-grams of words and their shapes: one of trusted documents, one of all. A
document's verdict is its mean log ratio against a fixed threshold, so each document is decided alone and
the same way at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.features import shaped
from chatloom.llm.tables import bounded, slices
from chatloom.llm.textbytes import Words, texts_of, windows, words

BITS = 16
#: Added to each bucket's share of 2**BITS, in n-grams.
SMOOTHING = 0.5
#: Mean log ratio from which a document is kept.
THRESHOLD = -0.4
REPEAT_WIDTH = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def bucket_counts(docs: DataFrame, text: str = "text", bits: int = BITS) -> np.ndarray:
    """N-grams in each bucket over all rows: summed in each partition, then by bucket. 2**bits numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in slices(batches):
            for _, _, _, bucket in shaped(texts_of(batch), bits):
                total += np.bincount(bucket, minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = bounded(docs).select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << bits)
    counts[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy()
    return counts


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log of each bucket's smoothed share of trusted text over that of raw text; 0 everywhere without trusted text."""
    if not trusted.sum():
        return np.zeros(len(raw))
    smooth = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * len(c))
    return np.log(smooth(trusted)) - np.log(smooth(raw))


def trusted_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of all rows of docs that have a label as good. Both sides are dealt by key, as the ids grow with the corpus."""
    good = labels.where((F.col("quality") == 1) & F.col(key).isNotNull()).select(F.col(key).alias("_trusted")).distinct()
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(text))
    return rows.join(good.hint("shuffle_hash"), F.col("_id") == F.col("_trusted"), "left_semi")


def repeated_words(w: Words, width: int = REPEAT_WIDTH) -> np.ndarray:
    """For each text, the words that lie in a window of so many words which the text holds twice or more."""
    value, at = windows(w.hash, w.word_at, width)
    owner = w.text_of_word()
    hits = np.zeros(len(w.hash) + 1, np.int64)
    if len(at):
        order = np.lexsort((value, owner[at]))
        same = (value[order][1:] == value[order][:-1]) & (owner[at][order][1:] == owner[at][order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(hits, at[twice], 1)
        np.add.at(hits, at[twice] + width, -1)
    return np.bincount(owner[np.cumsum(hits)[:-1] > 0], minlength=w.last - w.first)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def rules(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts, the mean log ratio and the verdict of every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)
    bits = int(len(ratio) - 1).bit_length()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            n = len(texts)
            n_words, chars, symbols, repeats = (np.zeros(n, np.int64) for _ in range(4))
            for w in words(texts, lower=False):
                inside = np.zeros(len(w.data) + 1, np.int8)
                inside[w.start] += 1
                inside[w.end] -= 1
                in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
                n_words[w.first : w.last] = np.diff(w.word_at)
                chars[w.first : w.last] = w.per_text(in_word & ((w.data & 0xC0) != 0x80))
                symbols[w.first : w.last] = w.per_text(_SYMBOL[w.data])
                repeats[w.first : w.last] = repeated_words(w)
            total, grams = np.zeros(n), np.zeros(n)
            for first, last, owner, bucket in shaped(texts, bits):
                total[first:last] = np.bincount(owner, held.value[bucket], minlength=last - first)
                grams[first:last] = np.bincount(owner, minlength=last - first)
            mean = total / np.maximum(grams, 1)
            failed = (n_words < 20) | (100 * repeats > 30 * n_words)
            lines = np.fromiter(map(repeated_lines, texts), np.int64, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, chars, symbols, lines, repeats, failed, mean, ~failed & (mean >= threshold)))], names)

    names = [key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept"]
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, log_ratio double, kept boolean"
    return bounded(docs).select(key, F.col(text).alias("text")).mapInArrow(judge, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_ratio, kept of every row.

    The raw multinomial counts all rows of docs, the trusted one all labelled good rows. Null and
    empty texts have no words and fail the base rules; null ids and repeated rows are judged like any row; an
    empty table gives none; without labels the ratio is 0 everywhere. Only id and text of docs are read.
    """
    raw = bucket_counts(docs, text)
    trusted = bucket_counts(trusted_rows(docs, labels, key, text), text)
    return rules(docs, log_ratio(trusted, raw), threshold, key, text)
