"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a logistic probability
from hashed words; the document's is their noisy-or, 1 - prod(1 - p).  The
sentence model is trained from document labels alone by gradient ascent on the
noisy-or likelihood, and afterwards points out the offending sentences.

Training uses a bounded sample (``SAMPLE`` labelled documents, chosen by a hash
of the id); features are hashed in the executors, so the driver holds at most
the sample's word numbers.  Scoring is one pass over the documents, without a
shuffle; the broadcast model has a fixed size.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import WORDS, map_arrow, named, table, unit_hash

SAMPLE = 6000
DIM = 1 << 18
THRESHOLD = 0.3
MIN_DOCS = 4
MIN_Z = 1.0
PREFIXES = (4, 5, 6, 7, 8)

# UTF-8 safe: only ASCII bytes end a sentence.
_END = re.compile(rb"[.!?\n]+")


def sentence_words(text: bytes | None) -> list[set[bytes]]:
    """Distinct words of each sentence that has any."""
    out = []
    for s in _END.split(text or b""):
        w = set(s.translate(WORDS).split())
        if w:
            out.append(w)
    return out


def word_slots(word: bytes) -> list[int]:
    """Hashed features of a word: itself and its first 4 to 8 bytes, which
    inflected forms share."""
    return [zlib.crc32(word) % DIM] + [zlib.crc32(b"^" + word[:k]) % DIM for k in PREFIXES if len(word) >= k]


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 2 modulo 4; null ids are
    in the training part but have no label to learn."""
    return F.coalesce(F.crc32(named(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_bags(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  sample: int, seed: int) -> list:
    """At most about ``sample`` labelled, not held-out documents as (label,
    sentence lengths, word slots).  A repeated label row counts once, toxic
    if any of its rows is; a repeated document gives its smallest text."""
    ids = (
        labels.filter(named(label_col).isNotNull() & named(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(named(id_col).alias("id")).agg(F.max(named(label_col)).alias("y"))
    )
    n = ids.count()
    share = min(1.0, sample / max(n, 1))
    chosen = ids.filter(unit_hash("id", seed=seed) < share).limit(sample * 2)
    picked = (
        docs.select(named(id_col).alias("id"), named(text_col).cast("binary").alias("t"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "y").agg(F.min("t").alias("t"))
    )

    def bags(batches):
        for batch in batches:
            y, size, slots = [], [], []
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = sentence_words(t)
                y.append(label)
                found = [[k for w in sorted(x) for k in word_slots(w)] for x in s]
                size.append(np.array([len(x) for x in found], "<i4").tobytes())
                slots.append(np.array([k for x in found for k in x], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(size, pa.binary()), pa.array(slots, pa.binary())],
                names=["y", "size", "slots"])

    return picked.select(F.col("y").cast("int").alias("y"), "t").mapInArrow(
        bags, "y int, size binary, slots binary").collect()


class NoisyOr:
    """Sentence weights and bias; ``score`` maps a text to (document
    probability, sentence probabilities)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.tolist(), bias
        self._cache: dict[bytes, float] = {}

    def weight(self, word: bytes) -> float:
        w = self._cache.get(word)
        if w is None:
            if len(self._cache) > 500_000:
                self._cache.clear()
            w = self._cache[word] = sum([self.weights[k] for k in word_slots(word)])
        return w

    def sentence(self, words: set[bytes]) -> float:
        z = self.bias + sum([self.weight(w) for w in words])
        return 1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0)))

    def score(self, text: bytes | None) -> tuple[float, list[float]]:
        ps = [self.sentence(s) for s in sentence_words(text)]
        clean = 1.0
        for p in ps:
            clean *= 1.0 - p
        return 1.0 - clean, ps


def fit_noisy_or(bags, epochs: int = 120, rate: float = 0.15, l1: float = 1.5e-4,
                 min_docs: int = MIN_DOCS, min_z: float = MIN_Z) -> NoisyOr:
    """Proximal Adagrad on the mean noisy-or log-likelihood.  Slots in fewer than
    ``min_docs`` sampled documents, or whose document rates in the two classes
    differ by less than ``min_z`` standard errors, keep weight zero; only the
    others are laid out in memory.  Without documents of both classes the model
    scores (close to) zero."""
    bags = [(int(b[0] > 0), np.frombuffer(b[1], "<i4"), np.frombuffer(b[2], "<i4")) for b in bags]
    bags = [b for b in bags if len(b[1])]
    y = np.array([b[0] for b in bags], float)
    if len(np.unique(y)) < 2:
        return NoisyOr(np.zeros(DIM), -20.0)
    in_docs = np.zeros((2, DIM))
    for label, _, slots in bags:
        in_docs[label, np.unique(slots)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    p = in_docs.sum(axis=0) / n.sum()
    z = (in_docs[1] / n[1] - in_docs[0] / n[0]) / np.sqrt(np.maximum(p * (1 - p) * (1 / n).sum(), 1e-12))
    used = np.flatnonzero((in_docs.sum(axis=0) >= min_docs) & (np.abs(z) >= min_z))
    number = np.full(DIM, -1, np.int32)
    number[used] = np.arange(len(used))
    n_sent = np.array([len(b[1]) for b in bags])
    doc = np.repeat(np.arange(len(bags)), n_sent)
    size = np.zeros(n_sent.sum(), np.int8)  # one entry a sentence
    rows, cols, at = [], [], 0
    for _, sizes, slots in bags:
        c = number[slots]
        rows.append((np.repeat(np.arange(at, at + len(sizes)), sizes)[c >= 0]).astype(np.int32))
        cols.append(c[c >= 0])
        at += len(sizes)
    row, col = np.concatenate(rows), np.concatenate(cols)
    w, b = np.zeros(len(used)), -np.log(max(n_sent.mean(), 1) * 12.0)
    gw, gb = np.full(len(used), 1e-8), 1e-8
    m = len(bags)
    for _ in range(epochs):
        z = np.clip(b + np.bincount(row, weights=w[col], minlength=len(size)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        logq = np.bincount(doc, weights=np.log1p(-p), minlength=m)
        q = np.exp(logq)
        pos = np.minimum(q / np.maximum(1 - q, 1e-6), 1e3)
        g = np.where(y[doc] > 0, pos[doc], -1.0) * p / m
        dw = np.bincount(col, weights=g[row], minlength=len(used))
        db = g.sum()
        gw += dw * dw
        gb += db * db
        step = rate / np.sqrt(gw)
        w += step * dw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b += rate * 0.3 * db / np.sqrt(gb)
    weights = np.zeros(DIM)
    weights[used] = w
    return NoisyOr(weights, float(b))


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample: int = SAMPLE, seed: int = 5) -> NoisyOr:
    return fit_noisy_or(training_bags(docs, labels, id_col, text_col, label_col, sample, seed))


def score_toxicity(docs: DataFrame, model: NoisyOr, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out``: struct(score, sentences, offending).

    ``sentences`` counts the sentences with words; ``offending`` lists those
    with a probability of at least ``THRESHOLD`` as struct(first_byte,
    end_byte, p), byte offsets into the UTF-8 text.  Null and wordless texts
    have score 0 and no sentence.  Repeated rows are scored each, texts
    are read whole, whatever their length, and columns may have any name.  An
    empty table gives no row, and a column already called ``out`` is replaced.
    """
    docs = docs.select(*(named(c) for c in docs.columns if c.lower() != out.lower()))
    sent = docs.sparkSession.sparkContext.broadcast((np.array(model.weights), model.bias))
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, _FOUND)])

    def run(batches):
        scorer = NoisyOr(*sent.value)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            res = pa.array([_located(scorer, t) for t in texts], type=_RESULT)
            yield pa.RecordBatch.from_arrays([*batch.columns, res], names=[*batch.schema.names, "found"])

    return map_arrow(docs, run, schema)


_FOUND = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("sentences", T.IntegerType()),
    T.StructField("offending", T.ArrayType(T.StructType([
        T.StructField("first_byte", T.IntegerType()), T.StructField("end_byte", T.IntegerType()),
        T.StructField("p", T.DoubleType())])))])
_RESULT = pa.struct([("score", pa.float64()), ("sentences", pa.int32()), ("offending", pa.list_(pa.struct(
    [("first_byte", pa.int32()), ("end_byte", pa.int32()), ("p", pa.float64())])))])


def _located(model: NoisyOr, text: bytes | None) -> dict:
    score, ps = model.score(text)
    offending = []
    if ps and max(ps) >= THRESHOLD:
        spans, at = [], 0
        for m in [*_END.finditer(text), None]:
            end = m.start() if m else len(text)
            if text[at:end].translate(WORDS).split():
                spans.append((at, end))
            at = m.end() if m else end
        offending = [{"first_byte": a, "end_byte": z, "p": p} for (a, z), p in zip(spans, ps) if p >= THRESHOLD]
    return {"score": score, "sentences": len(ps), "offending": offending}


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs.select("doc_id", "text"), train_toxicity(docs, labels)).drop("text")
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("toxicity.sentences").alias("n_sentences"), F.col("toxicity.offending").alias("offending"))
