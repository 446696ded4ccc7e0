"""Quality classifier from weak labels.

Nine overlapping heuristic labellers vote on every document: seven look for one
kind of junk each (bad or nothing), two judge its prose (good, bad or nothing).
Expectation-maximisation over the counts of vote patterns (at most 2^7 x 3^2,
aggregated over all documents) estimates how often each labeller votes what in
each class, without any hand label.  The posterior of a document's
pattern is its soft label, and a hashed linear scorer over words and word
shapes is trained on a bounded sample of softly labelled documents
(``SAMPLE``).  The scorer then judges every document in one pass.

No document text moves: votes and scores are computed where the rows are; the
driver sees pattern counts and the sample's hashed features.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import STAGE_ROWS, fresh_name, releasing, table, unit_hash
from fieldlens.session import Scratch

SAMPLE = 6000
DIM = 1 << 18
THRESHOLD = 0.5
GAIN = 4.0  # scale of the shares while fitting
LABELLERS = ("symbols", "capitals", "bare_tokens", "shouting", "repetition", "one_word", "stutter", "function_words", "line_ends")
# Log odds that a vote carries before anything is estimated.
BELIEF = (2.2, 2.2, 2.2, 2.2, 2.2, 2.2, 2.2, 0.8, 0.8)
PROSE = 2  # the last labellers judge prose; their 0 tells nothing

# Very frequent short words of the four languages of the corpus.
FUNCTION_WORDS = frozenset(
    b"the of and to in is it that for was with as be by on are this from or an a "
    b"le la les de des et un une en que qui pour dans sur pas au du est il elle "
    b"der die das und ist in zu mit von den ein eine nicht auf "
    b"el los las y del por con para una se su al lo como".split())

_LETTER = bytes(b"L"[0] if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else
                b" "[0] if b in (32, 9, 10, 11, 12, 13) else
                b"0"[0] if 48 <= b <= 57 else
                b"."[0] if b in b".,;:'\"?!()-" else b"#"[0] for b in range(256))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def votes(text: bytes | None) -> tuple[int, ...]:
    """One vote of each labeller: 1 good, -1 bad, 0 nothing.  A text without
    words gets no vote."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(LABELLERS)
    kinds = text.translate(_LETTER)
    solid = max(1, len(text) - kinds.count(b" "))
    upper = len(text) - len(text.translate(None, _UPPER))
    lower = len(text) - len(text.translate(None, _LOWER))
    bare = sum([1 for k in kinds.split() if b"L" not in k and b"0" not in k])
    low = [w.strip(b".,;:!?").lower() for w in words]
    function = sum([1 for w in low if w in FUNCTION_WORDS]) / n
    lines = [x.rstrip() for x in text.split(b"\n") if x.strip()]
    ends = sum([1 for x in lines if x[-1:] in b".!?\"'"]) / len(lines)
    most = Counter(low).most_common(1)[0][1] / n
    return (
        -(kinds.count(b"#") / solid >= 0.04),
        -(upper / max(1, upper + lower) >= 0.4 and upper >= 10),
        -(bare / n >= 0.15),
        -(text.count(b"!") / n >= 0.3),
        -(n >= 30 and len(set(low)) / n < 0.25),
        -(n >= 20 and most >= 0.25),
        -(n >= 20 and sum(map(eq, words, words[1:])) / n >= 0.2),
        0 if n < 15 else 1 if function >= 0.08 else -1 if function <= 0.02 else 0,
        0 if len(lines) < 2 else 1 if ends >= 0.7 else -1 if ends <= 0.2 else 0,
    )


def fit_labellers(patterns: dict[tuple[int, ...], int], rounds: int = 200) -> dict[tuple[int, ...], float]:
    """Dawid-Skene expectation-maximisation on pattern counts: the posterior
    of 'good' for every pattern.  Each labeller has three outcomes (bad, none,
    good) per class; it starts from the votes weighted by ``BELIEF`` and a
    mild lean to good, and pseudo-counts keep the classes' meaning."""
    keys = list(patterns)
    if not keys:
        return {}
    v = np.array(keys) + 1
    n = np.array([patterns[k] for k in keys], float)
    p = 1 / (1 + np.exp(-(1.0 + (v - 1) @ np.array(BELIEF))))
    for _ in range(rounds):
        prior = np.clip((n * p).sum() / n.sum(), 0.05, 0.98)
        z = np.full(len(keys), np.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            good = np.bincount(v[:, j], weights=n * p, minlength=3) + [0.1, 1.0, 1.0]
            bad = np.bincount(v[:, j], weights=n * (1 - p), minlength=3) + [1.0, 1.0, 0.1]
            if j >= v.shape[1] - PROSE:
                good, bad = good * [1, 0, 1], bad * [1, 0, 1]
            rate = np.log(np.maximum(good, 1e-9) / good.sum()) - np.log(np.maximum(bad, 1e-9) / bad.sum())
            if j >= v.shape[1] - PROSE:
                rate[1] = 0.0
            z += rate[v[:, j]]
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return dict(zip(keys, p.tolist()))


_RUN = re.compile(rb"([A-Z])[A-Z]*|([a-z\x80-\xff])[a-z\x80-\xff]*|([0-9])[0-9]*")


def shape(word: bytes) -> bytes:
    """The word with runs of capitals, other letters and digits as A, a, 0."""
    return _RUN.sub(lambda m: b"A" if m[1] else b"a" if m[2] else b"0", word)


def features(word: bytes) -> tuple[int, int]:
    """Slots of the lower-cased word and of its shape."""
    return zlib.crc32(word.lower()) % DIM, zlib.crc32(b"\x00" + shape(word)) % DIM


SAME = zlib.crc32(b"\x01same") % DIM


def slots(text: bytes | None) -> list[int]:
    """All slots of a text: two a word, and one for each word that repeats
    the word before it."""
    words = (text or b"").split()
    return [k for w in words for k in features(w)] + [SAME] * (2 * sum(map(eq, words, words[1:])))


class LinearScorer:
    """Mean weight of a text's slots, squashed to 0..1."""

    def __init__(self, weights, bias: float):
        self.weights, self.bias = list(weights), bias
        self._cache: dict[bytes, float] = {}

    def word(self, w: bytes) -> float:
        a, b = features(w)
        if len(self._cache) > 500_000:
            self._cache.clear()
        x = self._cache[w] = self.weights[a] + self.weights[b]
        return x

    def score(self, text: bytes | None) -> float:
        words = (text or b"").split()
        get, new = self._cache.get, self.word
        total = 0.0
        for w in words:
            x = get(w)
            total += new(w) if x is None else x
        same = sum(map(eq, words, words[1:]))
        total += 2 * same * self.weights[SAME]
        z = self.bias + total / max(1, 2 * (len(words) + same))
        return 1 / (1 + float(np.exp(-min(max(z, -40.0), 40.0))))


def fit_scorer(rows, epochs: int = 150, rate: float = 0.3, l2: float = 1e-4) -> LinearScorer:
    """Logistic regression on soft labels by Adagrad.  ``rows`` are (posterior,
    slots as little-endian 32-bit); a document's features are its slots' shares."""
    rows = [(p, np.frombuffer(a, "<i4")) for p, a in rows]
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return LinearScorer(np.zeros(DIM), 4.0)
    y = np.array([r[0] for r in rows])
    size = np.array([len(r[1]) for r in rows])
    doc = np.repeat(np.arange(len(rows)), size)
    used, col = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    key, count = np.unique(doc.astype(np.int64) * len(used) + col, return_counts=True)
    doc, col = key // len(used), key % len(used)
    val = GAIN * count / size[doc]
    w, b = np.zeros(len(used)), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    gw, gb, m = np.full(len(used), 1e-8), 1e-8, len(rows)
    for _ in range(epochs):
        z = b + np.bincount(doc, weights=w[col] * val, minlength=m)
        g = (y - 1 / (1 + np.exp(-np.clip(z, -40, 40)))) / m
        dw = np.bincount(col, weights=g[doc] * val, minlength=len(used)) - l2 * w / m
        db = g.sum()
        gw += dw * dw
        gb += db * db
        w += rate * dw / np.sqrt(gw)
        b += rate * db / np.sqrt(gb)
    weights = np.zeros(DIM)
    weights[used] = GAIN * w
    return LinearScorer(weights, float(b))


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, votes) of every document; key is a hash of id and text."""
    def run(batches):
        for batch in releasing(batches):
            v = [list(votes(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(v, pa.list_(pa.int8()))], names=["key", "votes"])

    return docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("t")) \
        .mapInArrow(run, "key bigint, votes array<tinyint>")


def train_quality(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                  sample: int = SAMPLE, seed: int = 17):
    """(posterior of every vote pattern, the fitted scorer).

    Pattern counts cover all rows; the scorer sees about ``sample`` documents
    chosen by a hash of id and text (a group of repeated rows, chosen or not
    together, gives one)."""
    voted = scratch.table(label_documents(docs, id_col, text_col), "votes", arrow_rows=STAGE_ROWS)
    patterns = {tuple(r[0]): r[1] for r in voted.groupBy("votes").count().collect()}  # <= 1152 rows
    posterior = fit_labellers(patterns)
    share = min(1.0, sample / max(1, sum(patterns.values())))
    key = F.xxhash64(id_col, text_col)
    picked = (
        docs.select(key.alias("key"), F.col(text_col).cast("binary").alias("t"))
        .filter(unit_hash("key", seed=seed) < share)
        .groupBy("key").agg(F.min("t").alias("t"))
    )

    def hashed(batches):
        for batch in batches:
            p, found = [], []
            for t in batch.column(1).to_pylist():
                p.append(posterior.get(votes(t), 0.5))
                found.append(np.array(slots(t), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(found, pa.binary())], names=["p", "slots"])

    return posterior, fit_scorer(picked.mapInArrow(hashed, "p double, slots binary").collect())


def score_quality(docs: DataFrame, scorer: LinearScorer, posterior: dict | None = None, text_col: str = "text",
                  out: str = "quality") -> DataFrame:
    """``docs`` with ``out``: struct(score, weak_label, votes).

    ``score`` is the scorer's probability of good; ``weak_label`` is the
    posterior of the document's votes, both null without ``posterior``.  A null or empty text has no votes and the scorer's
    base rate.  Repeated rows are scored each, an empty table gives no row, and
    a column already called ``out`` is replaced.
    """
    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast((np.array(scorer.weights), scorer.bias, posterior))
    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    kind = pa.struct([("score", pa.float64()), ("weak_label", pa.float64()), ("votes", pa.list_(pa.int8()))])

    def run(batches):
        weights, bias, post = sent.value
        s = LinearScorer(weights.tolist(), bias)
        for batch in releasing(batches):
            res = []
            for t in batch.column(at).cast(pa.binary()).to_pylist():
                v = votes(t) if post is not None else None
                res.append({"score": s.score(t), "weak_label": post.get(v, 0.5) if v else None,
                            "votes": list(v) if v else None})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(res, type=kind)],
                                             names=[*batch.schema.names, out])

    return docs.mapInArrow(
        run, f"{schema}, `{out}` struct<score:double,weak_label:double,votes:array<tinyint>>")


def keep_good(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier does not reject, columns unchanged."""
    _, scorer = train_quality(docs, scratch, id_col, text_col)
    name = fresh_name(docs, "quality")
    return score_quality(docs, scorer, None, text_col, name) \
        .filter(F.col(name)["score"] >= THRESHOLD).drop(name)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op10") as scratch:
        posterior, scorer = train_quality(docs, scratch)
    return score_quality(docs, scorer, posterior).select(
        "doc_id", F.col("quality.score").alias("score"), F.col("quality.weak_label").alias("weak_label"),
        F.col("quality.votes").alias("votes"), (F.col("quality.score") >= THRESHOLD).alias("keep"))
