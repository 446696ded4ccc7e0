"""Fill-in-the-middle by in-place block rotation.

A document is cut at two code points into prefix, middle and suffix.  Its bytes
and the three sentinels go into one bytearray in text order, each sentinel
before its part; the wanted order is then reached inside the buffer by exchanging
two neighbouring segments with three reversals (each segment, then both
together).  ``psm`` exchanges middle and suffix, ``spm`` exchanges everything
before the suffix with the suffix.  The inverse finds the sentinels, rotates
back by the lengths of the exchanged segments and takes the sentinels out, so the
text returns byte for byte.

Scale: a text is handled on its own, no exchange takes place, and Spark bounds
the rows and bytes of a batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import TEXT_ROWS, fresh_name, map_arrow, table
from fieldlens.session import Scratch

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PERCENT, SPM_PERCENT = 90, 20


def rotate(buf: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange ``buf[lo:mid]`` and ``buf[mid:hi]`` in place by three reversals."""
    v = np.frombuffer(buf, np.uint8)
    for a, b in ((lo, mid), (mid, hi), (lo, hi)):
        v[a:b] = v[a:b][::-1]


def code_points(data: bytes) -> np.ndarray:
    """The byte offset of every code point, and the length as the last entry."""
    b = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((b & 0xC0) != 0x80), len(data))


def draw(key: str, n: int) -> tuple[str, int, int]:
    """(form, first cut, second cut) of a text of ``n`` code points, from the
    sha256 of its key."""
    d = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h3 % 100 >= FIM_PERCENT:
        return PLAIN, a, b
    return (SPM if h4 % 100 < SPM_PERCENT else PSM), a, b


def transform(data: bytes, form: str, a: int, b: int) -> bytes:
    """The text's bytes in ``form``, cut at byte offsets ``a`` and ``b``."""
    if form == PLAIN:
        return data
    buf = bytearray(data)
    for at, mark in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    start, mid = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)  # of <M>, of <S>
    rotate(buf, start if form == PSM else 0, mid, len(buf))
    return bytes(buf)


def invert(data: bytes, form: str) -> bytes:
    """The exact text of an output of :func:`transform`."""
    if form == PLAIN:
        return data
    buf = bytearray(data)
    p, s, m = (buf.find(x) for x in SENTINELS)
    if form == PSM:  # <P>prefix<S>suffix<M>middle: the part after <P>prefix was exchanged
        lo, mid = s, m
    else:  # <S>suffix<P>prefix<M>middle
        lo, mid = 0, p
    back = lo + len(buf) - mid
    rotate(buf, lo, mid, len(buf))
    # the text order is back: <P>prefix<M>middle<S>suffix
    middle_at = lo if form == PSM else m - p
    for at, mark in ((back, SUFFIX), (middle_at, MIDDLE), (0, PREFIX)):
        del buf[at:at + len(mark)]
    return bytes(buf)


def _key(seed: int, doc_id) -> str:
    return f"{seed}:" + ("" if doc_id is None else str(doc_id))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """``df`` with its text replaced by the transformed one, and columns ``n``
    (code points of the text), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain).

    Cuts and form depend on ``seed`` and the id alone, so rows that repeat an
    id are cut alike where their texts are equal.  A null text counts as empty;
    an empty text, or one that holds a sentinel, stays plain.  A null id has the
    key of an empty one.  Texts of any length are transformed whole.  All other
    columns pass through, whatever their names or types; columns already called
    n, form, prefix_chars or middle_chars are replaced.  An empty table stays
    empty.
    """
    new = ["n", "form", "prefix_chars", "middle_chars"]
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in new])
    out = T.StructType([*[T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in df.schema],
                        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])
    at, key_at = df.columns.index(text_col), df.columns.index(id_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            done, made = [], []
            for i, t in zip(batch.column(key_at).to_pylist(), texts):
                t = t or b""
                offsets = code_points(t)
                n = len(offsets) - 1
                form, a, b = draw(_key(seed, i), n)
                if n == 0 or any(x in t for x in SENTINELS):
                    form = PLAIN
                done.append(transform(t, form, int(offsets[a]), int(offsets[b])))
                made.append((n, form, *((None, None) if form == PLAIN else (a, b - a))))
            kind = batch.schema.field(at).type
            cols = [pa.array(done, pa.binary()).cast(kind) if j == at else batch.column(j)
                    for j in range(batch.num_columns)]
            cols += [pa.array([r[j] for r in made], pa.string() if j == 1 else pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in out])

    return map_arrow(df, run, out)


def restore(df: DataFrame, text_col: str = "text", form_col: str = "form", out_col: str = "restored") -> DataFrame:
    """``df`` with the exact original text of each transformed one in
    ``out_col``.  A null text is restored as empty; a null form counts as plain."""
    out = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())])
    at, form_at = df.columns.index(text_col), df.columns.index(form_col)

    def run(batches):
        for batch in batches:
            back = [invert(t or b"", f or PLAIN) for t, f in zip(
                batch.column(at).cast(pa.binary()).to_pylist(), batch.column(form_at).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(back, pa.binary()).cast(batch.schema.field(at).type)],
                names=[f.name for f in out])

    return map_arrow(df, run, out)


def op12_fim(spark, sf_dir: str) -> DataFrame:
    """All documents with seed 1, and the digests of output and restored text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = fresh_name(docs, "restored")
    made = restore(fill_in_middle(docs), out_col=back)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    with Scratch(spark, "op12") as scratch:
        out = scratch.table(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                        sha("text").alias("output_sha256"), sha(back).alias("restored_sha256")),
                            "out", arrow_rows=TEXT_ROWS)
        scratch.keep("out")
        return out
