"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items are cut into windows of ``window`` consecutive words (a
shorter item is one window).  All windows of a block of items form one
automaton over the normalised bytes; a document is normalised, joined with
single spaces and scanned once.  A match ends at a byte of the normalised
text, and counting the spaces before it gives word numbers, which map back to
the original text's word positions.

Scale: documents never shuffle.  Items are taken in blocks of at most
``block_bytes`` of window text, so an automaton's size has a bound that does
not depend on the benchmark.  Each block is one pass that carries the hits found
so far; every pass but the last is written, so that one automaton is alive in a
worker at a time and a lost executor repeats one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fieldlens.llm.common import TEXT_ROWS, alnum_words, fresh_name, releasing
from fieldlens.session import Scratch

BLOCK_BYTES = 8 << 20


def item_windows(words: list[bytes], window: int) -> list[bytes]:
    """The item's windows: every run of ``window`` words, or the whole item."""
    if len(words) <= window:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + window]) for i in range(len(words) - window + 1)]


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, window: int,
                     scratch: Scratch, block_bytes: int = BLOCK_BYTES) -> Iterator[dict[bytes, list]]:
    """Blocks of {window text: item ids}, each of at most ``block_bytes`` of
    item text times the window length (one larger item forms a block alone).

    Block numbers come from a hash of the text and the total size, so a block
    is read by a filter from the items' written table; only one block is on the
    driver at a time.
    """
    rows = scratch.table(items.select(F.col(id_col).cast("string").alias("id"),
                                      F.col(text_col).cast("binary").alias("text")).distinct(), "items")
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = max(1, -(-int(size) * window // block_bytes))
    for b in range(n):
        windows: dict[bytes, list] = {}
        for r in rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).toLocalIterator():
            for w in item_windows(alnum_words(r.text), window):
                ids = windows.setdefault(w, [])
                if r.id is not None and r.id not in ids:
                    ids.append(r.id)
        if windows:
            yield windows


def build_automaton(windows: dict[bytes, list]):
    """Automaton over latin-1 views of ' w1 w2 ... ' (one character a byte);
    each entry carries (word count, item ids)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for w, ids in windows.items():
        key = b" " + w + b" "
        a.add_word(key.decode("latin-1"), (w.count(b" ") + 1, tuple(ids)))
    a.make_automaton()
    return a


def scan_words(words: list[bytes], automaton) -> tuple[list[tuple[int, int]], set]:
    """Merged hit spans [first word, last word] and the ids of items found."""
    if not words:
        return [], set()
    norm = b" " + b" ".join(words) + b" "
    found: set = set()
    ends: list[tuple[int, int]] = []
    at, n_words = 0, 0
    for end, (n, ids) in automaton.iter(norm.decode("latin-1")):
        n_words += norm.count(b" ", at, end)  # spaces before this match's closing one
        at = end
        found.update(ids)
        ends.append((n_words - n, n_words - 1))
    return merge_spans(ends), found


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def mark_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       window: int = 10, block_bytes: int = BLOCK_BYTES,
                       out: str = "hits") -> DataFrame:
    """``docs`` with a column ``out``: struct(n_words, spans, items).

    ``spans`` are the merged runs of hit words as struct(first_word, last_word,
    first_byte, end_byte), words numbered from 0 and byte offsets into the
    UTF-8 bytes of the original text; ``items`` are the distinct ids (as
    strings, sorted) of the items with an occurring window.

    Null text has no words.  An empty benchmark, or items without words, hit
    nothing.  A null item id still marks words but is not listed.  Repeated
    rows of either table change nothing but the row count of ``docs``.  A
    column already called ``out`` is replaced.
    """
    docs = docs.drop(out)
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    span = StructType([StructField("first_word", IntegerType()), StructField("last_word", IntegerType()),
                       StructField("first_byte", IntegerType()), StructField("end_byte", IntegerType())])
    hit = StructType([StructField("n_words", LongType()), StructField("spans", ArrayType(span)),
                      StructField("items", ArrayType(StringType()))])
    schema = StructType([*docs.schema.fields, StructField(out, hit)])
    at = docs.columns.index(text_col)
    result, first, last = docs, True, None
    with Scratch(spark, "decontaminate") as scratch:
        blocks = benchmark_blocks(items, item_id_col, item_text_col, window, scratch, block_bytes)
        for i, windows in enumerate(blocks):
            if not first:  # the pass before, written; what it read can go
                result = scratch.table(result, f"pass{i}", arrow_rows=TEXT_ROWS)
                if last:
                    scratch.drop(last)
                last = f"pass{i}"
                sent.unpersist()
            sent = sc.broadcast(windows)

            def scan(batches, sent=sent, first=first):
                automaton = build_automaton(sent.value)
                for batch in releasing(batches):
                    texts = batch.column(at).cast(pa.binary()).to_pylist()
                    before = [None] * batch.num_rows if first else batch.column(batch.num_columns - 1).to_pylist()
                    hits = []
                    for t, old in zip(texts, before):
                        hits.append(_hits_of(t, automaton, old))
                    cols = list(batch.columns) if first else list(batch.columns)[:-1]
                    arr = pa.array(hits, type=_HIT)
                    yield pa.RecordBatch.from_arrays([*cols, arr], names=[*batch.schema.names[: len(cols)], out])

            result, first = result.mapInArrow(scan, schema), False
        if last:
            scratch.keep(last)
    if first:  # no window at all: still count words
        def count_only(batches):
            for batch in batches:
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                arr = pa.array([_hits_of(t, None, None) for t in texts], type=_HIT)
                yield pa.RecordBatch.from_arrays([*batch.columns, arr], names=[*batch.schema.names, out])

        result = docs.mapInArrow(count_only, schema)
    return result


_SPAN = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()),
                   ("first_byte", pa.int32()), ("end_byte", pa.int32())])
_HIT = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def _hits_of(text: bytes | None, automaton, old: dict | None) -> dict:
    words = alnum_words(text)
    spans, items = scan_words(words, automaton) if automaton is not None else ([], set())
    if old:
        spans = merge_spans(spans + [(s["first_word"], s["last_word"]) for s in old["spans"]])
        items = items | set(old["items"])
    return {"n_words": len(words), "spans": _with_bytes(text, words, spans), "items": sorted(items)}


def _with_bytes(text: bytes | None, words: list[bytes], spans: list[tuple[int, int]]) -> list[dict]:
    """Byte offsets of word spans: words are found one after the other in the
    lower-cased original, whose length is the same."""
    if not spans:
        return []
    import numpy as np

    from fieldlens.llm.common import WORDS

    b = np.frombuffer(text.translate(WORDS), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], b.view(np.int8), [0]])))
    starts, ends = edge[0::2], edge[1::2]
    return [{"first_word": a, "last_word": z, "first_byte": int(starts[a]), "end_byte": int(ends[z])}
            for a, z in spans]


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of contract op7: one row per document row."""
    marked = mark_contamination(docs.select("doc_id", "text"), items).drop("text")
    n_hit = F.aggregate("hits.spans", F.lit(0).cast("bigint"),
                        lambda a, s: a + s["last_word"] - s["first_word"] + 1)
    return marked.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without any benchmark window, columns unchanged."""
    name = fresh_name(docs, "hits")
    marked = mark_contamination(docs, items, out=name)
    return marked.filter(F.size(F.col(name)["spans"]) == 0).drop(name)
