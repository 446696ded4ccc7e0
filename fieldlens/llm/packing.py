"""Sequence packing by length patterns fitted with non-negative least squares.

1. Documents become token pieces of at most ``size`` tokens (Python tasks).
2. One aggregate gives the histogram of piece lengths: at most ``size`` rows.
3. On the histogram alone: patterns of up to four length bins that fill a
   sequence are enumerated (a bin stands in many of them), their repeat counts
   fitted by non-negative least squares, rounded down and filled with real
   lengths; what is left is packed best-fit by decreasing length into the
   patterns' gaps and into new sequences.  This is done on a few grids of bins
   and the plan with the fewest sequences stays.  Equal
   sequences are kept as (first sequence, count), so the work depends on the
   number of lengths, not on the number of documents.
4. Lengths and row numbers alone are ranked within each length (in slices, no
   whole length in one task) and look their sequence and offset up in the plan;
   both join the pieces by row number, so token ids neither meet by length in
   one task nor pass through a Python worker again.
"""

from __future__ import annotations

import zlib
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import STAGE_ROWS, fresh_name, named, rank_in_groups, releasing, table
from fieldlens.session import Scratch

SIZE = 2048
# (bins, most parts of a pattern, shortest part as a share of the size)
GRIDS = ((64, 4, 1 / 5), (64, 4, 1 / 16), (128, 3, 1 / 8), (256, 3, 1 / 8))
CACHE_WORDS = 1_000_000

_ENCODERS: dict[str | None, WordEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordEncoder(dict):
    """Word -> token ids (little-endian unsigned 32-bit), filled on demand.

    For a tokenizer whose pre-tokens never span a space or line break (such as
    the default one), a text's ids are its words' ids one after the other.
    A word of Latin letters is one pre-token: its ids come straight from the
    tokenizer's model; anything else takes the whole tokenizer.  The table is
    emptied when it holds ``CACHE_WORDS`` words.
    """

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path or default_tokenizer())
        self.model = self.tok.model
        self.chars = byte_chars()

    def __missing__(self, w: str) -> bytes:
        if len(w) > 1 and w[-1] in ".," and self.plain(w[:-1]):
            ids = self[w[:-1]] + self[w[-1]]
        elif self.plain(w):
            low = w.lower()
            if not low.isascii():
                low = "".join([self.chars[b] for b in low.encode()])
            ids = np.array([t.id for t in self.model.tokenize(low)], dtype="<u4").tobytes()
        else:
            ids = np.array(self.tok.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[w] = ids
        return ids

    @staticmethod
    def plain(w: str) -> bool:
        """Only letters that are single code points in normal form and change
        case one to one (Latin, without the dotted capital I)."""
        return w.isalpha() and (w.isascii() or (max(w) < "\u0180" and "\u0130" not in w))


def encode_bytes(texts: list[str | None], tokenizer_path: str | None = None) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit bytes."""
    ids = _ENCODERS.get(tokenizer_path)
    if ids is None:
        ids = _ENCODERS[tokenizer_path] = WordEncoder(tokenizer_path)
    if len(ids) > CACHE_WORDS:
        ids.clear()
    return [b"".join([ids[w] for w in (t or "").replace("\n", " ").split(" ")]) for t in texts]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SIZE, end_id: int = 0, tokenizer_path: str | None = None,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and the ids as
    bytes with ``with_ids``).  A document is its token ids and ``end_id``;
    null or empty text gives the end id alone.  Only documents longer than
    ``size`` tokens are cut."""
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = f"{id_col} {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches):
        for batch in releasing(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            src, piece, start, length, crc, raw = [], [], [], [], [], []
            for lo in range(0, len(texts), 256):
                for k, b in enumerate(encode_bytes(texts[lo:lo + 256], tokenizer_path), lo):
                    b += end
                    for j, a in enumerate(range(0, len(b), 4 * size)):
                        part = b[a:a + 4 * size]
                        src.append(k)
                        piece.append(j)
                        start.append(a // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            raw.append(part)
            cols = [ids.take(pa.array(src, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(raw, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(id_col, text_col).mapInArrow(cut, fields + ", ids binary" * with_ids)


def nnls(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x >= 0 minimising |a x - y| by an active set: add the most useful
    column, solve on the chosen ones, drop those that turn negative.  It ends
    when no column helps or the residual no longer falls."""
    x = np.zeros(a.shape[1])
    on = np.zeros(a.shape[1], dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(y).max(initial=0)))
    best_x, best_norm = x.copy(), float(y @ y)
    while True:
        gain = a.T @ (y - a @ x)
        gain[on] = 0
        best = int(np.argmax(gain)) if gain.size else 0
        if not gain.size or gain[best] <= tol:
            break
        on[best] = True
        while on.any():
            idx = np.flatnonzero(on)
            s = np.linalg.lstsq(a[:, idx], y, rcond=None)[0]
            if s.min() > tol:
                x[:] = 0
                x[idx] = s
                break
            low = s <= tol
            cur = x[idx]
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.where(low, cur / np.maximum(cur - s, 1e-300), np.inf).min()
            x[idx] = cur + min(1.0, step) * (s - cur)
            drop = idx[(x[idx] <= tol) & low]
            drop = drop if drop.size else idx[low]
            x[drop] = 0
            on[drop] = False
        r = y - a @ x
        if float(r @ r) >= best_norm * (1 - 1e-12):
            break
        best_x, best_norm = x.copy(), float(r @ r)
    return best_x


def bin_patterns(bins: int, parts: int) -> list[tuple[int, ...]]:
    """All patterns of 1 to ``parts`` length bins (1..bins) that sum to the
    whole, largest first."""
    out = []
    for k in range(1, parts + 1):
        for head in combinations_with_replacement(range(bins, 0, -1), k - 1):
            last = bins - sum(head)
            if last >= 1 and (not head or last <= head[-1]):
                out.append((*head, last))
    return out


class Plan:
    """Where the pieces of each length go: slots (length, first rank, count,
    first sequence, offset), with ranks gapless from 0 in each length.
    ``fitted`` counts the pieces that the patterns placed."""

    def __init__(self):
        self.slots: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = {}
        self.sequences = 0
        self.fitted = 0

    def put(self, length: int, count: int, first_seq: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.slots.append((length, rank, count, first_seq, offset))
        self.used[length] = rank + count


def plan_packing(histogram: dict[int, int], size: int = SIZE, grids=GRIDS) -> Plan:
    """Pack ``histogram`` (length -> count) into sequences of ``size``: of the
    plans of all ``grids`` the one with the fewest sequences, then with the
    most pieces placed by patterns."""
    return min((_plan_on_grid(histogram, size, *g) for g in grids), key=lambda p: (p.sequences, -p.fitted))


def _plan_on_grid(histogram: dict[int, int], size: int, bins: int, parts: int, least: float) -> Plan:
    plan = Plan()
    left = {k: int(v) for k, v in histogram.items() if v > 0}
    gaps: list[list[list[int]]] = [[] for _ in range(size + 1)]  # room -> [first sequence, count]
    width = -(-size // bins)
    in_bin: dict[int, list[int]] = {}
    for length in sorted(left, reverse=True):
        in_bin.setdefault(-(-length // width), []).append(length)
    counts = np.zeros(bins)
    for b, ls in in_bin.items():
        counts[b - 1] = sum(left[x] for x in ls)
    low = int(bins * least)
    pats = [p for p in bin_patterns(bins, parts) if p[-1] > low and all(b in in_bin for b in p)]
    if pats:
        a = np.zeros((bins, len(pats)))
        for j, p in enumerate(pats):
            for b in p:
                a[b - 1, j] += 1
        repeats = np.floor(nnls(a, counts) + 1e-6).astype(np.int64)
        for j in np.argsort(-np.array([p[0] for p in pats]), kind="stable"):
            _fill_pattern(plan, pats[j], int(repeats[j]), in_bin, left, gaps, size, width)
        plan.fitted = sum(plan.used.values())
    for length in sorted(left, reverse=True):  # best fit, decreasing
        _best_fit(plan, length, left[length], gaps, size)
    return plan


def _fill_pattern(plan: Plan, pattern, repeat: int, in_bin, left, gaps, size: int, width: int) -> None:
    """``repeat`` sequences of the pattern, as far as the lengths last: each
    bin is served from its longest remaining length that fits, and the last
    member is the longest from its bin on that still fits, so that little room
    is lost to the bins' width."""
    while repeat > 0:
        chosen: list[int] = []
        for i, b in enumerate(pattern):
            room = size - sum(chosen)
            pool = range(room, (b - 1) * width, -1) if i and i == len(pattern) - 1 else in_bin[b]
            pick = next((x for x in pool if x <= room and left.get(x, 0) > chosen.count(x)), None)
            if pick is None:
                return
            chosen.append(pick)
        m = min(repeat, min(left[x] // chosen.count(x) for x in set(chosen)))
        at = 0
        for x in chosen:
            plan.put(x, m, plan.sequences, at)
            left[x] -= m
            at += x
        if at < size:
            gaps[size - at].append([plan.sequences, m])
        plan.sequences += m
        repeat -= m


def _best_fit(plan: Plan, length: int, count: int, gaps, size: int) -> None:
    room = length
    while count > 0:
        while room <= size and not gaps[room]:
            room += 1
        if room > size:
            break
        first, have = gaps[room].pop()
        m = min(count, have)
        if have > m:
            gaps[room].append([first + m, have - m])
        plan.put(length, m, first, size - room)
        if room > length:
            gaps[room - length].append([first, m])
        count -= m
        if room - length >= length:
            room = length  # the new gap may take this length again, and fits better
    per = size // length
    for m, k in ((count // per, per), (1, count % per)):
        if m and k:
            for i in range(k):
                plan.put(length, m, plan.sequences, i * length)
            if size - k * length:
                gaps[size - k * length].append([plan.sequences, m])
            plan.sequences += m


def place(pieces: DataFrame, plan: Plan, row: str) -> DataFrame:
    """``pieces`` (written table, its rows numbered in ``row``) with sequence_id
    and offset from the plan, without the numbers."""
    by_length: dict[int, tuple] = {}
    for length in plan.used:
        by_length[length] = ([], [], [])
    for length, rank, _, seq, at in plan.slots:  # ranks ascend within a length
        for store, v in zip(by_length[length], (rank, seq, at)):
            store.append(v)
    sent = pieces.sparkSession.sparkContext.broadcast(
        {k: tuple(np.asarray(x, dtype=np.int64) for x in v) for k, v in by_length.items()})
    ranked = rank_in_groups(pieces.select(row, "length"), ["length"], [row], "rank")
    at_row, at_length, at_rank = (ranked.columns.index(c) for c in (row, "length", "rank"))

    def look_up(batches):
        slots = sent.value
        for batch in batches:
            lengths = batch.column(at_length).to_numpy(zero_copy_only=False)
            ranks = batch.column(at_rank).to_numpy(zero_copy_only=False)
            seq, off = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for x in np.unique(lengths):
                rows = np.flatnonzero(lengths == x)
                first, s, o = slots[int(x)]
                k = np.searchsorted(first, ranks[rows], side="right") - 1
                seq[rows] = s[k] + ranks[rows] - first[k]
                off[rows] = o[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(at_row), pa.array(seq), pa.array(off)], names=[row, "sequence_id", "offset"])

    placed = ranked.mapInArrow(look_up, f"`{row}` bigint, sequence_id bigint, offset bigint")
    return pieces.join(placed, row).select(
        *(named(c) for c in pieces.columns if c != row), "sequence_id", "offset")


def pack_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SIZE, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per token piece with its sequence and offset.

    Null and empty texts are one end token; texts of any length are cut into
    ``size``-token pieces; repeated rows are packed as often as they occur
    (their pieces are alike, so which copy sits where is free); null ids pass
    through; an empty table gives no row.  Extra columns are not read.  Pieces
    are ranked by a stored row number, so copies spread over the slices.  The
    result reads the scratch table ``pieces``.
    """
    cut = token_pieces(docs, id_col, text_col, size, 0, tokenizer_path, with_ids)
    row = fresh_name(cut, "__row")
    pieces = scratch.table(cut.withColumn(row, F.monotonically_increasing_id()), "pieces", arrow_rows=STAGE_ROWS)
    hist = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # <= size rows
    return place(pieces, plan_packing(hist, size), row)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    with Scratch(spark, "op6") as scratch:
        out = scratch.table(pack_documents(table(spark, sf_dir, "documents"), scratch), "out")
        scratch.keep("out")
        return out
