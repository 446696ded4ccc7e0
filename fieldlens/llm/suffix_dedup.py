"""Repeated byte windows by minimizer anchors and a verified hash sort.

A byte is removed if a ``DEPTH``-byte string covering it also starts in a
document with a smaller id.  Only equality through ``DEPTH`` bytes counts, so no
byte order is made: anchors and hashes replace a most-significant-digit radix
sort's passes over the bytes.

1. A window's anchor is the ``GRAM`` bytes inside it with the
   smallest hash (leftmost on a tie).  Equal windows have equal anchors, and
   neighbouring windows mostly share theirs, so a run of windows is one entry.
   Anchors are dealt by their hash; an anchor found in one document only ends
   there with all its windows.
2. The windows of the remaining anchors are dealt by anchor as regions (a run
   of windows and its bytes once) and sorted by a 64-bit hash of their bytes,
   one slice of the hash range at a time.  Neighbours of equal hash are compared
   byte by byte, and sorted by their bytes if a hash collides, so equal groups
   are exactly the repeated windows; each group's smallest id decides.

Results go back to the text as runs of window starts.

Scale: texts are written once as compressed blocks and only those blocks move.
Per block an anchor, and a region, is one entry however many documents share
it, so a passage or group of copies in a third of all documents is one entry a
block.  An anchor whose distinct regions, summed over the blocks, can hold more
bytes than a part, or that stands in more than ``HOT`` blocks, has its windows
dealt one by one by their own bytes, which splits the differing surroundings of
a common passage over all tasks.  A task's part is a slice of the hash range,
sized by the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import TEXT_ROWS, free_shuffles, shuffle_buckets, table
from fieldlens.session import Scratch

DEPTH = 50
GRAM = 16
BLOCK_BYTES = 4 << 20
PART_BYTES = 4 << 20
HOT = 4096
REGION_BYTES = 2 * DEPTH - GRAM  # of the longest region of one anchor
_CHUNK = 48_000
_SLICE = 1 << 19
_BITS = 48


# ---- packed arrays -------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed byte planes (equal high bytes vanish)."""
    import zstandard

    out = [np.array([len(arrays), *(len(a) for a in arrays)], "<u8").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes, *types: str) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    k = int(np.frombuffer(raw, "<u8", 1)[0])
    sizes = np.frombuffer(raw, "<u8", k, 8).astype(int)
    at, out = 8 * (k + 1), []
    for n, t in zip(sizes, types):
        w = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * w
    return out


# ---- windows and anchors -------------------------------------------------

def _words64(buf: np.ndarray, n: int, offset: int = 0) -> np.ndarray:
    """The 8 bytes at every position as unsigned integers (unaligned view)."""
    return np.ndarray((n,), dtype="<u8", buffer=buf.data, offset=offset, strides=(1,))


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def _gram_hash(buf: np.ndarray, at: int, n: int) -> np.ndarray:
    """48-bit hashes of the grams starting at at .. at+n-1."""
    h = _words64(buf, n, at) * np.uint64(0xBF58476D1CE4E5B9)
    _mix(h)
    h += _words64(buf, n, at + GRAM - 8)
    _mix(h)
    h *= np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(64 - _BITS)


def window_runs(buf: np.ndarray, ends: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, anchor number) of the runs of windows that share an
    anchor, in documents laid end to end in ``buf`` (their ends in ``ends``).
    Anchors have the smallest hashes of their windows, so the number scrambles
    the hash again: slices of its range then hold equal shares."""
    n = len(buf) - depth + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, np.zeros(0, np.uint64)
    span = depth - GRAM + 1  # grams a window
    starts, lengths, hashes = [], [], []
    for c in range(0, n, _CHUNK):
        m = min(_CHUNK, n - c)
        key = (_gram_hash(buf, c, m + span - 1) << np.uint64(16)) | np.arange(m + span - 1, dtype=np.uint64)
        low, width = key, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: m], low[span - width: span - width + m])
        # windows that reach over a document's end do not count
        ok = np.ones(m, dtype=bool)
        first, last = np.searchsorted(ends, [c, c + m + depth], side="right")
        for e in ends[first:last + 1]:
            ok[max(0, e - depth + 1 - c): max(0, min(m, e - c))] = False
        change = np.ones(m, dtype=bool)
        change[1:] = (low[1:] != low[:-1]) | (ok[1:] != ok[:-1])
        s = np.flatnonzero(change)
        size = np.diff(np.append(s, m))
        good = ok[s]
        starts.append(s[good] + c)
        lengths.append(size[good])
        hashes.append(low[s[good]] >> np.uint64(16))
    number = np.concatenate(hashes) * np.uint64(0xD6E8FEB86659FD93) & np.uint64((1 << _BITS) - 1)
    return np.concatenate(starts), np.concatenate(lengths), number


def window_hash(buf: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """64-bit hashes of the windows starting at the given places."""
    n = len(buf) - 7
    w = _words64(buf, n)
    h = np.full(len(at), 7, dtype=np.uint64)
    for o in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]:
        h = _mix(h * np.uint64(0xBF58476D1CE4E5B9) + w[at + o])
    return _mix(h)


# ---- blocks --------------------------------------------------------------

def text_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, ids, known, ends, texts): about ``BLOCK_BYTES`` of documents a
    row; ``known`` is 0 where the id is null."""
    def run(batches):
        import zstandard

        made = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t or b"")
                if size >= BLOCK_BYTES or i == len(texts) - 1:
                    part = [x or b"" for x in texts[lo:i + 1]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                        pa.array([pack(np.array([x or 0 for x in ids[lo:i + 1]], "<i8"))], pa.binary()),
                        pa.array([pack(np.array([x is not None for x in ids[lo:i + 1]], "u1"))], pa.binary()),
                        pa.array([pack(np.cumsum([len(x) for x in part]).astype("<i8"))], pa.binary()),
                        pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(part))], pa.binary()),
                    ], names=["block", "ids", "known", "ends", "texts"])
                    made, lo, size = made + 1, i + 1, 0

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary")).mapInArrow(
        run, "block bigint, ids binary, known binary, ends binary, texts binary")


class Block:
    """A block's documents: ids, ends and the bytes laid end to end."""

    def __init__(self, ids: bytes, known: bytes, ends: bytes, texts: bytes):
        import zstandard

        self.ids, = unpack(ids, "<i8")
        self.known = unpack(known, "u1")[0].astype(bool)
        self.ends, = unpack(ends, "<i8")
        raw = zstandard.ZstdDecompressor().decompress(texts) if len(self.ends) and self.ends[-1] else b""
        self.buf = np.frombuffer(raw, np.uint8)

    def runs(self):
        """Runs of windows of documents with an id, and each run's document."""
        s, n, h = window_runs(self.buf, self.ends)
        doc = np.searchsorted(self.ends, s, side="right")
        ok = self.known[doc] if len(s) else np.zeros(0, bool)
        return s[ok], n[ok], h[ok], doc[ok]


def _part_edges(parts: int) -> np.ndarray:
    """First hash of each part of the 48-bit range."""
    return (np.arange(parts, dtype=np.uint64) * np.uint64((1 << _BITS) // parts)).astype(np.uint64)


def _block_anchors(b: Block) -> tuple[np.ndarray, ...]:
    """(anchor, smallest id, largest id, distinct regions) of a block's
    distinct anchors.  A region is told by its first and last window, which
    cover it."""
    s, n, h, doc = b.runs()
    if not len(h):
        return h, b.ids[:0], b.ids[:0], np.zeros(0, np.int64)
    region = np.empty(len(h), np.uint64)
    for i in range(0, len(h), _SLICE):
        at, size = s[i:i + _SLICE], n[i:i + _SLICE]
        region[i:i + _SLICE] = window_hash(b.buf, at) + np.uint64(0x9E3779B97F4A7C15) * _mix(
            window_hash(b.buf, at + size - 1) + size.astype(np.uint64))
    order = np.lexsort((region, h))
    h, ids, region = h[order], b.ids[doc[order]], region[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    at = np.flatnonzero(new)
    new[1:] |= region[1:] != region[:-1]
    return (h[at], np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at),
            np.add.reduceat(new.astype(np.int64), at))


def _anchor_rows(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, packed): a block's distinct anchors of one part with the
    smallest id and the distance to the largest id that hold them, and the
    number of their distinct regions."""
    edges = _part_edges(parts)

    def run(batches):
        for batch in batches:
            for block, *cols in zip(*(batch.column(i).to_pylist() for i in range(5))):
                h, low, high, regions = _block_anchors(Block(*cols))
                if not len(h):
                    continue
                cut = np.append(np.searchsorted(h, edges), len(h))
                full = np.flatnonzero(cut[1:] > cut[:-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), pa.array(np.full(len(full), block), pa.int64()),
                    pa.array([pack(h[cut[p]:cut[p + 1]], low[cut[p]:cut[p + 1]],
                                   (high - low)[cut[p]:cut[p + 1]],
                                   regions[cut[p]:cut[p + 1]].astype("<u4")) for p in full], pa.binary())],
                    names=["part", "block", "packed"])

    return blocks.mapInArrow(run, "part int, block bigint, packed binary")


def _shared_anchors(rows: pa.Table, hot: int, most: int) -> pa.Table:
    """Of one part: for each block, its anchors that stand in two documents or
    more (of any block), with a flag for those in more than ``hot`` blocks or
    with more than ``most`` distinct regions, summed over the blocks."""
    blocks = rows.column("block").to_pylist()
    got = [unpack(p, "<u8", "<i8", "<i8", "<u4") for p in rows.column("packed").to_pylist()]
    h = np.concatenate([g[0] for g in got])
    low = np.concatenate([g[1] for g in got])
    high = low + np.concatenate([g[2] for g in got])
    regions = np.concatenate([g[3] for g in got])
    src = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    order = np.argsort(h, kind="stable")
    hs = h[order]
    at = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
    n = np.diff(np.append(at, len(hs)))
    shared = np.minimum.reduceat(low[order], at) != np.maximum.reduceat(high[order], at)
    keep = order[np.repeat(shared, n)]
    large = (n > hot) | (np.add.reduceat(regions[order].astype(np.int64), at) > most)
    flag = np.repeat(large, n)[np.repeat(shared, n)]
    by = np.argsort(src[keep], kind="stable")
    keep, flag = keep[by], flag[by]
    cut = np.searchsorted(src[keep], np.arange(len(got) + 1))
    full = [i for i in range(len(got)) if cut[i + 1] > cut[i]]
    return pa.table({
        "block": pa.array([blocks[i] for i in full], pa.int64()),
        "shared": pa.array([pack(h[keep[cut[i]:cut[i + 1]]], flag[cut[i]:cut[i + 1]].astype("u1")) for i in full],
                           pa.binary())})


_REGION_TYPE = "kind string, part int, block bigint, packed binary, bytes binary"
_REGION = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("block", pa.int64()),
                     ("packed", pa.binary()), ("bytes", pa.binary())])


def _regions(texts: pa.Table, shared: pa.Table, parts: int) -> pa.Table:
    """Of one block: its distinct regions under shared anchors, dealt into
    parts (kind R: numbers, smallest ids, sizes, bytes), and where each region
    starts in the block (kind O: numbers, starts; windows a region)."""
    import zstandard

    if not texts.num_rows or not shared.num_rows:
        return _REGION.empty_table()
    row = texts.to_pylist()[0]
    b = Block(row["ids"], row["known"], row["ends"], row["texts"])
    got = [unpack(p, "<u8", "u1") for p in shared.column("shared").to_pylist()]
    known = np.concatenate([g[0] for g in got])
    flags = np.concatenate([g[1] for g in got])
    order = np.argsort(known)
    known, flags = known[order], flags[order]
    s, n, h, doc = b.runs()
    k = np.minimum(np.searchsorted(known, h), len(known) - 1)
    on = known[k] == h
    s, n, h, doc, hot = s[on], n[on], h[on], doc[on], flags[k[on]] > 0
    if hot.any():  # one region a window, dealt by the window's own bytes
        rep = np.repeat(np.flatnonzero(hot), n[hot])
        first = np.concatenate([np.arange(x) for x in n[hot]])
        s2 = s[rep] + first
        h2 = window_hash(b.buf, s2) >> np.uint64(64 - _BITS)
        cold = ~hot
        s, h, doc, n = (np.concatenate([s[cold], s2]), np.concatenate([h[cold], h2]),
                        np.concatenate([doc[cold], doc[rep]]), np.concatenate([n[cold], np.ones(len(s2), n.dtype)]))
    raw, ids = b.buf.tobytes(), b.ids[doc]
    number: dict[bytes, int] = {}
    where = np.array([number.setdefault(raw[a:z], len(number))
                      for a, z in zip(s.tolist(), (s + n + DEPTH - 1).tolist())], dtype=np.int64)
    if not len(where):
        return _REGION.empty_table()
    m = len(number)
    low = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(low, where, ids)
    first = np.full(m, len(where))
    np.minimum.at(first, where, np.arange(len(where)))
    part = np.searchsorted(_part_edges(parts), h[first], side="right") - 1
    kinds, parts_out, packed, data = ["O"], [-1], [pack(where.astype("<u4"), s.astype("<u4"))], []
    every = list(number)
    data.append(pack(np.array([len(x) - DEPTH + 1 for x in every], "<u4")))
    by = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], part[by][1:] != part[by][:-1]]))
    for rows in np.split(by, cut[1:]):
        texts_of = [every[i] for i in rows.tolist()]
        kinds.append("R")
        parts_out.append(int(part[rows[0]]))
        packed.append(pack(rows.astype("<u4"), low[rows], np.array([len(x) for x in texts_of], "<u4")))
        data.append(zstandard.ZstdCompressor(level=3).compress(b"".join(texts_of)))
    return pa.table({"kind": kinds, "part": pa.array(parts_out, pa.int32()),
                     "block": pa.array([row["block"]] * len(kinds), pa.int64()),
                     "packed": pa.array(packed, pa.binary()), "bytes": pa.array(data, pa.binary())})


def _sort_windows(buf: np.ndarray, at: np.ndarray, region: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each window (its place in ``buf``, its region; ``low`` is a region's
    id): whether an equal window has a smaller id.  One pass deals the windows
    by the top bits of their hash, so that only one slice is sorted at a time;
    equal hashes are then checked byte by byte."""
    h = np.concatenate([window_hash(buf, at[i:i + _SLICE]) for i in range(0, len(at), _SLICE)])
    digit = (h >> np.uint64(60)).astype(np.uint8)
    out = np.zeros(len(at), dtype=bool)
    for d in range(16):
        rows = np.flatnonzero(digit == d)
        if len(rows):
            out[rows] = _sort_slice(buf, at[rows], h[rows], low[region[rows]])
    return out


def _sort_slice(buf: np.ndarray, at: np.ndarray, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    order = np.argsort(h, kind="stable")
    hs = h[order]
    new = np.concatenate([[True], hs[1:] != hs[:-1]])
    view = np.lib.stride_tricks.sliding_window_view(buf, DEPTH)
    bad = [np.zeros(0, np.int64)]
    same = np.flatnonzero(~new)
    for lo in range(0, len(same), _SLICE // 4):
        i = same[lo:lo + _SLICE // 4]
        bad.append(i[(view[at[order[i]]] != view[at[order[i - 1]]]).any(axis=1)])
    bad = np.concatenate(bad)
    if len(bad):  # a hash collision: order those groups by their bytes
        group = np.cumsum(new) - 1
        for g in np.unique(group[bad]):
            rows = np.flatnonzero(group == g)
            keys = [view[at[order[r]]].tobytes() for r in rows]
            perm = sorted(range(len(rows)), key=keys.__getitem__)
            order[rows] = order[rows[perm]]
            keys = [keys[p] for p in perm]
            new[rows] = [True] + [keys[j] != keys[j - 1] for j in range(1, len(keys))]
    starts = np.flatnonzero(new)
    low = np.minimum.reduceat(ids[order], starts)
    out = np.empty(len(at), dtype=bool)
    out[order] = ids[order] > np.repeat(low, np.diff(np.append(starts, len(at))))
    return out


def _repeated(rows: pa.Table) -> pa.Table:
    """Of one part: for each block, (region, first window, windows) runs that
    also start in a document with a smaller id than the block's smallest."""
    import zstandard

    blocks = rows.column("block").to_pylist()
    got = [unpack(p, "<u4", "<i8", "<u4") for p in rows.column("packed").to_pylist()]
    raw = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in rows.column("bytes").to_pylist())
    buf = np.frombuffer(raw, np.uint8)
    number = np.concatenate([g[0] for g in got])
    low = np.concatenate([g[1] for g in got])
    size = np.concatenate([g[2] for g in got]).astype(np.int64)
    src = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    n = size - DEPTH + 1
    region = np.repeat(np.arange(len(n), dtype=np.int32), n)
    first = np.cumsum(n) - n  # number of a region's first window
    at = np.arange(len(region), dtype=np.int32)
    at += np.repeat((np.cumsum(size) - size - first).astype(np.int32), n)
    gone = _sort_windows(buf, at, region, low)
    del at
    edge = np.ones(len(region), dtype=bool)
    edge[1:] = (region[1:] != region[:-1]) | (gone[1:] != gone[:-1])
    at = np.flatnonzero(edge)
    length = np.diff(np.append(at, len(region)))
    at, length = at[gone[at]], length[gone[at]]
    offset = at - first[region[at]]
    which = src[region[at]]
    cut = np.searchsorted(which, np.arange(len(got) + 1))
    full = [i for i in range(len(got)) if cut[i + 1] > cut[i]]
    return pa.table({
        "block": pa.array([blocks[i] for i in full], pa.int64()),
        "runs": pa.array([pack(number[region[at[cut[i]:cut[i + 1]]]], offset[cut[i]:cut[i + 1]].astype("<u4"),
                               length[cut[i]:cut[i + 1]].astype("<u4")) for i in full], pa.binary())})


_SPAN = pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64())])


def _cut_block(texts: pa.Table, found: pa.Table, with_kept: bool) -> pa.Table:
    """Of one block: every document's removed spans and what is left."""
    fields = [("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept_sha256", pa.string())]
    if with_kept:
        fields.append(("kept", pa.binary()))
    schema = pa.schema(fields)
    if not texts.num_rows:
        return schema.empty_table()
    row = texts.to_pylist()[0]
    b = Block(row["ids"], row["known"], row["ends"], row["texts"])
    cover = np.zeros(len(b.buf) + 1, dtype=np.int32)

    def cut(start: np.ndarray, windows: np.ndarray) -> None:
        np.add.at(cover, start, 1)
        np.add.at(cover, start + windows + DEPTH - 1, -1)

    places = [r for r in found.to_pylist() if r["kind"] == "O"]
    if places:
        where, start = (x.astype(np.int64) for x in unpack(places[0]["packed"], "<u4", "<u4"))
        order = np.argsort(where, kind="stable")
        by, start = where[order], start[order]
        edges = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
        ids = b.ids[np.searchsorted(b.ends, start, side="right")]
        low = np.repeat(np.minimum.reduceat(ids, edges), np.diff(np.append(edges, len(by))))
        again = ids > low  # the block itself holds the region in a smaller document
        if again.any():
            size, = unpack(places[0]["bytes"], "<u4")
            cut(start[again], size.astype(np.int64)[by[again]])
        for r in found.to_pylist():
            if r["kind"] == "G":
                number, offset, length = (x.astype(np.int64) for x in unpack(r["packed"], "<u4", "<u4", "<u4"))
                first = np.searchsorted(by, number)
                n = np.searchsorted(by, number, side="right") - first
                rep = np.repeat(np.arange(len(number)), n)
                at = np.repeat(first, n) + np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
                cut(start[at] + offset[rep], length[rep])
    gone = np.cumsum(cover[:-1]) > 0
    raw = b.buf.tobytes()
    out: dict[str, list] = {f[0]: [] for f in fields}
    lo = 0
    for k, hi in enumerate(b.ends.tolist()):
        mask = gone[lo:hi]
        spans = []
        kept = raw[lo:hi]
        if mask.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            spans = [{"first_byte": int(a), "end_byte": int(z)} for a, z in zip(edge[0::2], edge[1::2])]
            kept = b.buf[lo:hi][~mask].tobytes()
        out["id"].append(int(b.ids[k]) if b.known[k] else None)
        out["n_bytes"].append(hi - lo)
        out["spans"].append(spans)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        if with_kept:
            out["kept"].append(kept)
        lo = hi
    return pa.table(out, schema=schema)


def repeated_spans(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                   with_kept: bool = False, hot: int = HOT, part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, n_bytes, spans, kept_sha256, kept with ``with_kept``) of every row.

    ``spans`` are the maximal removed runs as byte offsets; ``kept`` the other
    bytes joined (it may split a character).  Null text is empty.  Rows that
    repeat an id belong to that id: they never remove each other's bytes.  Rows
    with a null id neither lose nor cause removals.  An empty table gives no
    row; other columns are not read.
    """
    blocks = scratch.table(text_blocks(docs, id_col, text_col), "blocks", arrow_rows=TEXT_ROWS)
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("binary")).cast("bigint"))).head()[0] or 0
    parts = max(shuffle_buckets(docs.sparkSession), -(-int(total) // part_bytes))
    shared = scratch.table(
        _anchor_rows(blocks, parts).groupBy("part").applyInArrow(
            lambda t: _shared_anchors(t, hot, part_bytes // REGION_BYTES), "block bigint, shared binary"), "shared")
    free_shuffles(docs.sparkSession)
    regions = scratch.table(
        blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
            lambda a, b: _regions(a, b, parts), _REGION_TYPE), "regions")
    scratch.drop("shared")
    free_shuffles(docs.sparkSession)  # the text's and the anchors'
    found = scratch.table(
        regions.filter("kind = 'R'").groupBy("part").applyInArrow(_repeated, "block bigint, runs binary"), "found")
    free_shuffles(docs.sparkSession)  # the regions'
    back = regions.filter("kind = 'O'").select("block", "kind", "packed", "bytes").unionByName(
        found.select("block", F.lit("G").alias("kind"), F.col("runs").alias("packed"),
                     F.lit(None).cast("binary").alias("bytes")))
    kind = "id bigint, n_bytes bigint, spans array<struct<first_byte:bigint,end_byte:bigint>>, kept_sha256 string"
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        lambda a, b: _cut_block(a, b, with_kept), kind + ", kept binary" * with_kept).withColumnRenamed("id", id_col)


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What window dedup leaves of every document."""
    with Scratch(spark, "op9") as scratch:
        spans = repeated_spans(table(spark, sf_dir, "documents"), scratch)
        out = scratch.table(spans.select(
            "doc_id", "n_bytes",
            F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end_byte"] - s["first_byte"]).alias("n_removed"),
            F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"), "out")
        scratch.keep("out")
        return out
