"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

A byte goes if a string of LENGTH bytes that covers it also starts in a document
with a smaller id. Sorting a suffix for each byte is not needed: of each string
only the K-byte substring with the smallest hash is an anchor, so equal strings
have equal anchors in the same place, about one in 18 bytes. Anchors whose
substring occurs in no other document (most) are dropped first.

The suffix of an anchor is the bytes from it on, then those before it, back to
front, each as far as a string over the anchor can reach. Suffixes are sorted
in each pack of documents, front-coded (length of the prefix shared with the one
before, and the rest), exchanged by hash bucket of the anchor and merged by a
loser tree that knows each suffix's common prefix with the last one put out, so
prefixes known to be equal are not compared again. In merged order equal
suffixes are neighbours, and the common prefix of neighbours bounds how far any
other suffix agrees; strings are compared only where that is enough. All
comparisons are of bytes; hashes only choose anchors and buckets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

LENGTH, K = 50, 16
WINDOWS = LENGTH - K + 1
LEFT = WINDOWS - 1
WIDTH = LENGTH + LEFT
#: Bytes of text that are worked on at a time; a longer document is a pack of its own.
PACK_BYTES = 2 << 20
#: At up to 512 packs; more with more.
BUCKET_BITS = 9
#: Place holder for bytes beyond a document's ends; not in any UTF-8 text.
OUTSIDE = 0xFF
FULL = np.uint64(1 << 63)
NO_ID = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15
#: Spreads anchors over the buckets: their own hashes are the least of many, so most share their first bits.
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SQUEEZE, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the K bytes (a power of two) from each place on."""
    h, size, power = data.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB), 1, _BASE
    while size < K:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = size * 2, power * power % (1 << 64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, of) -> np.ndarray:
    cur, size = values, 1
    while size * 2 <= width:
        cur, size = of(cur[:-size], cur[size:]), size * 2
    n = len(values) - width + 1
    return of(cur[:n], cur[width - size:width - size + n]) if size < width else cur


def anchors(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of documents that lie one after the other in ``data``."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _hashes(data)
    least = _sliding(h, WINDOWS, np.minimum)
    ends = np.cumsum(lengths)
    valid = np.ones(len(least) + 1, bool)
    for low, high in zip(np.maximum(ends - lengths, ends - LENGTH + 1).tolist(), ends.tolist(), strict=True):
        valid[max(low, 0):high] = False  # strings that would pass the document's end
    least[~valid[:len(least)]] = 0
    edge = np.zeros(WINDOWS - 1, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), WINDOWS, np.maximum)[:len(h)]
    at = np.flatnonzero(chosen == h)
    return at, h[at]


def packs(docs: DataFrame, id_col: str, text_col: str, pack_bytes: int) -> DataFrame:
    """Rows pack, ids, lengths, data (compressed): documents in pieces of work."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                                               pa.array([squeeze.compress(b"".join(texts))], pa.binary())], ["pack", "ids", "lengths", "data"])

        for batch in batches:
            for one, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text or b""
                if texts and size + len(raw) > pack_bytes:
                    yield full()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(one)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield full()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(fill, "pack long, ids array<long>, lengths array<long>, data binary")


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lengths, ids) of a pack; no id is the largest."""
    data = np.frombuffer(_OPEN.decompress(row["data"], max_output_size=max(1, int(sum(row["lengths"])))), np.uint8)
    return data, np.array(row["lengths"], np.int64), np.array([NO_ID if x is None else x for x in row["ids"]], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _cells(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, 32-bit rest) of the hashes, spread and sorted, as one number, their first index by bucket, and each hash's index."""
    distinct, inverse = np.unique(h * _SPREAD >> np.uint64(32 - bits), return_inverse=True)
    return distinct, np.searchsorted(distinct, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)), inverse


def shared(packed: DataFrame, bits: int) -> DataFrame:
    """pack, found: for its distinct anchor hashes, whether another pack has them (bits by bucket)."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data, lengths, _ = _opened(row)
            distinct, first, _ = _cells(anchors(data, lengths)[1], bits)
            rest = distinct.astype("<u4")
            some = [b for b in range(1 << bits) if first[b] < first[b + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([row["pack"]] * len(some), pa.int64()),
                                              pa.array([rest[first[b]:first[b + 1]].tobytes() for b in some], pa.binary())], ["bucket", "pack", "run"])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, "<u4") for x in group["run"]]
        every = np.concatenate(own)
        ordered = np.sort(every)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        return pd.DataFrame({"pack": group["pack"], "bucket": group["bucket"], "hit": [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in own]})

    cells = packed.mapInArrow(runs, "bucket int, pack long, run binary").groupBy("bucket").applyInPandas(compare, "pack long, bucket int, hit binary")
    return cells.groupBy("pack").agg(F.collect_list(F.struct("bucket", "hit")).alias("found"))


def _suffixes(data: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes (rows of WIDTH bytes), the bytes there are before and from the anchor on, and the documents' indices."""
    ends = np.cumsum(lengths)
    doc = np.searchsorted(ends, at, side="right")
    before, after = np.minimum(at - (ends - lengths)[doc], LEFT), np.minimum(ends[doc] - at, LENGTH)
    out = np.empty((len(at), WIDTH), np.uint8)
    for k, shift in enumerate([*range(LENGTH), *range(-1, -1 - LEFT, -1)]):  # places of all columns at once would take eight times as much
        out[:, k] = data[np.clip(at + shift, 0, len(data) - 1)]
    out[:, :LENGTH][np.arange(LENGTH) >= after[:, None]] = OUTSIDE
    out[:, LENGTH:][np.arange(LEFT) >= before[:, None]] = OUTSIDE
    return out, before, after, doc


def front_coded(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(prefix shared with the row before, rests) of sorted rows."""
    lcp = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return lcp, rows[np.arange(rows.shape[1]) >= lcp[:, None]].tobytes()


def decoded(lcp: list[int], rests: bytes, width: int = WIDTH) -> list[bytes]:
    out, last, at = [], b"", 0
    for n in lcp:
        last = last[:n] + rests[at:at + width - n]
        at += width - n
        out.append(last)
    return out


def merged(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, index, common prefix with the one before) of all strings in order, by a loser tree.

    ``known[r]`` is the common prefix of run r's next string with the last one
    put out. Of two strings the one that shares more with it is the smaller; only
    if both share as much are they compared, from there on.
    """
    k = len(runs)
    size = 1 << max(0, (k - 1).bit_length())
    heads = [r[0][0] if r[0] else None for r in runs] + [None] * (size - k)
    known = [0 if h is not None else -1 for h in heads]
    index = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix becomes that with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        p = known[a]
        if p < 0:
            return a, b
        x, y = heads[a], heads[b]
        if x == y:
            known[b] = len(y)
            return a, b
        u, v = int.from_bytes(x[p:]), int.from_bytes(y[p:])
        if u > v:
            a, b = b, a
        known[b] = len(x) - ((u ^ v).bit_length() + 7) // 8
        return a, b

    tree = [0] * size
    level = list(range(size))
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            win, tree[(len(level) + i) // 2] = play(level[i], level[i + 1])
            up.append(win)
        level = up
    w = level[0]
    while known[w] >= 0:
        i = index[w]
        yield w, i, known[w]
        index[w] = i = i + 1
        strings, prefixes = runs[w]
        if i < len(strings):
            heads[w], known[w] = strings[i], prefixes[i]
        else:
            known[w] = -1
        node = (size + w) >> 1
        while node:
            w, tree[node] = play(w, tree[node])
            node >>= 1


def covered(rows: np.ndarray, lcp: np.ndarray, before: np.ndarray, after: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For sorted suffixes, which strings over the anchor also start in a document with a smaller id.

    Bit l: the string that starts l bytes before the anchor; FULL: all there are.
    """
    out = np.zeros(len(rows), np.uint64)
    if not len(rows):
        return out
    head = np.flatnonzero(lcp < WIDTH)
    kind = np.cumsum(lcp < WIDTH) - 1
    least = np.minimum.reduceat(docs, head)
    out[docs > least[kind]] = FULL
    # distinct suffixes; the furthest that any other agrees from the anchor on
    near = np.minimum(lcp[head].astype(np.int64), LENGTH)
    reach = np.maximum(near, np.append(near[1:], 0))
    own = np.zeros(len(head), np.uint64)
    here, left, right = rows[head], before[head], after[head]
    for l in range(LEFT + 1):  # noqa: E741
        pick = np.flatnonzero((reach >= LENGTH - l) & (left >= l) & (right >= LENGTH - l))
        if len(pick) < 2:
            continue
        text = np.ascontiguousarray(np.concatenate([here[pick][:, :LENGTH - l], here[pick][:, LENGTH:LENGTH + l]], axis=1))
        order = _order(text)
        ordered = text[order]
        new = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))
        lowest = np.minimum.reduceat(least[pick][order], np.flatnonzero(new))[np.cumsum(new) - 1]
        hit = pick[order][least[pick][order] > lowest]
        own[hit] |= np.uint64(1 << l)
    lead = out == 0
    out[lead] = own[kind[lead]]
    return out


def _order(text: np.ndarray) -> np.ndarray:
    """Order that brings equal rows together; as fixed-width strings, with a last byte that is not zero."""
    wide = np.concatenate([text, np.ones((len(text), 1), np.uint8)], axis=1)
    return np.argsort(wide.view(f"S{wide.shape[1]}").ravel(), kind="stable")


def _blob(*arrays: np.ndarray, rests: bytes = b"") -> bytes:
    return _SQUEEZE.compress(b"".join(a.tobytes() for a in arrays) + rests)


def suffix_runs(packed: DataFrame, bits: int) -> DataFrame:
    """Sorted, front-coded runs: kind 0, bucket, pack, n, run. Kind 1: what is settled within the pack (place, mask).

    Of equal suffixes in a pack only those of the smallest id travel.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data, lengths, ids = _opened(row)
            at, h = anchors(data, lengths)
            distinct, first, inverse = _cells(h, bits)
            hit = np.zeros(len(distinct), bool)
            for x in row["found"] or []:
                low, high = first[x["bucket"]], first[x["bucket"] + 1]
                hit[low:high] = np.unpackbits(np.frombuffer(x["hit"], np.uint8), count=high - low).astype(bool)
            doc = np.searchsorted(np.cumsum(lengths), at, side="right")
            low = np.full(len(distinct), len(lengths))
            high = np.full(len(distinct), -1)
            np.minimum.at(low, inverse, doc)
            np.maximum.at(high, inverse, doc)
            use = (hit | (low < high))[inverse]
            at, bucket = at[use], (distinct >> np.uint64(32)).astype(np.int64)[inverse[use]]
            if not len(at):
                continue
            rows, before, after, doc = _suffixes(data, lengths, at)
            order = _order(rows)
            order = order[np.argsort(bucket[order], kind="stable")]
            rows, before, after, own, at, bucket = rows[order], before[order], after[order], ids[doc[order]], at[order], bucket[order]
            same = np.append(False, (rows[1:] == rows[:-1]).all(axis=1))
            head = np.flatnonzero(~same)
            least = np.minimum.reduceat(own, head)[np.cumsum(~same) - 1]
            done = own > least
            out = [(1, row["pack"] % (1 << bits), row["pack"], int(done.sum()), _blob(at[done].astype("<i8"), np.full(int(done.sum()), FULL).astype("<u8")))]
            edges = np.searchsorted(bucket[~done], np.arange((1 << bits) + 1))
            rows, before, after, own, at = (x[~done] for x in (rows, before, after, own, at))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                s = slice(edges[b], edges[b + 1])
                lcp, rests = front_coded(rows[s])
                out.append((0, b, row["pack"], len(lcp), _blob(own[s].astype("<i8"), at[s].astype("<i8"), lcp, before[s].astype(np.uint8), after[s].astype(np.uint8), rests=rests)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["kind", "bucket", "pack", "n", "run"])

    return packed.mapInArrow(make, "kind int, bucket int, pack long, n long, run binary")


def merge_runs(group: pd.DataFrame) -> pd.DataFrame:
    """All runs of a bucket merged; pack, n, run (place, mask) of the strings found. Settled rows pass through."""
    settled, group = group.loc[group["kind"] == 1, ["pack", "n", "run"]], group[group["kind"] == 0]
    if group.empty:
        return settled
    own, at, before, after, runs = [], [], [], [], []
    for n, blob in zip(group["n"], group["run"], strict=True):
        raw = _OPEN.decompress(blob, max_output_size=int(n) * (19 + WIDTH))
        own.append(np.frombuffer(raw, "<i8", n))
        at.append(np.frombuffer(raw, "<i8", n, 8 * n))
        lcp, b, a = np.frombuffer(raw, np.uint8, 3 * n, 16 * n).reshape(3, n)
        before.append(b)
        after.append(a)
        prefixes = lcp.tolist()
        runs.append((decoded(prefixes, raw[19 * n:]), prefixes))
    starts = np.concatenate([[0], np.cumsum(group["n"])[:-1]])
    order = np.fromiter((r << 40 | i << 8 | known for r, i, known in merged(runs)), np.int64, int(group["n"].sum()))
    which, number, lcp = order >> 40, order >> 8 & 0xFFFFFFFF, (order & 0xFF).astype(np.uint8)
    text = np.frombuffer(b"".join(runs[r][0][i] for r, i in zip(which.tolist(), number.tolist(), strict=True)), np.uint8).reshape(-1, WIDTH)
    runs.clear()
    flat = starts[which] + number
    masks = covered(text, lcp, np.concatenate(before)[flat].astype(np.int64), np.concatenate(after)[flat].astype(np.int64), np.concatenate(own)[flat])
    hit = masks != 0
    place, masks, which = np.concatenate(at)[flat][hit], masks[hit], which[hit]
    out = [(int(group["pack"].iloc[r]), int((which == r).sum()), _blob(place[which == r].astype("<i8"), masks[which == r].astype("<u8"))) for r in np.unique(which).tolist()]
    return pd.concat([pd.DataFrame(out, columns=["pack", "n", "run"]), settled])


def _removed(data: np.ndarray, lengths: np.ndarray, runs: list[dict]) -> np.ndarray:
    """Which bytes go."""
    change = np.zeros(len(data) + 1, np.int64)
    ends = np.cumsum(lengths)
    for x in runs or []:
        n = x["n"]
        if not n:
            continue
        raw = _OPEN.decompress(x["run"], max_output_size=16 * n)
        at, mask = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u8", n, 8 * n)
        full = at[mask & FULL != 0]
        doc = np.searchsorted(ends, full, side="right")
        np.add.at(change, np.maximum(full - LEFT, (ends - lengths)[doc]), 1)
        np.add.at(change, np.minimum(full + LENGTH, ends[doc]), -1)
        for l in range(LEFT + 1):  # noqa: E741
            some = at[(mask & FULL == 0) & (mask >> np.uint64(l) & np.uint64(1) != 0)] - l
            np.add.at(change, some, 1)
            np.add.at(change, some + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES, bucket_bits: int = BUCKET_BITS, with_kept: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the bytes kept).

    Null text is empty. A null id counts as larger than any other, so such rows
    remove nothing anywhere, and nothing of each other's. Rows that share an id
    remove nothing from each other. Texts under LENGTH bytes stay whole. A cut
    may fall within a character, so what is kept is bytes.
    """
    prepare(docs.sparkSession)
    packed = stored(packs(docs, id_col, text_col, pack_bytes), "packs")
    # four times the packs give twice the buckets, and runs twice as short
    bits = bucket_bits + max(0, math.ceil(math.log2(max(packed.count(), 1) / 512) / 2))
    found = stored(shared(packed, bits), "shared-anchors")
    runs = suffix_runs(packed.join(found, "pack", "left"), bits)
    spans = runs.groupBy("bucket").applyInPandas(merge_runs, "pack long, n long, run binary")
    spans = stored(spans.groupBy("pack").agg(F.collect_list(F.struct("n", "run")).alias("runs")), "repeat-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data, lengths, _ = _opened(row)
            gone = _removed(data, lengths, row["runs"])
            out, low = [], 0
            for one, n in zip(row["ids"], lengths.tolist(), strict=True):
                mine, kept = gone[low:low + n], data[low:low + n]
                if (removed := int(mine.sum())):
                    kept = kept[~mine]
                kept = kept.tobytes()
                n_spans = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum()) if removed else 0
                out.append((one, n, removed, n_spans, hashlib.sha256(kept).hexdigest(), kept)[:5 + with_kept])
                low += n
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[:5 + with_kept]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_kept])

    return packed.join(spans, "pack", "left").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)
