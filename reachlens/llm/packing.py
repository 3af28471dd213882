"""Best-fit packing of token pieces into sequences by minimum bin slack.

Per bin, the largest piece left is joined by the combination of other pieces
that leaves the least slack: a subset-sum table over the available lengths, kept
as the bits of one integer, tells which sums can be reached. The combination is
removed and used as often as the counts allow. Only the histogram of lengths
(at most ``capacity`` rows, whatever the size of the data) is needed for that;
pieces are numbered within their length in parallel and look up their place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

CAPACITY = 2048
END_ID = 0
#: Words, and parts of words, whose ids a task remembers besides those of the texts at hand; more are looked up anew.
#: Every Python worker of an executor has such a memory.
WORDS = 500_000
#: Texts sent to a Python worker at once; whole partitions of long texts would fill its memory.
BATCH_ROWS = 512
#: Signs that stand after words; apostrophes and special tokens' signs are not among them.
TAIL = ".,!?;:&$%#*"
#: Letters below it stay letters in NFC and lower case; some above end in a mark then.
PLAIN_END = "\u0130"
#: Lower-case letters only, which the tokeniser neither changes nor cuts.
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


def halves(word: str) -> tuple[str, str]:
    """A word's stem and closing signs, which have their ids each for itself.

    The tokeniser always cuts between a plain letter or digit and one of TAIL,
    and lower-cases; only what is PLAIN then is lower-cased here, since special
    tokens are case-sensitive.
    """
    stem = word.rstrip(TAIL)
    if not (stem[-1:].isalnum() and stem[-1] < PLAIN_END):
        return word, ""
    low = stem.lower()
    return (low if low != stem and PLAIN(low) else stem), word[len(stem):]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, then from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(sorted({*range(0x100)} - own))}


class WordIds:
    """Ids of words as little-endian uint32 bytes.

    The tokeniser drops white space and never joins across it, so the ids of a
    text are those of its parts between spaces, one after the other. It leaves
    PLAIN parts as they are, so these go straight to its model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.ids: dict[str, bytes] = {}

    def learn(self, texts: list[list[str]]) -> None:
        seen = set().union(*texts)
        new = seen.difference(self.ids)
        if len(self.ids) + len(new) > WORDS:
            self.ids = {w: self.ids[w] for w in seen.intersection(self.ids)}
        plain = set(filter(PLAIN, new))
        new -= plain
        cut = list(map(halves, new))
        need = plain.union(*cut).difference(self.ids)
        self._encode_plain(list(filter(PLAIN, need)))
        self._encode([x for x in need if not PLAIN(x)])
        known = self.ids
        known.update([(w, known[a] + known[b]) for w, (a, b) in zip(new, cut, strict=True)])

    def _encode_plain(self, parts: list[str]) -> None:
        tokenize, letters = self.model.tokenize, self.letters
        for x in parts:
            found = tokenize(x if x.isascii() else x.encode().decode("latin-1").translate(letters))
            self.ids[x] = b"".join([t.id.to_bytes(4, "little") for t in found])

    def _encode(self, parts: list[str]) -> None:
        for i in range(0, len(parts), 4096):
            some = parts[i:i + 4096]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            at = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(some) + 1))
            raw = ids.tobytes()
            self.ids.update((x, raw[4 * a:4 * b]) for x, a, b in zip(some, at[:-1].tolist(), at[1:].tolist(), strict=True))

    def encode(self, parts: list[str]) -> bytes:
        return b"".join(map(self.ids.__getitem__, parts))


_KNOWN: dict[str, WordIds] = {}


def _tokenizer(path: str) -> WordIds:
    """One per Python worker: reading the vocabulary takes longer than a batch."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids_crc32 (and the ids, if asked for).

    A document's ids end with END_ID; only documents over ``capacity`` are cut.
    Null text counts as empty: its one piece is END_ID alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokenizer(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low in range(0, len(texts), 128):
                parts = [(t or "").replace("\n", " ").split(" ") for t in texts[low:low + 128].to_pylist()]
                known.learn(parts)
                rows, out = [], ([], [], [], [], [])
                for i, words in enumerate(parts, low):
                    raw = known.encode(words) + END_ID.to_bytes(4, "little")
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at:at + 4 * capacity]
                        rows.append(i)
                        for to, x in zip(out, (k, at // 4, len(own) // 4, zlib.crc32(own), own), strict=True):
                            to.append(x)
                cols = [ids.take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:4])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(out[4], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Copies by length of the available pieces that fill ``room`` best, longer pieces first."""
    reach, seen = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        seen.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left > 0:
            step = min(step, left)
            reach |= (reach << (length * step)) & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: dict[int, int] = {}
    for length, before in reversed(seen):
        while not before >> total & 1:
            out[length] = out.get(length, 0) + 1
            total -= length
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(copies by length in a bin, number of such bins) until no piece is left."""
    counts = {k: n for k, n in counts.items() if n}
    out = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        bin_ = fullest({k: n for k, n in counts.items() if n}, capacity - top)
        counts[top] += 1
        bin_[top] = bin_.get(top, 0) + 1
        times = min(counts[k] // n for k, n in bin_.items())
        out.append((bin_, times))
        for k, n in bin_.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (doc_id, piece, length, ...) with sequence_id and offset.

    Pieces are numbered within their length: within the task that wrote them,
    shifted by the counts of the tasks before. So no length, however many
    pieces it has, meets in one task. Lengths must be 1 to ``capacity``.
    """
    columns = cut.columns
    conf, size = cut.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = conf.get(size)
    conf.set(size, BATCH_ROWS)
    try:
        rows = stored(cut.withColumn("slot", F.spark_partition_id()), "pieces")
    finally:
        conf.set(size, usual)
    cells = stored(rows.groupBy("length", "slot").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    ahead = cells.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts, bases, copies, offsets = [], [], [], []
    used: dict[int, int] = dict.fromkeys(counts, 0)
    sequence = 0
    for bin_, times in plan(counts, capacity):
        offset = 0
        for length in sorted(bin_, reverse=True):
            starts.append((length << 44) + used[length])
            bases.append(sequence)
            copies.append(bin_[length])
            offsets.append(offset)
            used[length] += times * bin_[length]
            offset += length * bin_[length]
        sequence += times
    order = np.argsort(np.array(starts, np.int64), kind="stable")
    starts, bases, copies, offsets = (np.array(x, np.int64)[order] for x in (starts, bases, copies, offsets))

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy(np.int64) << 44) + rank.to_numpy(np.int64)
        i = np.searchsorted(starts, key, side="right") - 1
        turn, slot = np.divmod(key - starts[i], copies[i])
        return pd.DataFrame({"sequence_id": bases[i] + turn, "offset": offsets[i] + slot * length.to_numpy(np.int64)})

    place.__annotations__ = {"length": pd.Series, "rank": pd.Series, "return": pd.DataFrame}
    number = F.row_number().over(Window.partitionBy("length", "slot").orderBy("doc_id", "piece"))
    ranked = rows.withColumn("number", number).join(ahead, ["length", "slot"])
    placed = ranked.withColumn("p", F.pandas_udf(place, "sequence_id long, offset long")("length", F.col("ahead") + F.col("number") - 1))
    return placed.select(*columns, "p.sequence_id", "p.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, **names) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    Repeated rows are packed as often as they occur; an empty table gives no
    rows; other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    return pack(pieces(docs, tokenizer, capacity=capacity, with_ids=with_ids, **names), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary, little-endian uint32): pieces with ``ids`` put together."""
    at = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(at.alias("at")).select("sequence_id", F.aggregate("at", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
