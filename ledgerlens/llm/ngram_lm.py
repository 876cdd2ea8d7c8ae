"""Language-model scores from a log-frequency Bloom filter of quantised bigram counts.

Training counts words and word pairs of all training documents; partial counts travel packed, by hash of the pair, and
meet in as many partitions as the session shuffles to. A pair with count c enters the filter once for each level 1 to
1 + floor(log2 c); scoring probes level after level until one is missing and takes the level's mean count. Level 1 uses more
hash functions than the others, as a false level 1 costs most.

Smoothing is Witten-Bell of strength s: P(w|h) = (c(h,w) + s T(h) P(w)) / (c(h) + s T(h)), with T(h) the number of
different words after h and P(w) = (c(w) + 1) / (N + V + 1), the contract's base. A document's first history is a start mark.

Memory: words (10 bytes each, and 12 for each number over 254) and the filter (about 12 bits a pair) are broadcast in blocks of at most
`block_mb`, a copy for each Python worker; the driver holds one block at a time and sees each word once. What fits in one block is scored in one pass; beyond it documents pass once for each block, with each token's
word counts written in between, and pairs are dealt to blocks by history so that each pass scores its own tokens.

Defined results: null text: empty, one end token. Null doc_id: a training document. No training documents: N = V = 0 and
every token has probability 1. Repeated rows count as often as they occur. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Scratch, ascii_lower, fetch, partitions, release, settings, shrink_executors, trim

_WORD = re.compile(WORD)
#: Hashes of the end token and of the start history; no word is hashed to them but by chance.
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
WORDS, PAIRS, NEXT = 0, 1, 2
PACKED = "kind int, bucket int, keys binary, counts binary"
FIRST_HASHES, MORE_HASHES = 8, 4
ROWS = 250  # documents that are tokenised at once
#: Packed rows are large: by their number alone, a batch would be a whole partition, in the JVM and in Python.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def held_out(doc_id: str = "doc_id", modulus: int = 7, remainder: int = 2):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit keys."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit word hashes of all texts, each text closed by END, and where texts end."""
    import xxhash

    flat: list[str] = []
    ends = np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            flat.extend(_WORD.findall(ascii_lower(text)))
        flat.append("")  # no word is empty
        ends[i] = len(flat)
    codes, known = pd.factorize(np.array(flat, dtype=object))
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) if w else int(END) for w in known], dtype=np.uint64)
    return (hashes[codes] if len(codes) else np.empty(0, np.uint64)), ends


def pairs(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of (history, word) for every token: the high halves of both hashes."""
    history = np.empty_like(hashes)
    history[1:] = hashes[:-1]
    history[np.concatenate(([0], ends[:-1])).astype(np.int64)] = START
    return (history >> np.uint64(32) << np.uint64(32)) | (hashes >> np.uint64(32))


def sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their summed counts. Empties both lists, as no array is kept longer than it is needed."""
    whole = np.concatenate([np.empty(0, np.uint64), *keys])
    keys.clear()
    order = np.argsort(whole, kind="stable")
    whole = whole[order]
    added = np.concatenate([np.empty(0, np.int64), *counts])
    counts.clear()
    added = added[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], whole[1:] != whole[:-1]))) if len(whole) else np.empty(0, np.int64)
    return whole[first], np.add.reduceat(added, first) if len(first) else added


def _pack(kind: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of a kind, one for each bucket of the keys' hash."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, counts = keys[order], counts[order]
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(b, keys[i:j].astype("<u8").tobytes(), counts[i:j].astype("<i8" if kind == WORDS else "<u4").tobytes()) for b, i, j in zip(range(buckets), edges[:-1].tolist(), edges[1:].tolist(), strict=True) if j > i]
    if rows:
        a, b, c = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.binary()), pa.array(c, pa.binary())], names=["kind", "bucket", "keys", "counts"])


class _Sum:
    """Counts by key that are merged whenever they have doubled."""

    def __init__(self, least: int = 1_000_000):
        self.keys, self.counts, self.least, self.size, self.done = [], [], least, 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.size += len(keys)
        if self.size > max(self.least, 2 * self.done):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = sums(self.keys, self.counts)
        self.keys, self.counts, self.size, self.done = [keys], [counts], len(keys), len(keys)
        return keys, counts


@dataclass
class Counted:
    """PACKED rows, each kind written in columns of its own: what reads words takes no pairs from the files."""

    exact: Scratch
    follow: Scratch

    @staticmethod
    def write(df: DataFrame) -> Scratch:
        own = [F.when(F.col("kind") == kind, F.col(c)).alias(f"{c}_{kind}") for kind in (WORDS, PAIRS, NEXT) for c in ("keys", "counts")]
        return Scratch(df.select("kind", "bucket", *own), "counts")

    @staticmethod
    def of(written: Scratch, kind: int) -> DataFrame:
        return written.read().filter(F.col("kind") == kind).select("kind", "bucket", *(F.col(f"{c}_{kind}").alias(c) for c in ("keys", "counts")))

    def read(self, kind: int) -> DataFrame:
        return self.of(self.follow if kind == NEXT else self.exact, kind)


def count(docs: DataFrame, most: int = 2_000_000) -> Counted:
    """PACKED rows of exact counts: of words, of pairs, and of the words that follow each history."""
    n = partitions(docs.sparkSession)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, both = _Sum(), _Sum()
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            hashes, ends = tokens(batch.column(0).to_pylist())
            words.add(*np.unique(hashes, return_counts=True))
            both.add(*np.unique(pairs(hashes, ends), return_counts=True))
            if both.size > most and len(both.merge()[0]) > most // 2:  # pass on what is held, so that memory doesn't grow with the partition
                yield from _pack(PAIRS, *both.merge(), n)
                yield from _pack(WORDS, *words.merge(), n)
                words, both = _Sum(), _Sum()
        yield from _pack(PAIRS, *both.merge(), n)
        yield from _pack(WORDS, *words.merge(), n)
        del words, both
        trim()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], _Sum] = {}
        for batch in batches:
            for kind, bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found.setdefault((kind, bucket), _Sum()).add(np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8" if kind == WORDS else "<u4"))
        for kind, bucket in sorted(found):
            keys, counts = found.pop((kind, bucket)).merge()
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([keys.astype("<u8").tobytes()], pa.binary()), pa.array([counts.astype("<i8" if kind == WORDS else "<u4").tobytes()], pa.binary())], names=["kind", "bucket", "keys", "counts"])
            if kind == PAIRS:
                yield from _pack(NEXT, *np.unique(keys >> np.uint64(32), return_counts=True), n)
            del keys, counts
        trim()

    # a bucket for each task: by the buckets' hash one task has up to half a dozen of them, and others none
    with settings(docs.sparkSession, BATCHES):
        one = Counted.write(docs.select(F.col("text").cast("string")).mapInArrow(local, PACKED).repartitionById(n, F.col("bucket")).mapInArrow(merged, PACKED))
        return Counted(one, Counted.write(Counted.of(one, NEXT).repartitionById(n, F.col("bucket")).mapInArrow(merged, PACKED)))


def _salt(level: int) -> np.uint64:
    return np.uint64(int(END) * level & (1 << 64) - 1)


def _positions(keys: np.ndarray, level: int, hashes: int, bits: int) -> Iterator[np.ndarray]:
    """Bit positions, one hash function after the other."""
    h = mix(keys + _salt(level))
    step = mix(h ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for _ in range(hashes):
        # the high half times the size, shifted: an even spread without a division
        yield ((h >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)
        h = h + step


class Filter:
    """Log-frequency Bloom filter in segments, one for each bucket of the pairs' hash; histories low to high belong to it."""

    levels = 40

    def __init__(self, segments: list[np.ndarray], low: int, high: int):
        self.low, self.high = low, high
        self.offset = np.concatenate(([0], np.cumsum([8 * len(s) for s in segments]))).astype(np.int64)
        self.size = np.diff(self.offset)
        self.bytes = np.concatenate([np.empty(0, np.uint8), *segments])

    @property
    def nbytes(self) -> int:
        return self.bytes.nbytes

    def covers(self, keys: np.ndarray) -> np.ndarray:
        history = keys >> np.uint64(32)
        return (history >= np.uint64(self.low)) & (history < np.uint64(self.high))

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Mean counts of the levels found; 0 for pairs that aren't there."""
        level = np.zeros(len(keys), dtype=np.int64)
        alive = np.arange(len(keys))
        segment = (mix(keys) % np.uint64(max(1, len(self.size)))).astype(np.int64)
        for step in range(1, self.levels + 1):
            bits = self.size[segment[alive]] if len(self.size) else np.zeros(len(alive), np.int64)
            alive, bits = alive[bits > 0], bits[bits > 0]
            h = mix(keys[alive] + _salt(step))
            stride = mix(h ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
            base = self.offset[segment[alive]]
            for _ in range(FIRST_HASHES if step == 1 else MORE_HASHES):
                at = base + ((h >> np.uint64(32)) * bits.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                there = (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                alive, h, stride, base, bits = alive[there], (h + stride)[there], stride[there], base[there], bits[there]
            if not len(alive):
                break
            level[alive] = step
        return np.where(level > 0, (np.exp2(level - 1) + np.exp2(level) - 1) / 2, 0.0)


def segment(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A filter segment, sized for half-full bits."""
    if not len(keys):
        return np.empty(0, np.uint8)
    level = np.floor(np.log2(counts)).astype(np.int64) + 1
    entries = FIRST_HASHES * len(keys) + MORE_HASHES * int((level - 1).sum())
    size = max(64, -(-int(entries / math.log(2)) // 8) * 8)
    bits = np.zeros(size, dtype=bool)
    for step in range(1, int(level.max()) + 1):
        for at in _positions(keys[level >= step], step, FIRST_HASHES if step == 1 else MORE_HASHES, size):
            bits[at] = True
    return np.packbits(bits, bitorder="little")


class Numbers:
    """Whole numbers, most of them small: one byte each, larger ones by position."""

    def __init__(self, values: np.ndarray):
        self.low = np.minimum(values, 255).astype(np.uint8)
        self.at = np.flatnonzero(self.low == 255).astype(np.uint32)
        self.high = values[self.at].astype(np.int64)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.at.nbytes + self.high.nbytes

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = self.low[at].astype(np.int64)
        big = np.flatnonzero(out == 255)
        out[big] = self.high[np.searchsorted(self.at, at[big])]
        return out


class Words:
    """Sorted word hashes with their counts and the number of different words after them."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, follow: np.ndarray):
        self.keys, self.counts, self.follow = keys, Numbers(counts), Numbers(follow)

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.counts.nbytes + self.follow.nbytes

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, follow) of each hash, 0 for those not held."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        there = self.keys[at] == hashes
        return np.where(there, self.counts[at], 0), np.where(there, self.follow[at], 0)


@dataclass
class Model:
    """What scoring needs; blocks are made one at a time."""

    counted: Counted
    total: int
    distinct: int
    documents: int
    start_follow: int
    pair_bytes: float
    block_bytes: int
    buckets: int

    def _rows(self, kind: int, low: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Counts of a kind whose keys lie in a range; executors leave the others out."""
        code = "<i8" if kind == WORDS else "<u4"

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    keys, counts = np.frombuffer(keys, "<u8"), np.frombuffer(counts, code)
                    own = (keys >= np.uint64(low)) & (keys <= np.uint64(last))
                    if own.any():
                        yield pa.RecordBatch.from_arrays([pa.array([keys[own].tobytes()], pa.binary()), pa.array([counts[own].tobytes()], pa.binary())], names=["keys", "counts"])

        for r in fetch(self.counted.read(kind).select("keys", "counts").mapInArrow(within, "keys binary, counts binary")):
            yield np.frombuffer(r["keys"], "<u8"), np.frombuffer(r["counts"], code)

    def words(self) -> Iterator[Words]:
        """Blocks of words by ranges of their hash."""
        blocks = max(1, math.ceil(11 * self.distinct / self.block_bytes))
        edges = [(i << 64) // blocks for i in range(blocks + 1)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            parts = list(self._rows(WORDS, low, high - 1))
            keys, counts = sums([k for k, _ in parts], [c for _, c in parts])
            follow = np.zeros(len(keys), np.uint32)
            for k, c in self._rows(NEXT, low >> 32, (high - 1) >> 32):  # by the high half of a history's hash
                order = np.argsort(k)
                at = np.minimum(np.searchsorted(k[order], keys >> np.uint64(32)), len(k) - 1)
                follow += np.where(k[order][at] == keys >> np.uint64(32), c[order][at], 0).astype(np.uint32)
            del parts
            yield Words(keys, counts, follow)

    def filters(self) -> Iterator[Filter]:
        """Blocks of the filter by ranges of the history's hash; executors build the segments."""
        blocks = max(1, math.ceil(self.pair_bytes / self.block_bytes))
        edges = [(i << 32) // blocks for i in range(blocks + 1)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):

            def build(batches: Iterator[pa.RecordBatch], low: int = low, high: int = high) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                        keys, counts = np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<u4")
                        own = (keys >> np.uint64(32) >= np.uint64(low)) & (keys >> np.uint64(32) < np.uint64(high))
                        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([segment(keys[own], counts[own]).tobytes()], pa.binary())], names=["bucket", "bits"])
                trim()

            pairs_ = self.counted.read(PAIRS).select("bucket", "keys", "counts")
            found = {r["bucket"]: np.frombuffer(r["bits"], np.uint8) for r in fetch(pairs_.mapInArrow(build, "bucket int, bits binary"), 16)}
            empty = np.empty(0, np.uint8)
            yield Filter([found.get(b, empty) for b in range(self.buckets)], low, high)


def fit(training: DataFrame, block_mb: int = 256) -> Model:
    """Count and size the model; block_mb bounds what is broadcast at once."""
    shrink_executors(training.sparkSession)  # what earlier queries took; their workers stand beside it
    counted = count(training)
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = level = start = ends = words = both = 0
        for batch in batches:
            for kind, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if kind == WORDS:
                    words += len(keys) // 8
                    c = np.frombuffer(counts, "<i8")
                    n += int(c.sum())
                    ends += int(c[np.frombuffer(keys, "<u8") == END].sum())
                elif kind == PAIRS:
                    both += len(keys) // 8
                    level += int(np.floor(np.log2(np.frombuffer(counts, "<u4"))).sum())
                else:
                    start += int(np.frombuffer(counts, "<u4")[np.frombuffer(keys, "<u8") == START >> np.uint64(32)].sum())
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (n, level, start, ends, words, both)], names=names)
        trim()

    names = ["n", "level", "start", "ends", "words", "pairs"]
    every = counted.read(WORDS).unionByName(counted.read(PAIRS)).unionByName(counted.read(NEXT))
    with settings(training.sparkSession, BATCHES):
        s = every.select("kind", "keys", "counts").mapInArrow(add, ", ".join(f"{x} long" for x in names)).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)).first()
    pair_bytes = (FIRST_HASHES * s["pairs"] + MORE_HASHES * s["level"]) / math.log(2) / 8
    release(training.sparkSession)  # the counts' shuffles, and what the executors' heaps took for them
    return Model(counted, s["n"], s["words"], s["ends"], s["start"], pair_bytes, block_mb << 20, partitions(training.sparkSession))


STATE = pa.struct([("counts", pa.binary()), ("follow", pa.binary()), ("pairs", pa.float64()), ("plain", pa.float64())])


def score(docs: DataFrame, model: Model, strength: int = 3) -> DataFrame:
    """docs (with a column text) and a struct column `lm_`: n_tokens, n_known, base_score, score."""
    out, room = docs, model.block_bytes
    total, distinct, documents, start_follow = model.total, model.distinct, model.documents, model.start_follow

    def apply(df: DataFrame, steps: list[Words | Filter]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(steps)
        again = "lm_state_" in df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            steps = shared.value
            for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
                names = batch.schema.names
                hashes, ends = tokens(batch.column(names.index("text")).to_pylist())
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                if again:
                    state = batch.column(names.index("lm_state_")).to_pylist()
                    counts = np.frombuffer(b"".join(x["counts"] for x in state), "<i8").copy()
                    follow = np.frombuffer(b"".join(x["follow"] for x in state), "<i8").copy()
                    logs, plain = np.array([x["pairs"] for x in state]), np.array([x["plain"] for x in state])
                else:
                    counts, follow = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
                    logs, plain = np.zeros(len(ends)), np.zeros(len(ends))
                for step in steps:
                    if isinstance(step, Words):
                        unique, back = np.unique(hashes, return_inverse=True)
                        c, f = step.find(unique)
                        counts += c[back]
                        follow += f[back]
                        continue
                    keys = pairs(hashes, ends)
                    own = np.flatnonzero(step.covers(keys))
                    unique, back = np.unique(keys[own], return_inverse=True)
                    seen = step.counts(unique)[back]
                    before = np.concatenate(([0], counts[:-1]))
                    variety = strength * np.concatenate(([0], follow[:-1]))
                    before[starts], variety[starts] = documents, strength * start_follow
                    base = (counts + 1) / (total + distinct + 1)
                    seen = np.where((counts[own] > 0) & (before[own] > 0), np.minimum(seen, np.minimum(counts[own], before[own])), 0)
                    below = before[own] + variety[own]
                    p = np.where(below > 0, (seen + variety[own] * base[own]) / np.maximum(below, 1), base[own])
                    parts = np.zeros(len(hashes))
                    parts[own] = np.log10(np.minimum(p, 1.0))
                    logs += np.add.reduceat(parts, starts) if len(starts) else 0
                raw, more = counts.astype("<i8").tobytes(), follow.astype("<i8").tobytes()
                base = np.log10((counts + 1) / (total + distinct + 1))
                plain = np.add.reduceat(base, starts) if len(starts) else plain
                known = np.add.reduceat((counts > 0).astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
                edges = list(zip((8 * starts).tolist(), (8 * ends).tolist(), strict=True))
                held = pa.StructArray.from_arrays([pa.array([raw[a:b] for a, b in edges], pa.binary()), pa.array([more[a:b] for a, b in edges], pa.binary()), pa.array(logs, pa.float64()), pa.array(plain, pa.float64())], fields=list(STATE))
                result = pa.StructArray.from_arrays([pa.array(ends - starts, pa.int64()), pa.array(known, pa.int64()), pa.array(plain, pa.float64()), pa.array(logs, pa.float64())], ["n_tokens", "n_known", "base_score", "score"])
                rest = [(n, c) for n, c in zip(names, batch.columns, strict=True) if n not in ("lm_state_", "lm_")]
                yield pa.RecordBatch.from_arrays([*(c for _, c in rest), *([held] if keep else []), result], names=[*(n for n, _ in rest), *(["lm_state_"] if keep else []), "lm_"])

        plain_ = df.drop("lm_state_", "lm_")
        extra = [F.lit(None).cast("struct<counts: binary, follow: binary, pairs: double, plain: double>").alias("lm_state_")] if keep else []
        schema = plain_.select("*", *extra, F.lit(None).cast("struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double>").alias("lm_")).schema
        return df.mapInArrow(run, schema)

    held: list[Words | Filter] = []
    keep = True
    for make in (model.words, model.filters):
        for block in make():
            if held and sum(b.nbytes for b in held) + block.nbytes > room:
                out = Scratch(apply(out, held), "lm").read()
                held = []
            held.append(block)
    keep = False
    return apply(out, held)


def op8(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document, learning from those that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(rows.filter(~held_out()))
    return score(rows, model).select("doc_id", held_out().alias("held_out"), *(F.col("lm_")[c].alias(c) for c in ("n_tokens", "n_known")), F.lit(model.total).cast("long").alias("train_tokens"), *(F.col("lm_")[c].alias(c) for c in ("base_score", "score")))
