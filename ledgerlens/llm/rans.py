"""Token ids in files of range asymmetric numeral system blocks.

Documents are dealt into shards by ranges of doc_id and stay in ascending order. A block holds whole documents, up to
about `block_tokens` ids, and is coded on its own with one static frequency table that all blocks share: ids are dealt
over interleaved lanes, each a 64-bit coder state that gives off 32-bit words. A block's header carries its place in the
id stream, the documents in it, the lanes' states, checkpoints (word position and states every so many steps, from
which decoding can start) and checksums, so blocks decode in parallel and halves of a block too.

Files are Parquet rows (shard, block, payload), written by Spark and so to any store, in directories by shard; payload
is the block's bytes: see Block.pack. The table is a row of its own under `table/`.

Defined results: null text: empty, one end id. Null doc_id: before all others. Rows of one doc_id keep the order of
their texts. Empty table: no blocks. A document longer than a block has a block of its own. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, partitions, scratch_path, slices, strings

BITS = 18  # the frequencies of a table sum to 2**BITS
LOW = np.uint64(1 << 31)  # states are at least LOW and below LOW << 32
MAGIC, VERSION = b"LRNS", 1
_HEAD = struct.Struct("<4sHHIIIIIIQ")
#: White space of any kind, and without line ends, as classes of Arrow's expressions.
_SPACE = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_NO_END = _SPACE.replace(r"\x{9}-\x{D}", r"\x{9}\x{B}-\x{D}")
#: A space first, white space last, or runs of white space other than line ends alone.
_ODD = rf"\A |[{_SPACE}]\z|[{_NO_END}][{_SPACE}]|[{_SPACE}][{_NO_END}]"


def normalise(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every id that occurs."""
    total, size = int(counts.sum()), 1 << bits
    seen = counts > 0
    if not total:
        return np.zeros(len(counts), dtype=np.uint32)
    if int(seen.sum()) > size:
        raise ValueError("more ids than the table has room for")
    freq = np.where(seen, np.maximum(1, counts * size // total), 0).astype(np.int64)
    over = int(freq.sum()) - size
    order = np.argsort(-freq, kind="stable")
    while over:  # spread what rounding left over the most frequent ids
        room = freq[order] > 1 if over > 0 else freq[order] > 0
        at = order[room]
        step = np.minimum(freq[at] - 1, np.maximum(1, abs(over) * freq[at] // size)) if over > 0 else np.maximum(1, -over * freq[at] // size)
        step = np.where(np.cumsum(step) <= abs(over), step, np.maximum(0, abs(over) - np.concatenate(([0], np.cumsum(step)[:-1]))))
        freq[at] -= np.sign(over) * step
        over = int(freq.sum()) - size
    return freq.astype(np.uint32)


class Table:
    """A static frequency table with what coding and decoding look up."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())


@dataclass
class Block:
    """Documents (ids, lengths) and their token ids, `start` ids into the stream."""

    start: int
    doc_ids: list[int | None]
    lengths: np.ndarray
    tokens: np.ndarray

    def pack(self, table: Table, max_lanes: int = 2048, checkpoint_steps: int = 128) -> bytes:
        n = len(self.tokens)
        lanes = 1 << max(0, min(max_lanes, n // 128).bit_length() - 1)
        states, words, points = encode(self.tokens, table, lanes, checkpoint_steps)
        docs = np.array([d is not None for d in self.doc_ids], dtype=np.uint8).tobytes() + np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes() + self.lengths.astype("<u4").tobytes()
        marks = b"".join(struct.pack("<II", step, at) + x.astype("<u8").tobytes() for step, at, x in points)
        body = docs + states.astype("<u8").tobytes() + struct.pack("<I", len(points)) + marks + words.astype("<u4").tobytes()
        head = _HEAD.pack(MAGIC, VERSION, BITS, table.crc, len(self.doc_ids), n, lanes, zlib.crc32(self.tokens.astype("<u4").tobytes()), zlib.crc32(body), self.start)
        return head + body

    @classmethod
    def unpack(cls, data: bytes, table: Table) -> Block:
        """Decode a whole block; ValueError if a checksum fails."""
        magic, version, bits, table_crc, n_docs, n, lanes, tokens_crc, body_crc, start = _HEAD.unpack_from(data)
        body = memoryview(data)[_HEAD.size :]
        if (magic, version, bits) != (MAGIC, VERSION, BITS) or table_crc != table.crc:
            raise ValueError("not a block of this table")
        if zlib.crc32(body) != body_crc:
            raise ValueError("the block is damaged")
        known = np.frombuffer(body, "u1", n_docs)
        ids = np.frombuffer(body, "<i8", n_docs, n_docs)
        lengths = np.frombuffer(body, "<u4", n_docs, 9 * n_docs)
        at = 13 * n_docs
        states = np.frombuffer(body, "<u8", lanes, at)
        (n_points,) = struct.unpack_from("<I", body, at + 8 * lanes)
        words = np.frombuffer(body, "<u4", -1, at + 8 * lanes + 4 + n_points * (8 + 8 * lanes))
        tokens = decode(states, words, n, table)
        if zlib.crc32(tokens.astype("<u4").tobytes()) != tokens_crc:
            raise ValueError("the block decodes to other ids")
        return cls(start, [int(d) if k else None for d, k in zip(ids, known, strict=True)], lengths, tokens)

    @staticmethod
    def from_checkpoint(data: bytes, table: Table, point: int) -> tuple[int, np.ndarray]:
        """(position of the first id, ids) from a block's checkpoint to its end."""
        _, _, _, _, n_docs, n, lanes, _, _, _ = _HEAD.unpack_from(data)
        body = memoryview(data)[_HEAD.size :]
        at = 13 * n_docs + 8 * lanes
        (n_points,) = struct.unpack_from("<I", body, at)
        step, word = struct.unpack_from("<II", body, at + 4 + point * (8 + 8 * lanes))
        states = np.frombuffer(body, "<u8", lanes, at + 4 + point * (8 + 8 * lanes) + 8)
        words = np.frombuffer(body, "<u4", -1, at + 4 + n_points * (8 + 8 * lanes))
        return step * lanes, decode(states, words[word:], n - step * lanes, table)


def encode(tokens: np.ndarray, table: Table, lanes: int, checkpoint_steps: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """(lane states, words, checkpoints); the last step is coded first, so that decoding runs forwards."""
    x = np.full(lanes, LOW, dtype=np.uint64)
    parts: list[np.ndarray] = []
    points, given = [], 0
    top, shift, bits = np.uint64(63 - BITS), np.uint64(32), np.uint64(BITS)
    for step in range(-(-len(tokens) // lanes) - 1, -1, -1):
        ids = tokens[step * lanes : (step + 1) * lanes]
        freq, start, own = table.freq[ids], table.start[ids], x[: len(ids)]
        full = own >= freq << top
        out = own[full]
        parts.append(out.astype(np.uint32))
        given += len(out)
        own[full] = out >> shift
        q = own // freq
        x[: len(ids)] = (q << bits) + (own - q * freq) + start
        if step and step % checkpoint_steps == 0:
            points.append((step, given, x.copy()))
    words = np.concatenate(parts[::-1]) if parts else np.empty(0, np.uint32)
    return x, words, [(s, given - g, state) for s, g, state in reversed(points)]


def decode(states: np.ndarray, words: np.ndarray, n: int, table: Table) -> np.ndarray:
    x, out, at = states.astype(np.uint64), np.empty(n, dtype=np.uint32), 0
    lanes, mask, bits, shift = len(x), np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
    for step in range(0, n, max(lanes, 1)):
        own = x[: min(lanes, n - step)]
        slot = own & mask
        ids = table.symbol[slot]
        out[step : step + len(own)] = ids
        own = table.freq[ids] * (own >> bits) + slot - table.start[ids]
        low = np.flatnonzero(own < LOW)
        own[low] = own[low] << shift | words[at : at + len(low)]
        at += len(low)
        x[: len(own)] = own
    if (x != LOW).any():
        raise ValueError("the block doesn't end where it should")
    return out


class Encoder:
    """Ids of whole texts as bytes of little-endian 16- or 32-bit integers, as the tokenizers library gives them by default:
    the string of an added token is that token.

    A text is cut at its single spaces, where the vocabulary's pattern always cuts too. Words that aren't remembered go
    through the library many at a time, as one string: the ids that start with a space tell where each word begins. Two
    generations of `most` words each are held: what the younger lacks is looked up in the older and moves up. Texts with
    other spacing or an added token go through the library whole. Closing punctuation is looked up apart from its word.
    """

    def __init__(self, path: str, most: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.bpe = self.tok.model
        size = self.tok.get_vocab_size()
        self.kind, self.code = ("<u2", "H") if size <= 1 << 16 else ("<u4", "I")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.opens = np.zeros(size, dtype=bool)  # ids that start with a space, \u0120 in a byte-level vocabulary
        for token, i in self.tok.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")
        self.most, self.seen, self.old = most, {}, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str], at_once: int = 1000) -> None:
        """Words follow a space, and hold no space and no white space at an end."""
        missing = words.difference(self.seen)
        if len(self.seen) + len(missing) > self.most:
            self.old, self.seen, missing = self.seen, {}, words
        seen, old = self.seen, self.old
        new, tailed = [], []
        for w in missing:
            if (known := old.get(w)) is not None:
                seen[w] = known
            elif w[-1:] in _CLOSING and (core := w.rstrip(_CLOSING)).isalpha() and max(core) < "\u0500":  # the pattern cuts after the letters
                tailed.append((w, core, w[len(core) :]))
            else:
                new.append(w)
        if tailed:
            cores = {core for _, core, _ in tailed}.difference(seen, new)
            new += cores.difference(old)
            seen.update((c, old[c]) for c in cores if c in old)
        plain = [w for w in new if w.isascii() and w.isalpha()]
        new = [w for w in new if not (w.isascii() and w.isalpha())]
        groups = [new[i : i + at_once] for i in range(0, len(new), at_once)]
        width = np.dtype(self.kind).itemsize
        for group, e in zip(groups, self.tok.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=self.kind)
            edges = (np.flatnonzero(self.opens[ids]) * width).tolist()
            if len(edges) != len(group):
                raise ValueError("the pattern doesn't cut at spaces")
            data = ids.tobytes()
            seen.update(zip(group, [data[a:b] for a, b in zip(edges, [*edges[1:], len(data)], strict=True)], strict=True))
        # the pattern leaves ASCII letters after a space whole, so these go to the library's model at once
        seen.update((w, array(self.code, [t.id for t in self.bpe.tokenize("\u0120" + w)]).tobytes()) for w in plain)
        ends = list({tail for _, _, tail in tailed})
        tails = dict(zip(ends, self.whole(ends), strict=True))
        seen.update((w, seen[core] + tails[tail]) for w, core, tail in tailed)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        for t in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, t))
        odd = odd.to_numpy(zero_copy_only=False)
        cut = ~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        out: list[bytes] = [b""] * len(texts)
        for i, data in zip(np.flatnonzero(odd).tolist(), self.whole(texts.filter(pa.array(odd)).to_pylist()), strict=True):
            out[i] = data
        parts = pc.split_pattern(texts.filter(pa.array(cut)), " ")
        if not len(parts):
            return out
        edges = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), strings(coded.dictionary)
        self.learn(set(words))
        first = edges[:-1]  # no space before these
        ids = [*map(self.seen.__getitem__, words), *self.whole([words[c] for c in codes[first].tolist()])]
        codes = codes.astype(np.int64)
        codes[first] = len(words) + np.arange(len(first))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), self.kind)
        sizes //= flat.itemsize
        size = sizes[codes]
        ends = np.cumsum(size)
        joined = flat[np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - size), size) + np.arange(ends[-1])].tobytes()
        stops = (ends[edges[1:] - 1] * flat.itemsize).tolist()
        for i, a, b in zip(np.flatnonzero(cut).tolist(), [0, *stops], stops, strict=False):
            out[i] = joined[a:b]
        return out


_CLOSING = ".,;:!?"
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, so that its memory serves all of its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


RAW = "shard int, block int, start long, doc_ids array<long>, lengths array<int>, tokens binary"


def raw_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, block_tokens: int = 1 << 19, shards: int | None = None) -> DataFrame:
    """Blocks of ids before coding; `start` counts from the shard's first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_ = encoder(tokenizer_path)
        end = np.array([end_id], dtype=encode_.kind).tobytes()
        width, shard = len(end), TaskContext.get().partitionId()
        block = start = held = 0
        ids: list[int | None] = []
        parts: list[bytes] = []

        def row() -> pa.RecordBatch:
            lengths = [len(p) // width for p in parts]
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([b"".join(parts)], pa.binary())], names=["shard", "block", "start", "doc_ids", "lengths", "tokens"])

        for batch in batches:
            for doc, data in ((d, x + end) for part in slices(batch, 1) for d, x in zip(part.column(0).to_pylist(), encode_(part.column(1)), strict=True)):
                n = len(data) // width
                if ids and held + n > block_tokens:
                    yield row()
                    block, start, held, ids, parts = block + 1, start + held, 0, [], []
                ids.append(doc)
                parts.append(data)
                held += n
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(shards or partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), F.length("text").asc_nulls_first())
    return dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.length("text").asc_nulls_first(), F.col("text").asc_nulls_first()).mapInArrow(run, RAW)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, vocab: int = 1 << 16, **options) -> str:
    """Encode docs (doc_id, text) into block files under path."""
    spark = docs.sparkSession
    kind = "<u2" if vocab <= 1 << 16 else "<u4"
    raw = Scratch(raw_blocks(docs, tokenizer_path, end_id, **options), "ids")

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(data, kind), minlength=vocab)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["id", "n"])

    counts = np.zeros(vocab, dtype=np.int64)  # the driver holds one count for each id of the vocabulary
    for r in raw.read().select("tokens").mapInArrow(histogram, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    freq = normalise(counts)
    bases, at = {}, 0  # one number for each shard
    for r in raw.read().groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).orderBy("shard").collect():
        bases[r["shard"]], at = at, at + r["n"]
    shared = spark.sparkContext.broadcast((freq, bases))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, bases = shared.value
        table = Table(freq)
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r["start"] + bases[r["shard"]], r["doc_ids"], np.array(r["lengths"]), np.frombuffer(r["tokens"], kind))
                yield pa.RecordBatch.from_arrays([pa.array([r["shard"]], pa.int32()), pa.array([r["block"]], pa.int32()), pa.array([block.pack(table)], pa.binary())], names=["shard", "block", "payload"])

    raw.read().mapInArrow(code, "shard int, block int, payload binary").write.partitionBy("shard").option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(BITS, freq.astype("<u4").tobytes())], "bits int, freq binary").coalesce(1).write.parquet(f"{path}/table")
    raw.drop()
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and the ids' place (shard, block) from block files, decoded in parallel."""
    shared = spark.sparkContext.broadcast(np.frombuffer(spark.read.parquet(f"{path}/table").first()["freq"], "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for shard, number, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                block = Block.unpack(payload, table)
                data, ends = block.tokens.astype("<u4").tobytes(), np.cumsum(block.lengths, dtype=np.int64)
                starts = ends - block.lengths
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), pa.array(starts + block.start, pa.int64()), pa.array(block.lengths, pa.int64()), pa.array(sums, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([number] * n, pa.int32())], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "block"])

    blocks = spark.read.schema("block int, payload binary, shard int").parquet(f"{path}/blocks").select("shard", "block", "payload")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, block int")


def op1(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents' ids to the shared folder, and read them back; the files go at exit."""
    spark = docs.sparkSession
    return read(spark, write(docs, scratch_path(spark, "rans"), tokenizer_path))
