"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into words where no piece can cross: before white space marks and around line ends. For every different
word of the corpus all substrings up to the longest piece are exploded and joined to the piece table on equality; what
is left are the lattice's edges, grouped by word, and a Spark `aggregate` folds them into a segmentation. For unigram models
the fold is Viterbi: the best score of each position from the edges that end there. For BPE models Viterbi gives other
ids than the library, since merges go by rank and not by the sum of scores; there the fold takes the best edge that joins
two neighbouring symbols until none is left, which is what the library does. Characters without a piece become bytes.

Words then go back to the texts without ever meeting on the driver or in one task. Documents are in chunks (of a file, by
row number, so that a chunk is the same however often it is read). A chunk asks for its different words, dealt over buckets
by hash; a bucket answers each chunk with its words' ids; answers and documents meet by chunk. Asks, answers and
documents travel packed. A hot word is asked for once by each chunk, so no bucket is hot.

Defined results: null or empty text: no ids. Words over FOLD characters are merged outside the fold, by the same
rule. Repeated rows give repeated results; other columns are kept, and the new column's name gets further underscores if
it is taken. Decoding gives the text back; a literal mark character decodes as a space, as in the library.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, partitions, release, settings, slices, trim, unused

MARK = "▁"
#: Words: marks and what follows them, a stretch without marks, or one line end or tab, which no piece may hold beside others.
CUT = f"{MARK}+[^{MARK}\n\t]*|[^{MARK}\n\t]+|[\n\t]"
ENDS = ("\n", "\t")
UNIGRAM, BPE = 1, 2
#: The characters of a word whose bounds fit in the bits of a long.
FOLD = 60
NORMAL, USER, UNUSED, BYTE = 1, 4, 5, 6


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]  # piece, score, type; ids are positions
    kind: int
    prefix: bool

    @property
    def byte_ids(self) -> list[int]:
        """Ids of bytes 0 to 255; the unknown id where the model has no bytes."""
        found = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        return [found.get(f"<0x{b:02X}>", self.unknown) for b in range(256)]

    @property
    def unknown(self) -> int:
        return next((i for i, (_, _, t) in enumerate(self.pieces) if t == 2), 0)

    @property
    def texts(self) -> list[tuple[str, float, int]]:
        """(piece, cost, id) of the pieces that text can hold."""
        return [(p, -s, i) for i, (p, s, t) in enumerate(self.pieces) if t in (NORMAL, USER, UNUSED)]

    @cached_property
    def table(self) -> dict[str, tuple[float, int]]:
        """(cost, id) by piece."""
        return {p: (c, i) for p, c, i in self.texts}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffers message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            i, value, shift = i + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            n, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = data[i : i + n], i + n
        yield key >> 3, value


def load(path: str) -> Model:
    """A model file of the library."""
    with open(path, "rb") as f:
        message = list(_fields(f.read()))
    pieces = []
    for piece in (dict(_fields(v)) for k, v in message if k == 1):
        pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, 1)))
    trainer, normal = (dict(_fields(next((v for k, v in message if k == n), b""))) for n in (2, 3))
    if normal.get(1, b"identity") != b"identity" or normal.get(4, 1) or trainer.get(24, 0):
        raise ValueError("only models without normalisation and with white space kept are read")
    if any(len(p) > 1 and t != BYTE and any(e in p for e in ENDS) for p, _, t in pieces):
        raise ValueError("no piece may hold a line end or tab beside other characters")
    return Model(pieces, trainer.get(3, UNIGRAM), bool(normal.get(3, 1)))


def orders(model: Model) -> tuple[list[tuple[str, int, int]], list[float]]:
    """(piece, order, id), and the costs by order: equal costs have one order."""
    costs = sorted({c for _, c, _ in model.texts})
    if len(model.pieces) >= NONE:
        raise ValueError("edges hold ids and orders of 16 bits")
    place = {c: i for i, c in enumerate(costs)}
    return [(p, place[c], i) for p, c, i in model.texts], costs


#: An edge is one long: order, start, end and id in 16, 8, 8 and 16 bits, so that edges sort by cost, then from the left.
NONE = 0xFFFF


def _start(x: Column) -> Column:
    return F.shiftright(x, 24).bitwiseAND(255).cast("int")


def _end(x: Column) -> Column:
    return F.shiftright(x, 16).bitwiseAND(255).cast("int")


def edges(words: DataFrame, model: Model) -> DataFrame:
    """words (id, word) with their lattice, sorted edges; ids are different, words of FOLD characters at most, and rows
    partitioned by id. Of words whose characters all are known pieces, edges of one character are implied: only the first
    is there, so that each word has an edge."""
    import xxhash

    pieces, _ = orders(model)
    longest = max(len(p) for p, _, _ in pieces)
    # joined by a number, which is faster than by text; the text is compared after it
    hashed = [(int(np.int64(np.uint64(xxhash.xxh64_intdigest(p.encode(), seed=42)))), p, o, i) for p, o, i in pieces]
    if len({h for h, *_ in hashed}) < len(hashed):
        raise ValueError("two pieces share a hash")
    table = F.broadcast(words.sparkSession.createDataFrame(hashed, "hash long, known string, order int, piece_id int"))  # the vocabulary's size
    # explode() would have the sequences made again in a filter of their number
    starts = words.select("id", "word", F.length("word").alias("n"), _plain(F.col("word"), model).alias("plain"))
    starts = starts.select("*", F.explode_outer(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    spans = starts.select("id", "word", "plain", "s", F.explode_outer(F.sequence(F.col("s") + 1, F.least(F.col("s") + longest, "n"))).alias("e"))
    wide = F.col("e") - F.col("s") > 1
    spans = spans.filter(wide | ~F.col("plain") | (F.col("s") == 0))
    exploded = spans.select("id", "word", "s", "e", F.substring("word", F.col("s") + 1, F.col("e") - F.col("s")).alias("piece"))
    joined = exploded.withColumn("hash", F.xxhash64("piece")).join(table, "hash", "left")
    found = F.col("piece") == F.col("known")
    joined = joined.filter(F.coalesce(found, F.lit(False)) | ~wide)  # a character's edge stays, with a piece or without
    order, piece = (F.when(found, F.col(c)).otherwise(F.lit(NONE)) for c in ("order", "piece_id"))
    edge = F.shiftleft(order.cast("long"), 32) + F.shiftleft((F.col("s") * 256 + F.col("e")).cast("long"), 16) + piece
    return joined.groupBy("id").agg(F.first("word").alias("word"), F.sort_array(F.collect_list(edge)).alias("edges"))  # ids are long: edges are sorted by number


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _wide(lattice: Column) -> Column:
    """Edges of more than one character with the bits of their start, `s`, and end, `e`."""
    with_bits = F.transform(lattice, lambda x: F.struct(x.alias("x"), _bit(_start(x)).alias("s"), _bit(_end(x)).alias("e")))
    return F.filter(with_bits, lambda x: x["e"] > F.shiftleft(x["s"], 1))


def _inner(x: Column) -> Column:
    """The bits of the places between an edge's ends."""
    return x["e"] - F.shiftleft(x["s"], 1)


ODD = 1 << 62  # a bit beyond all bounds


def _merge_fold(wide: Column, n: Column) -> Column:
    """Bounds, as bits, of the symbols that are left when the cheapest edge over two neighbours has been taken again and again.

    One pass over the edges in order of cost does that, unless an edge whose turn it is spans more than two symbols: a later
    merge could make it fit. Such words get the bit ODD.
    """

    def step(bounds: Column, x: Column) -> Column:
        ends = (bounds.bitwiseAND(x["s"]) != 0) & (bounds.bitwiseAND(x["e"]) != 0)
        return F.when(~ends, bounds).when(F.bit_count(bounds.bitwiseAND(_inner(x))) == 1, bounds.bitwiseAND(F.bitwise_not(_inner(x)))).otherwise(bounds.bitwiseOR(F.lit(ODD)))

    return F.aggregate(wide, _every(n), step)


def _every(n: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(63) - n)


def _exact_merge_fold(wide: Column, n: Column) -> Column:
    """As above, looking at all edges again after each merge."""

    def step(bounds: Column, _: Column) -> Column:
        fits = lambda x: (bounds.bitwiseAND(x["s"]) != 0) & (bounds.bitwiseAND(x["e"]) != 0) & (F.bit_count(bounds.bitwiseAND(_inner(x))) == 1)
        return bounds.bitwiseAND(F.bitwise_not(F.coalesce(_inner(F.get(F.filter(wide, fits), F.lit(0))), F.lit(0).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), _every(n), step)


def _viterbi_fold(lattice: Column, n: Column, costs: list[float]) -> Column:
    """Bounds, as bits, of the path of least cost; of equal paths the one whose last edges are longest."""
    entry = "struct<cost: double, s: int>"
    table = F.array(*map(F.lit, costs))
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(-1).alias("s")).cast(entry))
    cost = lambda x: F.coalesce(F.get(table, F.shiftright(x, 32).cast("int")), F.lit(1e6))  # noqa: E731  a character without a piece

    def step(best: Column, e: Column) -> Column:
        ways = F.transform(F.filter(lattice, lambda x: _end(x) == e), lambda x: F.struct((F.get(best, _start(x))["cost"] + cost(x)).alias("cost"), _start(x).alias("s")).cast(entry))
        return F.concat(best, F.array(F.array_min(ways)))

    best = F.aggregate(F.sequence(F.lit(1), n), start, step)
    back = lambda path, _: F.when(path[0] == 0, path).otherwise(F.concat(F.array(F.get(best, path[0])["s"]), path))
    return F.aggregate(F.aggregate(F.sequence(F.lit(1), n), F.array(n), back), F.lit(0).cast("long"), lambda bits, i: bits.bitwiseOR(_bit(i)))


def _ids(word: Column, lattice: Column, wide: Column, bounds: Column, model: Model) -> Column:
    """Ids of the edges between neighbouring bounds; bytes where there is no piece. wide: the lattice's wide edges with bits."""
    byte_ids = F.array(*map(F.lit, model.byte_ids))
    # the bits from start to end, of which both ends alone are bounds
    between = lambda x: F.call_function("shiftright", bounds, _start(x)).bitwiseAND(F.shiftleft(_bit(_end(x) - _start(x)), 1) - 1) == _bit(_end(x) - _start(x)).bitwiseOR(F.lit(1))
    placed = lambda x: F.shiftleft(_start(x), 16) + x.bitwiseAND(NONE).cast("int")
    ordered = F.array_sort(F.transform(F.filter(lattice, between), placed))

    def one(x: Column) -> Column:
        data = F.hex(F.encode(F.substring(word, F.shiftright(x, 16) + 1, F.lit(1)), "UTF-8"))
        fallback = F.transform(F.sequence(F.lit(0), F.floor(F.length(data) / 2).cast("int") - 1), lambda k: F.get(byte_ids, F.conv(F.substring(data, k * 2 + 1, F.lit(2)), 16, 10).cast("int")))
        return F.when(x.bitwiseAND(NONE) == NONE, fallback).otherwise(F.array(x.bitwiseAND(NONE)))

    # words of known characters: wide edges, and what is alone between two bounds
    ascii_ids = F.array(*(F.lit(model.table.get(chr(i), (0, NONE))[1]) for i in range(128)))
    letter = lambda i: F.substring(word, i + 1, F.lit(1))
    single = lambda i: F.when(letter(i) == MARK, F.lit(model.table.get(MARK, (0, NONE))[1])).otherwise(F.get(ascii_ids, F.ascii(letter(i))))
    alone = F.filter(F.sequence(F.lit(0), F.length(word) - 1), lambda i: F.call_function("shiftright", bounds, i).bitwiseAND(F.lit(3)) == 3)
    taken = F.filter(wide, lambda x: bounds.bitwiseAND(x["e"] + x["e"] - x["s"]) == x["s"] + x["e"])  # of the bits from start to end, the ends alone
    plain = F.array_sort(F.concat(F.transform(taken, lambda x: placed(x["x"])), F.transform(alone, lambda i: F.shiftleft(i, 16) + single(i))))
    return F.when(_plain(word, model), F.transform(plain, lambda x: x.bitwiseAND(NONE))).otherwise(F.flatten(F.transform(ordered, one)))


def _plain(word: Column, model: Model) -> Column:
    """Are a word's characters all pieces, of ASCII or the mark, as in most words? Viterbi needs every edge, so there no word is plain."""
    known = "".join(f"\\x{{{ord(p):X}}}" for p, _, _ in model.texts if len(p) == 1 and (p.isascii() or p == MARK))
    return word.rlike(f"^[{known}]*$") if model.kind == BPE and known else F.lit(False)


def merge(word: str, model: Model) -> list[int]:
    """Ids of a word of any length by BPE merges."""
    table = model.table
    symbols: list[str | None] = list(word)
    after = [*range(1, len(symbols)), -1] if symbols else []
    before = list(range(-1, len(symbols) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (found := table.get(both := symbols[i] + symbols[after[i]])):
            heapq.heappush(heap, (found[0], i, both))

    for i in range(len(symbols)):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i] if symbols[i] is not None else -1
        if j < 0 or symbols[i] + symbols[j] != both:
            continue
        symbols[i], symbols[j], after[i] = both, None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    bytes_ = model.byte_ids
    return [x for s in symbols if s is not None for x in ([table[s][1]] if s in table else [bytes_[b] for b in s.encode()])]


def word_ids(words: DataFrame, model: Model) -> DataFrame:
    """(id, word, ids) for different words (id, word); ids are null where a word has over FOLD characters: see long_ids."""
    # a word has some 20 edges, which are sorted: smaller partitions than those of words
    short = words.filter(F.length("word") <= FOLD).repartition(4 * partitions(words.sparkSession), "id")
    lattice = edges(short, model).withColumn("wide", _wide(F.col("edges")))
    if model.kind == BPE:
        once = lattice.withColumn("once", _merge_fold(F.col("wide"), F.length("word")))
        bounded = once.withColumn("bounds", F.when(F.col("once") < ODD, F.col("once")).otherwise(_exact_merge_fold(F.col("wide"), F.length("word"))))
    else:
        bounded = lattice.withColumn("bounds", _viterbi_fold(F.col("edges"), F.length("word"), orders(model)[1]))
    folded = bounded.select("id", "word", _ids(F.col("word"), F.col("edges"), F.col("wide"), F.col("bounds"), model).alias("ids"))
    return folded.unionByName(words.filter(F.length("word") > FOLD).select("id", "word", F.lit(None).cast("array<int>").alias("ids")))


def long_ids(ids: pa.ListArray, words: pa.Array, model: Model) -> pa.ListArray:
    """ids with those of longer words, which come as null."""
    if not ids.null_count:
        return ids
    cut = merge if model.kind == BPE else viterbi
    return pa.array([cut(w, model) if x is None else x for x, w in zip(ids.to_pylist(), words.to_pylist(), strict=True)], pa.list_(pa.int32()))


def viterbi(word: str, model: Model) -> list[int]:
    """Ids of the path of least cost; ties as in the fold."""
    table, longest = model.table, max(map(len, model.table))
    best: list[tuple[float, int]] = [(0.0, -1)]
    for e in range(1, len(word) + 1):
        best.append(min((best[s][0] + (table[word[s:e]][0] if word[s:e] in table else 1e6), s) for s in range(max(0, e - longest), e) if e - s == 1 or word[s:e] in table))
    out: list[int] = []
    e = len(word)
    while e > 0:
        s = best[e][1]
        w = word[s:e]
        out[:0] = [table[w][1]] if w in table else [model.byte_ids[b] for b in w.encode()]
        e = s
    return out


class Cutter:
    """Words of texts: single spaces and line ends are cut by Arrow, texts with runs of spaces or marks by CUT."""

    def __init__(self, model: Model):
        self.prefix, self.cut = MARK if model.prefix else "", re.compile(CUT)

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        """The words of each text; empty ones count for nothing."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, rf"\A |  |{MARK}|\x01").to_numpy(zero_copy_only=False)
        there = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        plain = pc.if_else(pa.array(~odd & there), texts, "")
        for end in ENDS:
            plain = pc.replace_substring(plain, end, f"\x01{end}\x01")
        plain = pc.replace_substring(plain, " ", f"\x01{MARK}")
        if self.prefix:
            plain = pc.if_else(pa.array(~odd & there), pc.binary_join_element_wise(self.prefix, plain, ""), plain)
        parts = pc.split_pattern(plain, "\x01")
        if odd.any():
            rows = parts.to_pylist()
            for i in np.flatnonzero(odd).tolist():
                rows[i] = self.cut.findall(self.prefix + texts[i].as_py().replace(" ", MARK))
            parts = pa.array(rows, parts.type)
        return parts


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=6).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _pack_words(words: pa.Array) -> bytes:
    """Words, of which none is empty or holds a line end."""
    return _pack(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py().encode())


def _unpack_words(data: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([_unpack(data).decode()]), "\n").flatten()


class Ids:
    """Stretches of ids: where each starts and its size, in one array."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def pack(self) -> bytes:
        return _pack(self.sizes.astype("<u4").tobytes() + self.flat.astype(KIND).tobytes())

    @classmethod
    def unpack(cls, data: bytes, n: int) -> Ids:
        data = _unpack(data)
        return cls(np.frombuffer(data, KIND, -1, 4 * n), np.frombuffer(data, "<u4", n))

    def take(self, codes: np.ndarray) -> Ids:
        return Ids(gather(self.flat, self.starts, self.sizes, codes)[0], self.sizes[codes])

    @classmethod
    def all(cls, parts: list[Ids]) -> Ids:
        return cls(np.concatenate([np.empty(0, KIND), *(p.flat for p in parts)]), np.concatenate([np.empty(0, np.int64), *(p.sizes for p in parts)]))


def _dealt(words: pa.Array, n: int) -> np.ndarray:
    """A bucket below n for each word, none of them empty, by a hash of its bytes."""
    out = np.empty(len(words), np.int64)
    weights = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k in range(0, len(words), 100_000):
        part = pa.concat_arrays([words.slice(k, 100_000)])  # from the start of its buffers
        edges = np.frombuffer(part.buffers()[1], "<i4", len(part) + 1).astype(np.int64)
        data = np.frombuffer(part.buffers()[2], "u1", edges[-1] - edges[0], edges[0]).astype(np.uint64)
        place = np.arange(len(data)) - np.repeat(edges[:-1] - edges[0], np.diff(edges))
        h = np.add.reduceat((data + np.uint64(1)) * weights[place & 63] * (place.astype(np.uint64) + np.uint64(1)), edges[:-1] - edges[0])
        h ^= h >> np.uint64(29)
        out[k : k + len(part)] = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(n)
    return out


def _rows(schema: str, *rows: tuple) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _numbered(docs: DataFrame) -> bool:
    """Does the plan know its rows' files and places in them?"""
    if "_metadata" not in docs._jdf.queryExecution().analyzed().metadataOutput().toString():
        return False
    try:
        return len(docs.select(F.col("_metadata.file_path"), F.col("_metadata.row_index")).columns) == 2
    except AnalysisException:  # a format without row numbers
        return False


def chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """docs with their chunk first: the file and the row number over what makes chunk_bytes of text on average. Tables that aren't files of rows are written first."""
    if not _numbered(docs):
        docs = Scratch(docs, "docs").read()
    mean = docs.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    rows = max(1, int(chunk_bytes / max(mean, 1.0)))
    return docs.select(F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / rows)).alias(unused(docs.columns, "chunk_")), "*")


ASK = "chunk long, bucket int, words binary"
ANSWER = "bucket int, chunk long, words binary, ids binary"
PART = "chunk long, kind int, a binary, b binary"


def encode(docs: DataFrame, model: Model, chunk_bytes: int = 32 << 20, check: bool = False) -> DataFrame:
    """docs (with a column text) and an array column `ids_`; with check also a column `round_trip_`: do the ids decode to the text?"""
    spark = docs.sparkSession
    n = partitions(spark)
    rows = chunked(docs, chunk_bytes)
    docs = rows.drop(rows.columns[0])
    at_text = docs.columns.index("text")
    shared = spark.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, chunk = Cutter(shared.value), None
        held: list[pa.Array] = []

        def asks() -> Iterator[pa.RecordBatch]:
            words = pc.unique(pa.concat_arrays([pa.array([], pa.string()), *held]))
            words = words.filter(pc.invert(pc.is_in(words, pa.array(["", *ENDS]))))
            words = words.take(pc.sort_indices(words))
            bucket = _dealt(words, n)
            order = np.argsort(bucket, kind="stable")
            words, edges = words.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(n + 1)).tolist()
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if b > a:
                    yield _rows(ASK, (chunk, k, _pack_words(words.slice(a, b - a))))

        for batch in batches:
            for now, part in by_chunk(batch):
                if now != chunk:
                    yield from asks()
                    chunk, held = now, []
                    pa.default_memory_pool().release_unused()
                for piece in slices(part, 1, 1 << 21):
                    held.append(pc.unique(cutter(piece.column(1)).flatten()))
                    if len(held) > 3 and len(held[-1]) + sum(map(len, held[1:])) > len(held[0]):
                        held = [pc.unique(pa.concat_arrays(held))]
        yield from asks()
        held.clear()
        trim()

    asked = Scratch(rows.select(rows.columns[0], "text").mapInArrow(ask, ASK), "asks")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, [pa.array([], pa.string())]

        def found() -> Iterator[pa.RecordBatch]:
            words = pc.unique(pa.concat_arrays(held))
            for k in range(0, len(words), 100_000):
                part = words.slice(k, 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, k + len(part), dtype=np.int64) + (bucket << 40)), part], names=["id", "word"])

        for batch in batches:
            for now, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != bucket:
                    if bucket is not None:
                        yield from found()
                    bucket, held = now, [pa.array([], pa.string())]
                held.append(_unpack_words(words))
                if sum(map(len, held[1:])) > max(200_000, len(held[0])):
                    held = [pc.unique(pa.concat_arrays(held))]
        if bucket is not None:
            yield from found()
        held.clear()
        trim()

    words = Scratch(asked.read().select("bucket", "words").repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(different, "id long, word string"), "words")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.Table.from_batches([b]) for b in batches]
        if not held:
            return
        table = pa.concat_tables(held).combine_chunks()
        if not table.num_rows:
            return
        bucket = table.column(0).to_numpy() >> 40
        order = np.argsort(bucket, kind="stable")
        words = pa.concat_arrays(table.column(1).chunks).take(pa.array(order))
        lists = long_ids(pa.concat_arrays(table.column(2).chunks), pa.concat_arrays(table.column(1).chunks), shared.value)
        ids = Ids(lists.flatten().to_numpy(zero_copy_only=False).astype(KIND), pc.list_value_length(lists).to_numpy(zero_copy_only=False)).take(order)
        edges = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield _rows(ANSWER, (int(bucket[order[a]]), None, _pack_words(words.slice(a, b - a)), ids.take(np.arange(a, b)).pack()))
        trim()

    # a sort by number and one pass over it, where the hash aggregate would hold and write single edges as lists
    with settings(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"}):
        known = Scratch(word_ids(words.read(), model).select("id", "word", "ids").mapInArrow(pack, ANSWER), "word-ids")
    words.drop()
    release(spark)
    both = known.read().unionByName(asked.read().select("bucket", "chunk", "words", F.lit(None).cast("binary").alias("ids")))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, words, ids, parts = None, None, None, []
        for batch in batches:
            for now, chunk, packed, found in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now != bucket:
                    bucket, words, parts = now, None, []
                own = _unpack_words(packed)
                if found is not None:  # these come first
                    parts.append((own, Ids.unpack(found, len(own))))
                    continue
                if words is None:
                    words, ids = pa.concat_arrays([w for w, _ in parts]), Ids.all([i for _, i in parts])
                yield _rows(PART, (chunk, 0, packed, ids.take(pc.index_in(own, words).to_numpy(zero_copy_only=False)).pack()))
        words, ids, parts = None, None, []
        trim()

    answers = Scratch(both.repartition(n, "bucket").sortWithinPartitions("bucket", F.col("ids").isNull()).mapInArrow(answer, PART), "answers")
    del both
    asked.drop()
    known.drop()
    release(spark)  # asks, words' ids and their shuffle are gone before the documents are shuffled

    def pack_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, part in by_chunk(batch):
                for piece in slices(part, at_text + 1, 1 << 22):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, piece.schema) as out:
                        out.write_batch(piece)
                    yield _rows(PART, (chunk, 1, _pack(sink.getvalue()), None))
        trim()

    packed = rows.mapInArrow(pack_docs, PART)
    ids_, trip_ = (unused(docs.columns, x) for x in ("ids_", "round_trip_"))
    names = [*docs.columns, ids_, *([trip_] if check else [])]

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cutter, pieces = Cutter(model), Pieces(model)
        fixed = [np.array(merge(e, model), KIND) for e in ("", *ENDS)]
        fixed = pa.array(["", *ENDS]), Ids(np.concatenate(fixed), np.array([len(x) for x in fixed]))
        chunk, words, ids, parts = None, None, None, []
        for batch in batches:
            # payloads stay in the batch, which may be a whole partition's
            for now, kind, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if now != chunk:
                    chunk, words, parts = now, None, [fixed]
                if kind == 0:  # these come first
                    own = _unpack_words(a.as_buffer())
                    parts.append((own, Ids.unpack(b.as_buffer(), len(own))))
                    continue
                if words is None:
                    words, ids, parts = pa.concat_arrays([w for w, _ in parts]), Ids.all([i for _, i in parts]), []
                for whole in pa.ipc.open_stream(_unpack(a.as_buffer())):
                    cut = cutter(whole.column(at_text + 1))
                    own = cut.flatten().dictionary_encode()
                    codes = pc.index_in(own.dictionary, words).to_numpy(zero_copy_only=False).astype(np.int64)[own.indices.to_numpy()]
                    edges, at = cut.offsets.to_numpy() - cut.offsets[0].as_py(), 0
                    for piece in slices(whole, at_text + 1, 1 << 20):
                        own_edges = edges[at : at + piece.num_rows + 1]
                        flat, ends = gather(ids.flat, ids.starts, ids.sizes, codes[own_edges[0] : own_edges[-1]])
                        offsets = np.concatenate(([0], ends))[own_edges - own_edges[0]]
                        found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))
                        texts = pc.fill_null(piece.column(at_text + 1), "").to_pylist() if check else []
                        more = [pa.array([x == t.replace(MARK, " ") for x, t in zip(pieces(flat, offsets), texts, strict=True)], pa.bool_())] if check else []
                        yield pa.RecordBatch.from_arrays([*piece.columns[1:], found, *more], names=names)
                        at += piece.num_rows
                pa.default_memory_pool().release_unused()
        words, ids, parts = None, None, []
        trim()

    schema = docs.select("*", F.lit(None).cast("array<int>").alias(ids_), *([F.lit(True).alias(trip_)] if check else [])).schema
    return packed.unionByName(answers.read()).repartition(n, "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(put_together, schema)


KIND = "<u2"  # ids are below NONE


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the stretches of flat that codes name one after the other, where each ends)."""
    size = sizes[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[codes] - (ends - size), size) + np.arange(total)], ends


def by_chunk(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows with one chunk, the first column."""
    chunks = batch.column(0).to_numpy()
    edges = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1).tolist(), len(chunks)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(chunks[a]), batch.slice(a, b - a)


class Pieces:
    """Texts of ids."""

    def __init__(self, model: Model):
        table = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == 3 else p.replace(MARK, " ").encode() for p, _, t in model.pieces]
        self.sizes = np.fromiter(map(len, table), np.int64, len(table))
        self.starts, self.flat, self.prefix = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(table), "u1"), int(model.prefix)

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of stretches of ids; bytes that aren't UTF-8 become U+FFFD, and the mark that encoding put first goes."""
        data, ends = gather(self.flat, self.starts, self.sizes, ids)
        data, edges = data.tobytes(), np.concatenate(([0], ends))[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace")[self.prefix :] for a, b in zip(edges, edges[1:], strict=False)]


def decode(rows: DataFrame, model: Model, column: str = "ids_") -> DataFrame:
    """rows with the text of an array of ids as the column `decoded_`; null ids: null."""
    shared, at = rows.sparkSession.sparkContext.broadcast(model), rows.columns.index(column)
    name = unused(rows.columns, "decoded_")
    names = [*rows.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for whole in batches:
            for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                ids = batch.column(at)
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                texts = pieces(ids.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t if known else None for t, known in zip(texts, ids.is_valid().to_pylist(), strict=True)], pa.string())], names=names)

    return rows.mapInArrow(run, rows.select("*", F.lit("").cast("string").alias(name)).schema)


def op4(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids, their number, and whether they decode to the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = encode(rows, model, check=True)
    return done.select("doc_id", F.col("ids_").alias("ids"), F.size("ids_").cast("long").alias("n_tokens"), F.col("round_trip_").alias("round_trip"))
