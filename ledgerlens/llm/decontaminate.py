"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of `width` words (a shorter item is one window). A document contains a window only if it
contains the window's rarest word, so that word is the necessary prefix: word frequencies over all documents give the
order, documents join the windows on prefix words, the position of the prefix word fixes where the window would have to
lie and whether it fits, and the words there are compared one by one.

The windows are broadcast in blocks of at most `block_windows`, whatever the benchmark's size; with more than one block
the documents pass once for each, written in between.

Defined results: null or empty text: no words, nothing hit. Null item text: no window. A null item_id is written as an
empty string. Items that repeat an id count once. Repeated documents give repeated results. Long texts are searched
whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, strings, unused

#: A-Z to a-z, and a space for every byte outside words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+; all bytes of a character beyond ASCII are inside.
_FOLD = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()
FOUND = "n_words long, spans array<int>, items array<string>"


def words(text: str | bytes | None) -> list[bytes]:
    """Folded words in UTF-8. Bytes, as str.translate takes about three times all the rest of a pass."""
    if not text:
        return []
    return (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).translate(_FOLD).split()


def encoded(texts: pa.Array) -> list[bytes | None]:
    return strings(texts.cast(pa.large_binary()))


def windows(text: str | None, width: int = 10) -> set[tuple[bytes, ...]]:
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def blocks(benchmark: DataFrame, width: int, block_windows: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Windows with the ids of their items; no more than about block_windows at a time on the driver."""
    held: dict[tuple[bytes, ...], set[str]] = {}
    for r in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        for w in windows(r["text"], width):
            held.setdefault(w, set()).add(r["item_id"] or "")
            if len(held) >= block_windows:  # an item may go over several blocks
                yield held
                held = {}
    if held:
        yield held


def frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary (a block's words) occurs, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = shared.value, Counter()
        for batch in batches:
            for text in encoded(batch.column(0)):
                seen.update(wanted.intersection(words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


Index = dict[bytes, list[tuple[list[bytes], int, tuple[str, ...]]]]


def index(block: dict[tuple[bytes, ...], set[str]], frequency: dict[bytes, int]) -> Index:
    """Windows by their rarest word: (words, position of that word, item ids). Windows with a word that no document has can't occur."""
    found: Index = {}
    for w, items in block.items():
        rank = [frequency.get(x, 0) for x in w]
        if 0 in rank:
            continue
        at = min(range(len(w)), key=lambda i: (rank[i], w[i], i))
        found.setdefault(w[at], []).append((list(w), at, tuple(sorted(items))))
    return found


def search(text_words: list[bytes], by_prefix: Index, prefixes: frozenset[bytes]) -> tuple[list[int], set[str]]:
    """Spans (start, end, ...) of the windows that occur, and their items."""
    spans: set[tuple[int, int]] = set()
    items: set[str] = set()
    if prefixes.isdisjoint(text_words):
        return [], items
    n = len(text_words)
    for at, word in enumerate(text_words):
        if word in prefixes:
            for window, offset, ids in by_prefix[word]:
                start = at - offset
                end = start + len(window)
                if start >= 0 and end <= n and text_words[start:end] == window:
                    spans.add((start, end))
                    items.update(ids)
    return [x for span in sorted(spans) for x in span], items


def mark(docs: DataFrame, by_prefix: Index, name: str = "leaks_", again: bool = False) -> DataFrame:
    """docs and, last, a struct column of FOUND; again: added to what an earlier block found, which is there already."""
    shared = docs.sparkSession.sparkContext.broadcast(by_prefix)
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_prefix = shared.value
        prefixes = frozenset(by_prefix)
        for batch in batches:
            names = batch.schema.names
            before = batch.column(names.index(name)).to_pylist() if again else None
            out = []
            for i, text in enumerate(encoded(batch.column(names.index("text")))):
                w = words(text)
                spans, items = search(w, by_prefix, prefixes)
                if before:
                    spans, items = before[i]["spans"] + spans, items.union(before[i]["items"])
                out.append({"n_words": len(w), "spans": spans, "items": sorted(items)})
            rest = [(n, c) for n, c in zip(names, batch.columns, strict=True) if not (again and n == name)]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(out, kind)], names=[*(n for n, _ in rest), name])

    fields = ", ".join(f"{x.split()[0]}: {x.split()[1]}" for x in FOUND.split(", "))
    plain = docs.drop(name) if again else docs
    return docs.mapInArrow(run, plain.select("*", F.lit(None).cast(f"struct<{fields}>").alias(name)).schema)


def find(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_windows: int = 200_000) -> DataFrame:
    """docs (with a column text) and, last, the struct column `leaks_` (with further underscores if that is taken): n_words,
    spans of hit windows, items."""
    out, n, name = docs, 0, unused(docs.columns, "leaks_")
    for n, block in enumerate(blocks(benchmark, width, block_windows), 1):
        if n > 1:
            out = Scratch(out, "leaks").read()
        out = mark(out, index(block, frequencies(docs, {x for w in block for x in w})), name, n > 1)
    return out if n else mark(out, {}, name)


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark)
    kind = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks = batch.column(1).to_pylist()
            hits = [covered(x["spans"]) for x in leaks]
            columns = [batch.column(0), [x["n_words"] for x in leaks], hits, [len(x["items"]) for x in leaks], [hashlib.sha256(",".join(x["items"]).encode()).hexdigest() for x in leaks], [h > 0 for h in hits]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 4 + (pa.string(), pa.bool_()), strict=True)], names=[x.split()[0] for x in kind.split(", ")])

    return found.select("doc_id", "leaks_").mapInArrow(run, kind)


def covered(spans: list[int]) -> int:
    """How many words lie in the spans."""
    total = last = 0
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, b - max(a, last))
        last = max(last, b)
    return total


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    found = find(docs, benchmark)
    return found.filter(F.size(F.col(found.columns[-1])["items"]) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, k FROM (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS k FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0))),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
