"""N-gram Jaccard join with Bayesian candidate pruning.

Documents become sets of hashed `n`-word shingles (words are runs without ASCII white space, A-Z lower-cased; a shorter
text is one shingle). Documents with one set are copies, and one of them stands for all. The others meet in the
buckets of `bands` bands of `rows` MinHash values. In a bucket, signatures are compared in steps of 16 values, and a pair is
dropped once the posterior probability (uniform prior) that its similarity reaches the threshold falls below
`tolerance`. What survives joins documents into clusters, and in a cluster every pair is verified exactly on its shingles,
so that the clusters only have to be connected, not complete.

Large buckets and clusters are cut into blocks, and each pair of blocks is a group of its own; pairs are counted where
they are verified and never become rows. With the defaults a pair of similarity 0.8 misses all buckets with probability
3e-6 and is pruned with probability below 1e-5.

Defined results: null, empty or blank texts have no shingle: a class of their own, no links. Rows with a null doc_id are
returned with a null class and no links. Repeated rows are copies of each other and are each returned; rows of one
doc_id with different texts count as the different texts they are. Other columns are ignored. Long texts count with all their shingles. Ties: the least doc_id names a class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Scratch, ascii_lower, cut, groups, partitions, release
from ledgerlens.llm.components import attach, components

_WORD = re.compile(WORD)
BANDS, ROWS, STEP = 32, 5, 16
_A = np.random.default_rng(20240229).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.default_rng(20240301).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    import xxhash

    flat: list[str] = []
    ends = []
    for text in texts:
        if text:
            flat.extend(_WORD.findall(ascii_lower(text)))
        ends.append(len(flat))
    codes, known = pd.factorize(np.array(flat, dtype=object))
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in known], dtype=np.uint64)[codes] if flat else np.empty(0, np.uint64)
    rolled = hashes[: max(0, len(hashes) - n + 1)].copy()
    for k in range(1, n):
        rolled = _mix(rolled + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + len(rolled)]
    rolled = _mix(rolled)
    out, a = [], 0
    for b in ends:
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            h = hashes[a : a + 1].copy()
            for k in range(a + 1, b):
                h = _mix(h + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + 1]
            out.append(_mix(h + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
        a = b
    return out


def set_key(found: np.ndarray) -> bytes:
    """What tells a set of shingles from any other: two sums of hashes, and its size."""
    return np.array([_mix(found).sum(dtype=np.uint64), _mix(found ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64), len(found)], dtype="<u8").tobytes()


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingles."""
    x, least = (found >> np.uint64(32)).astype(np.uint32), np.full(len(_A), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 8192):
        least = np.minimum(least, (x[None, i : i + 8192] * _A[:, None] + _B[:, None]).min(axis=1))
    return least


def minima(threshold: float, tolerance: float, size: int = BANDS * ROWS, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, least matches that keep a pair); signatures of bytes agree by chance once in 256."""
    t = threshold + (1 - threshold) / 256
    out = []
    for m in range(step, size + 1, step):
        below, k = (1 - t) ** (m + 1), 0  # P(similarity >= t | k of m) = P(Bin(m + 1, t) <= k)
        while below < tolerance:
            k += 1
            below += math.comb(m + 1, k) * t**k * (1 - t) ** (m + 1 - k)
        out.append((m, k))
    return out


def survivors(own: np.ndarray, others: np.ndarray, least: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of others the incremental comparison with own keeps."""
    alive, matches, done = np.arange(len(others)), np.zeros(len(others), np.int64), 0
    for m, k in least:
        matches = matches + (others[alive, done:m] == own[done:m]).sum(axis=1)
        keep = matches >= k
        alive, matches, done = alive[keep], matches[keep], m
        if not len(alive):
            break
    return alive


def spanning(signatures: np.ndarray, least: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges that connect whatever surviving pairs connect in a bucket; work grows with the rows outside its main cluster."""
    n = len(signatures)
    label, edges = np.arange(n), []

    def compare(i: int) -> None:
        other = np.flatnonzero(label != label[i])
        for j in other[survivors(signatures[i], signatures[other], least)].tolist():
            if label[j] != label[i]:
                edges.append((i, j))
                label[label == label[j]] = label[i]

    compare(0)
    for i in np.flatnonzero(label != label[0]).tolist():
        if (label == label[i]).all():
            break
        compare(i)
    return edges


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, room: int = 8_000_000) -> np.ndarray:
    """Boolean matrix: do sets left[i] and right[j] reach the threshold? Counted exactly on the shingles that several sets hold."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    width = int(column.max()) + 1 if len(column) else 0
    common = np.zeros((len(left), len(right)), dtype=np.float32)  # counts stay exact below 2**24
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    chunk = max(1, min(width, room // max(1, len(sets))))  # no wider than what a small cluster shares
    starts = np.searchsorted(column, np.arange(0, width + chunk, chunk))
    for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        x = np.zeros((len(left), chunk), dtype=np.float32)
        y = np.zeros((len(right), chunk), dtype=np.float32)
        o, c = owner[a:b], column[a:b] - k * chunk
        m, p = at_left[o] >= 0, at_right[o] >= 0
        x[at_left[o[m]], c[m]] = 1
        y[at_right[o[p]], c[p]] = 1
        common += x @ y.T
    both = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * both - 1e-6


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, size, set key, signature (bytes) and band keys of docs (doc_id, text)."""
    kind = "doc_id long, size int, set_key binary, signature binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, BANDS + 1, dtype=np.uint64)
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                rows = []
                for s in shingles(batch.column(1).to_pylist()):
                    if not len(s):
                        rows.append((0, None, None, None))
                        continue
                    values = signature(s)
                    h = salt.copy()
                    for r in range(ROWS):
                        h = _mix(h + np.uint64(0x9E3779B97F4A7C15)) ^ values[r::ROWS].astype(np.uint64)
                    rows.append((len(s), set_key(s), values.astype(np.uint8).tobytes(), _mix(h).astype(np.int64)))
                size, key, sig, bands = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int32()), pa.array(key, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "size", "set_key", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def _block_pairs(rows: DataFrame, group: str, order: str, block: int) -> DataFrame:
    """rows with a key for each pair of blocks of their group, and their block, dealt by hash into blocks of about `block`
    rows; groups of one row are left out. No task sees a whole group."""
    rows = attach(rows, group, order, n_=(F.lit(1), "sum")).filter("n_ > 1")
    count = F.ceil(F.col("n_") / block).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(block), order), count).cast("int"))
    pair = rows.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    return pair.withColumn("key", F.concat_ws(":", F.col(group).cast("string"), F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string"))).drop("n_", "other")


def surviving(reps: DataFrame, least: list[tuple[int, int]], block: int = 8192) -> DataFrame:
    """Edges (a, b) that connect what surviving pairs of any bucket connect; reps: rep, signature, bands."""
    hits = reps.select("rep", F.explode("bands").alias("band"))
    hits = attach(hits, "band", "rep", n=(F.lit(1), "sum"), members=(F.xxhash64("rep"), "bit_xor")).filter("n > 1")
    # bands whose buckets hold the same documents are one bucket
    bucket = hits.select("rep", F.concat_ws("-", F.col("members").cast("string"), F.col("n").cast("string")).alias("bucket")).dropDuplicates(["bucket", "rep"])
    bucket = cut(bucket, "buckets")  # counted again below, and by attach() in three places
    rows = _block_pairs(bucket, "bucket", "rep", block).select("key", "rep").join(reps.select("rep", "signature"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in groups(batches, "key"):
            if table.num_rows < 2:
                continue
            ids = table.column("rep").to_numpy()
            sigs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
            edges = spanning(sigs, least)
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(a)]), pa.array(ids[list(b)])], names=["a", "b"])

    n = partitions(reps.sparkSession)
    return rows.repartition(n, "key").sortWithinPartitions("key", "rep").select("key", "rep", "signature").mapInArrow(run, "a long, b long")


def verify(docs: DataFrame, clusters: DataFrame, threshold: float, block: int = 3072) -> DataFrame:
    """rep, documents and texts linked, and a representative to which it is connected, for each pair of blocks of a cluster.

    clusters: rep, component, copies, and the least doc_id and set key of the texts that rep stands for.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("least"), F.col("text").cast("string").alias("text")).join(clusters, "least")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                sets = shingles(batch.column(4).to_pylist())
                own = pa.array([set_key(s) == key for s, key in zip(sets, batch.column(3).to_pylist(), strict=True)], pa.bool_())  # a doc_id may have other texts
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "component", "copies", "shingles"]).filter(own)

    sets = texts.select("rep", "component", "copies", "set_key", "text").mapInArrow(shingled, "rep long, component long, copies long, shingles binary").dropDuplicates(["rep"])
    sets = cut(sets, "sets")  # else shingled again for the counts
    rows = _block_pairs(sets, "component", "rep", block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in groups(batches, "key"):
            ids, copies, part = (table.column(c).to_numpy() for c in ("rep", "copies", "block"))
            found = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            if (part == part[0]).all():
                left = right = np.arange(len(ids))
            else:
                left, right = np.flatnonzero(part == part.min()), np.flatnonzero(part == part.max())
            links = linked(found, left, right, threshold)
            if left is right:
                np.fill_diagonal(links, False)
            documents, texts_ = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            documents[left], texts_[left] = links @ copies[right], links.sum(axis=1)
            if left is not right:
                documents[right], texts_[right] = copies[left] @ links, links.sum(axis=0)
            root = np.arange(len(ids))
            seen = np.zeros(len(ids), dtype=bool)
            at_left, at_right = np.full(len(ids), -1), np.full(len(ids), -1)
            at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
            for i in range(len(ids)):  # rows are sorted by rep, so roots are the least of their component
                front = np.array([i]) if not seen[i] else np.empty(0, np.int64)
                while len(front):
                    seen[front], root[front] = True, i
                    near = np.zeros(len(ids), dtype=bool)
                    l, r = at_left[front], at_right[front]
                    near[right] |= links[l[l >= 0]].any(axis=0)
                    if left is not right:
                        near[left] |= links[:, r[r >= 0]].any(axis=1)
                    front = np.flatnonzero(near & ~seen)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(documents), pa.array(texts_), pa.array(ids[root])], names=["rep", "documents", "texts", "root"])

    n = partitions(docs.sparkSession)
    return rows.repartition(n, "key").sortWithinPartitions("key", "rep").select("key", "rep", "copies", "block", "shingles").mapInArrow(run, "rep long, documents long, texts long, root long")


def join(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """doc_id, class_id (the least doc_id of its connected documents), copy_of, n_copies, n_links (other documents that
    reach the threshold, copies included) and n_linked_texts (different texts among them), for every row of docs."""
    sketches = Scratch(sketch(docs), "sketches").read()
    known = sketches.filter("doc_id is not null and size > 0")
    # a set's number is its own, whatever ids its documents have; once written it stays
    reps = known.groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    reps = Scratch(reps.withColumn("rep", F.monotonically_increasing_id()), "reps").read()
    near = components(surviving(reps, minima(threshold, tolerance)))
    clusters = near.withColumnRenamed("node", "rep").join(reps.select("rep", "copies", "least", "set_key"), "rep")
    verified = Scratch(verify(docs, clusters, threshold), "verified").read()
    release(docs.sparkSession)
    classes = components(verified.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = verified.groupBy("rep").agg(F.sum("documents").alias("documents"), F.sum("texts").alias("texts"))
    named = attach(classes.join(reps.select(F.col("rep").alias("node"), "least"), "node"), "component", "node", class_id=(F.col("least"), "min")).select("node", "class_id")
    named = cut(named, "named")
    facts = reps.select("set_key", "rep", "least", "copies").join(counted, "rep", "left").join(named, F.col("rep") == F.col("node"), "left")
    facts = facts.select("set_key", F.col("least").alias("copy_of"), F.coalesce("class_id", "least").alias("class_id"), F.col("copies").alias("n_copies"), (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_linked_texts"))
    rows = sketches.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    none = rows.filter("set_key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_linked_texts"))
    return rows.filter("set_key is not null").join(facts, "set_key").select(*none.columns).unionByName(none)


def deduplicate(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """docs without those rows whose class has a row with a lesser doc_id; of repeated rows with one doc_id, one stays."""
    classes = Scratch(join(docs, threshold).select(F.col("doc_id").alias("doc_"), "class_id"), "classes").read()
    others = classes.filter("doc_ <> class_id").select("doc_").distinct()
    kept = docs.join(others, docs["doc_id"].cast("long") == F.col("doc_"), "left_anti")
    repeated = classes.filter("doc_ = class_id").groupBy("doc_").count().filter("count > 1").limit(1).count()
    if repeated:
        named = kept.filter("doc_id is not null").dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.filter("doc_id is null"))
    return kept
