"""Quality rules from tokeniser fertility.

Two public vocabularies measure every whole text: characters per token (a byte-level BPE for many languages),
the share of byte-fallback tokens and the token entropy (a SentencePiece BPE), the last as the mean over windows of
`window` tokens, the tail's among them, so that it doesn't depend on a text's length. Each language, or where that is null each script, gets
rejection bands around its own median, in units of its median absolute deviation, from all its documents that pass the base
rules. Junk shortens tokens and repeats them at once, so the first band is on the sum of both deviations.

Counts are the vocabularies' own on the whole text: words between single spaces are remembered, as both vocabularies always
cut there, and texts with other spacing go through the libraries whole. Medians are of values rounded to five places, so
they don't depend on how rows are dealt.

Defined results: null, empty or blank texts have no words: base_failed, not kept. A language with fewer than
`min_group` documents uses the bands of all documents. Repeated rows count as often as they occur. Long texts are
measured whole. Columns of the input keep their place; the results' columns come last, under names that get further
underscores if they are taken.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Scratch, unused

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, band_group string, n_tokens long, chars_per_token double, byte_share double, token_entropy double"
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
_WORD = re.compile(WORD)
_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
_NAMES = [x.split()[0] for x in MEASURES.split(", ")]
_KINDS = [_TYPES[x.split()[1]] for x in MEASURES.split(", ")]


@dataclass(frozen=True)
class Bands:
    """Limits in median absolute deviations (times 1.4826) from a group's median."""

    joint: float = -8.5  # chars_per_token and token_entropy together, below
    entropy: float = -12.0
    chars_low: float = -14.0
    chars_high: float = 20.0
    byte_share: float = 25.0
    min_group: int = 20


class Vocabularies:
    """Tokens of space-separated chunks, remembered in two generations of up to `most` chunks."""

    def __init__(self, piece_path: str | None = None, bpe_path: str | None = None, most: int = 400_000):
        import base64

        import public_tokenizers as public
        import sentencepiece
        import tiktoken

        self.sp = sentencepiece.SentencePieceProcessor(model_file=piece_path or public.path("piece_bpe_32k.model"))
        with open(bpe_path or public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("chunks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])
        self.most, self.known, self.old = most, {}, {}

    def learn(self, chunks: set[str]) -> None:
        missing = chunks.difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.old, self.known, missing = self.known, {}, chunks
        new = []
        for c in missing:
            if (found := self.old.get(c)) is not None:
                self.known[c] = found
            else:
                new.append(c)
        for chunk, ids in zip(new, self.sp.encode(new, num_threads=1), strict=True):
            self.known[chunk] = (array("H", ids).tobytes(), len(self.bpe.encode_ordinary(" " + chunk)))

    def tokens(self, text: str, chunks: list[str] | None) -> tuple[np.ndarray, int]:
        """SentencePiece ids and the number of BPE tokens of a text, by its chunks, which are known, if it may be cut at spaces."""
        if not text:
            return np.empty(0, "<u2"), 0
        if chunks is None:
            return np.array(self.sp.encode(text), dtype="<u2"), len(self.bpe.encode_ordinary(text))
        ids, counts = zip(*map(self.known.__getitem__, chunks), strict=True)
        # the first word has no space before it
        return np.frombuffer(b"".join(ids), dtype="<u2"), sum(counts) - counts[0] + len(self.bpe.encode_ordinary(chunks[0]))


_RUNS = re.compile(r"\s\s+|\A\s|\s\Z")


def chunks_of(text: str) -> list[str] | None:
    """A text's words between single spaces; None if white space other than line ends comes in runs, first or last, or the
    text holds the mark that SentencePiece writes for a space."""
    if "\u2581" in text or any(run.strip("\n") for run in _RUNS.findall(text)) or text[:1] == "\n" or text[-1:] == "\n":
        return None
    return text.split(" ")


_vocabularies: dict[tuple[str | None, str | None], Vocabularies] = {}


def vocabularies(piece_path: str | None, bpe_path: str | None) -> Vocabularies:
    """One for each worker process, so that its memory serves all of its tasks."""
    if (piece_path, bpe_path) not in _vocabularies:
        _vocabularies[piece_path, bpe_path] = Vocabularies(piece_path, bpe_path)
    return _vocabularies[piece_path, bpe_path]


def entropy(ids: np.ndarray, window: int = 128) -> float:
    """Mean entropy in bits over whole windows and the last one, which counts by the tokens that only it holds; over the
    text if it is shorter than a window."""
    if not len(ids):
        return 0.0
    width = min(window, len(ids))
    rest = len(ids) % width
    rows = ids[: len(ids) - rest].reshape(-1, width)
    if rest:
        rows = np.concatenate((rows, ids[None, -width:]))
    rows = np.sort(rows, axis=1)
    new = np.ones(rows.shape, dtype=bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    starts = np.flatnonzero(new.ravel())
    counts = np.diff(np.append(starts, rows.size))
    bits = counts * np.log2(counts)
    if rest:
        last = np.searchsorted(starts, rows.size - width)
        bits[last:] *= rest / width
    return float(np.log2(width) - bits.sum() / len(ids))


def repeated_words(words: list[str], n: int = 3) -> int:
    """Words inside n-word windows that occur twice or more."""
    if len(words) <= n:
        return 0
    codes, known = pd.factorize(np.array(words, dtype=object))
    keys = codes[: len(codes) - n + 1].astype(np.int64)
    for k in range(1, n):  # codes again after each word, so that keys never overflow
        keys = pd.factorize(keys * len(known) + codes[k : len(codes) - n + 1 + k])[0].astype(np.int64)
    counts = np.bincount(keys)
    if len(counts) == len(keys):
        return 0
    hit = np.zeros(len(words), dtype=bool)
    twice = counts[keys] > 1
    for k in range(n):
        hit[k : k + len(keys)] |= twice
    return int(hit.sum())


def script(text: str) -> str:
    """The commonest script of a text's letters, by the first word of their Unicode names."""
    import unicodedata

    seen = Counter(unicodedata.name(c, "?").split()[0] for c in set(text) if c.isalpha())
    return "script:" + (min(seen, key=lambda s: (-seen[s], s)) if seen else "none")


def base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    repeated = repeated_words(words)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(words) < 50 or 100 * repeated > 50 * len(words)


def measure(docs: DataFrame, window: int = 128, piece_path: str | None = None, bpe_path: str | None = None) -> DataFrame:
    """docs and, last, a struct column of MEASURES, from columns text and, if present, lang."""
    has_lang, added = "lang" in docs.columns, unused(docs.columns, "fertility_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabularies(piece_path, bpe_path)
        for batch in (whole.slice(i, 500) for whole in batches for i in range(0, whole.num_rows, 500)):
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            langs = batch.column(names.index("lang")).to_pylist() if has_lang else [None] * len(texts)
            chunks = [chunks_of(t) if t else [] for t in texts]
            tokens.learn(set().union(*(c for c in chunks if c)))
            rows = []
            for text, lang, parts in zip(texts, langs, chunks, strict=True):
                ids, n = tokens.tokens(text or "", parts)
                rows.append((*base(text), lang if lang is not None else script(text or ""), n, len(text) / n if n else 0.0, float(tokens.is_byte[ids].mean()) if len(ids) else 0.0, entropy(ids, window)))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NAMES]
            struct = pa.StructArray.from_arrays([pa.array(c, type=k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*names, added])

    fields = ", ".join(f"{a.split()[0]}: {a.split()[1]}" for a in MEASURES.split(", "))
    schema = docs.select("*", F.lit(None).cast(f"struct<{fields}>").alias(added)).schema
    return docs.mapInArrow(run, schema)


METRICS = ("chars_per_token", "byte_share", "token_entropy")


def _medians(rows: DataFrame, name: str) -> DataFrame:
    """band_group, n and the median of each metric, `name` before it, counted by rounded value first, so that a group's
    values never meet in one task."""
    values = rows.select("band_group", F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.round(m, 5).alias("v")) for m in METRICS))).alias("x"))
    bins = values.groupBy("band_group", "x.m", "x.v").agg(F.count("*").alias("k"))
    return bins.groupBy("band_group").agg(*(F.percentile(F.when(F.col("m") == m, F.col("v")), 0.5, F.col("k")).alias(f"{name}_{m}") for m in METRICS), F.sum(F.when(F.col("m") == METRICS[0], F.col("k"))).alias(f"n_{name}"))


def verdicts(measured: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """measured (of a written table; its last column holds MEASURES) and, last, a boolean column: is the row kept?"""
    f = F.col(f"`{measured.columns[-1]}`")
    good = measured.filter(~f["base_failed"]).select(f["band_group"].alias("band_group"), *(f[m].alias(m) for m in METRICS))
    both = good.unionByName(good.withColumn("band_group", F.lit(None).cast("string")))  # null: all documents
    mids = _medians(both, "mid")
    near = F.broadcast(mids.withColumnRenamed("band_group", "g"))  # a row for each language
    off = both.join(near, F.col("band_group").eqNullSafe(F.col("g"))).select("band_group", *(F.abs(F.col(m) - F.col(f"mid_{m}")).alias(m) for m in METRICS))
    stats = mids.join(_medians(off, "mad").withColumnRenamed("band_group", "g"), F.col("band_group").eqNullSafe(F.col("g"))).drop("g")
    found = stats.filter("band_group is null").first()
    whole = found.asDict() if found else {}
    key, group, stat, kept = (unused(measured.columns, x) for x in ("group_key_", "group_", "bands_", "kept_"))
    limits = F.struct(*(F.col(f"{x}_{m}") for x in ("mid", "mad") for m in METRICS)).alias(stat)
    own = stats.filter(F.col("band_group").isNotNull() & (F.col("n_mid") >= bands.min_group)).select(F.col("band_group").alias(group), limits)
    joined = measured.withColumn(key, f["band_group"]).join(F.broadcast(own), F.col(key) == F.col(group), "left")

    def z(m: str):
        mid, mad = (F.coalesce(F.col(stat)[f"{x}_{m}"], F.lit(whole.get(f"{x}_{m}")).cast("double")) for x in ("mid", "mad"))
        return F.coalesce((f[m] - mid) / F.greatest(mad * 1.4826, F.abs(mid) * 0.005, F.lit(1e-4)), F.lit(0.0))

    chars, share, bits = (z(m) for m in METRICS)
    inside = (chars + bits >= bands.joint) & (bits >= bands.entropy) & chars.between(bands.chars_low, bands.chars_high) & (share <= bands.byte_share)
    return joined.withColumn(kept, ~f["base_failed"] & inside).select(*(F.col(f"`{c}`") for c in measured.columns), kept)


def op2(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The contract's columns for every document, and the measures behind the verdict."""
    lang = [F.col("lang").cast("string").alias("lang")] if "lang" in docs.columns else []
    written = Scratch(measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *lang)).select("doc_id", "fertility_"), "fertility").read()
    f = F.col("fertility_")
    return verdicts(written, bands).select("doc_id", *(f[n].alias(n) for n in _NAMES[:6]), F.col("kept_").alias("kept"), *(f[n].alias(n) for n in _NAMES[6:]))


def keep(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    done = verdicts(Scratch(measure(docs), "fertility").read(), bands)
    return done.filter(F.col(done.columns[-1])).select(*(F.col(f"`{c}`") for c in docs.columns))
