"""Language identification by compression: the language whose dictionary shrinks a text most.

Method: each language gets one zstandard raw-content dictionary, cut from a bounded sample of its labelled rows. A
text is reduced to its lower-cased letters, with one space for any run of others, and compressed, whole, in segments
against every dictionary; the smallest total wins. The relative margin to the runner-up gives the score, and a narrow
margin is marked as rejected.

Defined results: null text, empty text or text without a letter: `und`, score 0, rejected. No learned language:
`und` for every row. Ties: the first language by name, score 0. Repeated rows give repeated results; other columns of
the input are ignored. Texts of any length are compressed whole, one segment in memory at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UND = "und"
_OTHER = re.compile(r"[\W\d_]+")
PREDICTION = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def held_out(doc_id: str = "doc_id", modulus: int = 4, remainder: int = 2):
    """True for rows that must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def letters(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


def fit(labelled: DataFrame, docs_per_lang: int = 400, chars_per_doc: int = 1000, dict_bytes: int = 110_000) -> dict[str, bytes]:
    """Dictionaries by language from columns text, lang.

    The sample is bounded: docs_per_lang different texts of a language, or all it has, chars_per_doc characters of each
    and dict_bytes in all. They are those of the least hashes, so copies neither add to nor take from a language's
    sample. A rate from the number of different texts leaves few rows to rank, at over twice docs_per_lang expected, and
    all texts of a language that has no more than that.
    """
    rows = labelled.filter("lang is not null and length(trim(text)) > 0").select("lang", "text")
    hashed = rows.select("lang", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in hashed.distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    scale = 1 << 40
    rate = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(scale, -(-scale * (2 * docs_per_lang + 100) // n))))])
    place = F.pmod(F.xxhash64("text"), F.lit(scale))
    sample = rows.filter(place < rate[F.col("lang")]).select("lang", F.substring("text", 1, chars_per_doc).alias("text"), place.alias("place"), F.xxhash64("text").alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "h"))
    got = sample.dropDuplicates(["lang", "h"]).withColumn("rank", rank).filter(F.col("rank") <= docs_per_lang).orderBy("place", "h", "lang").collect()
    found: dict[str, bytes] = {}
    for lang in sorted(counts):
        data = b" ".join(letters(r["text"]) for r in got if r["lang"] == lang)[:dict_bytes]
        if len(data) >= 8:
            found[lang] = data
    return found


class Classifier:
    """Sizes of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3, segment: int = 4096):
        import zstandard

        self.langs, self.segment = sorted(dictionaries), segment
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = letters(text)
        parts = [data[i : i + self.segment] for i in range(0, len(data), self.segment)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.coders]

    def predict(self, text: str | None, min_margin: float = 0.004) -> tuple[str, float, float, bool]:
        """(language, score from 0 to 1, relative margin, rejected)."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UND, 0.0, 0.0, True
        got = self.sizes(text)
        order = sorted(range(len(got)), key=lambda i: (got[i], i))
        second = got[order[1]] if len(order) > 1 else len(text.encode("utf-8", "replace")) + 9
        margin = max(0.0, (second - got[order[0]]) / max(second, 1))
        return self.langs[order[0]], margin / (margin + 0.02), margin, margin < min_margin


def predict(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.004) -> DataFrame:
    """PREDICTION columns for every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages x dict_bytes at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = Classifier(shared.value)
        for batch in batches:
            got = [classify.predict(t, min_margin) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], **{c: [g[i] for g in got] for i, c in enumerate(("lang_pred", "score", "margin", "rejected"))}})

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(run, PREDICTION)


def crc32_mod(doc_id: object, modulus: int) -> int:
    """The split rule in plain Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % modulus


def op9(docs: DataFrame) -> DataFrame:
    """Predict every document, learning from those that are not held out."""
    model = fit(docs.filter(~held_out()))
    marks = docs.select("doc_id", "text")
    return predict(marks, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")
