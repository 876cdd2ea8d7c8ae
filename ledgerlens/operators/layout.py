"""OCR results, layout tokens and page blocks."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Token labels and kinds of blocks.
LABELS = ("other", "header", "key", "value", "table_header", "table_row", "footer")
BLOCKS = (("header", 0.35), ("table", 0.25), ("totals", 0.35))
WORD = "doc_id, pos, text, x1, y1, x2, y2, confidence, page_num, block_num, line_num, word_num"


def words_of_tsv(rows: DataFrame) -> DataFrame:
    """Word rows from a recogniser's table (doc_id, left, top, width, height, conf, ..., text as strings): no blanks, no bad boxes."""
    n = lambda c: F.col(c).try_cast("int")
    out = rows.filter(F.trim("text") != "").select(
        "doc_id", "pos", "text", n("left").alias("x1"), n("top").alias("y1"), (n("left") + n("width")).alias("x2"), (n("top") + n("height")).alias("y2"),
        F.when(F.col("conf").try_cast("double").isNotNull(), F.col("conf").try_cast("double")).alias("confidence"),
        F.coalesce(n("page_num"), F.lit(1)).alias("page_num"), *(F.coalesce(n(c), F.lit(0)).alias(c) for c in ("block_num", "line_num", "word_num")),
    )
    return out.filter("x1 is not null and y1 is not null and x2 is not null and y2 is not null")


def words_of_polygons(results: DataFrame) -> DataFrame:
    """Word rows from (doc_id, found: array of (polygon array<array<double>>, text, score)): rectangles around polygons."""
    each = results.select("doc_id", F.posexplode("found").alias("i", "w"))
    edge = lambda f, k: f(F.transform("w.polygon", lambda p: p[k])).cast("int")
    return each.select("doc_id", F.col("i").alias("pos"), "w.text", edge(F.array_min, 0).alias("x1"), edge(F.array_min, 1).alias("y1"), edge(F.array_max, 0).alias("x2"), edge(F.array_max, 1).alias("y2"), F.col("w.score").cast("double").alias("confidence"), F.lit(1).alias("page_num"), *((F.col("i") + 1).alias(c) for c in ("block_num", "line_num", "word_num")))


Recogniser = Callable[[bytes], "str | None"]


def tesseract(lang: str = "eng", psm: int = 6, oem: int = 3, command: str = "tesseract") -> Recogniser:
    """An engine that runs the program of that name on each image; RuntimeError where it isn't installed."""

    def run(content: bytes) -> str | None:
        import subprocess

        try:
            done = subprocess.run([command, "stdin", "stdout", "-l", lang, "--psm", str(psm), "--oem", str(oem), "tsv"], input=content, capture_output=True, check=False)
        except FileNotFoundError as error:
            raise RuntimeError(f"{command} isn't installed on this worker") from error
        return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None

    return run


def recognise(scans: DataFrame, engine: Recogniser | None = None) -> DataFrame:
    """Word rows from files (doc_id, content): engine gives a table of tab-separated text for an image, or None for no
    words. Without an engine, the stub, there are no words."""
    names = "level page_num block_num par_num line_num word_num left top width height conf text".split()

    @F.pandas_udf("array<array<string>>")
    def run(contents: pd.Series) -> pd.Series:
        tables = [engine(c) if engine and c is not None else None for c in contents]
        return pd.Series([[f for f in (line.split("\t") for line in (t or "").splitlines()[1:]) if len(f) == len(names)] for t in tables])

    rows = scans.select("doc_id", F.posexplode(run("content")).alias("pos", "f"))
    return words_of_tsv(rows.select("doc_id", "pos", *(F.col("f")[i].alias(n) for i, n in enumerate(names))))


def first_result(docs: DataFrame, *engines: str) -> DataFrame:
    """The words of the first engine (a column each) that has a result, its name, and the engines asked; `stub` and no words without any."""
    found = F.coalesce(*(F.when(F.col(e).isNotNull(), F.struct(F.col(e).alias("words"), F.lit(e).alias("engine"))) for e in engines))
    return docs.withColumns({"words": found["words"], "engine": F.coalesce(found["engine"], F.lit("stub")), "engine_attempts": F.array(*map(F.lit, engines))})


def engine_order(setting: str = "auto", known: tuple[str, ...] = ("tesseract", "paddle"), stub: bool = True) -> tuple[str, ...]:
    """Engines by a setting: auto, or a list with commas; unknown names are skipped. Nothing left is an error without the stub."""
    asked = known if setting == "auto" else tuple(x.strip().lower() for x in setting.split(","))
    usable = tuple(e for e in asked if e in known or e == "stub")
    if not usable and not stub:
        raise RuntimeError("no OCR engine is left")
    return usable or ("stub",)


def boxes_0_1000(words: DataFrame) -> DataFrame:
    """words with `box`: coordinates scaled by the document's largest to 0 to 1000, cut to integers."""
    w = Window.partitionBy("doc_id")
    edge = lambda c: F.greatest(F.coalesce(F.max(c).over(w), F.lit(1)), F.lit(1))
    scaled = lambda c, side: F.greatest(F.lit(0), F.least(F.lit(1000), (F.coalesce(c, F.lit(0)) * (1000.0 / F.col(side))).cast("int")))
    return words.withColumns({"wide_": edge("x2"), "high_": edge("y2")}).withColumn("box", F.array(scaled(F.col("x1"), "wide_"), scaled(F.col("y1"), "high_"), scaled(F.col("x2"), "wide_"), scaled(F.col("y2"), "high_"))).drop("wide_", "high_")


def stub_labels(words: DataFrame) -> DataFrame:
    """doc_id, tokens, engine, model_name: every word is `other`."""
    token = F.struct("pos", "text", "x1", "y1", "x2", "y2", "box", F.lit("other").alias("label"), F.lit(0.0).alias("score"))
    return boxes_0_1000(words.filter(F.trim("text") != "")).groupBy("doc_id").agg(F.sort_array(F.collect_list(token)).alias("tokens")).withColumns({"engine": F.lit("stub"), "model_name": F.lit(None).cast("string")})


def first_subtokens(predictions: DataFrame) -> DataFrame:
    """One row for each word of (doc_id, word, idx, label, score): that of its first sub-token."""
    return predictions.groupBy("doc_id", "word").agg(F.min_by(F.struct("idx", "label", "score"), "idx").alias("p")).select("doc_id", "word", "p.*")


def model_labels(words: DataFrame, label: Callable[[list[list[str]], list[list[list[int]]]], list[list[tuple[str, float]]]], name: str, most: int = 512) -> DataFrame:
    """As stub_labels, from a model: label(texts, boxes) for a batch of documents; words beyond `most` are left out, as the model's window does."""
    kind = "array<struct<label: string, score: double>>"

    @F.pandas_udf(kind)
    def run(texts: pd.Series, boxes: pd.Series) -> pd.Series:
        return pd.Series([[{"label": a, "score": float(b)} for a, b in one] for one in label([list(t)[:most] for t in texts], [list(map(list, b))[:most] for b in boxes])])

    base = stub_labels(words)
    got = base.withColumn("got_", run(F.transform("tokens", lambda t: t["text"]), F.transform("tokens", lambda t: t["box"])))
    tokens = F.transform(F.slice("tokens", F.lit(1), F.size("got_")), lambda t, i: t.withField("label", F.col("got_")[i]["label"]).withField("score", F.col("got_")[i]["score"]))
    return got.withColumns({"tokens": tokens, "engine": F.lit("huggingface"), "model_name": F.lit(name)}).drop("got_")


def with_images(words: DataFrame, images: DataFrame) -> DataFrame:
    """words of the documents that have an image that can be read (doc_id, data); a model of pages can't label the others."""
    return words.join(images.filter("data is not null").select("doc_id").distinct(), "doc_id", "left_semi")


def annotate(words: DataFrame, backend: str = "stub", load: Callable[[], Callable] | None = None, name: str = "", images: DataFrame | None = None) -> DataFrame:
    """Labels by a backend's name: a model that load() can't bring up, or that isn't there, is the stub. Documents without an
    image have no tokens where the model needs images."""
    label = None
    if backend not in ("stub", "disabled") and load is not None:
        try:
            label = load()
        except Exception:  # noqa: BLE001 - whatever is missing, the stub stands in
            label = None
    if label is None:
        return stub_labels(words)
    return model_labels(with_images(words, images) if images is not None else words, label, name or backend)


def heuristic_blocks(words: DataFrame) -> DataFrame:
    """(doc_id, kind, box, confidence): header is the top 22 % of the words' extent, totals the bottom 18 %, the table lies between."""
    extent = words.groupBy("doc_id").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    high = F.greatest(F.col("y2") - F.col("y1"), F.lit(1))
    cut = extent.withColumns({"a": (F.col("y1") + high * 0.22).cast("int"), "b": (F.col("y2") - high * 0.18).cast("int")})
    edges = {"header": ("y1", "a"), "table": ("a", "b"), "totals": ("b", "y2")}
    blocks = F.array(*(F.struct(F.lit(k).alias("kind"), F.array("x1", F.col(edges[k][0]), "x2", F.col(edges[k][1])).alias("box"), F.lit(c).alias("confidence")) for k, c in BLOCKS))
    return cut.select("doc_id", F.explode(blocks).alias("b")).select("doc_id", "b.*")


def blocks_with_counts(words: DataFrame) -> DataFrame:
    """heuristic_blocks with the number of words in each, as words_in_blocks would find them: one shuffle, no join."""
    w = Window.partitionBy("doc_id")
    edge = {n: f(n).over(w).alias(f"{n}_") for n, f in (("x1", F.min), ("y1", F.min), ("x2", F.max), ("y2", F.max))}
    rows = words.select("doc_id", ((F.col("y1") + F.col("y2")) / 2).alias("middle"), *edge.values())
    high = F.greatest(F.col("y2_") - F.col("y1_"), F.lit(1))
    rows = rows.withColumns({"a": (F.col("y1_") + high * 0.22).cast("int"), "b": (F.col("y2_") - high * 0.18).cast("int")})
    middle = F.col("middle")
    inside = {"header": (middle >= F.col("y1_")) & (middle < F.col("a")), "table": (middle >= F.col("a")) & (middle < F.col("b")), "totals": middle >= F.col("b")}
    pages = rows.groupBy("doc_id").agg(*(F.min(c).alias(c) for c in ("x1_", "y1_", "x2_", "y2_", "a", "b")), *(F.count_if(test).alias(kind) for kind, test in inside.items()))
    edges = {"header": ("y1_", "a"), "table": ("a", "b"), "totals": ("b", "y2_")}
    blocks = F.array(*(F.struct(F.lit(k).alias("kind"), F.array("x1_", edges[k][0], "x2_", edges[k][1]).alias("box"), F.lit(c).alias("confidence"), F.col(k).alias("n_words")) for k, c in BLOCKS))
    return pages.select("doc_id", F.explode(blocks).alias("x")).select("doc_id", "x.*")


def words_in_blocks(words: DataFrame, blocks: DataFrame) -> DataFrame:
    """Words with the kind of the block that holds their middle: one join by document, the band is a residual test."""
    middle = (F.col("y1") + F.col("y2")) / 2
    inside = (middle >= F.col("box")[1]) & ((middle < F.col("box")[3]) | (F.col("kind") == "totals"))
    return words.join(blocks, "doc_id").filter(inside).drop("box", "confidence_")


