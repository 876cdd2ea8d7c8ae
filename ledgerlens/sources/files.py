"""Reading and writing documents: scans, OCR and layout JSON, payloads, raw model texts, results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OCR = "source string, engine string, engine_attempts array<string>, elapsed_seconds double, word_count int, words array<struct<text: string, bbox: array<int>, confidence: double, page_num: int, block_num: int, line_num: int, word_num: int>>"
LAYOUT = "tokens array<struct<text: string, bbox: array<int>, bbox_layoutlm: array<int>, label: string, score: double>>, embeddings array<array<float>>, model_name string, engine string"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the path), length and content of a file, or of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("doc_id"), "length", "modificationTime", "content")


def images(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and height, width, channels, data (rows of gray or RGB) of images; files that aren't images have null data."""
    import numpy as np
    import pyarrow as pa

    read = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path)
    i = F.col("image")
    rows = read.select(i["origin"].alias("doc_id"), *(F.when(i["height"] > 0, i[c]).alias(n) for c, n in (("height", "height"), ("width", "width"), ("nChannels", "channels"), ("data", "data"))))

    def rgb(batches):
        for batch in batches:
            for k, (channels, data) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):  # pages are large: one at a time
                colours = 3 if (channels or 0) > 1 else channels
                if colours == 3:  # Spark's rows are blue, green, red and perhaps alpha
                    data = np.frombuffer(data, np.uint8).reshape(-1, channels)[:, 2::-1].tobytes()
                yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(k, 1) for j in range(3)), pa.array([colours], pa.int32()), pa.array([data], pa.binary())], names=["doc_id", "height", "width", "channels", "data"])

    return rows.mapInArrow(rgb, "doc_id string, height int, width int, channels int, data binary")


def write_files(files: DataFrame, folder: str) -> None:
    """Files (name, content) into a folder that all executors have mounted; a file appears whole or not at all."""

    def write(rows) -> None:
        import os

        os.makedirs(folder, exist_ok=True)
        for r in rows:
            part = os.path.join(folder, f".{r['name']}.{os.getpid()}")
            with open(part, "wb") as f:
                f.write(r["content"])
            os.replace(part, os.path.join(folder, r["name"]))

    files.select("name", "content").foreachPartition(write)


def _json(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").option("mode", mode).option("recursiveFileLookup", "true").json(path).withColumn("doc_id", F.col("_metadata.file_path"))


def ocr_words(spark: SparkSession, path: str) -> DataFrame:
    """Word rows of OCR results; a damaged file has no words. Missing page numbers are 1, other missing numbers 0."""
    each = _json(spark, path, OCR).select("doc_id", F.posexplode(F.coalesce("words", F.array().cast("array<struct<text: string, bbox: array<int>, confidence: double, page_num: int, block_num: int, line_num: int, word_num: int>>"))).alias("pos", "w"))
    box = lambda i: F.coalesce(F.get("w.bbox", F.lit(i)), F.lit(0))
    return each.select("doc_id", "pos", F.coalesce("w.text", F.lit("")).alias("text"), box(0).alias("x1"), box(1).alias("y1"), box(2).alias("x2"), box(3).alias("y2"), "w.confidence", F.coalesce("w.page_num", F.lit(1)).alias("page_num"), *(F.coalesce(F.col(f"w.{c}"), F.lit(0)).alias(c) for c in ("block_num", "line_num", "word_num")))


def layout(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, tokens, engine, model_name of layout results."""
    t = lambda x, i: F.coalesce(F.get(x["bbox"], F.lit(i)), F.lit(0))
    tokens = F.transform(F.coalesce("tokens", F.array().cast("array<struct<text: string, bbox: array<int>, bbox_layoutlm: array<int>, label: string, score: double>>")), lambda x: F.struct(F.coalesce(x["text"], F.lit("")).alias("text"), t(x, 1).alias("y1"), t(x, 3).alias("y2"), x["label"].alias("label"), x["score"].alias("score")))
    return _json(spark, path, LAYOUT).select("doc_id", tokens.alias("tokens"), "engine", "model_name")


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a recogniser's tables, unquoted, all strings."""
    columns = "level string, page_num string, block_num string, par_num string, line_num string, word_num string, left string, top string, width string, height string, conf string, text string"
    read = spark.read.schema(columns).option("sep", "\t").option("header", "true").option("quote", "").csv(path)
    return read.withColumns({"doc_id": F.col("_metadata.file_path"), "pos": F.monotonically_increasing_id()})


def lenient_json(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and `value` (Variant); whatever can't be read is an empty object."""
    return spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("doc_id"), F.coalesce(F.try_parse_json("value"), F.parse_json(F.lit("{}"))).alias("value"))


def strict_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Payloads; reading fails on the first that is damaged."""
    return _json(spark, path, schema, "FAILFAST")


def raw_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, raw_text of stored model responses: the replay of a vision model."""
    return spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("raw_text"))


def write_json(docs: DataFrame, path: str, single: bool = False) -> None:
    """JSON lines; single puts a summary into one file."""
    (docs.coalesce(1) if single else docs).write.mode("overwrite").json(path)


def write_stages(docs: DataFrame, path: str) -> None:
    """The vision path's four outputs: raw, parsed, validation, json. The plan runs once."""
    docs = docs.persist()
    try:
        docs.select("doc_id", "raw_text").write.mode("overwrite").json(f"{path}/raw")
        docs.select("doc_id", F.to_json("parsed").alias("parsed"), "parse_error").write.mode("overwrite").json(f"{path}/parsed")
        docs.select("doc_id", "validation", "llm").write.mode("overwrite").json(f"{path}/validation")
        docs.select("doc_id", "meta", "rows", "validation", "llm").write.mode("overwrite").json(f"{path}/json")
    finally:
        docs.unpersist()


def write_split(docs: DataFrame, path: str) -> None:
    """meta and items apart, as a run of the parser alone leaves them."""
    docs = docs.persist()
    try:
        docs.select("doc_id", "meta.*").write.mode("overwrite").json(f"{path}/meta")
        docs.select("doc_id", "rows").write.mode("overwrite").json(f"{path}/items")
    finally:
        docs.unpersist()


def layout_payloads(docs: DataFrame) -> DataFrame:
    """Layout results as they are written: one row for each document."""
    token = lambda t: F.struct(t["text"].alias("text"), F.array(t["x1"], t["y1"], t["x2"], t["y2"]).alias("bbox"), t["box"].alias("bbox_layoutlm"), t["label"].alias("label"), t["score"].alias("score"))
    return docs.select("doc_id", F.transform("tokens", token).alias("tokens"), "engine", "model_name")


def block_payloads(blocks: DataFrame) -> DataFrame:
    """Blocks as they are written: one row for each document."""
    return blocks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("kind", "box", "confidence"))).alias("blocks"))


def ocr_payloads(words: DataFrame, engines: DataFrame | None = None) -> DataFrame:
    """OCR results as they are written: one row for each document; engines (doc_id, engine, engine_attempts) says whose they are."""
    word = F.struct("pos", "text", F.array("x1", "y1", "x2", "y2").alias("bbox"), *(["confidence"] if "confidence" in words.columns else []), "page_num", "block_num", "line_num", "word_num")
    docs = words.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(word)), lambda w: w.dropFields("pos")).alias("words"), F.count("*").alias("word_count")).withColumn("source", F.col("doc_id"))
    return docs.join(engines.select("doc_id", "engine", "engine_attempts"), "doc_id", "left") if engines is not None else docs
