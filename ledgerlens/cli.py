"""Command line: python -m ledgerlens.cli classic|vlm|ocr|layout|read|clean|validate|bench|models ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import backends, images, layout, meta, rules
from ledgerlens.plans import classic, validation, vlm
from ledgerlens.session import get_spark
from ledgerlens.sources import files

COMMANDS = {
    "classic": "OCR results to validated documents",
    "vlm": "raw model responses to validated documents",
    "ocr": "images to OCR results",
    "layout": "OCR results to layout results and blocks",
    "read": "images to stored responses of a vision model",
    "clean": "images to cleaned images",
    "validate": "payloads to their validation",
    "bench": "prompts of documents by every known model",
    "models": "list the known models",
}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in COMMANDS.items():
        c = commands.add_parser(name, help=text)
        if name != "models":
            c.add_argument("input")
            c.add_argument("output")
        if name in ("classic", "vlm"):
            c.add_argument("--spec", action="store_true", help="follow the written contract instead of observed behaviour")
        if name in ("classic", "validate"):
            c.add_argument("--seller-name")
            c.add_argument("--seller-tax-id")
        if name == "classic":
            c.add_argument("--layout", help="layout results by the same paths")
        if name == "vlm":
            c.add_argument("--currency")
        if name == "ocr":
            c.add_argument("--engine", default="auto", help="auto, tesseract or stub")
            c.add_argument("--lang", default="eng")
        if name == "read":
            c.add_argument("--stored", help="stored responses, by the images' stems")
        if name == "clean":
            c.add_argument("--dpi", type=int, default=0)
    a = parser.parse_args(args)
    spark = get_spark(a.command)
    if a.command == "models":
        backends.registry(spark).show(truncate=False)
    elif a.command == "classic":
        files.write_json(classic.run(files.ocr_words(spark, a.input), meta.Company(a.seller_name, a.seller_tax_id), files.layout(spark, a.layout) if a.layout else None, spec=a.spec), a.output)
    elif a.command == "vlm":
        files.write_stages(vlm.run(files.raw_texts(spark, a.input), a.currency, spec=a.spec), a.output)
    elif a.command == "ocr":
        engine = layout.tesseract(a.lang) if layout.engine_order(a.engine, ("tesseract",))[0] == "tesseract" else None
        files.write_json(files.ocr_payloads(layout.recognise(files.scan(spark, a.input), engine)), a.output)
    elif a.command == "layout":
        words = files.ocr_words(spark, a.input)
        files.write_json(files.layout_payloads(layout.annotate(words)), f"{a.output}/layout")
        files.write_json(files.block_payloads(layout.heuristic_blocks(words)), f"{a.output}/blocks")
    elif a.command == "read":
        stored = files.raw_texts(spark, a.stored).select(stem("doc_id").alias("stem"), "raw_text") if a.stored else None
        scans = files.scan(spark, a.input).withColumn("stem", stem("doc_id"))
        found = scans.join(stored, "stem", "left") if stored is not None else scans.withColumn("raw_text", F.lit(None).cast("string"))
        files.write_json(found.select("doc_id", "raw_text"), a.output)
    elif a.command == "clean":
        files.write_files(images.png_files(images.preprocess(files.images(spark, a.input)), a.dpi), a.output)
    elif a.command == "validate":
        files.write_json(validation.run(files.strict_json(spark, a.input, validation.PAYLOAD), rules.Rules(seller_name=a.seller_name, seller_tax_id=a.seller_tax_id)), a.output)
    else:
        files.write_json(bench(files.strict_json(spark, a.input, validation.PAYLOAD)), a.output)


def stem(path: str):
    """A path's last name without its ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def bench(payloads: DataFrame, **models) -> DataFrame:
    """The prompts of payloads by every known model; models: generate or load of backends.sweep."""
    none = F.array().cast("array<string>")
    prompt = backends.validation_prompt(F.col("meta"), F.col("rows"), rules.CLASSIC_FIELDS, 0.5, F.lit(None).cast("string"), none)
    return backends.sweep(payloads.select("doc_id", prompt.alias("prompt")), **models)


if __name__ == "__main__":
    main()
