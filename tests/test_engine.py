"""Scalar rules, the vision path, layout, images, settings and the catalog's agreement with its SQL."""

import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators import backends, images, layout, rules, vlm as V
from ledgerlens.plans import catalog, vlm
from ledgerlens.sources import config, files

D = datetime.date


@pytest.mark.parametrize(
    ("rule", "cases"),
    [
        (lambda c: S.last_amount(c), {"Total 5": None, "$ 5": 5.0, "$1,234.50 and 7": 1234.5, "1.234,56": 1.23456, "100.": 100.0, "1.2.3": None, "EUR 10.00.": None}),
        (lambda c: S.last_amount(c, False), {"Total 5": 5.0, "$1,234.50 and 7": 7.0}),
        (S.first_date, {"2020 . 1 . 5": D(2020, 1, 5), "03/04/2020": D(2020, 3, 4), "31.12.2020": None, "Dec 31, 2020": D(2020, 12, 31), "1999-01-02": None}),
        (S.normalize_date, {"03/04/2020": D(2020, 4, 3), "12/31/2020": D(2020, 12, 31), "31.12.2020": D(2020, 12, 31), "2020-1-5": D(2020, 1, 5), "31/02/2020": None, "03/04/20": None, "Sept 3, 2024": D(2024, 9, 3), "2024.01.02": None}),
        (S.normalize_number, {"$1,200.50": 1200.5, "1 200,50": 120050.0, "€ 5": 5.0, "-$5": None, "USD 5": None, "1e3": 1000.0, "": None, "1_000": 1000.0}),
        (S.normalize_currency, {"usd": "USD", "US$": "USD", "CHF": None}),
        (S.detect_currency, {"EUROPE 5": "EUR", "5 US Dollars": "USD", "CHF 5": None}),
        (S.canonical_key, {"Seller Tax-ID": "seller_tax_id", "dueDate": "payment_date", "vat_exemption": "vat_exemption", "total": "total_gross"}),
    ],
)
def test_scalars(spark, rule, cases):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").select("i", rule(F.col("t")).alias("v")).orderBy("i").collect()
    assert dict(zip(cases, [r["v"] for r in rows], strict=True)) == cases


def run_vlm(spark, *texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, raw_text string")
    return {r["doc_id"]: r for r in vlm.run(rows, **options).select("doc_id", "meta", "rows", "validation", "parse_error").collect()}


DEMO = {
    "meta": {"seller_name": "Demo Seller d.o.o.", "issue_date": "2024-12-01", "supply_date": "01.12.2024", "currency": "EUR", "total_net": 100, "total_vat": "22,0"[:2], "total_gross": 122},
    "items": [{"description": "Service", "quantity": 1, "unit_price": 100, "vat_rate": 22, "gross_amount": 122}],
}


def test_vision_path(spark):
    got = run_vlm(spark, "```json\n" + json.dumps(DEMO) + "\n```", '{"meta": {"seller', None, "[1, 2]")
    meta, rows = got[0]["meta"], got[0]["rows"]
    assert meta["seller_name"] is None and meta["currency"] is None and (meta["total_net"], meta["total_vat"], meta["total_gross"]) == (0.0, None, 0.0)
    assert [tuple(r) for r in rows] == [("Service", 1.0, None, 100.0, None, None, None, None, None)]
    assert got[0]["validation"]["errors"] == [f"Missing required field: {f}" for f in rules.VLM_FIELDS]
    for i in (1, 2, 3):
        assert got[i]["validation"]["errors"][12] == "No item rows detected" and got[i]["parse_error"]
        assert got[i]["validation"]["errors"][-1].startswith("parse_error: ")


def test_vision_path_by_contract(spark):
    r = run_vlm(spark, json.dumps(DEMO), spec=True)[0]
    assert (r["meta"]["seller_name"], r["meta"]["issue_date"], r["meta"]["total_net"], r["meta"]["total_vat"], r["meta"]["total_gross"], r["meta"]["currency"]) == ("Demo Seller d.o.o.", D(2024, 12, 1), 100.0, 22.0, 122.0, "EUR")
    assert (r["rows"][0]["vat_rate"], r["rows"][0]["gross_amount"], r["rows"][0]["net_amount"]) == (22.0, 122.0, None)


def test_synthetic_row_and_totals(spark):
    r = run_vlm(spark, json.dumps({"summary": {"subtotal": "$100.00", "total": "$110.00", "stateSalesTax": "$10.00"}}))[0]
    assert [tuple(x) for x in r["rows"]] == [("Invoice total", 1.0, None, 100.0, 100.0, None, 10.0, 110.0, "USD")]
    assert (r["meta"]["total_net"], r["meta"]["total_vat"], r["meta"]["total_gross"], r["meta"]["currency"]) == (100.0, 10.0, 110.0, "USD")


def test_layout(spark):
    words = spark.createDataFrame([(1, 0, "a", 10, 20, 110, 60), (1, 1, "b", 0, 0, 200, 300), (2, 0, "c", 0, 0, 1000, 1000)], "doc_id int, pos int, text string, x1 int, y1 int, x2 int, y2 int")
    boxes = {(r["doc_id"], r["pos"]): r["box"] for r in layout.boxes_0_1000(words).collect()}
    assert boxes[1, 0] == [50, 66, 550, 200]
    found = {r["kind"]: r["box"] for r in layout.heuristic_blocks(words.filter("doc_id = 2")).collect()}
    assert found == {"header": [0, 0, 1000, 220], "table": [0, 220, 1000, 820], "totals": [0, 820, 1000, 1000]}
    inside = {(r["doc_id"], r["kind"]): r["count"] for r in layout.words_in_blocks(words, layout.heuristic_blocks(words)).groupBy("doc_id", "kind").count().collect()}
    counted = {(r["doc_id"], r["kind"], tuple(r["box"])): r["n_words"] for r in layout.blocks_with_counts(words).collect()}
    assert counted == {(r["doc_id"], r["kind"], tuple(r["box"])): inside.get((r["doc_id"], r["kind"]), 0) for r in layout.heuristic_blocks(words).collect()}
    assert layout.engine_order("auto") == ("tesseract", "paddle") and layout.engine_order("nope") == ("stub",)
    with pytest.raises(RuntimeError):
        layout.engine_order("nope", stub=False)


def test_images(spark):
    a = np.full((40, 60, 3), 255, np.uint8)
    a[10:20, 15:45] = 0
    out, applied, _ = images.crop_to_content(a, 240, 2)
    assert applied and out.shape == (14, 34, 3)
    assert images.luma(np.array([[[255, 0, 0]]], np.uint8))[0, 0] == 76 and images.a4_size(300) == (2481, 3507)
    chain = (("grayscale", {}), ("denoise", {}), ("contrast", {}), ("adaptive_binarization", {}))
    rows = spark.createDataFrame([("x", 40, 60, 3, bytearray(a.tobytes())), ("bad", None, None, None, None)], "doc_id string, height int, width int, channels int, data binary")
    got = {r["doc_id"]: r for r in images.preprocess(rows, chain).collect()}
    assert set(np.frombuffer(got["x"]["data"], np.uint8)) == {0, 255} and [s["step"] for s in got["x"]["steps"]] == [c[0] for c in chain]
    assert got["bad"]["steps"][0]["warning"] == "not an image"


def page(angle=0.0, h=300, w=400):
    """Black bars on white, turned."""
    a = np.full((h, w, 3), 255, np.uint8)
    for y in range(40, 260, 20):
        a[y : y + 6, 30:370] = (200, 30, 10)
    return images.rotate(a, angle) if angle else a


def test_skew_angles():
    for angle in (-3.0, 2.0, 4.0):
        gray = images.luma(page(angle))
        found = images.candidate_angles(gray, 5.0)
        assert len(found) == 3 and all(abs(abs(x) - abs(angle)) < 0.8 for x in found[1:])
        straight, applied, _ = images.deskew(page(angle), 5.0, 1.0)
        assert applied and abs(images.rectangle_angle(np.where(images.luma(straight) < 128, 0, 255).astype(np.uint8))) < 0.8
    assert images.deskew(page(), 5.0, 1.0)[1] is False
    assert images.hough_angle(np.full((50, 50), 255, np.uint8), 5.0) is None and images.rectangle_angle(np.full((50, 50), 255, np.uint8)) is None


def test_cubic_sampling():
    a = np.arange(64, dtype=np.uint8).reshape(8, 8) * 3
    assert (images._resized(a, 8, 8) == a).all() and images._resized(a, 4, 2).shape == (2, 4)
    ramp = np.tile(np.arange(0, 200, 2, dtype=np.uint8), (20, 1))
    assert np.abs(images._resized(ramp, 50, 10)[:, 5:-5].astype(int) - np.arange(1, 200, 4)[5:-5]).max() <= 1
    local, applied, _ = images.adaptive_binarization(page(), 35, 10, local=True)
    assert applied and set(np.unique(local)) == {0, 255}


def test_files_to_clean_files(spark, tmp_path):
    """The source, the chain and the sink compose, and colours keep their order."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.b.png").write_bytes(images.png(page(), 300))
    (tmp_path / "in/bad.png").write_bytes(b"no image")
    found = {r["doc_id"].rsplit("/")[-1]: r for r in files.images(spark, str(tmp_path / "in")).collect()}
    assert found["a.b.png"]["data"] == page().tobytes() and found["a.b.png"]["channels"] == 3 and found["bad.png"]["data"] is None
    chain = (("grayscale", {}), ("crop_to_content", {"margin": 5}))
    done = images.preprocess(files.images(spark, str(tmp_path / "in")), chain)
    files.write_files(images.png_files(done, 150), str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["a.b__crop_to_content.png"]
    again = files.images(spark, str(tmp_path / "out")).collect()[0]
    assert (again["height"], again["width"], again["channels"]) == (216, 350, 1) and set(again["data"]) == {255, int(images.luma(page())[41, 40])}


def test_recognise_and_annotate(spark, tmp_path):
    table = "h\n1\t1\t1\t1\t1\t1\t5\t6\t10\t20\t91.5\tINVOICE\n1\t1\t1\t1\t1\t2\tx\t6\t10\t20\t9\tbad\n1\t1\t1\t1\t1\t3\t5\t6\t1\t2\t-1\t \n"
    scans = spark.createDataFrame([("a", bytearray(b"1")), ("b", None)], "doc_id string, content binary")
    got = layout.recognise(scans, lambda content: table).collect()
    assert [(r["doc_id"], r["text"], r["x1"], r["y1"], r["x2"], r["y2"], r["confidence"]) for r in got] == [("a", "INVOICE", 5, 6, 15, 26, 91.5)]
    assert layout.recognise(scans).count() == 0
    with pytest.raises(RuntimeError):
        layout.tesseract(command="no-such-program")(b"")
    words = layout.recognise(scans, lambda content: table)
    payload = files.ocr_payloads(words).collect()[0]
    assert payload["word_count"] == 1 and payload["words"][0]["confidence"] == 91.5 and payload["source"] == "a"

    def broken():
        raise OSError("no weights")

    label = lambda: lambda texts, boxes: [[("header", 0.9)] * len(t) for t in texts]
    seen = spark.createDataFrame([("a", bytearray(b"1"))], "doc_id string, data binary")
    assert layout.annotate(words, "huggingface", broken).first()["engine"] == "stub"
    labelled = layout.annotate(words, "huggingface", label, "m", seen)
    assert [(t["label"], t["score"]) for t in labelled.first()["tokens"]] == [("header", 0.9)] and layout.annotate(words, "huggingface", label, "m", seen.limit(0)).count() == 0
    assert files.layout_payloads(labelled).first()["tokens"][0]["bbox"] == [5, 6, 15, 26] and len(files.block_payloads(layout.heuristic_blocks(words)).first()["blocks"]) == 3


def test_models_are_plugged_in(spark, tmp_path):
    scans = spark.createDataFrame([("a", bytearray(b"xy")), ("b", None)], "doc_id string, content binary")
    got = {r["doc_id"]: r["raw_text"] for r in backends.read_images(scans, lambda contents, prompt: [f"{len(c)}{prompt}" for c in contents], " p ").collect()}
    assert got == {"a": "2p", "b": None}
    stored = spark.createDataFrame([("a", "{}")], "doc_id string, raw_text string")
    assert {r["doc_id"]: r["raw_text"] for r in backends.read_images(scans, stored=stored).collect()} == {"a": "{}", "b": None}
    prompts = spark.createDataFrame([(1, "say")], "doc_id int, prompt string")
    load = lambda model, quant: lambda texts, most, heat: [f"{t}{model} {quant} {most} {heat}" for t in texts]
    out = {r["model"]: r["output"] for r in backends.sweep(prompts, load=load).collect()}
    assert len(out) == len(backends.MODELS) and out["qwen2-7b"] == "Qwen/Qwen2-7B-Instruct 4bit 512 0.2"
    (tmp_path / "models--a--b/snapshots/1").mkdir(parents=True)
    assert backends.local_model("a/b", str(tmp_path)).endswith("snapshots/1") and backends.local_model("c/d", str(tmp_path)) == "c/d"
    with pytest.raises(FileNotFoundError):
        backends.local_model("c/d", str(tmp_path), offline=True)


def test_commands(spark, tmp_path, monkeypatch):
    from ledgerlens import cli

    monkeypatch.setattr(cli, "get_spark", lambda name: spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.png").write_bytes(images.png(page()))
    (tmp_path / "payload.json").write_text(json.dumps({"meta": {"seller_name": "0", "total_net": 0}, "rows": []}))
    cli.main(["ocr", str(tmp_path / "in"), str(tmp_path / "ocr"), "--engine", "stub"])
    cli.main(["read", str(tmp_path / "in"), str(tmp_path / "raw")])
    cli.main(["clean", str(tmp_path / "in"), str(tmp_path / "clean")])
    cli.main(["validate", str(tmp_path / "payload.json"), str(tmp_path / "done")])
    cli.main(["bench", str(tmp_path / "payload.json"), str(tmp_path / "bench")])
    cli.main(["models"])
    errors = spark.read.json(str(tmp_path / "done")).select("validation.errors").first()[0]
    assert "Missing required field: seller_name" not in errors and "Missing required field: total_net" in errors
    assert spark.read.json(str(tmp_path / "bench")).count() == len(backends.MODELS) and len(list((tmp_path / "clean").iterdir())) == 1


def test_zero_in_text_is_present(spark):
    r = run_vlm(spark, json.dumps({"invoice": {"number": "0", "id": "7"}}), json.dumps({"invoice": {"number": 0, "id": "7"}}))
    assert r[0]["meta"]["invoice_number"] == "0" and r[1]["meta"]["invoice_number"] == "7"


def test_settings():
    assert config.mappings("a:\n  b: true\n  c: 'x'\nd: null\n") == {"a": {"b": True, "c": "x"}, "d": None}
    with pytest.raises(KeyError):
        backends.model_id("nope")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_catalog(spark, name):
    import duckdb

    at = "/root/testdata/sf0.001"
    sql = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem"):
        sql.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, at)
    want = sql.sql(catalog.ORACLE_SQL[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
