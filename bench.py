"""Headline queries, and the image chain over pages of A4 at 300 dpi, timed: one JSON line."""

import json
import os
import time

from ledgerlens.operators import images
from ledgerlens.plans import catalog
from ledgerlens.session import get_spark

# the whole classic and vision paths are left out: see the README for what they take
HEADLINE = ("lines_from_words", "layout_boxes", "page_blocks", "rules_amounts", "scalar_rules")


PAGES = 16


def pages(spark, n: int = PAGES):
    """Printed pages (doc_id, height, width, channels, data), straight and in colour, as a scanner gives them."""
    import numpy as np
    import pyarrow as pa

    def draw(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                a, r = np.full((3508, 2480, 3), 255, np.uint8), np.random.default_rng(k)
                for y in range(300, 3200, 60):
                    for x in range(200, 2200, 90):
                        a[y : y + 30, x : x + r.integers(20, 80)] = r.integers(0, 90, 3)
                yield pa.RecordBatch.from_arrays([pa.array([str(k)]), pa.array([3508], pa.int32()), pa.array([2480], pa.int32()), pa.array([3], pa.int32()), pa.array([a.tobytes()], pa.binary())], names=["doc_id", "height", "width", "channels", "data"])

    return spark.range(0, n, 1, n).mapInArrow(draw, "doc_id string, height int, width int, channels int, data binary")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["rules_amounts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the session
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    began = time.time()
    images.preprocess(pages(spark)).write.format("noop").mode("overwrite").save()
    took[f"images_{PAGES}_pages"] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
