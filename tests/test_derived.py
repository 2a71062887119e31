import sys

from pyspark import cloudpickle

from fixtures import derived

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES, SIZE = 40, 1 << 20
WITH_PLACES = derived._with_places


def small_batch(batch, *rest):
    if batch.nbytes > derived.BATCH_BYTES + 2 * SIZE:
        raise ValueError(f"a batch of {batch.nbytes} bytes")
    return WITH_PLACES(batch, *rest)


def test_large_pages_come_in_small_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "_with_places", small_batch)
    urls = spark.range(PAGES).selectExpr("id AS page_id", "concat('https://www.example.net/', id) AS url")
    urls.selectExpr("*", f"repeat('x', {SIZE}) AS html").write.parquet(str(tmp_path / "pages.parquet"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    store = derived.crawl_store(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert spark.read.parquet(store["index"]).count() == 3 * PAGES + 1
