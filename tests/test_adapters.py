import io
import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.sources import adapters as AD
from plumbline.sources import pages as SP
from plumbline.sources import sinks


class Answer(io.BytesIO):
    status = 200


def test_forms():
    seen = []

    def send(request, timeout):
        seen.append((request.full_url, request.data, timeout))
        return Answer(json.dumps({"ok": [1]}).encode())

    assert AD.post_form("http://x/y", {"a": "b c"}, 5, send) == {"ok": [1]} and seen == [("http://x/y", b"a=b+c", 5)]

    def refuse(request, timeout):
        out = Answer(b"{}")
        out.status = 500
        return out

    with pytest.raises(OSError, match="500"):
        AD.post_form("http://x/y", send=refuse)


def test_pages_of_files(spark, tmp_path):
    def read(content):  # workers can't import the tests
        if content == b"broken":
            raise ValueError("no pages")
        return [(line, [["a", None, " b "], [None, ""]], 1) for line in content.decode().split("\n")]

    files = spark.createDataFrame([("p1", "s1", b"one\ntwo"), ("p2", "s2", b"broken")], "path string, sha256 string, content binary")
    got = {(r.doc_id, r.page_no): (r.text, r.method, r.reason) for r in AD.file_pages(files, read).collect()}
    assert got == {("s1", 1): ("one\na |  | b", "native", None), ("s1", 2): ("two\na |  | b", "native", None), ("s2", 0): (None, "failed", "ValueError: no pages")}
    folder = str(tmp_path / "pages")
    assert AD.cached_pages(spark, files, read, folder, {"dpi": 300}).count() == 3
    more = files.unionByName(spark.createDataFrame([("p3", "s3", b"three")], files.schema))
    only_new = lambda content: read(content) if content == b"three" else 1 / 0
    assert AD.cached_pages(spark, more, only_new, folder, {"dpi": 300}).where("method = 'native'").count() == 3
    assert AD.cached_pages(spark, more.where("sha256 = 's3'"), read, folder, {"dpi": 300}).count() == 1
    assert AD.settings_key({"a": 1, "b": 2}) == AD.settings_key({"b": 2, "a": 1}) != AD.settings_key({"a": 1, "b": 2}, 2)
    assert SP.read_pages(AD.file_pages(files, read)).columns == ["doc_id", "page_no", "text"]


def test_ocr(spark):
    s = "doc_id string, text string, method string, reason string, ocr boolean, image binary"
    pages = spark.createDataFrame([("a", "x", "native", None, False, b"1"), ("b", "", "native", None, True, b"2")], s)
    assert {r.doc_id: (r.text, r.method) for r in AD.with_ocr(pages, lambda image: "read " + image.decode()).collect()} == {"a": ("x", "native"), "b": ("read 2", "ocr")}

    def missing(image):
        raise AD.OCRUnavailable("engine is missing")

    for engine, why in ((None, "no OCR engine"), (missing, "engine is missing")):
        assert {r.doc_id: (r.text, r.reason) for r in AD.with_ocr(pages, engine).collect()} == {"a": ("x", None), "b": ("", why)}


def test_dividends_and_formats(spark):
    feed = spark.createDataFrame([("Alpha PLC", 7, 1), ("ALPHA plc", 9, 2), ("Beta", 8, 3), ("Alpha PLC", None, 4)], "company string, announcementId long, id long")
    issuers = spark.createDataFrame([("A", "Alpha P.L.C.", 1)], "ticker string, name string, ord long")
    details = spark.createDataFrame([(7, "old", 1), (7, "new", 2), (9, "x", 1)], "announcementId long, text string, ord long")
    got = sorted((r.ticker, r.announcementId, r.text, r.recency, r.feed_id) for r in SP.latest_dividends(feed, issuers, details).collect())
    assert got == [("A", 7, "new", 2, 1), ("A", 9, "x", 1, 2)]
    df = sinks.with_formats(spark.createDataFrame([("A", 1.0, 2.0, 3)], "ticker string, roe double, pe double, n long"))
    assert [f.metadata["format"] for f in df.schema] == ["general", "percent", "two digits", "integer"] and df.schema[0].metadata["frozen"]


def test_folded_text(spark):
    rows = spark.createDataFrame([("ﬁnance ½ ‘x’ Ａ",), (None,)], "t string")
    assert [r.n for r in rows.select(X.normalize_text(F.col("t")).alias("n")).collect()] == ["finance 1⁄2 'x' A", None]
