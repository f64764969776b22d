"""Adapters to what lies outside of Spark: a service that answers forms, files that have pages, an engine that reads images. Each takes
the outside thing as a function, so that nothing here needs a library that isn't installed."""

from __future__ import annotations

import hashlib
import json
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
PAGES = "doc_id string, path string, page_no int, text string, image_count int, method string, reason string"


class OCRUnavailable(RuntimeError):
    """No engine that reads images."""


def post_form(url: str, form: dict | None = None, timeout: float = 30.0, send: Callable = urllib.request.urlopen):
    """The JSON answer to a form; raises on an answer that isn't a success. For the job that lands payloads, not for executors."""
    request = urllib.request.Request(url, data=urllib.parse.urlencode(form or {}).encode(), headers={"Accept": "application/json"}, method="POST")
    with send(request, timeout=timeout) as answer:
        if not 200 <= answer.status < 300:
            raise OSError(f"{url} answered {answer.status}")
        return json.loads(answer.read())


def settings_key(settings: dict, version: int = 1) -> str:
    """The name under which pages read with these settings are kept."""
    return hashlib.sha256(json.dumps([version, settings], sort_keys=True, default=str).encode()).hexdigest()[:16]


def file_pages(files: DataFrame, read: Callable[[bytes], Iterable[tuple[str, list, int]]]) -> DataFrame:
    """files(path, sha256, content) -> PAGES. read gives for each page its text, its tables as rows of cells, and how many images it has; rows go
    below the text, joined as `table_rows` does. A file that can't be read is one row of page 0 with the reason."""

    def lines(tables: list) -> list[str]:
        return [" | ".join((c or "").strip() for c in row) for row in tables if any((c or "").strip() for c in row)]

    def each(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, sha, content = (batch.column(k)[i].as_py() for k in range(3))
                try:
                    rows = [{"doc_id": sha, "path": path, "page_no": n, "text": "\n".join([text or "", *lines(tables)]).strip("\n"), "image_count": images, "method": "native"} for n, (text, tables, images) in enumerate(read(content), 1)]
                except Exception as e:  # whatever a reader raises over a broken file is that file's review row
                    rows = [{"doc_id": sha, "path": path, "page_no": 0, "method": "failed", "reason": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return files.select("path", "sha256", "content").mapInArrow(each, PAGES)


_SCHEMA = pa.schema([("doc_id", pa.string()), ("path", pa.string()), ("page_no", pa.int32()), ("text", pa.string()), ("image_count", pa.int32()), ("method", pa.string()), ("reason", pa.string())])


def cached_pages(spark: SparkSession, files: DataFrame, read: Callable, folder: str, settings: dict, version: int = 1) -> DataFrame:
    """file_pages, kept by settings: only files whose content isn't there yet are read. Each run writes a folder of its own; where a run was repeated, or two ran at
    once, a file's pages are those of the first by name, so none is doubled."""
    place = f"{folder}/{settings_key(settings, version)}"
    spark.createDataFrame([], PAGES).write.mode("overwrite").parquet(f"{place}/run=-")
    schema = f"{PAGES}, run string"
    known = spark.read.schema(schema).parquet(place).select(C("doc_id").alias("_known")).distinct()
    new = files.dropDuplicates(["sha256"]).join(known, C("sha256") == C("_known"), "left_anti")
    file_pages(new, read).write.parquet(f"{place}/run={uuid.uuid4().hex}")
    held = spark.read.schema(schema).parquet(place)
    first = held.groupBy(C("doc_id").alias("_wanted")).agg(F.min("run").alias("_run"))
    wanted = files.select(C("sha256").alias("_asked")).distinct().join(first, C("_asked") == C("_wanted"))
    return held.join(wanted, (held.doc_id == C("_wanted")) & (C("run") == C("_run")), "left_semi").drop("run")


def with_ocr(pages: DataFrame, engine: Callable[[bytes], str] | None) -> DataFrame:
    """pages(.., text, method, reason, ocr, image): where ocr is set, the text that the engine reads from the image. Without an engine, or where it
    raises OCRUnavailable, the page keeps its text and has the reason, for review; an engine that has failed so once isn't asked again."""
    names = pages.columns
    text, method, reason, ocr, image = (names.index(c) for c in ("text", "method", "reason", "ocr", "image"))

    def each(batches):
        why = None if engine else "no OCR engine"
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (text, method, reason)]
            for i, (wanted, picture) in enumerate(zip(batch.column(ocr).to_pylist(), batch.column(image).to_pylist(), strict=True)):
                if wanted and why is None:
                    try:
                        columns[0][i], columns[1][i] = engine(picture), "ocr"
                        continue
                    except OCRUnavailable as e:
                        why = str(e) or "no OCR engine"
                if wanted:
                    columns[2][i] = why
            arrays = list(batch.columns)
            for k, values in zip((text, method, reason), columns, strict=True):
                arrays[k] = pa.array(values, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return pages.mapInArrow(each, pages.schema)
