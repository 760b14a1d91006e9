"""Files and payloads in: JSON documents, API bodies, snapshot folders, source registries; and atomic files out."""

from __future__ import annotations

import csv
import json
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path
from typing import Any, TextIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def api_items(df: DataFrame, body: str, path: str, keep: Iterable[str] = ()) -> DataFrame:
    """(keep, pos, item VARIANT) of the list at a path of JSON bodies; an unreadable body, a miss and an empty list give no row."""
    items = F.try_variant_get(F.try_parse_json(F.col(body)), f"$.{path}" if path else "$", "array<variant>")
    return df.select(*keep, F.posexplode(items).alias("pos", "item"))


def json_records(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """The records of JSON files that hold one document each; `field` is the list within it, if not the whole."""
    df = spark.read.option("multiLine", "true").json(path)
    return df.select(F.explode(field).alias("r")).select("r.*") if field else df


def snapshot_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(source_key, text) of a folder with one <key>.html for each source."""
    pages = spark.read.text(f"{folder}/*.html", wholetext=True)
    return pages.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.html$", 1).alias("source_key"), F.col("value").alias("text"))


SOURCE_FIELDS = ("key", "name", "issuer", "network", "vendor", "tier", "source_type", "role", "url", "adapter", "strategy", "fallback_strategy", "wait_for_selector", "notes")


def registry(spark: SparkSession, path: str, adapters: Iterable[str]) -> DataFrame:
    """The source registry of a YAML file (sources, with defaults for what they leave out); an unknown adapter is an error."""
    import yaml

    doc = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    rows = [{**(doc.get("defaults") or {}), **s} for s in doc.get("sources") or []]
    known = set(adapters)
    if unknown := sorted({str(r.get("adapter")) for r in rows} - known):
        raise ValueError(f"unknown adapters: {', '.join(unknown)}")
    values = [tuple(None if r.get(f) is None else str(r[f]) for f in SOURCE_FIELDS) for r in rows]
    return spark.createDataFrame(values, T.StructType([T.StructField(f, T.StringType()) for f in SOURCE_FIELDS]))


class ReaderUnavailable(RuntimeError):
    """No reader of this kind of file is installed or given."""


class ExcelUnavailable(RuntimeError):
    """The library that writes workbooks is not installed."""


def document_texts(files: DataFrame, reader: Callable[[bytes, int], str] | None, max_pages: int = 12, least: int = 40) -> DataFrame:
    """(path, text, error) of binary files (path, content), as `spark.read.format("binaryFile")` gives them.

    `reader` turns content and a number of pages into text; a text of `least` characters or fewer is
    none (a scan without text). A failing file is an error in its row. Without a reader this is an error.
    """
    if reader is None:
        raise ReaderUnavailable("document_texts needs a reader; no PDF library is part of this package")

    def one(content: bytes | None) -> tuple[str | None, str | None]:
        try:
            text = reader(bytes(content or b""), max_pages)
            return (text, None) if text and len(text.strip()) > least else (None, None)
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(p, *one(c)) for p, c in zip(b["path"], b["content"], strict=True)], columns=["path", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")


# --- sinks -----------------------------------------------------------------------------------------


def flat_columns(schema: T.StructType, prefix: str = "") -> list[Column]:
    """Nested fields as columns with dotted names; lists and maps as compact JSON."""
    out: list[Column] = []
    for f in schema:
        path = f"{prefix}.{f.name}" if prefix else f.name
        quoted = ".".join(f"`{p}`" for p in path.split("."))
        if isinstance(f.dataType, T.StructType):
            out += flat_columns(f.dataType, path)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            out.append(F.to_json(quoted).alias(path))
        else:
            out.append(F.col(quoted).alias(path))
    return out


def flattened(df: DataFrame) -> DataFrame:
    """`df` with nested structs as dotted columns and lists as JSON, ready for flat files."""
    return df.select(*flat_columns(df.schema))


@contextmanager
def atomic(path: str, encoding: str = "utf-8", newline: str | None = None) -> Iterator[TextIO]:
    """A text file that appears whole or not at all; folders on the way are made."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    fd, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(fd, "w", encoding=encoding, newline=newline) as f:
            yield f
        os.replace(temporary, target)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_json(df: DataFrame, path: str, lines: bool = False, indent: int = 2) -> int:
    """One local file of the rows as a JSON list, or one row a line; rows stream through the driver, none are held. The number of rows."""
    n = 0
    with atomic(path) as f:
        f.write("" if lines else "[")
        for (text,) in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
            if lines:
                f.write(text + "\n")
            else:
                f.write(("," if n else "") + "\n" + json.dumps(json.loads(text), ensure_ascii=False, indent=indent))
            n += 1
        f.write("" if lines else "\n]\n")
    return n


def write_csv(df: DataFrame, path: str) -> int:
    """One local CSV file with a byte-order mark and flattened columns; rows stream through the driver. The number of rows."""
    flat, n = flattened(df), 0
    with atomic(path, "utf-8-sig", "") as f:
        out = csv.writer(f)
        out.writerow(flat.columns)
        for row in flat.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_excel(df: DataFrame, path: str, sheet: str = "data") -> int:
    """One local workbook of the flattened rows, which stream through the driver; an error of its own where openpyxl is missing. The number of rows."""
    try:
        from openpyxl import Workbook
    except ImportError as e:
        raise ExcelUnavailable("write_excel needs openpyxl") from e
    flat, n = flattened(df), 0
    book = Workbook(write_only=True)
    page = book.create_sheet(sheet)
    page.append(flat.columns)
    for row in flat.toLocalIterator():
        page.append(list(row))
        n += 1
    book.save(path)
    return n


def write_ledger(df: DataFrame, path: str, title: str = "records") -> int:
    """One local HTML page that embeds the rows as JSON, with < > & escaped so that no text can end the script. The number of rows."""
    n = 0
    name = title.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    with atomic(path) as f:
        f.write(f'<!doctype html><meta charset="utf-8"><title>{name}</title><table id="rows"></table><script id="data" type="application/json">[')
        for (text,) in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
            f.write(("," if n else "") + "\n" + text.replace("&", "\\u0026").replace("<", "\\u003c").replace(">", "\\u003e"))
            n += 1
        f.write(
            '\n]</script><script>const rows = JSON.parse(document.getElementById("data").textContent), t = document.getElementById("rows");'
            "rows.forEach((r, i) => { if (!i) Object.keys(r).forEach(k => t.createTHead && (t.tHead || t.createTHead().insertRow()) && t.tHead.rows[0].append(Object.assign(document.createElement('th'), {textContent: k})));"
            "const x = t.insertRow(); Object.values(r).forEach(v => { x.insertCell().textContent = v === null ? '' : typeof v === 'object' ? JSON.stringify(v) : v; }); });</script>\n"
        )
    return n


def write_table(df: DataFrame, path: str, form: str = "parquet", by: Iterable[str] = (), options: Mapping[str, Any] | None = None) -> None:
    """The distributed sink: any Spark format, partitioned by columns; json and csv get the forms of the local sinks."""
    out = flattened(df) if form == "csv" else df
    out.write.mode("overwrite").options(**({"header": "true"} if form == "csv" else {}) | dict(options or {})).partitionBy(*by).format(form).save(path)
