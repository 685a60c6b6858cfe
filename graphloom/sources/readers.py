"""Readers: text, HTML, DOCX and PDF documents, chunk files, graph files and task files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.text import base_name
from graphloom.operators.structure import html_text, html_title, normalize_newlines, sections, upper_header
from graphloom.sources import pdf as pdf_text

CHUNK_SCHEMA = "chunk_ix int, text string, metadata struct<section_title:string,source:string,title:string,type:string>"
TASK_ITEM = "task_id:string,priority:string,status:string,task_type:string,entity_type:string,reason:string,extracted:string,corrected:string,notes:string"
_S = "string"

#: explicit schemas of the entity lists of a graph file; nothing is inferred
GRAPH_SCHEMAS = {
    "events": f"id {_S}, year int, title {_S}, description {_S}, significance int, type {_S}, start_date {_S}, end_date {_S}, sources array<{_S}>, tags array<{_S}>",
    "actors": f"id {_S}, name {_S}, type {_S}, country {_S}, description {_S}, role {_S}, start_date {_S}, end_date {_S}, website {_S}, expertise array<{_S}>",
    "locations": f"id {_S}, name {_S}, type {_S}, coordinates struct<type:{_S},coordinates:array<double>>, country {_S}, region {_S}, description {_S}",
    "concepts": f"id {_S}, name {_S}, definition {_S}, alternative_names array<{_S}>, parent_concept_id {_S}, domain array<{_S}>, significance int",
    "publications": f"id {_S}, title {_S}, type {_S}, year int, date {_S}, publisher {_S}, author_ids array<{_S}>, isbn {_S}, doi {_S}, abstract {_S}, significance int, open_access boolean, url {_S}",
    "relationships": f"id {_S}, source_id {_S}, source_type {_S}, target_id {_S}, target_type {_S}, relationship_type {_S}, description {_S}, strength int",
}


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source, title, type, text): whole UTF-8 files with universal newlines."""
    raw = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("source"), F.col("value"))
    return raw.select("source", F.regexp_replace("source", r"^.*/", "").alias("title"), F.lit("text").alias("type"), normalize_newlines("value").alias("text"))


def read_html(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, title, type, text) of fetched pages; the title defaults to the address."""
    return pages.select(F.col(url).alias("source"), F.coalesce(html_title(html), F.col(url)).alias("title"), F.lit("web").alias("type"), html_text(html).alias("text"))


def docx_paragraphs(content: bytes) -> list[tuple[int, str | None, str]]:
    """(pos, style, text) of the paragraphs of an OOXML document, by the standard library alone."""
    from xml.etree import ElementTree as X

    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = X.fromstring(z.read("word/document.xml"))
        names = {}
        if "word/styles.xml" in z.namelist():
            for s in X.fromstring(z.read("word/styles.xml")).iter(f"{w}style"):
                n = s.find(f"{w}name")
                names[s.get(f"{w}styleId")] = n.get(f"{w}val") if n is not None else None
    out = []
    for i, p in enumerate(body.iter(f"{w}p")):
        st = p.find(f"{w}pPr/{w}pStyle")
        key = st.get(f"{w}val") if st is not None else None
        style = names.get(key) or key
        text = "".join("\t" if e.tag == f"{w}tab" else "\n" if e.tag == f"{w}br" else e.text or "" for e in p.iter() if e.tag in (f"{w}t", f"{w}tab", f"{w}br"))
        out.append((i, style.capitalize() if style and style.lower().startswith("heading") else style, text))
    return out


def read_docx(files: DataFrame) -> DataFrame:
    """(source, pos, style, text, error) of (path, content) rows as the binaryFile source gives them.

    A file that is no OOXML document, such as an old .doc, gives one row with an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, i, s, t, None) for i, s, t in docx_paragraphs(content)]
                except Exception as e:  # noqa: BLE001
                    rows.append((path, 0, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["source", "pos", "style", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "source string, pos int, style string, text string, error string")


def _pdf_readers():
    """PDF readers in order of preference, each giving the pages and the properties; the first two are optional extras."""
    out = []
    try:
        import pypdf

        def first(content: bytes):
            r = pypdf.PdfReader(io.BytesIO(content))
            info = {k.lstrip("/"): str(v) for k, v in (r.metadata or {}).items()}
            return [p.extract_text() or "" for p in r.pages], info

        out.append(first)
    except ImportError:
        pass
    try:
        from pdfminer.high_level import extract_text

        # pages end with a form feed
        out.append(lambda content: (extract_text(io.BytesIO(content)).split("\f"), {}))
    except ImportError:
        pass
    return [*out, pdf_text.read]


def read_pdf(files: DataFrame, readers=None) -> DataFrame:
    """(source, title, author, pages, text, page_lines, error): the first reader that succeeds, else the last one's error.

    ``text`` joins the pages that hold text by blank lines; ``page_lines`` is their
    lines without blank ones between pages, from which :func:`pdf_sections` cuts
    sections. A file without a title is named by its path. ``readers`` are
    functions from the content to (pages, properties).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _pdf_readers() if readers is None else readers
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                error, name = "no PDF reader is installed", path.rsplit("/", 1)[-1]
                for r in known:
                    try:
                        pages, info = r(content)
                        full = [p for p in pages if p]
                        rows.append((path, info.get("Title") or name, info.get("Author"), len(pages), "".join(p + "\n\n" for p in full), "\n".join(full), None))
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                else:
                    rows.append((path, name, None, None, None, None, error))
            out = pd.DataFrame(rows, columns=["source", "title", "author", "pages", "text", "page_lines", "error"])
            yield out.astype({"pages": "Int32"})

    return files.select("path", "content").mapInPandas(run, "source string, title string, author string, pages int, text string, page_lines string, error string")


def pdf_sections(docs: DataFrame) -> DataFrame:
    """(source, section_no, title, content) of :func:`read_pdf` rows: an upper-case line of any page opens a section."""
    return sections(docs, upper_header, key="source", text="page_lines")


def read_binary(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)


def unreadable(spark: SparkSession, path: str, wanted: str = "chunks") -> DataFrame:
    """(path, error) of the JSON files that hold neither a list nor an object with the list ``wanted``; the readers give no row for them."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    inner = F.schema_of_variant(F.try_variant_get("v", f"$.{wanted}", "variant"))
    error = F.when(F.col("v").isNull(), "no JSON").when(~(kind.startswith("ARRAY") | F.coalesce(inner.startswith("ARRAY"), F.lit(False))), f"no list of {wanted}")
    return raw.select("path", error.alias("error")).where("error IS NOT NULL")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of a JSON file: a list, or an object with a 'chunks' list; positions become chunk_ix when absent. A broken file gives no row (see :func:`unreadable`)."""
    flat = T._parse_datatype_string(CHUNK_SCHEMA)
    raw = spark.read.text(path, wholetext=True)
    as_list = F.from_json("value", T.ArrayType(flat))
    as_object = F.from_json("value", T.StructType([T.StructField("chunks", T.ArrayType(flat))]))["chunks"]
    is_list = F.ltrim("value").startswith("[")
    return raw.select(F.posexplode(F.when(is_list, as_list).otherwise(as_object)).alias("pos", "c")).where("c IS NOT NULL").select(
        F.coalesce("c.chunk_ix", "pos").alias("chunk_ix"), "c.text", "c.metadata"
    )


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The entity lists and relationships of a graph file by singular kind; missing lists are empty."""
    whole = T.StructType([T.StructField(k, T.ArrayType(T._parse_datatype_string(d))) for k, d in GRAPH_SCHEMAS.items()])
    doc = spark.read.schema(whole).option("multiLine", True).json(path)
    return {k[:-1]: doc.select(F.posexplode(k).alias("ord", "x")).select("ord", "x.*") for k in GRAPH_SCHEMAS}


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Review tasks of a file with a 'review_tasks' list; a broken or missing list is empty (see :func:`unreadable`)."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.from_json("value", f"review_tasks array<struct<{TASK_ITEM}>>")["review_tasks"]).alias("ord", "t"))
        .select("ord", "t.*")
    )


def output_name(path) -> F.Column:
    return base_name(path)
