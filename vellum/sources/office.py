"""Word and slide documents read with the standard library; adapters for what needs a program that may be missing."""

from __future__ import annotations

import io
import posixpath
import shutil
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"

LINES = "doc string, page int, line_no int, text string, error string"


def docx_paragraphs(content: bytes) -> list[str]:
    """Stripped paragraphs of the body that are not blank; tables, headers and text boxes are not read."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    out = []
    for p in body.findall(f"{_W}p") if body is not None else ():
        parts = []
        for node in p.iter():
            parts.append({f"{_W}t": node.text or "", f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n"}.get(node.tag, ""))
        if text := "".join(parts).strip():
            out.append(text)
    return out


def pptx_slides(content: bytes) -> list[str]:
    """One text per slide in the order of the presentation: paragraphs of top-level shapes, or "Slide i" where there are none."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("ppt/_rels/presentation.xml.rels")).findall(f"{_PKG}Relationship")}
        order = ElementTree.fromstring(z.read("ppt/presentation.xml")).find(f"{_P}sldIdLst")
        out = []
        for n, ref in enumerate(order if order is not None else (), 1):
            target = posixpath.normpath(posixpath.join("ppt", rels[ref.get(f"{_R}id")]))
            tree = ElementTree.fromstring(z.read(target.lstrip("/"))).find(f"{_P}cSld/{_P}spTree")
            lines = []
            for shape in tree.findall(f"{_P}sp"):
                for p in shape.findall(f"{_P}txBody/{_A}p"):
                    if text := "".join(t.text or "" for t in p.iter(f"{_A}t")).strip():
                        lines.append(text)
            out.append("\n".join(lines) or f"Slide {n}")
    return out


def _per_file(read: Callable[[bytes], list[tuple[int, int, str]]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, content in zip(frame["doc"], frame["content"], strict=True):
                try:
                    rows += [(doc, page, n, text, None) for page, n, text in read(content)]
                except Exception as problem:  # one bad file never stops the others
                    rows.append((doc, None, None, None, f"{type(problem).__name__}: {problem}"[:400]))
            yield pd.DataFrame(rows, columns=["doc", "page", "line_no", "text", "error"]).astype({"page": "Int32", "line_no": "Int32"})

    return run


def read_docx(files: DataFrame) -> DataFrame:
    """Lines of files (doc, content) with page 0; a file that cannot be read is a row with an error."""
    return files.select("doc", "content").mapInPandas(_per_file(lambda b: [(0, i, t) for i, t in enumerate(docx_paragraphs(b))]), LINES)


def read_pptx(files: DataFrame) -> DataFrame:
    """One row per slide of files (doc, content), its page being its number."""
    return files.select("doc", "content").mapInPandas(_per_file(lambda b: [(i, 0, t) for i, t in enumerate(pptx_slides(b), 1)]), LINES)


PLACED = "doc string, page int, block_no int, line_no int, text string, bbox array<double>, width double, height double, error string"


def pdf_lines(pdf) -> list[tuple]:
    """(page, block_no, line_no, text, bbox, width, height) of the lines of an open PDF, in the order of its blocks; a page without text is one row without."""
    out = []
    for page_no, page in enumerate(pdf, 1):
        size = float(page.rect.width), float(page.rect.height)
        before = len(out)
        for block_no, block in enumerate(page.get_text("dict")["blocks"]):
            for line_no, line in enumerate(block.get("lines", ())):
                text = "".join(span["text"] for span in line["spans"])
                if text.strip():
                    out.append((page_no, block_no, line_no, text, [float(x) for x in line["bbox"]], *size))
        if len(out) == before:
            out.append((page_no, None, None, None, None, *size))
    return out


def read_pdf(files: DataFrame, lines: Callable[[bytes], list[tuple]] | None = None) -> DataFrame:
    """Lines of PDF files (doc, content) with their place, as kept_lines() and intake() take them. A file that cannot be read, or all where no PDF library is installed, is a row with an error.

    lines: what gives pdf_lines() of the content of one file; by default an installed library.
    """

    def installed(content: bytes) -> list[tuple]:
        try:
            import fitz
        except ImportError:
            raise RuntimeError("no PDF library is installed") from None
        with fitz.open(stream=content, filetype="pdf") as pdf:
            return pdf_lines(pdf)

    columns = ["doc", "page", "block_no", "line_no", "text", "bbox", "width", "height", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc, content in zip(frame["doc"], frame["content"], strict=True):
                try:
                    rows = [(doc, *line, None) for line in (lines or installed)(content)]
                except Exception as problem:  # one bad file never stops the others
                    rows = [(doc, *[None] * 7, f"{type(problem).__name__}: {problem}"[:400])]
                yield pd.DataFrame(rows, columns=columns).astype({"page": "Int32", "block_no": "Int32", "line_no": "Int32"})

    return files.select("doc", "content").mapInPandas(run, PLACED)


def with_program(files: DataFrame, program: str, run: Callable[[bytes, str], list[tuple[int, int, str]]]) -> DataFrame:
    """Lines from an outside program (office converter, recogniser) given by name; run(content, path of the program) does the work.

    One file at a time per partition; where the program is missing every file is a row
    with an error.
    """

    def each(content: bytes) -> list[tuple[int, int, str]]:
        path = shutil.which(program)
        if path is None:
            raise RuntimeError(f"{program} is not installed")
        return run(content, path)

    return files.select("doc", "content").mapInPandas(_per_file(each), LINES)
