"""Whole passes on the smallest tables."""

from __future__ import annotations

import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from vellum.__main__ import main
from vellum.plans import library

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("command", ["intake", "repair", "slides", "validate", "lexicon"])
def test_commands(spark, command, tmp_path, capsys):
    assert main([command, "--tables", FOLDER, "--out", str(tmp_path), "--apply"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report and (tmp_path / command).exists()
    if command == "intake":
        assert report["processed"] > 0 and report["failed"] == 0
    if command == "repair":
        assert report["unsafe"] == 0 and (tmp_path / "history").exists()


#: A frame header of 200 x 100 pixels in three colours, and nothing to see.
JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x64\x00\xc8\x03" + bytes(9) + b"\xff\xd9"


def png(width, height, colour, rows, kinds=(0, 0), palette=b""):
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + (part(b"PLTE", palette) if palette else b"") + part(b"IDAT", zlib.compress(b"".join(bytes([k]) + r for k, r in zip(kinds, rows, strict=False)))) + part(b"IEND", b"")


def test_images_become_pages():
    from vellum.sources.images import image_pdf

    out, w, h = image_pdf(JPEG)
    assert (w, h) == (842.0, 421.0) and b"/MediaBox [0 0 842.000 421.000]" in out and JPEG in out and b"/DCTDecode" in out
    at = int(out.split(b"startxref\n")[1].split(b"\n")[0])
    assert out[at : at + 4] == b"xref"
    for n, line in enumerate(out[at:].split(b"\n")[3:8], 1):
        assert out[int(line[:10]) :].startswith(b"%d 0 obj" % n)
    plain, w, h = image_pdf(png(1, 2, 2, [b"\x01\x02\x03", b"\x04\x05\x06"]))
    assert (w, h) == (421.0, 842.0) and b"/Predictor 15 /Colors 3" in plain
    assert b"/Indexed /DeviceRGB 1 <000000ffffff>" in image_pdf(png(1, 1, 3, [b"\x01"], palette=b"\0\0\0\xff\xff\xff"))[0]
    for kind, second in ((0, b"\x05\x06\x07\xff"), (1, b"\x05\x06\x07\xff"), (2, b"\x04\x04\x04\x00"), (3, bytes([5, 5, 6, 128])), (4, b"\x04\x04\x04\x00")):
        stream = image_pdf(png(1, 2, 6, [b"\x01\x02\x03\xff", second], (0, kind)))[0].split(b"/Filter /FlateDecode")[1].split(b"stream\n")[1].split(b"\nendstream")[0]
        assert zlib.decompress(stream) == b"\x01\x02\x03\x05\x06\x07", kind
    for bad in (b"", b"GIF89a", b"\xff\xd8\xff\xd9", b"\x89PNG\r\n\x1a\n"):
        with pytest.raises(ValueError):
            image_pdf(bad)


def test_inbox_to_published_pairs(spark, tmp_path):
    from vellum.sources import office

    def fake_pdf(content: bytes) -> list[tuple]:
        """A PDF is here its lines of text; a form feed ends a page."""
        if content.startswith(b"broken"):
            raise ValueError("no PDF")
        return [(p, 0, n, t or None, [50.0, 200.0 + 20 * n, 500.0, 215.0 + 20 * n], 595.0, 842.0) for p, page in enumerate(content.decode().split("\f"), 1) for n, t in enumerate(page.split("\n"))]

    root = tmp_path / "lib"
    (root / "_inbox").mkdir(parents=True)
    (root / "Dân sự").mkdir()
    (root / "Dân sự" / "luật.pdf").write_bytes(b"old")
    for name, text in {"[Dân sự] luật.pdf": "Chương I\nĐiều 1. Phạm vi\n1. Khoản một", "ảnh.pdf": "\f", "[X] hỏng.pdf": "broken", "[X] b.docx": "x"}.items():
        (root / "_inbox" / name).write_bytes(text.encode())
    (root / "_inbox" / "[X] tấm.JPG").write_bytes(JPEG)
    read = lambda files: office.read_pdf(files, fake_pdf)
    told = {r["name"]: r["error"] for r in library.inbox_pass(spark, str(root), "2026-01-01T00:00:00+07:00", read).collect()}
    assert {n for n, e in told.items() if e is None} == {"[Dân sự] luật.pdf", "ảnh.pdf", "[X] tấm.JPG"} and "no PDF" in told["[X] hỏng.pdf"] and told["[X] b.docx"]
    assert len(list((root / "_inbox").iterdir())) == 5
    report = library.inbox_passes(spark, [str(tmp_path / "missing"), str(root)], "2026-01-01T00:00:00+07:00", read, True)
    assert report[str(root)] == {"processed": 3, "failed": 2} and "error" in report[str(tmp_path / "missing")]
    assert {p.name for p in (root / "_inbox").iterdir()} == {"[X] hỏng.pdf", "[X] b.docx"}
    made = json.loads((root / "Dân sự" / "luật (1).json").read_text())
    assert made["kind"] == "legal" and [u["label"] for u in made["units"]] == ["Chương I", "Điều 1", "Khoản 1"] and made["units"][1]["bbox"] == [50.0, 220.0, 500.0, 235.0] and made["addedAt"].startswith("2026")
    assert (root / "Dân sự" / "luật (1).pdf").exists() and (root / "Dân sự" / "luật.pdf").read_bytes() == b"old"
    assert (root / "X" / "tấm.pdf").read_bytes().startswith(b"%PDF") and json.loads((root / "X" / "tấm.json").read_text())["units"][0]["bbox"] == [0.0, 0.0, 842.0, 421.0]
    scan = json.loads((root / "Chưa phân loại" / "ảnh.json").read_text())
    assert scan["units"][0]["text"].startswith("[trang ảnh scan") and scan["units"][0]["bbox"] == [0.0, 0.0, 595.0, 842.0]


def test_pdf_lines_keep_their_place():
    from types import SimpleNamespace as Obj

    from vellum.sources import office

    line = lambda *spans, y=10: {"bbox": (1, y, 2, y + 5), "spans": [{"text": s} for s in spans]}
    page = Obj(rect=Obj(width=595, height=842), get_text=lambda kind: {"blocks": [{"lines": [line("a", "b"), line("  ")]}, {"image": 1}, {"lines": [line("c", y=20)]}]})
    bare = Obj(rect=Obj(width=842, height=595), get_text=lambda kind: {"blocks": []})
    assert office.pdf_lines([page, bare]) == [(1, 0, 0, "ab", [1.0, 10.0, 2.0, 15.0], 595.0, 842.0), (1, 2, 0, "c", [1.0, 20.0, 2.0, 25.0], 595.0, 842.0), (2, None, None, None, None, 842.0, 595.0)]


def test_report_only_writes_nothing(spark, tmp_path):
    assert main(["repair", "--tables", FOLDER, "--out", str(tmp_path)]) == 0 and not list(tmp_path.iterdir())


def test_recognition_goes_on_where_it_stopped(spark):
    heads = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "doc string, pagecount int")
    marker = "[trang ảnh scan — chưa có lớp văn bản] (trang 1)"
    units = spark.createDataFrame([("a", marker, None), ("b", marker, None), ("c", "chữ", None)], "doc string, text string, ocr boolean")
    progress = spark.createDataFrame([("a", 0.5, 9)], "key string, fraction double, last_read long")
    results = spark.createDataFrame([("a", 1)], "doc string, page int")
    queue = library.recognition_queue(heads, units, results, progress, 120, 30.0, 1)
    assert [(r["doc"], r["page"]) for r in queue.orderBy("rank").collect()] == [("a", 2), ("a", 3), ("b", 1)]
    rest = library.recognition_queue(heads, units, results.union(queue.select("doc", "page")), progress, 120, 30.0, 1)
    assert [(r["doc"], r["page"]) for r in rest.collect()] == [("b", 2)]
    assert library.numbered(queue.select("doc", "page"), ["page"]).where(F.col("unit_no") == 1).count() == 2


def test_recognised_documents_are_guarded(spark):
    line = "Điều 1. người quản lý di sản xem xét lại hợp đồng mẫu"
    shape = "ocr_line_id long, doc string, page int, line_no int, text string, conf double, bbox array<double>, block struct<b:int,p:int>"
    docs = ("ok", "count", "foreign", "poor", "partly")
    results = [(10 * i + p, d, p, 0, line if d != "poor" else "x", 90.0, None, (0, 0)) for i, d in enumerate(docs) for p in (1, 2) if (d, p) != ("partly", 2)]
    heads = spark.createDataFrame([(d, 2) for d in docs], "doc string, pagecount int")
    pages = spark.createDataFrame([(d, p, 595.0, 842.0) for d in docs for p in ((1, 2, 3) if d == "count" else (1, 2))], "doc string, page int, width double, height double")
    marker = "[trang ảnh scan — chưa có lớp văn bản] (trang 1)"
    units = [(d, marker, None) for d in docs] + [("foreign", "chữ", None)] + [(f"clean{i}", line, None) for i in range(3)]
    out = library.recognised(heads, spark.createDataFrame(results, shape), spark.createDataFrame(units, "doc string, text string, ocr boolean"), pages).collect()
    assert {r["doc"] for r in out} == {"ok"} and [(r["type"], r["label"], r["kind"], r["ocr"]) for r in sorted(out, key=lambda r: r["unit_no"])] == [("dieu", "Điều 1", "legal", True)] * 2
