"""One image as a one-page PDF, written with the standard library: the pixels are kept as they are stored."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from vellum.operators.raster import LONG_SIDE

_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _jpeg(data: bytes) -> tuple[int, int, dict[str, str], bytes]:
    """(width, height, image dictionary, stream) of a JPEG, by its frame header."""
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            raise ValueError("broken JPEG")
        mark, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if mark == 0xFF:  # padding
            at += 1
            continue
        if mark in _FRAMES:
            bits, height, width, parts = struct.unpack(">BHHB", data[at + 4 : at + 10])
            space = {1: "/DeviceGray", 3: "/DeviceRGB", 4: "/DeviceCMYK"}[parts]
            return width, height, {"ColorSpace": space, "BitsPerComponent": str(bits), "Filter": "/DCTDecode"}, data
        at += 2 + size
    raise ValueError("JPEG without a frame")


def _rows(raw: bytes, height: int, stride: int, step: int) -> Iterator[bytearray]:
    """Scan lines of a PNG with their filters undone."""
    before = bytearray(stride)
    for n in range(height):
        begin = n * (stride + 1)
        kind, line = raw[begin], bytearray(raw[begin + 1 : begin + 1 + stride])
        for i in range(stride):
            left, up = line[i - step] if i >= step else 0, before[i]
            if kind == 1:
                line[i] = line[i] + left & 255
            elif kind == 2:
                line[i] = line[i] + up & 255
            elif kind == 3:
                line[i] = line[i] + (left + up) // 2 & 255
            elif kind == 4:
                corner = before[i - step] if i >= step else 0
                guess = left + up - corner
                near = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]
                line[i] = line[i] + near & 255
        yield line
        before = line


def _png(data: bytes) -> tuple[int, int, dict[str, str], bytes]:
    """(width, height, image dictionary, stream) of a PNG; its compressed rows go in as they are, but for a transparency, which is dropped."""
    at, body, palette, head = 8, b"", b"", None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = part
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    if head is None or not body:
        raise ValueError("broken PNG")
    width, height, bits, colour, _, _, interlaced = head
    if interlaced:
        raise ValueError("interlaced PNG")
    colours = {0: 1, 2: 3, 3: 1, 4: 1, 6: 3}[colour]
    if colour in (4, 6):
        step, keep = (colours + 1) * bits // 8, colours * bits // 8
        body = zlib.compress(b"".join(b"".join(bytes(line[i : i + keep]) for i in range(0, len(line), step)) for line in _rows(zlib.decompress(body), height, width * step, step)))
    space = f"[/Indexed /DeviceRGB {len(palette) // 3 - 1} <{palette.hex()}>]" if colour == 3 else "/DeviceGray" if colours == 1 else "/DeviceRGB"
    out = {"ColorSpace": space, "BitsPerComponent": str(bits), "Filter": "/FlateDecode"}
    if colour not in (4, 6):
        out["DecodeParms"] = f"<< /Predictor 15 /Colors {colours} /BitsPerComponent {bits} /Columns {width} >>"
    return width, height, out, body


def image_pdf(data: bytes) -> tuple[bytes, float, float]:
    """(PDF, width, height) of one image: a page of its proportions whose long side is LONG_SIDE points."""
    if data[:2] == b"\xff\xd8":
        width, height, image, stream = _jpeg(data)
    elif data[:8] == b"\x89PNG\r\n\x1a\n":
        width, height, image, stream = _png(data)
    else:
        raise ValueError("no JPEG or PNG")
    if not width or not height:
        raise ValueError("an image without pixels")
    scale = LONG_SIDE / max(width, height)
    w, h = width * scale, height * scale
    draw = f"q {w:.3f} 0 0 {h:.3f} 0 0 cm /I Do Q".encode()
    entries = " ".join(f"/{k} {v}" for k, v in image.items())
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {w:.3f} {h:.3f}] /Resources << /XObject << /I 5 0 R >> >> /Contents 4 0 R >>".encode(),
        f"<< /Length {len(draw)} >>\nstream\n".encode() + draw + b"\nendstream",
        f"<< /Type /XObject /Subtype /Image /Width {width} /Height {height} {entries} /Length {len(stream)} >>\nstream\n".encode() + stream + b"\nendstream",
    ]
    out, places = b"%PDF-1.5\n%\xe2\xe3\xcf\xd3\n", []
    for n, body in enumerate(objects, 1):
        places.append(len(out))
        out += f"{n} 0 obj\n".encode() + body + b"\nendobj\n"
    table = "".join(f"{p:010d} 00000 n \n" for p in places)
    out += f"xref\n0 {len(objects) + 1}\n0000000000 65535 f \n{table}trailer\n<< /Size {len(objects) + 1} /Root 1 0 R >>\nstartxref\n{len(out)}\n%%EOF\n".encode()
    return out, w, h


def image_pages(files: DataFrame) -> DataFrame:
    """(doc, pdf, width, height, error) of image files (doc, content), one row each; one that cannot be read has an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, content in zip(frame["doc"], frame["content"], strict=True):
                try:
                    rows.append((doc, *image_pdf(bytes(content)), None))
                except Exception as problem:  # one bad file never stops the others
                    rows.append((doc, None, None, None, f"{type(problem).__name__}: {problem}"[:400]))
            yield pd.DataFrame(rows, columns=["doc", "pdf", "width", "height", "error"])

    return files.select("doc", "content").mapInPandas(run, "doc string, pdf binary, width double, height double, error string")
