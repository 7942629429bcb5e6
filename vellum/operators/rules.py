"""What the language and its documents look like, as data. Values are fixed by the library that the documents belong to."""

from __future__ import annotations

from vellum.functions.columns import WS

# Line patterns of legal texts. [^\n] stands for "any character of the line".
ARTICLE = rf"^{WS}*Điều{WS}+(\d+)\.{WS}*[^\n]*$"
CHAPTER = rf"^{WS}*((?:[Cc][Hh][Ưư][Ơơ][Nn][Gg]){WS}+[IVXLCDMivxlcdm\d]+)(?:$|[^\p{{L}}\p{{N}}_])"
CLAUSE = rf"^{WS}*(\d+){WS}*[.)]{WS}+[^\n]+$"

# Margins of a page in which running lines stand, as shares of its height.
TOP, BOTTOM = 0.12, 0.80

# The stamp of the digital signature, and what the cover of the gazette prints (fixed values).
SIGNATURE_STARTS = ("thời gian ký:", "cơ quan:", "ký bởi:", "người ký:")
EMAIL_LINE = r"^[\w.+-]+@[\w-]+(?:\.[\w-]+)+$"
EMAIL_CONTACT = rf"^(?:[Ee]-?[Mm][Aa][Ii][Ll]){WS}*:{WS}*[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
COVER_PARTS = ("văn bản quy phạm pháp luật", "công báo", "chủ tịch nước")
COVER_LINES = (r"^quốc hội$", rf"[-–]{WS}*quốc hội$", rf"^(luật|bộ luật|nghị định|nghị quyết|thông tư|quyết định){WS}+số{WS}*:", rf"^số{WS}*:{WS}*\d")

MARKER = "[trang ảnh scan — chưa có lớp văn bản]"
UNCLASSIFIED = "Chưa phân loại"

UNIT_TYPES = ("dieu", "khoan", "diem", "slide", "heading", "paragraph")
KINDS = ("legal", "slide", "prose")
SOURCE_FORMATS = ("pdf", "docx", "pptx")
SOURCES = ("share", "watch")
SCHEMA_VERSION = 1

# Files of the intake.
IMAGES = (".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".tif", ".tiff")
DOCUMENTS = (".pdf", ".doc", ".docx", ".ppt", ".pptx")
FORMAT_OF = {".pdf": "pdf", ".doc": "docx", ".docx": "docx", ".ppt": "pptx", ".pptx": "pptx"} | dict.fromkeys(IMAGES, "pdf")

# Gates of a recognised page: characters, mean confidence, share of unknown words; of the lexicon: letters, uses, documents.
PAGE_CHARS, PAGE_CONF, PAGE_UNKNOWN = 20, 60.0, 0.15
WORD_LETTERS, WORD_USES, WORD_DOCS = 7, 3, 2
# Recognition is repeated at FINE dpi where the median long line (over LONG characters) is lower than LOW pixels at COARSE dpi.
COARSE, FINE, LONG, LOW = 200, 300, 15, 30.0
