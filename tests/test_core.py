"""Operators of the core on small inputs."""

from __future__ import annotations

import io
import json
import random
import unicodedata
import zipfile

import pytest
from pyspark.sql import functions as F

from vellum.functions import columns as C
from vellum.functions.text import decode_vni, is_syllable, strip_accents
from vellum.operators import anchor, health, lines, ranking, raster, recognition, repair, sidecar, slides, structure
from vellum.sources import cache, discovery, names, office

LINE = "line_id long, doc string, origin string, page int, block_no int, line_no int, text string, bbox array<double>"


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def legal(spark, texts, page=1):
    data = [(i, "d", "o", page, 0, i, t, [0.0, 1.0 * i, 9.0, 1.0 * i + 1]) for i, t in enumerate(texts)]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, LINE).repartition(3)


def fold(texts):
    """Legal units by a plain reading of the rules, line by line."""
    import re

    out, chapter, article, open_unit = [], None, None, None
    for raw in texts:
        t = raw.strip()
        if not t:
            continue
        ch = re.match(r"(?i)\s*(chương\s+[ivxlcdm\d]+)\b", t)
        d = re.match(r"\s*Điều\s+(\d+)\.\s*(.*)$", t)
        k = re.match(r"\s*(\d+)\s*[.)]\s+(.+)$", t)
        if ch:
            label = re.sub(r"\s+", " ", ch[1])
            out.append(["heading", label, [chapter] if chapter else [], t])
            chapter, article, open_unit = label, None, None
        elif d:
            article = f"Điều {d[1]}"
            out.append(["dieu", article, [chapter] if chapter else [], t])
            open_unit = out[-1]
        elif k and article:
            out.append(["khoan", f"Khoản {k[1]}", ([chapter] if chapter else []) + [article], t])
            open_unit = out[-1]
        elif open_unit:
            open_unit[3] += "\n" + t
        else:
            out.append(["paragraph", "", [chapter] if chapter else [], t])
    return [tuple(map(str, x)) for x in out]


@pytest.mark.parametrize("seed", range(4))
def test_legal_units_follow_the_fold(spark, seed):
    r = random.Random(seed)
    pool = ["Chương I. Mở", "CHƯƠNG  II", "Điều 1. Một", "Điều 2 của Luật này", "Điều 3. Ba", "1. khoản", "2) khoản hai", "a) điểm", "văn bản", "   ", "Chương IV của luật"]
    texts = [r.choice(pool) for _ in range(40)]
    got = rows(structure.legal_units(legal(spark, texts)).orderBy("unit_no"), "type", "label", "path", "text")
    assert [tuple(map(str, x)) for x in got] == fold(texts)


def test_article_reference_is_no_article(spark):
    got = rows(structure.legal_units(legal(spark, ["Điều 201. Tên", "Điều 201 của Luật này quy định"])), "type", "text")
    assert got == [("dieu", "Điều 201. Tên\nĐiều 201 của Luật này quy định")]


def test_running_lines_and_cascade(spark):
    data, pages = [], []
    for p in range(1, 5):
        pages.append(("d", p, 595.0, 842.0))
        data += [
            (p * 10, "d", "o", p, 0, 0, f"CÔNG BÁO/Số {360 + p}", [0.0, 20.0, 9.0, 30.0]),
            (p * 10 + 1, "d", "o", p, 1, 1, "Điều 5. Tên" if p == 2 else f"thân bài {'abcd'[p - 1]}", [0.0, 300.0, 9.0, 310.0]),
            (p * 10 + 2, "d", "o", p, 2, 2, f"{p}", [0.0, 800.0, 9.0, 810.0]),
        ]
    data += [(90, "d", "o", 1, 1, 3, "Người ký: A", [0.0, 400.0, 9.0, 410.0]), (91, "d", "o", 3, 1, 3, "gửi abc@toaan.gov.vn trước ngày", None), (92, "d", "o", 1, 1, 4, "QUỐC HỘI", [0.0, 300.0, 1.0, 1.0]), (93, "d", "o", 3, 1, 4, "QUỐC HỘI", [0.0, 300.0, 1.0, 1.0])]
    ls, ps = spark.createDataFrame(data, LINE), spark.createDataFrame(pages, "doc string, page int, width double, height double")
    assert sorted(rows(lines.running_lines(ls, ps))) == [("d", "#", 4), ("d", "công báo/số #", 4)]
    kept = {r[0] for r in rows(lines.kept_lines(ls, ps), "line_id")}
    assert kept == {11, 21, 31, 41, 91, 93}


def test_vni_native_and_python_agree(spark):
    cases = {"cô sôû lyù luaän": "cơ sở lý luận", "toaùn": "toaùn", "phaïm vaø hình phaït Phaàn thứ nhất": "phạm và hình phạt Phaàn thứ nhất", "Toà án": "Toà án", "öffentliches": "öffentliches", "Acuña-Alfaro": "Acuña-Alfaro"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert dict(rows(df, "t", repair.convert(F.col("t")))) == cases
    alone = {"cô sôû lyù luaän": "cơ sở lý luận", "toaùn": "toán", "Ñieàu": "Điều", "ÔÛ GIÖÕA": "Ở GIỮA"}
    assert {k: decode_vni(k) for k in alone} == alone
    assert dict(rows(spark.createDataFrame([(k,) for k in alone], "t string"), "t", repair.decode_vni(F.col("t")))) == alone


def test_repair_is_idempotent_and_safe(spark):
    data = [("a", 1, "cô sôû lyù luaän", None), ("a", 2, unicodedata.normalize("NFD", "dấu tổ hợp"), None), ("b", 1, "toaùn", True), ("c", 1, None, None), ("c", 2, "", None)]
    units = spark.createDataFrame(data, "doc string, unit_id long, text string, ocr boolean")
    once = repair.apply_repair(units)
    assert sorted(rows(once, "doc", "unit_id", "text"), key=str) == sorted([("a", 1, "cơ sở lý luận"), ("a", 2, "dấu tổ hợp"), ("b", 1, "toaùn"), ("c", 1, None), ("c", 2, "")], key=str)
    assert sorted(rows(repair.apply_repair(once)), key=str) == sorted(rows(once), key=str)
    report = {r["doc"]: r for r in repair.repair_report(units).collect()}
    assert report["a"]["changed"] == 2 and report["a"]["safe"] and not report["c"]["safe"]


def test_validation(spark):
    good = {"schemaVersion": 1, "title": "t", "source": "share", "addedAt": "x", "sourceFormat": "pdf", "pageCount": 1, "kind": "legal", "units": [{"type": "dieu", "label": "", "path": [], "text": "a", "page": 1, "bbox": [1, 2.5, 3, 4], "ocr": True}]}
    unit = good["units"][0]
    cases = [
        (good, []),
        (good | {"pageCount": True}, ["field pageCount wrong type: expected int"]),
        (good | {"pageCount": 1.0}, ["field pageCount wrong type: expected int"]),
        (good | {"kind": "z", "pageCount": 0}, ["kind invalid: z", "pageCount must be >= 1"]),
        (good | {"units": []}, ["units must not be empty"]),
        ({k: v for k, v in good.items() if k != "title"}, ["missing field: title"]),
        (good | {"units": [unit | {"page": True}]}, ["units[0] page wrong type"]),
        (good | {"units": [unit, unit | {"bbox": [1, 2, 3, True]}]}, ["units[1] bbox must be a list of 4 numbers"]),
        (good | {"units": [unit | {"ocr": 1, "text": ""}]}, ["units[0] text must not be empty", "units[0] ocr must be a boolean"]),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(98, "{"), (99, None)], "i int, json string")
    got = dict(rows(sidecar.validation_errors(df), "i", "errors"))
    assert got == {i: e for i, (_, e) in enumerate(cases)} | {98: ["not an object"], 99: ["not an object"]}


def test_slides(spark):
    box = [10.0, 10.0, 100.0, 30.0]
    data = [("a", 1, 1, 1, "x", box), ("a", 2, 2, 1, "y", [10.0, 40.0, 120.0, 60.0]), ("a", 3, 3, 2, " ", box), ("b", 4, 1, 9, "z", None)]
    units = spark.createDataFrame(data, "doc string, unit_id long, unit_no int, page int, text string, bbox array<double>")
    counts = spark.createDataFrame([("a", 3), ("b", 3)], "doc string, pagecount int")
    assert rows(slides.slide_units(units, counts)) == [("a", 1, "Slide 1", "x\ny", 10.0, 10.0, 120.0, 60.0)]


def test_recognised_words(spark, tmp_path):
    head = "level page_num block_num par_num line_num word_num left top width height conf text".split()
    body = [["5", 1, 1, 1, 1, 1, 200, 400, 100, 40, 96, "Điều"], ["5", 1, 1, 1, 1, 2, 320, 402, 40, 38, 90, '1."'], ["5", 1, 1, 1, 1, 3, 1, 1, 1, 1, -1, "x"], ["4", 1, 1, 1, 1, 0, 1, 1, 1, 1, -1, ""]]
    (tmp_path / "w.tsv").write_text("\n".join("\t".join(map(str, r)) for r in [head, *body]))
    words = recognition.words_of(recognition.read_tsv(spark, str(tmp_path / "w.tsv")))
    got = recognition.lines_of_words(words, ("page_num", "block_num", "par_num", "line_num"), "word_num").first()
    assert got["text"] == 'Điều 1."' and got["conf"] == 93
    assert [round(got[c], 2) for c in ("x0", "y0", "x1", "y1")] == [72, 144, 129.6, 158.4]


def test_verdict_order(spark):
    data = [("d", 1, 1, "ngắn", 99.0), ("d", 2, 2, "một hai ba bốn năm sáu bảy", 10.0), ("d", 3, 3, "1234567890 1234567890 11", 90.0), ("d", 4, 4, "zzz qqq www xxx một hai ba bốn", 90.0), ("d", 5, 5, "một hai ba bốn một hai ba bốn", 90.0), ("d", 6, 6, None, None)]
    page = spark.createDataFrame(data, "doc string, page int, line_no int, text string, conf double")
    lexicon = spark.createDataFrame([(w,) for w in "một hai ba bốn".split()], "word string")
    assert dict(rows(recognition.page_verdicts(page, lexicon), "page", "reason")) == {1: "too little text", 2: "low confidence", 3: "no words", 4: "unrecognised words", 5: ""}


def test_names(spark):
    cases = {"x.pdf": ("Chưa phân loại", "x.pdf", "watch"), "[Môn] x.pdf": ("Môn", "x.pdf", "share"), "[A][B] y.pdf": ("A/B", "y.pdf", "share"), "[Môn][..] x.pdf": ("Chưa phân loại", "x.pdf", "share"), "[_a] x.pdf": ("Chưa phân loại", "x.pdf", "share"), "[Chưa phân loại][B] x.pdf": ("Chưa phân loại", "x.pdf", "share")}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {n: tuple(x) for n, x in rows(df, "n", names.destination(F.col("n")))} == cases
    gates = {"a.PDF": (True, None), ".a.pdf": (False, None), "a.pdf.tmp": (False, "a.pdf"), "a.tmp": (False, None), "a.syncthing.b.pdf": (False, None), "a.exe": (False, None), "a.jpg.tmp.TMP": (False, "a.jpg")}
    df = spark.createDataFrame([(k,) for k in gates], "n string")
    assert {n: (a, t) for n, a, t in rows(df, "n", names.is_candidate(F.col("n")), names.without_tmp(F.col("n")))} == gates


def test_free_stems(spark):
    def brute(arrivals, existing):
        taken, out = set(existing), []
        for subject, seq, name in sorted(arrivals, key=lambda x: x[1]):
            base = name[:-4]
            stem, k = base, 0
            while (subject, stem) in taken:
                k += 1
                stem = f"{base} ({k})"
            taken.add((subject, stem))
            out.append((subject, seq, base, stem))
        return sorted(out)

    r = random.Random(5)
    for pool in (["x", "y"], ["x", "x (1)", "x (2)", "y"]):
        arrivals = [(r.choice("AB"), i, r.choice(pool) + ".pdf") for i in range(25)]
        existing = [("A", "x"), ("A", "x (1)"), ("B", "y"), ("A", "x (4)")]
        got = names.free_stems(spark.createDataFrame(arrivals, "subject string, seq int, name string"), spark.createDataFrame(existing, "subject string, stem string"))
        assert sorted(rows(got)) == brute(arrivals, existing)


def test_anchor_is_monotone(spark):
    units = spark.createDataFrame([("d", 1, "Alpha  beta"), ("d", 2, "gamma"), ("d", 3, "nowhere"), ("d", 4, "alpha beta"), ("d", 5, "")], "doc string, unit_no int, text string")
    pages = spark.createDataFrame([("d", 1, "intro"), ("d", 2, "alpha\nBETA and more"), ("d", 3, "gamma")], "doc string, page int, text string")
    assert sorted(rows(anchor.anchored(units, pages), "unit_no", "page")) == [(1, 2), (2, 3), (3, 3), (4, 3), (5, 3)]


def test_anchor_against_brute_force(spark):
    r = random.Random(3)
    pages = [(d, p, " ".join(r.choice(["một", "hai", "ba bốn"]) for _ in range(r.randint(0, 40)))) for d in "ab" for p in range(1, 8)]
    units = []
    for d in "abc":
        for n in range(30):
            text = r.choice([t for x, _, t in pages if x == d] or ["x"])
            units.append((d, n, text[(i := r.randint(0, 20)) : i + r.choice([5, 60])] if r.random() < 0.8 else "lạ"))
    want = []
    for d in "abc":
        floor = 1
        for _, n, text in (u for u in units if u[0] == d):
            start = " ".join(text.split())[:40]
            floor = next((p for x, p, t in pages if x == d and start and p >= floor and start in t), floor)
            want.append((d, n, floor))
    got = rows(anchor.anchored(spark.createDataFrame(units, "doc string, unit_no int, text string").repartition(3), spark.createDataFrame(pages, "doc string, page int, text string")))
    assert sorted(got) == sorted(want)


def test_progress_and_priority(spark):
    entries = spark.createDataFrame([("a", "luat", 38, 48, 100), ("b", "luat", 10, 48, 200), ("a", "gt", 1, 398, 50), ("a", "xoa", 5, 10, 10), ("a", "hong", None, 0, 7)], "device string, key string, page int, total int, last_read long")
    stones = spark.createDataFrame([("b", "xoa", 10)], "device string, key string, ts long")
    progress = discovery.reading_progress(entries, stones)
    assert {r[0]: (round(r[1], 3), r[2]) for r in rows(progress)} == {"luat": (0.792, 200), "gt": (0.003, 50), "hong": (0.0, 7)}
    candidates = spark.createDataFrame([("luat", 48), ("gt", 398), ("bao", 1), ("xoa", 10)], "rel string, pages int")
    assert [r["rel"] for r in discovery.prioritised(candidates, progress).orderBy("rank").collect()] == ["luat", "gt", "bao", "xoa"]


def test_reading_files_with_reserved_names(spark, tmp_path):
    (tmp_path / "_reading-x.json").write_text(json.dumps({"entries": {"a.pdf": {"page": 1, "total": 4, "lastReadAt": 9}}, "tombstones": {"b.pdf": 3}}))
    (tmp_path / "_reading-y.json").write_text("not json")
    (tmp_path / "a").mkdir()
    (tmp_path / "a/_b.json").write_text("{}")
    listed = discovery.listing(spark, str(tmp_path))
    assert {(r["rel_path"], r["size"]) for r in listed.collect()} == {(n, (tmp_path / n).stat().st_size) for n in ("_reading-x.json", "_reading-y.json", "a/_b.json")}
    files = discovery.contents(listed.where("rel_path like '_reading%'").unionByName(spark.createDataFrame([("_reading-z.json", 0, 0)], listed.schema)), str(tmp_path))
    entries, stones = discovery.reading_entries(files)
    assert rows(entries) == [("_reading-x.json", "a.pdf", 1, 4, 9)] and rows(stones, "key", "ts") == [("b.pdf", 3)]


def test_discovery_policies(spark):
    paths = ["a/x.json", "a/x.pdf", "a/y.json", "_mon.json", "_mon.pdf", "_inbox/z.json", "_inbox/z.pdf", "b/_print/w.json", "b/_print/w.pdf", ".stversions/a/x.json", ".stversions/a/x.pdf", "r.json", "r.pdf"]
    files = spark.createDataFrame([(p, 1, 1) for p in paths], "rel_path string, size long, mtime long")
    got = {p: {r[0] for r in rows(discovery.sidecar_paths(files, p))} for p in ("repair", "ocr", "validate")}
    assert got == {"repair": {"a/x.json", "_mon.json", "r.json"}, "ocr": {"a/x.json", "a/y.json", "b/_print/w.json", "r.json"}, "validate": {"a/x.json", "r.json"}}
    index = spark.createDataFrame([("a/x.json", 1, 1), ("r.json", 2, 1)], "rel_path string, size long, mtime long")
    assert "a/x.json" not in {r[0] for r in rows(discovery.due(files, index), "rel_path")} and "r.json" in {r[0] for r in rows(discovery.due(files, index), "rel_path")}


def brute_alerts(runs, after, repeat):
    out, first, alert = [], None, None
    for ts, ok, sent in runs:
        if ok:
            if first is not None and (alert is not None or ts - first >= after * 60):
                out.append((ts, "recovered" if alert is not None else "recovered_unreported"))
            first = alert = None
            continue
        first = ts if first is None else first
        if (ts - alert >= repeat * 3600 if alert is not None else ts - first >= after * 60) and sent:
            out.append((ts, "failing"))
            alert = ts
    return out


def test_alerts_batch_and_stream(spark, tmp_path):
    from vellum.streaming.health import alert_stream

    r = random.Random(2)
    data, want = [], []
    for task in "ab":
        runs = [(1_700_000_000 + 1800 * i, r.random() < 0.12, r.random() < 0.7) for i in range(200)]
        want += [(task, *x) for x in brute_alerts(runs, 120, 24)]
        data += [(task, i, *x) for i, x in enumerate(runs)]
    df = spark.createDataFrame(data, "task string, run_id long, t long, ok boolean, sent boolean").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    got = sorted((a, int(b.timestamp()), c) for a, b, c in rows(health.alerts(df)))
    assert got == sorted(want)
    source = str(tmp_path / "runs")
    df.coalesce(1).write.parquet(source)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = alert_stream(spark.readStream.schema(df.schema).parquet(source))
    try:
        q = stream.writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    except Exception as missing:  # the stateful operator needs a library that may be missing
        pytest.skip(str(missing)[:100])
    try:
        q.awaitTermination(120)
    except Exception as missing:
        pytest.skip(str(missing)[:200])
    assert sorted((a, int(b.timestamp()), c) for a, b, c in rows(spark.table("alerts"))) == sorted(want)


def test_budget(spark):
    pages = spark.range(1, 31).select(F.col("id").alias("rank"), F.lit(10.0).alias("seconds"))
    assert health.admitted(pages, 120).count() == 8 and health.admitted(pages, 40).count() == 2


def test_rank_over_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    got = ranking.ranked(df, [F.col("v").desc()])
    assert got.where("rank <> 1000 - v").count() == 0
    summed = ranking.summed_before(got, "rank", "v", "s", 64)
    assert summed.where("rank = 3").first()["s"] == 999 + 998


def test_errors_and_durations(spark):
    rules = spark.createDataFrame([(2, "b", "two"), (1, "A|x", "one")], "ord int, match string, reason string")
    got = rows(health.explained(spark.createDataFrame([("aB",), ("B",), ("c",), (None,)], "detail string"), rules))
    assert got == [("aB", "one"), ("B", "two"), ("c", None), (None, None)]
    many = spark.createDataFrame([(i, f"x{i}$", str(i)) for i in range(350)], "ord int, match string, reason string")
    assert rows(health.explained(spark.createDataFrame([("x349",), ("x7",)], "detail string"), many)) == [("x349", "349"), ("x7", "7")]
    assert [r[0] for r in rows(spark.createDataFrame([(5,), (125,), (3000,)], "m int").select(health.duration_text(F.col("m"))))] == ["5 phút", "2 giờ 5 phút", "2 ngày 2 giờ"]


def test_retention_and_mirror(spark):
    snaps = spark.createDataFrame([("2024-01-0%d" % i,) for i in range(1, 7)] + [("other",)], "name string")
    assert sorted(r[0] for r in rows(discovery.expired_snapshots(snaps))) == ["2024-01-01", "2024-01-02"]
    a = spark.createDataFrame([("x", 1, 1), ("y", 1, 1), ("z", 1, 1)], "rel_path string, size long, mtime long")
    b = spark.createDataFrame([("x", 1, 1), ("y", 1, 2), ("w", 1, 1)], "rel_path string, size long, mtime long")
    assert sorted(rows(discovery.mirror_diff(a, b))) == [("w", "delete"), ("y", "copy"), ("z", "copy")]


def test_raster(spark):
    images = spark.createDataFrame([("a", 1, 500, 150.0, "DCT"), ("b", 1, 100, 150.0, "DCT"), ("c", 1, 10, 150.0, "JPX")], "doc string, page int, px_w int, page_w double, filter string")
    assert dict(rows(raster.heavy_documents(images))) == {"a": True, "b": False, "c": True}
    assert {r[0]: r[2] for r in rows(raster.render_dpi(images))} == {"a": 150, "b": 48, "c": 4}
    pixels = spark.createDataFrame([("a", 1, 10, 10, 12)] * 400 + [("a", 1, 200, 10, 10)] * 2, "doc string, page int, r int, g int, b int")
    assert rows(raster.gray_pages(pixels), "gray") == [(False,)]
    assert tuple(rows(spark.range(1).select(raster.page_size(F.lit(200.0), F.lit(100.0))))[0][0]) == (842.0, 421.0)


def _zip(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_office_files(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = _zip({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t> Điều 1. </w:t></w:r><w:r><w:t>A</w:t></w:r></w:p><w:p/><w:tbl><w:p><w:r><w:t>no</w:t></w:r></w:p></w:tbl></w:body></w:document>"})
    ns = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    slide = f"<p:sld {ns}><p:cSld><p:spTree><p:sp><p:txBody><a:p><a:r><a:t>Hai</a:t></a:r></a:p></p:txBody></p:sp></p:spTree></p:cSld></p:sld>"
    pptx = _zip({
        "ppt/presentation.xml": f'<p:presentation {ns}><p:sldIdLst><p:sldId id="1" r:id="r2"/><p:sldId id="2" r:id="r1"/></p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="slides/slide1.xml"/><Relationship Id="r2" Target="slides/slide2.xml"/></Relationships>',
        "ppt/slides/slide1.xml": f"<p:sld {ns}><p:cSld><p:spTree/></p:cSld></p:sld>", "ppt/slides/slide2.xml": slide,
    })
    files = spark.createDataFrame([("a", docx), ("bad", b"x")], "doc string, content binary")
    got = rows(office.read_docx(files), "doc", "page", "text")
    assert got[0] == ("a", 0, "Điều 1. A") and got[1][0] == "bad" and rows(office.read_docx(files), "error")[1][0]
    assert rows(office.read_pptx(spark.createDataFrame([("p", pptx)], "doc string, content binary")), "page", "text") == [(1, "Hai"), (2, "Slide 2")]
    assert "not installed" in rows(office.with_program(files, "no-such-program", lambda b, p: []), "error")[0][0]


def test_inbox_stream_and_sinks(spark, tmp_path):
    from vellum.streaming import inbox

    box = tmp_path / "_inbox"
    box.mkdir()
    for name in ("[Môn] a.pdf", ".hidden.pdf", "b.exe", "c.jpg"):
        (box / name).write_bytes(b"1")
    done = tmp_path / "done"
    done.mkdir()

    def publish(row):
        if row["name"] == "c.jpg":
            raise ValueError("no picture")
        with (done / row["name"]).open("a") as f:
            f.write(row["subject"])

    for _ in range(2):  # a second pass finds nothing new
        q = inbox.publish_stream(inbox.inbox_files(spark, str(box)).select("name", "subject"), str(tmp_path / "cp"), publish)
        q.awaitTermination(60)
        assert [(p.name, p.read_text()) for p in done.iterdir()] == [("[Môn] a.pdf", "Môn")]
        assert sorted(rows(spark.read.parquet(str(tmp_path / "cp-report"))), key=str) == [("[Môn] a.pdf", None), ("c.jpg", "ValueError: no picture")]
    pdf, js = tmp_path / "out/a.pdf", tmp_path / "out/a.json"
    assert inbox.publish_pair(box / "c.jpg", {"x": "ị"}, pdf, js, box / "c.jpg") and not (box / "c.jpg").exists() and json.loads(js.read_text()) == {"x": "ị"}
    stat = pdf.stat()
    old = js.read_bytes()
    assert not inbox.replace_if_unchanged(js, b"other", "{}", pdf, (stat.st_size, stat.st_mtime_ns))
    assert inbox.replace_if_unchanged(js, old, "{}", pdf, (stat.st_size, stat.st_mtime_ns)) and js.read_text() == "{}"


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a  b ",), ("",), (None,)], "t string")
    assert rows(df.select(C.squash(F.col("t")), C.word_count(F.col("t")))) == [("a b", 2), ("", 0), (None, None)]
    assert [is_syllable(w) for w in ("người", "quyền", "gì", "xg", "thiiê", "keát")] == [True, True, True, False, False, False]
    assert strip_accents("Điều ở") == "Dieu o"
    assert rows(spark.createDataFrame([("ê",)], "t string").select(C.nfc(F.col("t")))) == [("ê",)]


def test_empty_tables(spark):
    ls = spark.createDataFrame([], LINE)
    ps = spark.createDataFrame([], "doc string, page int, width double, height double")
    assert structure.document_units(ls, ps).count() == 0 and lines.running_lines(ls, ps).count() == 0 and structure.marker_units(ps, ls).count() == 0


def test_page_cache(spark, tmp_path):
    head = {"v": 1, "engine": "e"}
    data = [("a", 0, json.dumps(head)), ("a", 1, '{"page": 1, "dpi": 200, "lines": ["x"]}'), ("a", 2, '{"page": 1, "dpi": 300, "lines": ["y"]}'), ("a", 3, '{"page": 2, "err'), ("b", 0, '{"v": 2}'), ("b", 1, '{"page": 1}')]
    got = rows(cache.cached_pages(spark.createDataFrame(data, "doc string, seq int, value string"), F.lit(json.dumps(head))), "doc", "page", "dpi")
    assert got == [("a", 1, 300)]
    engine = cache.Engine("reader", "5", "vie", 200)
    results = spark.createDataFrame([("a", 1), ("b", 1)], "doc string, page int")
    cache.append_pages(results, str(tmp_path / "c"), engine, F.concat(F.lit("s-"), "doc"))
    now = spark.createDataFrame([("a", "s-a"), ("b", "changed")], "doc string, signature string")
    table = spark.read.parquet(str(tmp_path / "c"))
    assert rows(cache.usable(table, engine, now), "doc") == [("a",)]
    assert cache.usable(table, cache.Engine("reader", "5", "vie", 300), now).count() == 0


def test_settings_and_archive(tmp_path):
    assert cache.settings('{"enabled": true, "workers": 4}') == (True, 4) and cache.settings('{"enabled": 1, "workers": true}') == (False, 2)
    assert cache.settings(None) == (False, 2) and cache.settings("[]") == (False, 2) and cache.settings('{"enabled": true, "workers": 9}') == (True, 2)
    (tmp_path / "a.pdf").write_text("1")
    (tmp_path / "old").mkdir()
    (tmp_path / "old/a.pdf").write_text("0")
    assert cache.archive(tmp_path / "a.pdf", tmp_path / "old", set()).name == "a (1).pdf"
    assert cache.file_hash(tmp_path / "old/a.pdf").startswith("5feceb66") and cache.label(tmp_path / "kho") == tmp_path.name


def test_stable_files(spark, tmp_path):
    from vellum.streaming.inbox import stable_files

    schema = "path string, size long, seen long"
    q = None
    for n, listing in enumerate([[("a", 1), ("b", 5)], [("a", 1), ("b", 6)], [("a", 1), ("b", 6)]]):
        spark.createDataFrame([(p, s, n) for p, s in listing], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        stream = stable_files(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted(rows(spark.read.parquet(str(tmp_path / "out")))) == [("a", 1), ("b", 6)]


def test_repairs_do_not_depend_on_partitioning(spark):
    lines_in = legal(spark, ["Chương I. A", "Điều 1. B", "1. c", "d", "Điều 2. E"] * 5)
    want = sorted(map(str, rows(structure.legal_units(lines_in))))
    assert sorted(map(str, rows(structure.legal_units(lines_in.repartition(11))))) == want
