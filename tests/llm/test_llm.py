"""Operators for training text on small inputs: results against brute force, and every kind of dirt."""

from __future__ import annotations

import itertools
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions.text import VNI_PAIRS
from vellum.llm import boilerplate, encoding, leakage, lookalike, mixing, pii, quality, scanfix, terms
from vellum.llm.common import once
from vellum.llm.encoding import TCVN3

LONG = "người quản lý di sản xem xét lại hợp đồng mẫu " * 20_000


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def clashing(df):
    """Extra columns with the names that operators use inside."""
    for name in ("word", "key", "n", "template", "record", "slot", "code", "bucket", "rank", "_row", "tab", "row_id", "scan", "title", "label"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


# --- shared --------------------------------------------------------------------------------------


def test_once(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "c"), (None, "c")], "k long, t string")
    assert sorted(rows(once(df, "k")), key=str) == sorted([(1, "a"), (2, None), (None, "c"), (None, "c")], key=str)


# --- 1 -------------------------------------------------------------------------------------------

DOC_LINES = "line_id long, doc string, origin string, page int, block_no int, line_no int, text string, bbox array<double>"


def test_template_ignores_form():
    forms = ["Trang 12", "TRANG  3.", "Ｔｒａｎｇ 7 !", "Trang 4", "Tra​ng 1", unicodedata.normalize("NFD", "Trang 99…"), "Тrang 5"]
    assert len({boilerplate.template(f) for f in forms}) == 1
    assert boilerplate.template("Trang một") != boilerplate.template("Trang hai")
    assert boilerplate.template("- 12 -") == boilerplate.template("- 3 -") and boilerplate.template("") == ""


def test_repeated_lines_against_brute_force(spark):
    r = random.Random(1)
    data, n = [], 0
    for origin, docs in (("a", 20), ("hot", 60), ("tiny", 2), ("three", 3)):
        for d in range(docs):
            for line in range(6):
                text = r.choice([f"Trang {r.randint(1, 99)}", "Bản quyền thuộc nhóm", "BẢN QUYỀN  thuộc nhóm.", f"riêng {origin} {d} {line} {'abc'[r.randrange(3)]}", "hiếm gặp" if d % 10 == 0 else f"nội dung {'xyz'[r.randrange(3)]}{'qwertyuiop'[d % 10]}", None, ""])
                data.append((n, f"{origin}{d}", origin, 1, 0, line, text, None))
                if r.random() < 0.1:
                    data.append(data[-1])
                n += 1
    data += [(n + 1, None, "a", 1, 0, 0, "Trang 1", None), (n + 2, "z", None, 1, 0, 0, "Trang 1", None), (n + 3, "a0", "a", 1, 0, 0, LONG, None)]
    docs_of, in_docs = defaultdict(set), defaultdict(set)
    for i, doc, origin, *_, text, _ in data:
        if doc is not None and origin is not None:
            docs_of[origin].add(doc)
            if text is not None and boilerplate.template(text):
                in_docs[origin, boilerplate.template(text)].add(doc)
    want = {i for i, doc, origin, *_, text, _ in data if doc and origin and text and len(in_docs[origin, boilerplate.template(text)]) >= max(3, 0.2 * len(docs_of[origin]))}
    df = clashing(spark.createDataFrame(data, DOC_LINES).repartition(5))
    got = rows(boilerplate.repeated_lines(df))
    assert sorted(i for (i,) in got) == sorted(want) and want
    texts = dict(rows(boilerplate.without_repeated(df), "doc", "text"))
    assert set(texts) == {d for _, d, *_ in data if d} and not any(re.search(r"^Trang \d+$", t, re.MULTILINE) for d, t in texts.items() if d.startswith("hot"))


def test_tree_levels_and_slots():
    tree = boilerplate.TokenTree()
    for i, doc in enumerate("aab"):
        tree.add("o", doc, f"Số {i} của năm 2020")
    tree.add("o", "c", "x")
    assert sorted((o, k, t, sorted(d)) for o, k, t, d in tree.leaves()) == [("o", "số 0 của năm 0", f"số {boilerplate.WILD} của năm 2020", ["a", "b"]), ("o", "x", "x", ["c"])]
    assert set(tree.root["o"]["số"]["0"]["của"]) == {"số 0 của năm 0"} and set(tree.root["o"]["x"]) == {None} and tree.held == 3


def test_trees_merge_in_any_order():
    r = random.Random(5)
    lines = [(r.choice("op"), r.choice("abcd"), r.choice(["Trang {}", "Số {} của {}", "a b c d {}", "{}"]).format(r.randrange(3), r.randrange(2))) for _ in range(60)]
    whole = boilerplate.TokenTree()
    parts = [boilerplate.TokenTree() for _ in range(4)]
    for i, line in enumerate(lines):
        whole.add(*line)
        parts[i % 4].add(*line)
    plain = lambda t: sorted((o, k, str(f), sorted(d)) for o, k, f, d in t.leaves())
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        merged = boilerplate.TokenTree()
        for i in order:
            merged.merge(parts[i])
        assert plain(merged) == plain(whole) and merged.held == whole.held


def test_marks_behind_a_line_do_not_count():
    assert len({boilerplate.template(t) for t in ("Trang 3", "Trang 4 *", "- Trang 5".removeprefix("- "), "TRANG 6 …!", "Trang 7 -_")}) == 1
    assert boilerplate.template("* * *") == boilerplate.template("* * *") != ""


# --- 2 -------------------------------------------------------------------------------------------

OCR = "ocr_line_id long, doc string, page int, line_no int, text string, conf double, bbox array<double>, block struct<b:int,p:int>, ocr_at timestamp"
PROSE = ["Bên bảo lãnh cần đình chỉ phụ lục hợp đồng có dấu hiệu giả", "tạo theo tỷ lệ lỗi của mỗi bên. Việc kiểm tra quyết định tạm", "thời còn thiếu chữ ký do người thừa kế thực hiện trong lúc đó."]
KINDS = {
    "prose": PROSE,
    "list": ["• tóm tắt vụ việc", "a) biên bản giao nhận", "Phạm vi kỷ luật lao động .......... 324", "nội dung tranh chấp, 274, 204, 305"],
    "table": ["bảo hành  83,2  12  4.500", "đại diện | 82% | 13 | -", "2014  43%  23%  90.785"],
    "junk": [">^ |«— ¬¬| i°*^.° I>'I_. °", "J` —J^¬*, :/^/'`", "v veằ# # g9r xx"],
}


def ocr(spark, docs):
    data, n = [], 0
    for doc, lines in docs.items():
        for i, t in enumerate(lines):
            data.append((n, doc, 1 + i // 30, i, t, None if i % 7 == 0 else 80.0, None, (1, i // 4), None))
            n += 1
    return data


def test_kinds_of_documents(spark):
    r = random.Random(2)
    docs = {f"{k}{i}": [r.choice(v) for _ in range(25)] + ["Trang 5"] for k, v in KINDS.items() for i in range(4)}
    docs["mixed"] = PROSE * 6 + KINDS["list"] * 3
    docs["numbers"] = ["- 3 -", "4"]
    data = ocr(spark, docs)
    data += data[:40] + [(9990, None, 1, 1, "x", 1.0, None, None, None), (9991, "prose0", None, None, None, None, None, None, None), (9992, "prose1", 9, 1, LONG, 50.0, None, None, None), (9993, "blank", 1, 1, "  ", 1.0, None, None, None)]
    df = clashing(spark.createDataFrame(data, OCR).repartition(6))
    got = {d for (d,) in rows(quality.found(df))}
    assert got == {f"{k}{i}" for k in ("list", "table", "junk") for i in range(4)}
    stats = {r["doc"]: r for r in quality.document_statistics(df).collect()}
    assert stats["numbers"]["prose_share"] is None and stats["prose0"]["lines"] == 26 and "blank" not in stats
    assert stats["table0"]["table_share"] > 0.9 and stats["junk1"]["known_words"] < 0.5 and 3 < stats["prose2"]["mean_word_length"] < 5


def some_model(seed=0):
    r = np.random.default_rng(seed)
    return quality.Model(r.dirichlet(np.ones(4)), r.dirichlet(np.ones(4), 4), [r.dirichlet(np.ones(n), 4) for n in quality.SYMBOLS]), r


def path_score(model, codes, path):
    score = np.log(model.start[path[0]])
    for i, c in enumerate(codes):
        score += (np.log(model.trans[path[i - 1], path[i]]) if i else 0) + model.seen[c][path[i]]
    return score


def test_viterbi_against_all_paths():
    model, r = some_model()
    chains = [np.append(r.integers(0, quality.CODES, n), quality.CODES) for n in (4, 0, 2, 5)]
    flat, ends = np.concatenate(chains), np.cumsum([len(c) for c in chains])
    want = [max(itertools.product(range(4), repeat=len(c)), key=lambda p, c=c: path_score(model, c, p)) for c in chains]
    assert quality.viterbi(flat, ends, model).tolist() == [x for p in want for x in p]
    assert quality.viterbi(flat[:0], ends[:0], model).tolist() == []
    assert quality._features_of(quality._code([2, 3, 4, 1, 0, 2, 1])) == [2, 3, 4, 1, 0, 2, 1]
    row = quality._code([2, 3, 4, 1, 0, 2, 1])
    assert abs(model.seen[row] - sum(np.log(e[:, x]) for e, x in zip(model.emit, [2, 3, 4, 1, 0, 2, 1], strict=True))).max() < 1e-9


def test_expected_counts_against_all_paths():
    model, r = some_model(1)
    codes = r.integers(0, quality.CODES, 5)
    start, steps, counts = quality.expected(codes, np.array([5]), model)
    paths = list(itertools.product(range(4), repeat=5))
    weight = np.exp([path_score(model, codes, p) for p in paths])
    weight /= weight.sum()
    for k in range(4):
        assert abs(start[k] - sum(w for p, w in zip(paths, weight, strict=True) if p[0] == k)) < 1e-9
        assert abs(counts[codes[2], k] - sum(w for p, w in zip(paths, weight, strict=True) for i in range(5) if codes[i] == codes[2] and p[i] == k)) < 1e-9
        for j in range(4):
            assert abs(steps[k, j] - sum(w * sum(a == k and b == j for a, b in itertools.pairwise(p)) for p, w in zip(paths, weight, strict=True))) < 1e-9


def test_long_pages_as_in_one_piece(spark, monkeypatch):
    model, r = some_model(2)
    codes = r.integers(0, quality.CODES, 400)
    whole = quality.viterbi(codes, np.array([400]), model)
    cuts = np.array([90, 170, 171, 400])
    cross = quality.crossing(codes, cuts, model, np.array([True, False, False, False]))
    leave = np.array(quality.borders(list(cross)))
    assert (quality.viterbi(codes, cuts, model, np.array([-1, *leave[:-1]]), leave) == whole).all()
    lines = [(i, d, p, i, random.Random(i).choice(sum(KINDS.values(), [])), 50.0, None, None, None) for d, p in (("a", 1), ("b", None)) for i in range(30)]
    lines = [(n, *x[1:]) for n, x in enumerate(lines)]
    df = spark.createDataFrame(lines, OCR)
    monkeypatch.setattr(quality, "model_of", lambda pages: model)
    labels = lambda: {r["id"]: r["label"] for r in quality.label_lines(df).collect()}
    want = labels()
    monkeypatch.setattr(quality, "PIECE", 7)
    assert labels() == want and len(want) == 60


def test_neighbours_correct_the_rule(spark):
    """The same words are a list entry amid entries, against the rule, and prose amid prose."""
    entry, same = "a) biên bản giao nhận", "biên bản giao nhận tài liệu"
    assert quality.first_label(quality._features_of(quality.code_of(same))) == 0
    docs = {f"list{i}": KINDS["list"] * 6 + [entry] * 3 + [same] + [entry] * 3 + KINDS["list"] * 6 for i in range(3)}
    docs |= {f"prose{i}": PROSE * 8 + [same] + PROSE * 8 for i in range(3)}
    data = ocr(spark, docs)
    text = {r[0]: r[4] for r in data}
    got = {(r["doc"][:4], r["label"]) for r in quality.label_lines(spark.createDataFrame(data, OCR)).collect() if text[r["id"]] == same}
    assert got == {("list", "list"), ("pros", "prose")}


# --- 3 -------------------------------------------------------------------------------------------

UNITS = "unit_id long, doc string, unit_no int, type string, label string, path array<string>, text string, page int, bbox array<double>, ocr boolean"


def scan(spark):
    clean = " ".join(PROSE).replace(".", " .") + " phụ lục không đồng"
    units = [(i, f"c{i % 3}", i, "paragraph", "", [], clean, 1, None, None) for i in range(9)]
    page = [
        (0, "Quy định chung về đặt cọc 7"), (1, "Bên bảo lãnh cần đì-"), (2, "nh chỉ phụ lục kh0ng đồng †ạm thời"), (3, "còn thiếu chữ ký do người thừa kế thực hiện."), (4, "- 7 -"),
    ]
    lines, n = [], 0
    for p in (1, 2, 3):
        for no, t in page:
            lines.append((n, "s", p, no, t, 80.0, None, (1 if no == 0 else 2 if no < 4 else 3, 1), None))
            n += 1
    lines += [(100 + i, "lists", 1, i, t, 80.0, None, (1, 1), None) for i, t in enumerate(KINDS["list"] * 5)]
    lines += [(200, "s", 4, 0, "Quy định khác hẳn về việc này", 80.0, None, (1, 1), None), (201, "s", 4, 1, "kinh tế - xã hội của người học -", 80.0, None, (2, 1), None), (202, "s", 4, 2, "Điều 238a theo mẫu B1 là đủ.", 80.0, None, (2, 1), None)]
    lines += lines[1:3] + [(300, "s", 5, 0, None, None, None, None, None), (301, None, 1, 0, "x", None, None, None, None), (302, "s", 6, 0, "", None, None, (1, 1), None)]
    units += [(50, "s", 9, "paragraph", "", [], "Bên bảo lãnh cần đì-\nnh chỉ phụ lục", 1, None, True), (51, "s", 10, "paragraph", "", [], "Trang 7", 1, None, True), (51, "s", 10, "paragraph", "", [], "Trang 7", 1, None, True), (52, "lists", 1, "paragraph", "", [], "n9ười", 1, None, True), (53, "s", 11, "paragraph", "", [], None, 1, None, True)]
    return clashing(spark.createDataFrame(lines, OCR)), clashing(spark.createDataFrame(units, UNITS))


def test_scan_noise(spark):
    lines, units = scan(spark)
    got = set(rows(scanfix.scan_noise(lines, units)))
    want = {("units", 50, "broken_word"), ("units", 51, "page_number")}
    for p in range(3):
        want |= {("ocr_lines", 5 * p, "running_header"), ("ocr_lines", 5 * p + 1, "broken_word"), ("ocr_lines", 5 * p + 2, "misread"), ("ocr_lines", 5 * p + 4, "page_number")}
    assert got == want


def test_paragraphs(spark):
    lines, units = scan(spark)
    got = sorted(rows(scanfix.paragraphs(lines, units), "page", "text"))
    assert got[0] == (1, "Bên bảo lãnh cần đình chỉ phụ lục không đồng tạm thời còn thiếu chữ ký do người thừa kế thực hiện.") and len(got) == 4


def test_repaired_units(spark):
    lines, units = scan(spark)
    top = [(60 + p, "t", p, "paragraph", "", [], "Quy định chung về đặt cọc\nphụ lục kh0ng đồng", p, None, True) for p in (1, 2)]
    got = sorted(rows(scanfix.repaired_units(lines, units.select(*spark.createDataFrame(top, UNITS).columns).unionByName(spark.createDataFrame(top, UNITS)))))
    assert got == [("units", 50, "Bên bảo lãnh cần đình chỉ phụ lục"), ("units", 51, ""), ("units", 61, "phụ lục không đồng"), ("units", 62, "phụ lục không đồng")]
    assert scanfix.repaired_units(lines, units.limit(0)).count() == 0


def test_readings_and_cuts():
    assert dict(scanfix.readings("n9ười"))["người"] == "9>g" and "chưa" in dict(scanfix.readings("cliưa")) and "hợp" in dict(scanfix.readings("liợp"))
    assert scanfix.doubtful("iigười") and not scanfix.doubtful("238a") and not scanfix.doubtful("liên") and not scanfix.doubtful("B1")
    assert scanfix.cut_word("người khởi ki-") == "ki" and not scanfix.cut_word("kinh tế -") and not scanfix.cut_word("x rr¬") and scanfix.cut_word("một ng=")
    assert scanfix.readings("x" * 10_000) == () and scanfix.title_key("HIỆU LỰC C0NG KHAI 257") == scanfix.title_key("hiệu lực công khai")


def test_every_reading_of_a_neighbour_is_asked():
    places = [{"before": "", "word": "n0!", "after": "th0!"}, {"before": "n0!", "word": "th0!", "after": ""}]
    model = {"nói": 40, "nòi": 20, "thôi": 60, "thòi": 20, "nòi thòi": 20}
    asked = set(scanfix._wanted({"places": [places]})["gram"])
    assert all([w for w, _ in scanfix.plausible(t)].index(x) >= 8 for t, x in (("n0!", "nòi"), ("th0!", "thòi")))  # a pair is asked from both sides
    assert set(model) <= asked
    assert scanfix.decode(places, {g: n for g, n in model.items() if g in asked}, {}) == ["nòi", "thòi"]


def test_no_reading_is_cut_off(spark):
    """Every syllable that the chart makes of a token is proposed, against all ways through the chart."""
    for token in ("n0!", "1i!1n", "cl0rn", "th0!li", "|i0!"):
        ways = {""}
        todo = [("", 0)]
        words = set()
        while todo:
            word, i = todo.pop()
            if i == len(token):
                words.add(word)
                continue
            if token[i].isalpha():
                todo.append((word + token[i], i + 1))
            todo += [(word + r, i + n) for n in (1, 2) for r in scanfix.CONFUSIONS.get(token[i : i + n], "") if i + n <= len(token)]
        want = {w for w in words - {token} if scanfix.is_syllable(w.lower()) and len(w) > 1}
        assert {w for w, _ in scanfix.plausible(token)} == want and ways
    assert len(scanfix.plausible("n0!")) > 8


def test_foreign_words_of_any_length(spark):
    word = "internationalisation"
    token = word.replace("o", "0").replace("m", "rn")
    assert scanfix.foreign(token) and scanfix.skeleton(token) == scanfix.skeleton(word) and scanfix.channel(token, lambda c: -1.0, word) == (word, ("0>o", "0>o"))
    assert scanfix.channel("!" * 400 + "abcd", lambda c: -1.0)[0].endswith("abcd")
    lines, units = scan(spark)
    units = units.select(*[f.name for f in spark.createDataFrame([], UNITS).schema])
    units = units.unionByName(spark.createDataFrame([(400 + i, "c1", i, "paragraph", "", [], f"the {word} of law", 1, None, None) for i in range(5)] + [(90, "s", 9, "paragraph", "", [], f"the {token} of law", 1, None, True)], UNITS))
    assert ("units", 90, f"the {word} of law") in set(rows(scanfix.repaired_units(lines, units)))


def test_titles_of_any_length(spark):
    for title in ("Tập báo", "Quy định " * 60 + "hết"):
        lines = [(p * 10 + i, "s", p, i, t, 80.0, None, (i, 1), None) for p in (1, 2) for i, t in enumerate([f"{title} {p}", *PROSE])]
        got = set(rows(scanfix.scan_noise(spark.createDataFrame(lines, OCR), spark.createDataFrame([], UNITS))))
        assert {("ocr_lines", 10, "running_header"), ("ocr_lines", 20, "running_header")} == {x for x in got if x[2] == "running_header"}


def test_language_model_counts(spark):
    units = spark.createDataFrame([(1, "một hai một", None), (2, "hai một", True), (3, "má»™t", None), (4, None, None)], "unit_id long, text string, ocr boolean")
    assert dict(rows(scanfix.language_model(units))) == {"một": 2, "hai": 1, "một hai": 1, "hai một": 1}


# --- 4 -------------------------------------------------------------------------------------------


def brute_terms(data):
    seen, occurrences, records = set(), Counter(), defaultdict(set)
    docs = {d or "" for _, d, _ in data}
    for key, doc, text in data:
        if (key, doc) in seen and key is not None:
            continue
        seen.add((key, doc))
        for t in terms._TERM.findall((text or "").lower()):
            occurrences[t] += 1
            records[t].add(doc or "")
    mark = lambda t: "rare" if occurrences[t] < 3 or len(records[t]) == 1 else "common" if len(records[t]) > 0.25 * len(docs) else None
    return sorted(((t, occurrences[t], len(records[t]), mark(t)) for t in occurrences), key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_terms_against_brute_force(spark, partitions):
    r = random.Random(4)
    words = ["của", "Của", "Ðiều", unicodedata.normalize("NFD", "nghĩa"), "a1b", "x_y", "một", "hiếm" + "a", "©"]
    data = [(i, r.choice(["hot"] * 10 + [f"d{k}" for k in range(12)]), " ".join(r.choice(words) for _ in range(r.randrange(30)))) for i in range(400)]
    data += [data[0], data[0], (9000, None, "riêng lẻ"), (9001, "d1", None), (9002, "d2", ""), (None, "d3", "không khóa"), (None, "d3", "không khóa"), (9003, "d99", LONG)]
    df = clashing(spark.createDataFrame(data, "unit_id long, doc string, text string").repartition(partitions))
    assert sorted(rows(terms.term_statistics(df)), key=str) == brute_terms(data)


def test_terms_flush_and_empty(spark, monkeypatch):
    empty = spark.createDataFrame([], "unit_id long, doc string, text string")
    assert terms.term_statistics(empty).count() == 0
    import pyarrow as pa

    monkeypatch.setattr(terms, "HELD", 2)
    batch = pa.RecordBatch.from_pydict({"record": ["a", "a", "b", "c", "d"], "key": ["1", "2", "3", "4", "5"], "text": ["x y", "x z", "x", "y x", "z"]})
    total = Counter()
    for out in terms._last_seen(iter([batch.slice(0, 2), batch.slice(2)])):
        for t, shared, n, k in zip(*(c.to_pylist() for c in out.columns), strict=True):
            total[t, "n"] += n
            total[t, "k"] += k if shared is None else 1
    assert dict(total) == {("x", "n"): 4, ("x", "k"): 3, ("y", "n"): 2, ("y", "k"): 2, ("z", "n"): 2, ("z", "k"): 2}


# --- 5 -------------------------------------------------------------------------------------------


def test_look_alikes(spark):
    plain = "Bên bảo lãnh của người quản lý cấp cơ sở có quyền"
    cases = {
        1: (plain, False), 2: ("Bên bảo lãnh", True), 3: ("Ｂêｎ bảo lãnh", True), 4: (unicodedata.normalize("NFD", "Bên bảo"), True), 5: ("Bê​n", True), 6: ("сủа bên", True),
        7: ("(nguyên văn: решение по делу)", False), 8: ("άρθρο του κώδικα", False), 9: ("303 m² “trích dẫn” – • …", False), 10: ("für ähnliche Fälle", False), 11: ("má»™t pháº§n x", False), 12: ("", False), 13: ("со người", True), 14: ("ðịnh giá", True),
    }
    units = [(k, "d", t, None) for k, (t, _) in cases.items()] + [(90, "d", None, None), (None, "d", "a b", None), (2, "d", cases[2][0], None), (91, "d", plain + " co co", None), (92, "d", LONG + " ", None)]
    df = clashing(spark.createDataFrame(units, "unit_id long, doc string, text string, ocr boolean"))
    lines = clashing(spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "má»™t ")], "ocr_line_id long, text string"))
    got = set(rows(lookalike.found(df, lines)))
    assert got == {("units", k) for k, (_, y) in cases.items() if y} | {("units", 92), ("ocr_lines", 1), ("ocr_lines", 3)}
    texts = {(t, k): x for t, k, x in rows(lookalike.consistent(lookalike.texts(df.where("unit_id <> 92"), lines)))}
    assert texts["units", 2] == "Bên bảo lãnh" and texts["units", 3] == "Bên bảo lãnh" and texts["units", 4] == "Bên bảo" and texts["units", 5] == "Bên" and texts["units", 6] == "của bên"
    assert texts["units", 7] == cases[7][0] and texts["units", 9] == cases[9][0] and texts["units", 11].startswith("một phần") and texts["units", 14] == "định giá"


def test_capital_look_alikes(spark):
    cases = {
        1: ("Bên В", "Bên B"), 2: ("ТНЕ", "THE"), 3: ("КНО МАХ", "KHO MAX"), 4: ("ΝΟ", "NO"), 5: ("Υ", "Y"), 6: ("Веn", "Ben"),
        7: ("НЕТ", "НЕТ"), 8: ("решение КНО", "решение КНО"), 9: ("νο", "vo"),
    }
    data = [(k, t, None) for k, (t, _) in cases.items()] + [(50, "the kho max, bên b, no y: vo ben", None)]
    texts = lookalike.texts(spark.createDataFrame(data, "unit_id long, text string, ocr boolean"))
    assert {k for _, k in rows(lookalike.look_alikes(texts))} == {k for k, (t, x) in cases.items() if t != x}
    got = {k: x for _, k, x in rows(lookalike.consistent(texts))}
    assert {k: got[k] for k in cases} == {k: x for k, (_, x) in cases.items()}


def test_trie_automaton():
    trie = lookalike.Trie()
    for w, n in (("của", 5), ("cua", 9), ("cấp", 1)):
        trie.add(w, n)
    assert trie.walk("сủа") == "của" and trie.walk("с​ấр") == "cấp" and trie.walk("xyz") is None
    assert trie.walk("cux") is None and trie.walk("cux", budget=lookalike.EDIT) == "cua" and trie.walk("ca", budget=lookalike.EDIT) == "cua" and trie.walk("cuua", budget=lookalike.EDIT) == "cua"
    assert trie.walk("cυа") == "cua" and trie.walk("cμa") is None and trie.walk("cμa", budget=1) == "cua"


def brute_walk(words, word, budget):
    def cost(a, b):
        table = {(0, 0): 0}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                ways = [table[0, 0]] if i == j == 0 else []
                if i and j:
                    free = b[j - 1] in (a[i - 1].lower(), lookalike.LOOKALIKE.get(a[i - 1], a[i - 1]).lower())
                    ways.append(table[i - 1, j - 1] + (0 if free else lookalike.NEARLY if b[j - 1] in lookalike.NEAR.get(a[i - 1].lower(), "") else lookalike.EDIT))
                if i:
                    ways.append(table[i - 1, j] + (0 if a[i - 1] in lookalike.IGNORABLE else lookalike.EDIT))
                if j:
                    ways.append(table[i, j - 1] + lookalike.EDIT)
                table[i, j] = min(ways)
        return table[len(a), len(b)]

    found = [(c, -n, w) for w, n in words.items() if (c := cost(word, w)) <= budget]
    return min(found)[2] if found else None


def test_automaton_against_edit_distance():
    r = random.Random(8)
    words = {"".join(r.choice("abnhuvy") for _ in range(r.randint(1, 4))): r.randint(1, 9) for _ in range(40)}
    trie = lookalike.Trie()
    for w, n in words.items():
        trie.add(w, n)
    for _ in range(300):
        word, budget = "".join(r.choice("abnυνηаһ​А") for _ in range(r.randint(1, 4))), r.choice([0, 1, 2, 1000, 1001, 2000])
        assert trie.walk(word, budget) == brute_walk(words, word, budget), (word, budget)


def test_the_vocabulary_overrules_the_table(spark):
    """By the table υ is u; only the tries know that it stands for a v here, and that η is an n or an h."""
    cases = {1: ("υăn bản", "văn bản"), 2: ("υui", "vui"), 3: ("Lụậη", "Lụậη"), 4: ("luậη ηhà", "luận nhà"), 5: ("ηόmos 5μm", "ηόmos 5μm"), 6: ("tυần", "tuần")}
    data = [(k, t, None) for k, (t, _) in cases.items()] + [(50, "văn bản vui luận nhà tuần", None)]
    texts = lookalike.texts(spark.createDataFrame(data, "unit_id long, text string, ocr boolean"))
    got = {k: x for _, k, x in rows(lookalike.consistent(texts))}
    assert {k: got[k] for k in cases} == {k: x for k, (_, x) in cases.items()}
    assert {k for _, k in rows(lookalike.look_alikes(texts))} == {1, 2, 4, 6}


# --- 6 -------------------------------------------------------------------------------------------

SENTENCE = "Người quản lý di sản được quyền chấm dứt hợp đồng với nghĩa vụ cấp dưỡng, “trích dẫn” và ký."


def misread(text, chart, layers=1):
    back = {b: c for c, b in chart.items()}
    for _ in range(layers):
        text = "".join(back[b] for b in text.encode())
    return text


def test_round_trips():
    for chart in (encoding._CP1252, encoding._MAC):
        for layers in (1, 2):
            bad = misread(SENTENCE, chart, layers)
            assert encoding.repair(bad) == (SENTENCE, "utf8"), (bad, encoding.repair(bad))
    to_vni = {v: k for k, v in VNI_PAIRS.items() if k[1].islower() or k[0].isupper()}
    plain = "Người quản lý di sản được quyền chấm dứt nghĩa vụ cấp dưỡng."
    single = {"đ": "ñ", "Đ": "Ñ", "ư": "ö", "ơ": "ô", "ỉ": "æ", "ị": "ò", "ĩ": "ó"}
    single |= {"ươ": "öô"}
    vni = "".join(single.get(c) or (lambda p: single.get(p[0], p[0]) + p[1] if p else c)(to_vni.get(c)) for c in plain)
    assert encoding.repair(vni) == (plain, "vni")
    to_tcvn = {v: chr(k) for k, v in TCVN3.items()}
    assert encoding.repair("".join(to_tcvn.get(c, c) for c in plain)) == (plain, "tcvn3")


@pytest.mark.parametrize("chart", ["cp1252", "mac_roman", "cp1250", "cp1251", "cp437", "cp850"])
def test_every_chart_round_trips(chart):
    for text in ("Điều khoản về nghĩa vụ", "quyền sở hữu của người"):
        words = []
        for word in text.split(" "):
            try:
                words.append(word.encode("utf-8").decode(chart))
            except UnicodeDecodeError:
                words.append(word)
        garbled = " ".join(words)
        assert garbled != text and encoding.repair(garbled) == (text, "utf8")
    for plain in ("решение по делу о разводе", "Příliš žluťoučký kůň", "Zażółć gęślą jaźń", "für größere Fälle", "Ελληνική Δημοκρατία"):
        assert encoding.repair(plain) == (plain, "")


def test_clean_foreign_and_lost():
    for text in (SENTENCE, "für ähnliche Fälle", "el dueño señalado", "où est l'héritier? Le naïf", "Noël à Besançon", "Toà án", "решение по делу", "m² – • …", "Là ai? Ở đây", "một hai?\n- Ba", "", None):
        assert encoding.repair(text) == (text, ""), text
    for text in ("ngh�a vụ", "?i?u ki?n", "m?i c? quy?n"):
        assert encoding.repair(text) == (text, "lost")
    assert encoding.repair("từ v­ề nhà")[1] == "" and encoding.repair("€òn †ài ng¬\nười", True)[1] == ""
    assert encoding.repair("phần sau má»™t phần")[0] == "phần sau một phần"


def test_garbled_signs():
    for text in ("§123", "“100", "15°C.", "10€", "£100", "©2020", "½", "Acme™"):
        bad = misread(text, encoding._CP1252)
        assert encoding.repair(bad) == (text, "utf8") and encoding.repair(text) == (text, ""), text
    assert encoding.repair(misread("§123", encoding._CP1252), True)[1] == ""  # junk of scans


def test_encoding_table(spark):
    data = [(1, misread(SENTENCE, encoding._CP1252), None), (1, misread(SENTENCE, encoding._CP1252), None), (2, SENTENCE, None), (3, None, None), (4, "", True), (None, "má»™t", None), (5, LONG + " má»™t", None), (6, "x ngh�a", None)]
    df = clashing(spark.createDataFrame(data, "unit_id long, text string, ocr boolean"))
    assert sorted(rows(encoding.found(df))) == [(1,), (5,), (6,)]
    got = {k: (d, t) for k, d, t in rows(encoding.restore_encoding(df))}
    assert got[1] == ("utf8", SENTENCE) and got[5] == ("utf8", LONG + " một") and got[6] == ("lost", "x ngh�a")
    assert encoding.found(df.limit(0)).count() == 0


# --- 7 -------------------------------------------------------------------------------------------


def test_leaks(spark):
    r = random.Random(7)
    syllables = "người quản lý di sản được quyền chấm dứt hợp đồng với nghĩa vụ cấp dưỡng trong thời hạn theo mẫu bên bán giao nhận tài liệu đã ký trước khi tòa xét lại việc kiểm tra chứng cứ bản gốc".split()
    text = lambda n: [r.choice(syllables) + r.choice(["", "a", "o"]) for _ in range(n)]
    items = [(i, " ".join(text(60))) for i in range(20)] + [(50, "câu hỏi ngắn"), (51, None), (None, " ".join(text(60)))]
    docs, want = [], set()
    for d in range(60):
        words = text(80)
        kind, (item, passage) = d % 6, items[d % 20]
        own = passage.split()
        at = r.randrange(5, 25)
        if kind == 0:
            words[20:20] = own[at : at + 34]
            want.add((d, item))
        elif kind == 1:
            part = own[at : at + 35]
            for k in (4, 15, 26):
                part[k] = "thay"
            words[30:30] = [unicodedata.normalize("NFD", w).upper() + r.choice([",", "\n", ""]) for w in part]
            want.add((d, item))
        elif kind == 2:
            words[10:10] = own[at : at + 18]
        docs.append((d, " ".join(words)))
    docs += [(100, docs[0][1]), (0, docs[0][1]), (101, None), (102, ""), (103, LONG + " " + " ".join(items[3][1].split()[:40]) + " " + LONG), (None, items[0][1])]
    want |= {(100, 0), (103, 3)}
    got = rows(leakage.found(clashing(spark.createDataFrame(docs, "doc_id long, text string")), clashing(spark.createDataFrame(items, "item_id long, text string"))))
    assert sorted(got) == sorted(want)


def test_folded_as_words():
    r = random.Random(8)
    pool = ["Điều 5.", unicodedata.normalize("NFD", "nghĩa"), "ｗｉｄｅ", "сủа", " ", "\n", "—", "\U0001f600", "решение", "", "a​b", "x\uffffy", "!", "É", "²"]
    texts = [r.choice(["", " "]).join(r.choice(pool) for _ in range(r.randrange(9))) for _ in range(300)]
    data, begins = leakage.folded(texts)
    got = [data[a : b - 1].tobytes().decode() for a, b in zip(begins, begins[1:], strict=False)]
    assert got == [" ".join(leakage.words_of(t)) for t in texts]


def test_many_items_and_empty(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(300)], "item_id long, text string")
    docs = items.where("item_id < 8").select((F.col("item_id") + 100).alias("doc_id"), "text")
    assert sorted(rows(leakage.found(docs, items))) == [(i + 100, i) for i in range(8)]
    assert leakage.found(docs.limit(0), items).count() == 0 and leakage.found(docs, items.limit(0)).count() == 0


def test_bound_of_short_words(spark):
    """Words so short that grams of 18 characters prove nothing: shorter grams are taken, the bound is never raised."""
    r = random.Random(4)
    words = [r.choice("abcdefghijk") for _ in range(45)]
    assert leakage.bound(words, 18, 30, 0.1) < 1 <= leakage.bound(words, 10, 30, 0.1)
    part = words[5:37]
    for i in (7, 15, 23):
        part[i] = "z"
    docs = spark.createDataFrame([(1, "x y " + " ".join(part) + " x"), (2, " ".join(r.choice("abcdefghijk") for _ in range(60)))], "doc_id long, text string")
    assert rows(leakage.found(docs, spark.createDataFrame([(9, " ".join(words))], "item_id long, text string"))) == [(1, 9)]


def test_dense_against_brute_force():
    r = random.Random(6)
    for _ in range(50):
        at = np.array(sorted(r.sample(range(100), 30)))
        owner, width, least = at // 37, r.randint(1, 20), r.randint(1, 6)
        want = [any(a <= x < a + width and o == w and sum(a <= y < a + width and v == o for y, v in zip(at, owner, strict=True)) >= least for a, w in zip(at, owner, strict=True)) for x, o in zip(at, owner, strict=True)]
        assert leakage.dense(at, owner, width, least).tolist() == want


def test_documents_are_read_twice_whatever_the_items(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"một văn bản số {i}") for i in range(20)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    reads = set()
    for n in (5, 500):
        items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(n)], "item_id long, text string")
        plan = leakage.found(docs, items)._jdf.queryExecution().optimizedPlan().toString()
        reads.add(plan.count("Relation [doc_id"))
    assert reads == {2}


# --- 8 -------------------------------------------------------------------------------------------


def sources(spark):
    data = [(i, "w " * (5 + i % 7), "big" if i % 3 else "hot") for i in range(600)] + [(1000 + i, "w w w", "small") for i in range(5)] + [(2000, None, "small"), (2001, "w", None), (2002, "", "untold"), (1000, "w w w", "small")]
    targets = [("big", 0.3, 3), ("hot", 0.4, 2), ("small", 0.2, 4), ("none", 0.1, 2), (None, 0.1, 1)]
    return clashing(spark.createDataFrame(data, "doc_id long, text string, source string")), spark.createDataFrame(targets, "source string, weight double, max_repeat int")


def test_mix(spark):
    docs, targets = sources(spark)
    plan = {r["source"]: r for r in mixing.plan(mixing.sized(docs), targets).collect()}
    assert set(plan) == {"big", "hot", "small", "none"}
    assert {s for s, p in plan.items() if p["short"]} == {"small", "none"} == {s for (s,) in rows(mixing.found(docs, targets))}
    drawn = rows(mixing.mix(docs, targets), "doc_id", "source", "tokens", "copies")
    for s in ("big", "hot", "small"):
        each = [c for _, x, _, c in drawn if x == s]
        n = docs.where(F.col("source") == s).count()
        expected = plan[s]["copies"] * n
        assert abs(sum(each) - expected) < 1 + 1e-6 and max(each) <= plan[s]["max_repeat"] and max(each) - (min(each) if len(each) == n else 0) <= 1
    assert all(c == 4 for _, x, _, c in drawn if x == "small")
    assert sorted(drawn) == sorted(rows(mixing.mix(docs.repartition(9), targets), "doc_id", "source", "tokens", "copies"))
    shares = {r["source"]: r["actual"] for r in mixing.report(docs, targets).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["none"] == 0
    assert mixing.report(docs.limit(0), targets).where("short").count() == 0


# --- 9 -------------------------------------------------------------------------------------------


def test_segment_programme_against_all_sets():
    from itertools import combinations

    r = random.Random(3)
    for _ in range(60):
        spans = sorted({(s, s + r.randint(1, 5), r.choice("ab")) for s in (r.randrange(12) for _ in range(8))})
        scores = [r.uniform(-1, 2) for _ in spans]
        best = 0.0
        for k in range(len(spans) + 1):
            for pick in combinations(range(len(spans)), k):
                cut = sorted((spans[i][0], spans[i][1]) for i in pick)
                if all(a[1] <= b[0] for a, b in zip(cut, cut[1:], strict=False)):
                    best = max(best, sum(scores[i] for i in pick))
        got = pii.best_segments(spans, scores)
        assert abs(sum(scores[spans.index(x)] for x in got) - best) < 1e-9


def test_mentions(spark):
    text = "Nguyên đơn là ông Trần Văn An, ở số 12/4 ngõ 5 phố Hoa Lan, quận Cọ Mây, đã nộp đơn. ĐT: 0912 345 678\nEmail: a.b@c.example Hộ chiếu hoặc thẻ (C1234567). Mã vạch ấn phẩm 207190630590 bị mờ. Số tiền 122.079.000 đồng."
    down = unicodedata.normalize("NFD", text)
    data = [(1, text), (1, text), (2, down), (3, None), (4, ""), (None, text), (5, LONG + text)]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    got = defaultdict(set)
    for k, label, pos in rows(pii.found(df)):
        got[k].add((label, pos))
    want = {("person", text.index("Trần") + 1), ("address", text.index("12/4") + 1), ("phone", text.index("0912") + 1), ("email", text.index("a.b@") + 1), ("id_number", text.index("C1234567") + 1)}
    assert got[1] == want and set(got) == {1, 2, 5}
    assert got[2] == {(label, len(unicodedata.normalize("NFD", text[: pos - 1])) + 1) for label, pos in want}
    assert got[5] == {(label, pos + len(LONG)) for label, pos in want}
    clean = {k: t for k, t in rows(pii.redacted(df), "doc_id", "text")}
    assert "[PERSON], ở số [ADDRESS], đã" in clean[1] and "[PHONE]" in clean[1] and "[EMAIL]" in clean[1] and "([ID_NUMBER])" in clean[1] and clean[3] is None and clean[4] == ""
    assert pii.found(df.limit(0)).count() == 0
