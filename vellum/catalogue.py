"""Every query of the core, by name, with the SQL that gives the same rows.

Queries take whole tables. Deliveries of a row count once: lines and units are taken
by their id. The SQL uses explicit character classes, as the expressions do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import columns as C
from vellum.operators import anchor, health, lines, ranking, raster, recognition, repair, rules, sidecar, slides, structure
from vellum.sources import cache, discovery, names

FLAGSHIP = "q_document_units"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str, key: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return delivered_once(df, key) if key else df


def delivered_once(df: DataFrame, key: str, by: str = "doc") -> DataFrame:
    """Every row id of a document once, the smallest row in the order of the columns, whatever the partitioning.

    Rows are brought together by document, which what follows needs anyway, not by id.
    A row id stands in one document; null ids are taken as different rows.
    """
    rest = [c for c in df.columns if c not in (key, by)]
    apart = F.when(F.col(key).isNull(), F.struct(*rest))
    rows = df.repartition(by).groupBy(by, key, apart.alias("_apart")).agg(F.min(F.struct(*rest)).alias("_row"))
    return rows.select(key, by, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "doc_lines", "line_id")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "doc_pages")


def _units(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "units", "unit_id")


def _ocr(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "ocr_lines", "ocr_line_id")


def _sidecars(spark: SparkSession, d: str) -> DataFrame:
    """The first delivery of each sidecar."""
    rows = _t(spark, d, "sidecars")
    return rows.groupBy("doc").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "doc"]), "ingested_at").alias("r")).select("doc", "r.*")


# --- SQL pieces ------------------------------------------------------------------------------

WS = C.WS
STRIP = lambda c: f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"
SQUASH = lambda c: f"regexp_replace({STRIP(c)}, '{WS}+', ' ', 'g')"
MASKED = lambda c: rf"regexp_replace(lower({SQUASH(c)}), '\p{{Nd}}+', '#', 'g')"
HAS = lambda c, p: f"regexp_matches({c}, '{p}')"
STRUCTURAL = f"({HAS('text', rules.ARTICLE)} OR {HAS('text', rules.CHAPTER)})"
_LOW = f"lower({STRIP('text')})"
SIGNATURE = "(" + " OR ".join([*(f"starts_with({_LOW}, '{s}')" for s in rules.SIGNATURE_STARTS), HAS(STRIP("text"), rules.EMAIL_LINE), HAS(STRIP("text"), rules.EMAIL_CONTACT)]) + ")"
COVER = "(" + " OR ".join([*(f"contains({_LOW}, '{s}')" for s in rules.COVER_PARTS), *(HAS(_LOW, r) for r in rules.COVER_LINES)]) + ")"
MARGIN = f"coalesce(top < height * {rules.TOP} OR top > height * {rules.BOTTOM}, false)"

BOX = "bbox[1] AS x0, bbox[2] AS y0, bbox[3] AS x1, bbox[4] AS y1"


def _boxed(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.get("bbox", i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]).drop("bbox")


DOC_LINES = "l AS (SELECT * FROM doc_lines QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY doc) = 1)"
UNITS = "u AS (SELECT * FROM units QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY doc) = 1)"
OCR = "o AS (SELECT * FROM ocr_lines QUALIFY row_number() OVER (PARTITION BY ocr_line_id ORDER BY doc) = 1)"
SIDECARS = "s AS (SELECT * FROM sidecars QUALIFY row_number() OVER (PARTITION BY doc ORDER BY ingested_at) = 1)"
PLACED = lambda l: f"""{l}, h AS (SELECT doc, page, max(height) AS height FROM doc_pages GROUP BY doc, page),
p AS (SELECT l.*, h.height, l.bbox[2] AS top FROM l LEFT JOIN h USING (doc, page))"""
RUNNING = lambda l: f"""{PLACED(l)}, n AS (SELECT doc, count(DISTINCT page) AS pages FROM doc_pages GROUP BY doc),
k AS (SELECT doc, page, {MASKED('text')} AS key FROM p WHERE text IS NOT NULL AND {MARGIN} AND NOT {STRUCTURAL}),
r AS (SELECT doc, key, count(DISTINCT page) AS n_pages, any_value(pages) AS pages FROM k JOIN n USING (doc) WHERE key <> '' GROUP BY doc, key
  HAVING count(DISTINCT page) >= greatest(2, (any_value(pages) + 1) // 2))"""
KEPT = lambda l: f"""{RUNNING(l)}, m AS (SELECT p.*, {STRUCTURAL} AS structural, {MASKED('text')} AS key FROM p WHERE text IS NOT NULL),
w AS (SELECT *, max(structural::INT) OVER (PARTITION BY doc ORDER BY page, block_no, line_no, line_id ROWS UNBOUNDED PRECEDING) = 1 AS seen FROM m),
kept AS (SELECT w.* FROM w LEFT JOIN r USING (doc, key) WHERE structural OR NOT ({SIGNATURE} OR (page = 1 AND NOT seen AND {COVER}) OR ({MARGIN} AND r.key IS NOT NULL)))"""


def _legal(source: str) -> str:
    """Legal units out of a table of lines; c to g are the steps of R1."""
    none = "NULLIF(regexp_extract(t, '{}', 1), '')"
    order = "ORDER BY page, block_no, line_no, line_id"
    return f"""a AS (SELECT *, {STRIP('text')} AS t FROM {source}), b AS (SELECT *, {SQUASH(none.format(rules.CHAPTER))} AS ch FROM a WHERE t <> ''),
c AS (SELECT *, CASE WHEN ch IS NULL THEN {none.format(rules.ARTICLE)} END AS d FROM b),
e AS (SELECT *, CASE WHEN ch IS NULL AND d IS NULL THEN {none.format(rules.CLAUSE)} END AS k2,
  count(ch) OVER x AS part, last_value(ch IGNORE NULLS) OVER x AS chapter,
  last_value(ch IGNORE NULLS) OVER (PARTITION BY doc {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM c WINDOW x AS (PARTITION BY doc {order} ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, last_value(d IGNORE NULLS) OVER (PARTITION BY doc, part {order} ROWS UNBOUNDED PRECEDING) AS article FROM e),
g AS (SELECT *, CASE WHEN ch IS NOT NULL THEN 'heading' WHEN d IS NOT NULL THEN 'dieu' WHEN k2 IS NOT NULL AND article IS NOT NULL THEN 'khoan' WHEN article IS NULL THEN 'paragraph' END AS kind FROM f),
i AS (SELECT *, count(kind) OVER (PARTITION BY doc {order} ROWS UNBOUNDED PRECEDING) AS unit_no FROM g),
legal AS (SELECT doc, unit_no, first(kind {order}) AS type,
  first(CASE kind WHEN 'heading' THEN ch WHEN 'dieu' THEN 'Điều ' || d WHEN 'khoan' THEN 'Khoản ' || k2 ELSE '' END {order}) AS label,
  first(CASE kind WHEN 'heading' THEN coalesce(earlier, '') WHEN 'khoan' THEN concat_ws('|', chapter, 'Điều ' || article) ELSE coalesce(chapter, '') END {order}) AS path,
  string_agg(t, chr(10) {order}) AS text, first(page {order}) AS page, first(bbox {order}) AS bbox FROM i GROUP BY doc, unit_no)"""


def _document_units(lines: str) -> str:
    """CTEs up to `du`, the units of all documents out of a CTE `l` of lines."""
    return f"""{KEPT(lines)}, kinds AS (SELECT doc, bool_or({HAS(STRIP('text'), rules.ARTICLE)}) AS legal FROM kept GROUP BY doc),
src AS (SELECT kept.* FROM kept JOIN kinds USING (doc) WHERE legal), {_legal('src')},
q AS (SELECT doc, page, block_no, string_agg(text, chr(10) ORDER BY line_no, line_id) AS text, CASE WHEN count(bbox) > 0 THEN [min(bbox[1]), min(bbox[2]), max(bbox[3]), max(bbox[4])] END AS bbox FROM kept JOIN kinds USING (doc) WHERE NOT legal GROUP BY doc, page, block_no),
du AS (SELECT doc, unit_no, type, label, path, text, page, bbox FROM legal UNION ALL
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY page, block_no), 'paragraph', '', '', text, page, bbox FROM q)"""


# --- lines and structure ---------------------------------------------------------------------


@query(f"WITH {_document_units(DOC_LINES)} SELECT doc, unit_no, type, label, path, text, page, {BOX} FROM du")
def q_document_units(spark, d):
    units = structure.document_units(_lines(spark, d), _pages(spark, d))
    return _boxed(units.withColumn("path", F.array_join("path", "|")))


@query(f"WITH {RUNNING(DOC_LINES)} SELECT doc, key, n_pages FROM r")
def q_running_lines(spark, d):
    return lines.running_lines(_lines(spark, d), _pages(spark, d))


@query(f"WITH {KEPT(DOC_LINES)} SELECT line_id FROM kept")
def q_kept_lines(spark, d):
    return lines.kept_lines(_lines(spark, d), _pages(spark, d)).select("line_id")


@query(f"WITH {DOC_LINES}, src AS (SELECT * FROM l), {_legal('src')} SELECT doc, unit_no, type, label, path, text, page, {BOX} FROM legal")
def q_legal_units(spark, d):
    return _boxed(structure.legal_units(_lines(spark, d)).withColumn("path", F.array_join("path", "|")))


@query(f"WITH {DOC_LINES} SELECT doc, CASE WHEN bool_or({HAS(STRIP('text'), rules.ARTICLE)}) THEN 'legal' ELSE 'prose' END AS kind FROM l GROUP BY doc")
def q_document_kinds(spark, d):
    return structure.document_kinds(_lines(spark, d))


@query(f"""WITH l AS (SELECT DISTINCT doc_id, i, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))
SELECT doc_id, i AS line_no, text FROM l WHERE {SIGNATURE} OR {COVER}""")
def q_stamp_lines(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    return rows.where(lines.is_signature(F.col("text")) | lines.is_cover(F.col("text"))).select("doc_id", (F.col("i") + 1).alias("line_no"), "text").distinct()


@query(f"""WITH {DOC_LINES} SELECT doc, page, block_no, string_agg(text, chr(10) ORDER BY line_no, line_id) AS text,
min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1 FROM l WHERE text IS NOT NULL GROUP BY doc, page, block_no""")
def q_block_paragraphs(spark, d):
    return lines.block_paragraphs(_lines(spark, d))


@query(f"""WITH {DOC_LINES}, t AS (SELECT doc, line_no, line_id, {STRIP('text')} AS text FROM l WHERE page = 0)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY line_no, line_id) AS unit_no, CASE WHEN h THEN 'heading' ELSE 'paragraph' END AS type, CASE WHEN h THEN text ELSE '' END AS label, text
FROM (SELECT *, length(text) <= 60 AND NOT regexp_matches(text, '[.?!:]$') AS h FROM t WHERE text <> '')""")
def q_text_units(spark, d):
    return structure.text_units(_lines(spark, d).where("page = 0"))


@query(f"""SELECT DISTINCT doc, page, 'Trang ' || page AS label, '{rules.MARKER} (trang ' || page || ')' AS text, width AS x1, height AS y1
FROM doc_pages WHERE doc NOT IN (SELECT doc FROM doc_lines WHERE text IS NOT NULL)""")
def q_marker_units(spark, d):
    return structure.marker_units(_pages(spark, d), _lines(spark, d))


@query(f"""WITH {UNITS}, {DOC_LINES}, p AS (SELECT doc, page, lower({SQUASH("string_agg(text, chr(10) ORDER BY line_no, line_id)")}) AS page_text FROM l WHERE text IS NOT NULL GROUP BY doc, page),
w AS (SELECT doc, unit_id, unit_no, substring(lower({SQUASH('text')}), 1, 40) AS start FROM u),
z AS (SELECT w.doc, w.unit_no, list_sort(list(DISTINCT page) FILTER (page IS NOT NULL)) AS hits FROM w LEFT JOIN p ON w.doc = p.doc AND start <> '' AND contains(page_text, start) GROUP BY w.doc, w.unit_no),
v AS (SELECT doc, list(unit_no ORDER BY unit_no) AS nos, list(hits ORDER BY unit_no) AS hs FROM z GROUP BY doc),
f AS (SELECT doc, nos, list_reduce(list_transform(hs, lambda h: [struct_pack(h := coalesce(h, []), o := []::INT[])]), lambda acc, x:
  [struct_pack(h := acc[1].h, o := list_append(acc[1].o, coalesce(list_filter(x[1].h, lambda q: q >= coalesce(acc[1].o[-1], 1))[1], acc[1].o[-1], 1)))], [struct_pack(h := []::INT[], o := []::INT[])]) AS r FROM v)
SELECT doc, unnest(nos) AS unit_no, unnest(r[1].o) AS page FROM f""")
def q_page_anchors(spark, d):
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line_id", "text"))), lambda x: x["text"])
    pages = _lines(spark, d).where("text is not null").groupBy("doc", "page").agg(F.array_join(ordered, "\n").alias("text"))
    return anchor.anchored(_units(spark, d), pages)


# --- slides and repair -----------------------------------------------------------------------


@query(f"""WITH {UNITS}, {SIDECARS}, g AS (SELECT doc, bool_and(type = 'paragraph' AND coalesce(label, '') = '') AS plain, bool_or(bbox IS NOT NULL) AS boxed FROM u GROUP BY doc)
SELECT s.doc FROM s JOIN g USING (doc) WHERE sourceformat = 'pptx' AND kind = 'prose' AND plain AND boxed""")
def q_degraded_slides(spark, d):
    return slides.degraded_slides(_sidecars(spark, d), _units(spark, d))


@query(f"""WITH {UNITS}, {SIDECARS}, j AS (SELECT u.*, s.pagecount FROM u JOIN s USING (doc) WHERE s.pagecount >= 1),
ok AS (SELECT doc FROM j GROUP BY doc HAVING bool_and(coalesce(page BETWEEN 1 AND pagecount, false)))
SELECT doc, page, 'Slide ' || page AS label, string_agg(text, chr(10) ORDER BY unit_no, unit_id) FILTER (regexp_matches(text, '\\S')) AS text,
min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1
FROM j JOIN ok USING (doc) GROUP BY doc, page HAVING count(*) FILTER (regexp_matches(text, '\\S')) > 0""")
def q_slide_units(spark, d):
    return slides.slide_units(_units(spark, d), _sidecars(spark, d).select("doc", "pagecount"))


@query(f"""WITH {UNITS} SELECT unit_id, {HAS('text', repair.VNI_LETTERS)} AS vni, {HAS('text', repair.UNICODE_LETTERS)} AS unicode FROM u WHERE {HAS('text', repair.EVIDENCE)}""")
def q_vni_evidence(spark, d):
    text = F.col("text")
    return _units(spark, d).where(repair.has_vni_evidence(text)).select("unit_id", repair.looks_vni(text).alias("vni"), repair.looks_unicode(text).alias("unicode"))


_PAIR_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in repair.VNI_PAIRS.items()) + "}"
EVIDENT, UNICODE, VNI = (lambda c, p=p: HAS(c, p) for p in (repair.EVIDENCE, repair.UNICODE_LETTERS, repair.VNI_LETTERS))


def _decoded(c: str, n: int) -> str:
    """A text decoded from VNI, with the pairs in pm.m; n keeps the names of nested lambdas apart."""
    return f"""list_reduce(string_split(translate({c}, 'ñÑöÖôÔæÆòÒóÓ', 'đĐưƯơƠỉỈịỊĩĨ'), ''), lambda a{n}, c{n}:
  CASE WHEN m[right(a{n}, 1) || c{n}] IS NOT NULL THEN left(a{n}, length(a{n}) - 1) || m[right(a{n}, 1) || c{n}] ELSE a{n} || c{n} END, '')"""


_BY_WORDS = f"array_to_string(list_transform(regexp_extract_all(ln, '(\\s+|\\S+)', 1), lambda w: CASE WHEN {EVIDENT('w')} OR {VNI('w')} THEN {_decoded('w', 3)} ELSE w END), '')"
_BY_LINES = f"array_to_string(list_transform(string_split(text, chr(10)), lambda ln: CASE WHEN NOT {EVIDENT('ln')} THEN ln WHEN NOT {UNICODE('ln')} THEN {_decoded('ln', 2)} ELSE {_BY_WORDS} END), chr(10))"
#: Units with `fixed`: the widest scope that is all VNI is decoded, and letters are composed; texts of scans stay.
REPAIRED = f"""{UNITS}, pm AS (SELECT {_PAIR_MAP} AS m), cv AS (SELECT u.*, {_decoded('text', 1)} AS whole, {_BY_LINES} AS parts FROM u, pm WHERE {EVIDENT('text')} AND NOT coalesce(ocr, false)),
fx AS (SELECT unit_id, doc, text, ocr, nfc_normalize(CASE WHEN {UNICODE('text')} THEN parts ELSE whole END) AS fixed FROM cv
  UNION ALL SELECT unit_id, doc, text, ocr, CASE WHEN coalesce(ocr, false) THEN text ELSE nfc_normalize(text) END FROM u WHERE coalesce(ocr, false) OR NOT {EVIDENT('text')} OR text IS NULL),
wc AS (SELECT *, NOT coalesce(ocr, false) AS own, {STRIP('fixed')} AS a, {STRIP('text')} AS b FROM fx),
rp AS (SELECT doc, count(*) FILTER (own AND fixed <> text) AS changed, count(*) FILTER (own AND {VNI('fixed')}) AS residue,
  bool_and(NOT own OR coalesce(a <> '' AND len(regexp_split_to_array(a, '{WS}+')) = len(regexp_split_to_array(b, '{WS}+')), false)) AS safe FROM wc GROUP BY doc)"""


@query(f"WITH {REPAIRED} SELECT unit_id, whole AS text FROM cv WHERE NOT {UNICODE('text')} AND nfc_normalize(text) = text UNION ALL SELECT unit_id, {_decoded('text', 1)} FROM u, pm WHERE ocr AND {EVIDENT('text')} AND NOT {UNICODE('text')} AND nfc_normalize(text) = text")
def q_vni_decoded(spark, d):
    text = F.col("text")
    rows = _units(spark, d).where(repair.has_vni_evidence(text) & ~repair.looks_unicode(text) & (C.nfc(text) == text))
    return rows.select("unit_id", repair.decode_vni(text).alias("text"))


@query(f"WITH {REPAIRED} SELECT unit_id, fixed AS text FROM fx WHERE {EVIDENT('text')} AND NOT coalesce(ocr, false)")
def q_vni_converted(spark, d):
    """Every unit with VNI in it, whole or in lines or words of it."""
    return repair.repaired(_units(spark, d).where(repair.has_vni_evidence(F.col("text")) & ~F.coalesce("ocr", F.lit(False)))).select("unit_id", F.col("fixed").alias("text"))


@query(f"WITH {UNITS} SELECT unit_id, nfc_normalize(text) AS text FROM u WHERE nfc_normalize(text) <> text")
def q_composed(spark, d):
    rows = _units(spark, d).where(F.col("text").rlike(r"[^\x00-\x7F]")).withColumn("fixed", C.nfc(F.col("text")))
    return rows.where("fixed <> text").select("unit_id", F.col("fixed").alias("text"))


@query(f"WITH {REPAIRED} SELECT doc, changed, residue, safe FROM rp")
def q_repair_report(spark, d):
    return repair.repair_report(_units(spark, d))


@query(f"WITH {REPAIRED} SELECT unit_id, CASE WHEN safe AND changed > 0 THEN fixed ELSE text END AS text FROM fx LEFT JOIN rp USING (doc)")
def q_repaired_units(spark, d):
    return repair.apply_repair(_units(spark, d)).select("unit_id", "text")


# --- recognition -----------------------------------------------------------------------------

WORDS = lambda c: rf"regexp_extract_all(lower({c}), '([\p{{L}}\p{{Nl}}\p{{No}}]+)', 1)"
LEXICON = f"""{UNITS}, lw AS (SELECT doc, unnest({WORDS('nfc_normalize(text)')}) AS word FROM u WHERE NOT coalesce(ocr, false) AND NOT starts_with(text, '{rules.MARKER}')),
lex AS (SELECT word, count(*) AS uses, count(DISTINCT doc) AS docs FROM lw WHERE length(word) <= {rules.WORD_LETTERS} GROUP BY word HAVING count(*) >= {rules.WORD_USES} AND count(DISTINCT doc) >= {rules.WORD_DOCS})"""
VERDICTS = f"""{LEXICON}, {OCR}, nb AS (SELECT *, translate(nfc_normalize(text), 'Ðð', 'Đđ') AS t FROM o WHERE {STRIP('text')} <> ''),
st AS (SELECT doc, page, sum(length(regexp_replace(t, '{WS}', '', 'g'))) AS chars, avg(conf) AS conf FROM nb GROUP BY doc, page),
tw AS (SELECT doc, page, unnest({WORDS('t')}) AS word FROM nb),
tk AS (SELECT doc, page, count(*) AS words, count(*) FILTER (lex.word IS NULL) AS unknown FROM tw LEFT JOIN lex USING (word) GROUP BY doc, page),
vd AS (SELECT st.doc, st.page, chars, conf, coalesce(words, 0) AS words, coalesce(unknown, 0) AS unknown,
  CASE WHEN chars < {rules.PAGE_CHARS} THEN 'too little text' WHEN coalesce(conf, 0) < {rules.PAGE_CONF} THEN 'low confidence' WHEN coalesce(words, 0) = 0 THEN 'no words'
  WHEN unknown / words > {rules.PAGE_UNKNOWN} THEN 'unrecognised words' ELSE '' END AS reason FROM st LEFT JOIN tk USING (doc, page))"""


@query(f"WITH {LEXICON} SELECT * FROM lex")
def q_lexicon(spark, d):
    return recognition.lexicon(_units(spark, d))


@query(f"WITH {VERDICTS} SELECT doc, page, chars, round(conf, 6) AS conf, words, unknown, reason FROM vd")
def q_page_verdicts(spark, d):
    # the last digits of a mean depend on the order of its sum
    return recognition.page_verdicts(_ocr(spark, d), recognition.lexicon(_units(spark, d))).withColumn("conf", F.round("conf", 6))


@query(f"""WITH {OCR}, x AS (SELECT doc, page, median((bbox[4] - bbox[2]) * 200 / 72) FILTER (length(text) > 15) AS pixels FROM o GROUP BY doc, page)
SELECT doc, page, round(pixels, 4) AS pixels, coalesce(pixels < 30, false) AS again FROM x""")
def q_line_heights(spark, d):
    return recognition.line_heights(_ocr(spark, d)).withColumn("pixels", F.round("pixels", 4))


@query("""SELECT l_orderkey, string_agg(l_returnflag || l_linenumber, ' ' ORDER BY l_linenumber, l_returnflag || l_linenumber) AS text, round(min(l_quantity * 0.36), 2) AS x0, round(min(l_linenumber * 0.36::DOUBLE), 2) AS y0,
round(max((l_quantity + 10) * 0.36), 2) AS x1, round(max((l_linenumber + 20) * 0.36::DOUBLE), 2) AS y1, round(avg(l_tax * 100), 2) AS conf FROM lineitem GROUP BY l_orderkey""")
def q_lines_of_words(spark, d):
    words = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("text"), F.col("l_quantity").alias("left"), F.col("l_linenumber").alias("top"), F.lit(10).alias("width"), F.lit(20).alias("height"), (F.col("l_tax") * 100).alias("conf"))
    return recognition.lines_of_words(words, ("l_orderkey",), "l_linenumber")


_SCAN_LINES = f"""{VERDICTS}, l AS (SELECT doc, page, min(line_no) OVER (PARTITION BY doc, page, block) AS block_no, line_no, ocr_line_id AS line_id, t AS text, bbox FROM nb JOIN vd USING (doc, page) WHERE reason = '')"""


@query(f"""WITH {_document_units(_SCAN_LINES)},
mk AS (SELECT doc, page, 'paragraph' AS type, 'Trang ' || page AS label, '' AS path, '{rules.MARKER} (trang ' || page || ')' AS text, CASE WHEN max(width) IS NOT NULL AND max(height) IS NOT NULL THEN [0.0::DOUBLE, 0.0::DOUBLE, max(width), max(height)] END AS bbox
  FROM doc_pages WHERE doc IN (SELECT doc FROM o) AND (doc, page) NOT IN (SELECT (doc, page) FROM vd WHERE reason = '') GROUP BY doc, page),
al AS (SELECT doc, page, 0 AS ord, unit_no AS seq, type, label, path, text, bbox, true AS ocr FROM du UNION ALL SELECT doc, page, 1, 0, type, label, path, text, bbox, NULL::BOOLEAN FROM mk)
SELECT doc, CASE WHEN bool_or(type = 'dieu') OVER (PARTITION BY doc) THEN 'legal' ELSE 'prose' END AS kind, row_number() OVER (PARTITION BY doc ORDER BY page, ord, seq) AS unit_no, type, label, path, text, page, {BOX}, ocr FROM al""")
def q_scan_units(spark, d):
    units = recognition.scan_units(_ocr(spark, d), recognition.lexicon(_units(spark, d)), _pages(spark, d))
    return _boxed(units.withColumn("path", F.array_join("path", "|")))


@query("SELECT doc, page, ocr_line_id, ocr_at FROM ocr_lines QUALIFY row_number() OVER (PARTITION BY doc, page ORDER BY ocr_at DESC, ocr_line_id DESC) = 1")
def q_latest_pages(spark, d):
    return recognition.latest_pages(_t(spark, d, "ocr_lines"), order=("ocr_at", "ocr_line_id")).select("doc", "page", "ocr_line_id", "ocr_at")


# --- sidecars --------------------------------------------------------------------------------


@query(f"""WITH {UNITS}, {SIDECARS}, j AS (SELECT doc, unit_no, '{{' || concat_ws(',', '"type":' || to_json(type), '"label":' || to_json(coalesce(label, '')), '"path":' || to_json(path), '"text":' || to_json(text), '"page":' || page,
  CASE WHEN len(bbox) = 4 THEN '"bbox":' || to_json(bbox) END, CASE WHEN ocr THEN '"ocr":true' END) || '}}' AS unit FROM u),
g AS (SELECT doc, string_agg(unit, ',' ORDER BY unit_no) AS units FROM j GROUP BY doc)
SELECT doc, '{{' || concat_ws(',', '"schemaVersion":' || schemaversion, '"title":' || to_json(coalesce(title, '')), '"source":' || to_json(source), '"addedAt":' || to_json(addedat), '"sourceFormat":' || to_json(sourceformat), '"pageCount":' || pagecount, '"kind":' || to_json(kind), '"units":[' || units || ']') || '}}' AS json
FROM s JOIN g USING (doc)""")
def q_sidecar_json(spark, d):
    return sidecar.sidecar_json(_sidecars(spark, d), _units(spark, d))


@query(f"""WITH {UNITS}, {SIDECARS}, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY unit_no, unit_id) - 1 AS i FROM u),
e AS (SELECT doc, string_agg('units[' || i || '] text must not be empty', ';' ORDER BY i) AS m FROM n WHERE text = '' GROUP BY doc)
SELECT s.doc, coalesce(concat_ws(';', CASE WHEN pagecount < 1 THEN 'pageCount must be >= 1' END, e.m), '') AS errors FROM s LEFT JOIN e USING (doc) WHERE doc IN (SELECT doc FROM u)""")
def q_validation(spark, d):
    checked = sidecar.validation_errors(sidecar.sidecar_json(_sidecars(spark, d), _units(spark, d)))
    return checked.select("doc", F.array_join("errors", ";").alias("errors"))


@query(f"""WITH {SIDECARS}, b AS (SELECT doc, CASE WHEN subject IS NULL THEN title || '.pdf' ELSE '[' || replace(subject, '/', '][') || '] ' || title || '.pdf' END AS name FROM s WHERE title IS NOT NULL),
c AS (SELECT *, regexp_extract(name, '^((?:\\[[^\\]]*\\]\\s*)+)(.+)$', 1) AS blob, {STRIP("regexp_extract(name, '^((?:\\[[^\\]]*\\]\\s*)+)(.+)$', 2)")} AS rest FROM b),
e AS (SELECT *, list_transform(regexp_extract_all(blob, '\\[([^\\]]*)\\]', 1), lambda x: trim(x)) AS parts FROM c)
SELECT doc, CASE WHEN blob = '' OR len(list_filter(parts, lambda x: x = '' OR x IN ('.', '..') OR contains(x, '/') OR contains(x, chr(92)) OR starts_with(x, '_'))) > 0 OR (parts[1] = '{rules.UNCLASSIFIED}' AND len(parts) > 1)
  THEN '{rules.UNCLASSIFIED}' ELSE array_to_string(parts, '/') END AS subject, CASE WHEN blob = '' THEN name ELSE rest END AS clean_name, CASE WHEN blob = '' THEN 'watch' ELSE 'share' END AS source FROM e""")
def q_destinations(spark, d):
    rows = _sidecars(spark, d).where("title is not null")
    name = F.when(F.col("subject").isNull(), F.concat("title", F.lit(".pdf"))).otherwise(F.concat(F.lit("["), F.replace("subject", F.lit("/"), F.lit("][")), F.lit("] "), "title", F.lit(".pdf")))
    return rows.select("doc", names.destination(name).alias("x")).select("doc", "x.*")


@query(f"""WITH {SIDECARS}, f AS (SELECT doc, regexp_extract(rel_path, '[^/]*$') || CASE hash % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx.tmp' WHEN 2 THEN '.pptx.TMP.tmp' WHEN 3 THEN '.crdownload' ELSE '.png' END AS name FROM (SELECT *, length(rel_path) AS hash FROM s)),
g AS (SELECT *, regexp_replace(name, '(?i)(\\.tmp)+$', '') AS bare FROM f),
k AS (SELECT *, lower(regexp_extract(name, '.(\\.[^./]*)$', 1)) AS x, lower(regexp_extract(bare, '.(\\.[^./]*)$', 1)) AS y FROM g)
SELECT doc, name, NOT starts_with(name, '.') AND NOT contains(lower(name), '.syncthing.') AND x IN ('{"','".join((*rules.DOCUMENTS, *rules.IMAGES))}') AS accepted,
CASE WHEN bare <> name AND NOT starts_with(bare, '.') AND NOT contains(lower(bare), '.syncthing.') AND y IN ('{"','".join((*rules.DOCUMENTS, *rules.IMAGES))}') THEN bare END AS repaired FROM k""")
def q_name_gates(spark, d):
    ends = F.element_at(F.array(*map(F.lit, (".PDF", ".docx.tmp", ".pptx.TMP.tmp", ".crdownload", ".png"))), F.length("rel_path") % 5 + 1)
    rows = _sidecars(spark, d).select("doc", F.concat(F.regexp_extract("rel_path", "[^/]*$", 0), ends).alias("name"))
    return rows.select("doc", "name", names.is_candidate(F.col("name")).alias("accepted"), names.without_tmp(F.col("name")).alias("repaired"))


@query("""WITH e AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 5), a AS (SELECT p_brand, p_partkey, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS r FROM part WHERE p_size > 5)
SELECT a.p_brand AS subject, p_partkey AS seq, a.p_type AS base, CASE WHEN r - 1 + (e.p_type IS NOT NULL)::INT = 0 THEN a.p_type ELSE a.p_type || ' (' || (r - 1 + (e.p_type IS NOT NULL)::INT) || ')' END AS stem
FROM a LEFT JOIN e ON a.p_brand = e.p_brand AND a.p_type = e.p_type""")
def q_free_names(spark, d):
    part = _t(spark, d, "part")
    new = part.where("p_size > 5").select(F.col("p_brand").alias("subject"), F.col("p_partkey").alias("seq"), F.concat("p_type", F.lit(".pdf")).alias("name"))
    return names.free_stems(new, part.where("p_size <= 5").select(F.col("p_brand").alias("subject"), F.col("p_type").alias("stem")).distinct())


@query(f"""WITH {SIDECARS} SELECT doc, substr(sha1(rel_path), 1, 16) AS doc_id, CASE WHEN subject IS NULL THEN 0 ELSE len(list_filter(string_split(subject, '/'), lambda x: x <> '')) END AS depth,
CASE lower(regexp_extract(rel_path, '.(\\.[^./]*)$', 1)) WHEN '.pdf' THEN 'pdf' ELSE NULL END AS format FROM s""")
def q_document_ids(spark, d):
    rows = _sidecars(spark, d)
    depth = F.when(F.col("subject").isNull(), 0).otherwise(F.size(names.subject_folders(F.col("subject"))))
    return rows.select("doc", names.document_id(F.col("rel_path")).alias("doc_id"), depth.alias("depth"), names.source_format(F.col("rel_path")).alias("format"))


# --- discovery and runtime -------------------------------------------------------------------

_FILES = """fl AS (SELECT rel_path FROM s UNION SELECT regexp_replace(rel_path, '\\.json$', '.pdf') FROM s WHERE pagecount > 1 UNION SELECT '_inbox/' || doc || '.json' FROM s WHERE kind = 'slide'
UNION SELECT 'kho/.stversions/' || doc || '.json' FROM s WHERE kind = 'prose' UNION SELECT '_mon.json')"""


def _files(spark, d) -> DataFrame:
    s = _sidecars(spark, d)
    parts = [
        s.select("rel_path"),
        s.where("pagecount > 1").select(F.regexp_replace("rel_path", r"\.json$", ".pdf")),
        s.where("kind = 'slide'").select(F.concat(F.lit("_inbox/"), "doc", F.lit(".json"))),
        s.where("kind = 'prose'").select(F.concat(F.lit("kho/.stversions/"), "doc", F.lit(".json"))),
        spark.range(1).select(F.lit("_mon.json")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


_FOLDERS = "string_split(rel_path, '/')[:-2]"


@query(f"""WITH {SIDECARS}, {_FILES}, j AS (SELECT rel_path, {_FOLDERS} AS f, string_split(rel_path, '/')[-1] AS name, rel_path IN (SELECT regexp_replace(rel_path, '\\.pdf$', '.json') FROM fl WHERE rel_path LIKE '%.pdf') AS pair FROM fl WHERE rel_path LIKE '%.json')
SELECT 'repair' AS policy, rel_path FROM j WHERE pair AND NOT list_has_any(f, ['.stversions', '.stfolder', '_inbox', '_print'])
UNION ALL SELECT 'ocr', rel_path FROM j WHERE NOT regexp_matches(coalesce(f[1], ''), '^[_.]') AND NOT starts_with(name, '_')
UNION ALL SELECT 'validate', rel_path FROM j WHERE pair AND len(list_filter(f, lambda x: starts_with(x, '.st'))) = 0 AND coalesce(f[-1], '') NOT IN ('_inbox', '_print') AND NOT starts_with(name, '_')""")
def q_discovery(spark, d):
    files = _files(spark, d)
    out = None
    for policy in ("repair", "ocr", "validate"):
        part = discovery.sidecar_paths(files, policy).select(F.lit(policy).alias("policy"), "rel_path")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {UNITS} SELECT doc, bool_or(starts_with(text, '{rules.MARKER}')) AS marker, bool_or(NOT starts_with(text, '{rules.MARKER}') AND NOT coalesce(ocr, false)) AS foreign FROM u GROUP BY doc""")
def q_inspection(spark, d):
    return discovery.inspected(_units(spark, d))


@query("""SELECT DISTINCT o_orderkey FROM (SELECT o_orderkey, o_totalprice, o_custkey FROM orders) f LEFT JOIN (SELECT o_orderkey AS k, o_totalprice AS a, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 END AS b FROM orders WHERE o_orderstatus <> 'P') i ON f.o_orderkey = i.k
WHERE i.k IS NULL OR a <> o_totalprice OR b <> o_custkey""")
def q_incremental(spark, d):
    o = _t(spark, d, "orders")
    files = o.select(F.col("o_orderkey").alias("rel_path"), F.col("o_totalprice").alias("size"), F.col("o_custkey").alias("mtime"))
    index = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("rel_path"), F.col("o_totalprice").alias("size"), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-1).alias("mtime"))
    return discovery.due(files, index).select(F.col("rel_path").alias("o_orderkey")).distinct()


_PROGRESS = """en AS (SELECT user_id AS key, (event_id % 50)::INT AS page, (event_id % 61)::INT AS total, epoch_us(ts) AS last_read FROM events WHERE event_type <> 'error'),
tb AS (SELECT user_id AS key, max(epoch_us(ts)) - 86400000000 AS ts FROM events WHERE event_type = 'error' GROUP BY user_id),
pr AS (SELECT key, max(CASE WHEN total > 0 THEN page / total ELSE 0 END) AS fraction, max(last_read) AS last_read FROM en LEFT JOIN tb USING (key) WHERE tb.ts IS NULL OR last_read > tb.ts GROUP BY key)"""


def _progress(spark, d) -> DataFrame:
    e = _t(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    entries = e.where("event_type <> 'error'").select(F.col("user_id").alias("key"), (F.col("event_id") % 50).cast("int").alias("page"), (F.col("event_id") % 61).cast("int").alias("total"), F.col("us").alias("last_read"))
    stones = e.where("event_type = 'error'").select(F.col("user_id").alias("key"), (F.col("us") - 86400000000).alias("ts"))
    return discovery.reading_progress(entries, stones)


@query(f"WITH {_PROGRESS} SELECT key, round(fraction, 6) AS fraction, last_read FROM pr")
def q_reading_progress(spark, d):
    return _progress(spark, d).withColumn("fraction", F.round("fraction", 6))


@query(f"""WITH {_PROGRESS}, c AS (SELECT c_custkey AS rel, c_nationkey + 1 AS pages FROM customer)
SELECT rel, pages, row_number() OVER (ORDER BY (fraction IS NOT NULL)::INT DESC, fraction DESC NULLS LAST, last_read DESC NULLS LAST, CASE WHEN fraction IS NULL THEN pages END NULLS FIRST, rel) AS rank FROM c LEFT JOIN pr ON rel = key""")
def q_priority(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("rel"), (F.col("c_nationkey") + 1).alias("pages"))
    return discovery.prioritised(c, _progress(spark, d)).select("rel", "pages", "rank")


@query(f"""WITH {SIDECARS}, p AS (SELECT doc, unnest(generate_series(1, pagecount)) AS page FROM s WHERE pagecount >= 1) SELECT doc, page FROM p WHERE (doc, page) NOT IN (SELECT (doc, page) FROM ocr_lines)""")
def q_missing_pages(spark, d):
    return discovery.missing_pages(_sidecars(spark, d), _t(spark, d, "ocr_lines"))


@query("SELECT DISTINCT doc, page FROM ocr_lines WHERE doc NOT IN (SELECT doc FROM sidecars WHERE kind = 'legal')")
def q_orphans(spark, d):
    live = _t(spark, d, "sidecars").where("kind = 'legal'").select("doc").distinct()
    return discovery.orphans(_t(spark, d, "ocr_lines").select("doc", "page").distinct(), live)


@query("""SELECT coalesce(a.k, b.k) AS s_suppkey, CASE WHEN b.k IS NULL THEN 'copy' WHEN a.k IS NULL THEN 'delete' ELSE 'copy' END AS action
FROM (SELECT s_suppkey AS k, s_nationkey AS n, s_acctbal AS v FROM supplier WHERE s_nationkey < 15) a FULL JOIN (SELECT s_suppkey AS k, s_nationkey AS n, CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0 END AS v FROM supplier WHERE s_nationkey >= 8) b ON a.k = b.k
WHERE a.k IS NULL OR b.k IS NULL OR a.n <> b.n OR a.v <> b.v""")
def q_mirror_diff(spark, d):
    s = _t(spark, d, "supplier")
    a = s.where("s_nationkey < 15").select("s_suppkey", F.col("s_nationkey").alias("size"), F.col("s_acctbal").alias("mtime"))
    b = s.where("s_nationkey >= 8").select("s_suppkey", F.col("s_nationkey").alias("size"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).otherwise(0.0).alias("mtime"))
    return discovery.mirror_diff(a, b, "s_suppkey")


@query("SELECT name FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS name FROM orders) QUALIFY row_number() OVER (ORDER BY name DESC) > 4")
def q_expired_snapshots(spark, d):
    return discovery.expired_snapshots(_t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("name")).distinct())


# --- health ----------------------------------------------------------------------------------


def _runs(spark, d) -> DataFrame:
    e = _t(spark, d, "events")
    return e.select(F.col("user_id").alias("task"), F.col("event_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))


_RUNS = "ru AS (SELECT user_id AS task, event_id AS run_id, ts, event_type <> 'error' AS ok FROM events)"


@query(f"""WITH {_RUNS}, x AS (SELECT *, coalesce(count(*) FILTER (ok) OVER (PARTITION BY task ORDER BY ts, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS streak FROM ru)
SELECT task, min(ts) FILTER (NOT ok) AS first_fail, max(ts) FILTER (NOT ok) AS last_fail, count(*) FILTER (NOT ok) AS fails, max(ts) FILTER (ok) AS recovered FROM x GROUP BY task, streak HAVING count(*) FILTER (NOT ok) > 0""")
def q_failure_streaks(spark, d):
    return health.streaks(_runs(spark, d)).select("task", F.col("first_fail").cast("timestamp_ntz").alias("first_fail"), F.col("last_fail").cast("timestamp_ntz").alias("last_fail"), "fails", F.col("recovered").cast("timestamp_ntz").alias("recovered"))


@query(f"""WITH {_RUNS}, x AS (SELECT task, lag(ts) OVER (PARTITION BY task ORDER BY ts, run_id) AS start, ts AS "end" FROM ru), y AS (SELECT *, datesub('minute', start, "end") AS minutes FROM x)
SELECT task, start, "end", minutes, CASE WHEN minutes >= 1440 THEN (minutes // 1440) || ' ngày ' || (minutes // 60 % 24) || ' giờ' WHEN minutes >= 60 THEN (minutes // 60 % 24) || ' giờ ' || (minutes % 60) || ' phút' ELSE minutes || ' phút' END AS duration FROM y WHERE minutes >= 720""")
def q_downtimes(spark, d):
    out = health.downtimes(_runs(spark, d), 720)
    return out.select("task", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "minutes", health.duration_text(F.col("minutes")).alias("duration"))


ALERTS = f"""{_RUNS}, x AS (SELECT *, coalesce(count(*) FILTER (ok) OVER (PARTITION BY task ORDER BY ts, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS streak FROM ru),
y AS (SELECT task, min(ts) FILTER (NOT ok) AS a, max(ts) FILTER (ok) AS b, list(ts ORDER BY ts, run_id) FILTER (NOT ok) AS fails FROM x GROUP BY task, streak HAVING count(*) FILTER (NOT ok) > 0),
z AS (SELECT task, a, b, list_reduce(list_transform(fails, lambda t: [t]), lambda sent, t: CASE WHEN len(sent) = 0 AND t[1] >= a + INTERVAL 120 MINUTE OR len(sent) > 0 AND t[1] >= sent[-1] + INTERVAL 24 HOUR THEN list_append(sent, t[1]) ELSE sent END, []::TIMESTAMP[]) AS sent FROM y),
al AS (SELECT task, unnest(sent) AS ts, 'failing' AS kind FROM z UNION ALL SELECT task, b, CASE WHEN len(sent) > 0 THEN 'recovered' ELSE 'recovered_unreported' END FROM z WHERE b IS NOT NULL AND (len(sent) > 0 OR b >= a + INTERVAL 120 MINUTE))"""


@query(f"WITH {ALERTS} SELECT task, ts, kind FROM al")
def q_health_alerts(spark, d):
    return health.alerts(_runs(spark, d), 120, 24).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_RULES = [(1, "ERR|signup.*[02468]$", "sign-up with an even number"), (2, "click|VIEW", "seen"), (3, "purchase", "bought")]


@query("""WITH x AS (SELECT event_id, event_type || ' ' || event_id AS detail FROM events) SELECT event_id, CASE WHEN regexp_matches(detail, '(?i)ERR|signup.*[02468]$') THEN 'sign-up with an even number' WHEN regexp_matches(detail, '(?i)click|VIEW') THEN 'seen' WHEN regexp_matches(detail, '(?i)purchase') THEN 'bought' END AS reason FROM x""")
def q_error_reasons(spark, d):
    rows = _t(spark, d, "events").select("event_id", F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("detail"))
    return health.explained(rows, spark.createDataFrame(_RULES, "ord int, match string, reason string")).select("event_id", "reason")


@query(f"""WITH {SIDECARS}, c AS (SELECT doc, pagecount, row_number() OVER (ORDER BY pagecount, doc) AS rank, pagecount * 0.67 AS seconds FROM s WHERE pagecount >= 1),
x AS (SELECT *, coalesce(sum(seconds) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2 AS start FROM c) SELECT doc, rank FROM x WHERE start < 75""")
def q_admitted(spark, d):
    s = _sidecars(spark, d).where("pagecount >= 1").select("doc", "pagecount")
    rows = ranking.ranked(s, [F.col("pagecount"), F.col("doc")]).withColumn("seconds", F.col("pagecount") * 0.67)
    return health.admitted(rows, 120, 2).select("doc", "rank")


@query("""SELECT doc, max(CASE WHEN page * 400 / (width / 72) > 200 THEN 1 ELSE 0 END) = 1 AS heavy, min(greatest(1, least(150, coalesce(page * 400 / (width / 72), 150)))::DOUBLE // 1)::INT AS dpi FROM doc_pages GROUP BY doc""")
def q_heavy_scans(spark, d):
    images = _pages(spark, d).select("doc", "page", (F.col("page") * 400).alias("px_w"), F.col("width").alias("page_w"), F.lit("DCT").alias("filter"))
    return raster.heavy_documents(images).join(raster.render_dpi(images).groupBy("doc").agg(F.min("dpi").alias("dpi")), "doc")


@query(f"""WITH {SIDECARS} SELECT doc, sha256(rel_path || coalesce(title, '')) AS digest FROM s""")
def q_content_hashes(spark, d):
    rows = _sidecars(spark, d)
    return rows.select("doc", F.sha2(F.concat("rel_path", F.coalesce("title", F.lit(""))).cast("binary"), 256).alias("digest"))


@query(f"""WITH {_RUNS}, x AS (SELECT *, coalesce(count(*) FILTER (ok) OVER (PARTITION BY task ORDER BY ts, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS streak FROM ru),
y AS (SELECT task, min(ts) FILTER (NOT ok) AS a, max(ts) FILTER (ok) AS b FROM x GROUP BY task, streak HAVING count(*) FILTER (NOT ok) > 0)
SELECT task, strftime(a, '%d/%m/%Y %H:%M') || ' - ' || strftime(b, '%d/%m/%Y %H:%M') || ': task ' || task || ' is well again' AS message FROM y WHERE b IS NOT NULL""")
def q_messages(spark, d):
    done = health.streaks(_runs(spark, d)).where("recovered is not null")
    when = lambda c: F.date_format(c, "dd/MM/yyyy HH:mm")
    return done.select("task", C.template("{from} - {to}: task {task} is well again", **{"from": when("first_fail"), "to": when("recovered"), "task": F.col("task")}).alias("message"))


@query("""WITH a AS (SELECT c_nationkey AS n, c_custkey AS ord, c_mktsegment AS digest FROM customer) SELECT arg_min(digest, ord) AS digest FROM a WHERE digest IN (SELECT c_mktsegment FROM customer WHERE c_nationkey = 3) AND n = 7""")
def q_merge_base(spark, d):
    c = _t(spark, d, "customer")
    ours = c.where("c_nationkey = 7").select(F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("digest"))
    return cache.newest_common(ours, c.where("c_nationkey = 3").select(F.col("c_mktsegment").alias("digest")).distinct())


@query(f"WITH {ALERTS} SELECT task::VARCHAR AS task, ts, kind FROM al")
def q_alert_stream(spark, d):
    """The alerts of q_health_alerts out of the stateful stream, read to its end."""
    from pathlib import Path

    from vellum.session import scratch
    from vellum.streaming.health import alert_stream

    path = Path(f"{d}/events.parquet")
    source = spark.readStream.schema(spark.read.parquet(str(path)).schema).option("maxFilesPerTrigger", 1000)
    events = source.parquet(str(path)) if path.is_dir() else source.option("pathGlobFilter", path.name).parquet(str(path.parent))
    runs = events.select(F.col("user_id").alias("task"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    out = scratch(spark)
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = alert_stream(runs.withColumn("task", F.col("task").cast("string")))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    finally:
        if kept:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return spark.read.schema("task string, ts timestamp, kind string").parquet(out).select("task", F.col("ts").cast("timestamp_ntz").alias("ts"), "kind")
