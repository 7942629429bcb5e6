"""The pN_ queries of this subpackage and their SQL. Every query runs over its whole tables with production parameters."""

from __future__ import annotations

from vellum.llm import boilerplate, encoding, leakage, lookalike, mixing, pii, quality, scanfix, terms
from vellum.llm.common import table


def queries() -> dict:
    def on(f, *tables):
        return lambda spark, d: f(*[table(spark, d, t) for t in tables])

    return {
        "p1_found": on(boilerplate.found, "doc_lines"),
        "p1_documents": on(boilerplate.without_repeated, "doc_lines"),
        "p2_found": on(quality.found, "ocr_lines"),
        "p2_statistics": on(quality.document_statistics, "ocr_lines"),
        "p3_found": on(scanfix.found, "ocr_lines", "units"),
        "p3_paragraphs": on(scanfix.paragraphs, "ocr_lines", "units"),
        "p3_units": on(scanfix.repaired_units, "ocr_lines", "units"),
        "p4_found": on(terms.found, "units"),
        "p4_terms": on(terms.term_statistics, "units"),
        "p5_found": on(lookalike.found, "units", "ocr_lines"),
        "p5_texts": on(lambda u, o: lookalike.consistent(lookalike.texts(u, o)), "units", "ocr_lines"),
        "p6_found": on(encoding.found, "units"),
        "p6_restored": on(lambda u: encoding.restore_encoding(u).distinct(), "units"),
        "p7_found": on(leakage.found, "documents", "eval_items"),
        "p8_found": on(mixing.found, "documents", "mix_targets"),
        "p8_mix": on(mixing.mix, "documents", "mix_targets"),
        "p8_shares": on(mixing.report, "documents", "mix_targets"),
        "p9_found": on(pii.found, "documents"),
        "p9_texts": on(lambda docs: pii.redacted(docs.select("doc_id", "text")), "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {"p1_found": boilerplate.FOUND_SQL, "p1_documents": boilerplate.DOCUMENTS_SQL, "p4_found": terms.FOUND_SQL, "p4_terms": terms.TERMS_SQL}
