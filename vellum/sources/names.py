"""File names: gates, destinations, free names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.columns import stem, strip, suffix
from vellum.operators import rules

_PREFIXED = r"^((?:\[[^\]]*\]\s*)+)(.+)$"


def is_candidate(name: Column) -> Column:
    """Whether the intake takes a file: visible, no transfer in progress, an extension it knows."""
    return ~name.startswith(".") & ~F.lower(name).contains(".syncthing.") & suffix(name).isin(*rules.DOCUMENTS, *rules.IMAGES)


def without_tmp(name: Column) -> Column:
    """The name without trailing .tmp if what remains is one that the intake takes, else null."""
    bare = F.regexp_replace(name, r"(?i)(\.tmp)+$", "")
    return F.when((bare != name) & is_candidate(bare), bare)


def destination(name: Column) -> Column:
    """struct(subject, clean_name, source) of a file name with [subject] prefixes.

    Without a prefix the file is unclassified and was dropped by hand; with a prefix it
    was shared. A segment that is empty, a dot folder, a path or reserved, and any
    nesting under the unclassified subject, lead to the unclassified subject.
    """
    blob, rest = F.regexp_extract(name, _PREFIXED, 1), strip(F.regexp_extract(name, _PREFIXED, 2))
    parts = F.transform(F.regexp_extract_all(blob, F.lit(r"\[([^\]]*)\]"), 1), strip)
    bad = F.exists(parts, lambda s: (s == "") | s.isin(".", "..") | s.contains("/") | s.contains("\\") | s.startswith("_"))
    nested = (F.try_element_at(parts, F.lit(1)) == rules.UNCLASSIFIED) & (F.size(parts) > 1)
    subject = F.when((blob == "") | bad | nested, rules.UNCLASSIFIED).otherwise(F.array_join(parts, "/"))
    clean = F.when(blob == "", name).otherwise(rest)
    return F.struct(subject.alias("subject"), clean.alias("clean_name"), F.when(blob == "", "watch").otherwise("share").alias("source"))


def subject_folders(subject: Column) -> Column:
    """Folders of a subject below the root; an empty subject is the root."""
    return F.filter(F.split(subject, "/"), lambda s: s != "")


def source_format(name: Column) -> Column:
    """pdf, docx or pptx by extension; images become PDF pages. Null for anything else."""
    table = F.create_map(*[F.lit(x) for pair in rules.FORMAT_OF.items() for x in pair])
    return F.try_element_at(table, suffix(name))


def document_id(rel: Column) -> Column:
    return F.substring(F.sha1(rel.cast("binary")), 1, 16)


def free_stems(arrivals: DataFrame, existing: DataFrame) -> DataFrame:
    """(subject, seq, base, stem): for each arrival the first of `base`, `base (1)`, `base (2)`, ... that is free.

    arrivals(subject, seq, name) in order of seq, existing(subject, stem). The k-th
    arrival of a base takes the k-th free number: one window over arrivals and taken
    numbers counts how many taken ones it goes past. Bases that themselves look like `other (k)` of the same subject are
    followed one by one, in a fold over the arrivals of that subject only.
    """
    new = arrivals.withColumn("base", stem(F.col("name")))
    other = F.regexp_extract("base", r"^(.*) \(\d+\)$", 1)
    bases = new.select("subject", "base").distinct()
    clash = new.where(other != "").select("subject", other.alias("base")).join(bases, ["subject", "base"], "left_semi").select("subject").distinct()
    plain, hard = new.join(clash, "subject", "left_anti"), new.join(clash, "subject", "left_semi")

    number = F.when(F.regexp_extract("stem", r" \((\d+)\)$", 1) != "", F.regexp_extract("stem", r" \((\d+)\)$", 1).try_cast("int"))
    taken = existing.select("subject", F.explode(F.array(F.struct(F.col("stem").alias("base"), F.lit(0).alias("k")), F.struct(F.regexp_replace("stem", r" \(\d+\)$", "").alias("base"), number.alias("k")))).alias("t"))
    taken = taken.select("subject", "t.base", "t.k").where("k is not null").where((F.col("k") == 0) | (F.col("k") > 0)).distinct()
    ranked = plain.withColumn("rank", F.row_number().over(Window.partitionBy("subject", "base").orderBy("seq")))
    # before the i-th taken number there are (number - i) free ones: an arrival of rank r goes past all taken ones of which r or fewer come before
    by_base = Window.partitionBy("subject", "base")
    before = taken.withColumn("place", F.col("k") - F.row_number().over(by_base.orderBy("k")) + 1).select("subject", "base", "place", F.lit(0).alias("kind"), F.lit(None).cast(arrivals.schema["seq"].dataType).alias("seq"))
    both = before.unionByName(ranked.select("subject", "base", (F.col("rank") - 1).alias("place"), F.lit(1).alias("kind"), "seq"))
    passed = F.count_if(F.col("kind") == 0).over(by_base.orderBy("place", "kind").rowsBetween(Window.unboundedPreceding, 0))
    free = both.withColumn("k", F.col("place") + passed).where("kind = 1")
    named = F.when(F.col("k") == 0, F.col("base")).otherwise(F.concat("base", F.lit(" ("), F.col("k").cast("string"), F.lit(")")))
    simple = free.select("subject", "seq", "base", named.alias("stem"))

    def follow(new, old):
        import pandas as pd

        taken = set(old["stem"])
        out = []
        for r in new.sort_values("seq").itertuples():
            name, k = r.base, 0
            while name in taken:
                k += 1
                name = f"{r.base} ({k})"
            taken.add(name)
            out.append((r.subject, r.seq, r.base, name))
        return pd.DataFrame(out, columns=["subject", "seq", "base", "stem"]).astype({"subject": object, "base": object, "stem": object})

    seq = arrivals.schema["seq"].dataType.simpleString()
    one_by_one = hard.groupBy("subject").cogroup(existing.join(clash, "subject", "left_semi").groupBy("subject")).applyInPandas(follow, f"subject string, seq {seq}, base string, stem string")
    return simple.unionByName(one_by_one)
