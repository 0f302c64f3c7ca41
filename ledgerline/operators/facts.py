"""Reports to facts: choice of the document, sections by landmarks, opinion, period, flags. Columns only, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import text as T
from ..functions.dates import fiscal_period

#: Characters of a section.
SECTION_CHARS = 6000
PASSED = ("rcept_no", "corp_code", "corp_name", "corp_cls", "stock_code", "report_name", "rcept_dt", "category", "source_url")


def entry_kind(name: Column, code: Column) -> Column:
    """consolidated, audit (never both), main, or other, of a document's name and code."""
    file = T.base_name(F.col("filename"))
    main = code.isin(*D.MAIN_CODES) | (file.endswith(".xml") & ~file.contains("_")) | (name.endswith(D.REPORT_SUFFIX) & (code == ""))
    return F.when((name == D.CONSOLIDATED[0]) | (code == D.CONSOLIDATED[1]), "consolidated").when((name == D.AUDIT[0]) | (code == D.AUDIT[1]), "audit").when(main, "main").otherwise("other")


def document_head(content: Column) -> tuple[Column, Column]:
    """Name and code of a document from its first 8 KiB."""
    head = F.make_valid_utf8(F.substring(content, 1, 8192).cast("string"))
    both = r'<DOCUMENT-NAME[^>]*\bACODE="(\d+)"[^>]*>([^<]*)</DOCUMENT-NAME>'
    coded = F.regexp_extract(head, both, 1)
    return F.when(coded != "", F.regexp_extract(head, both, 2)).otherwise(F.regexp_extract(head, r"<DOCUMENT-NAME[^>]*>([^<]*)</DOCUMENT-NAME>", 1)), coded


def choose_documents(files: DataFrame) -> DataFrame:
    """One file of each filing among (rcept_no, path): consolidated, audit, the filing's own, else the only one."""
    name = T.base_name(F.col("path"))
    own = lambda end: name == F.concat(F.col("rcept_no"), F.lit(end))
    rank = F.when(own("_00761.xml"), 0).when(own("_00760.xml"), 1).when(own(".xml"), 2).otherwise(3)
    best = files.withColumn("__rank", rank).groupBy("rcept_no").agg(F.min(F.struct("__rank", "path")).alias("x"), F.count("*").alias("n"))
    return best.filter("x.__rank < 3 or n = 1").select("rcept_no", F.col("x.path").alias("path"))


#: All landmarks of reports: found together, in one pass.
LANDMARKS = T.Landmarks([*D.OPINION_HEADERS, *D.SECTION_LANDMARKS, *D.GOING_CONCERN_HEADERS])


def with_landmarks(df: DataFrame, text: str = "full_text") -> DataFrame:
    """Adds what the parse reads places from, each a column of its own so that it is worked out once.

    ``found`` (``LANDMARKS``); the numbers of the first opinion header, key matters, emphasis and headers of doubt; and the
    places where the first three of them end (``*_end``) and the section goes on to (``*_stop``).
    """
    found, number = F.col("found"), F.col
    df = df.withColumn("found", LANDMARKS.found(F.col(text)))
    df = df.withColumns({n: LANDMARKS.first(found, marks) for n, marks in {"opinion_no": D.OPINION_HEADERS, "kam_no": [D.KEY_MATTERS], "emphasis_no": [D.EMPHASIS], **{f"doubt_no_{i}": [h] for i, h in enumerate(D.GOING_CONCERN_HEADERS)}}.items()})
    but = lambda header: [m for m in D.SECTION_LANDMARKS if m != header]
    df = df.withColumns({f"{n}_next": LANDMARKS.next(found, number(f"{n}_no"), but(header)) for n, header in (("opinion", None), ("kam", D.KEY_MATTERS), ("emphasis", D.EMPHASIS))})
    return df.withColumns({f"{n}_end": LANDMARKS.end(found, number(f"{n}_no")) for n in ("opinion", "kam", "emphasis")} | {f"{n}_stop": LANDMARKS.start(F.col(text), found, number(f"{n}_next")) for n in ("opinion", "kam", "emphasis")})


def opinion_paragraph(text: Column) -> Column:
    """From the earliest opinion header to the next landmark; empty without a header. ``deciding`` goes on from there."""
    at = F.col("opinion_end") - F.length(F.get("found.mark", F.col("opinion_no") - 1))
    return F.when(F.col("opinion_no").isNotNull(), T.strip(F.substring(text, at, F.least(F.col("opinion_stop") - at, F.lit(1200))))).otherwise("")


def section(text: Column, name: str) -> Column:
    """What follows the header ``name`` (kam, emphasis) up to the next landmark; empty without the header."""
    begin = F.col(f"{name}_end")
    return F.when(F.col(f"{name}_no").isNotNull(), T.strip(F.substring(text, begin, F.least(F.col(f"{name}_stop") - begin, F.lit(SECTION_CHARS))))).otherwise("")


def deciding(text: Column, paragraph: Column) -> Column:
    """The paragraph if it holds a deciding phrase, else the opinion's sentence wherever it stands, else the paragraph."""
    decided = F.lit(False)
    for marker in D.OPINION_MARKERS:
        decided = decided | paragraph.contains(marker)
    return F.when(decided, paragraph).otherwise(F.coalesce(F.when(text.contains(D.OPINION_WORD), F.nullif(F.regexp_extract(text, D.OPINION_SENTENCE_PATTERN, 0), F.lit(""))), paragraph))


def going_concern(text: Column) -> Column:
    """Snippet after the first header that occurs, else around the phrase that raises doubt; null if neither occurs."""
    numbers = [F.col(f"doubt_no_{i}") for i in range(len(D.GOING_CONCERN_HEADERS))]
    after = [F.when(n.isNotNull(), T.strip(F.substring(text, LANDMARKS.end(F.col("found"), n), F.lit(400)))) for n in numbers]
    said = F.when(text.contains(D.GOING_CONCERN_WORD), F.regexp_extract(text, D.GOING_CONCERN_PATTERN, 0)).otherwise("")
    at = F.length(F.get(F.split(text, D.GOING_CONCERN_PATTERN, 2), F.lit(0)))
    start = F.greatest(F.lit(0), at - 80)
    around = T.strip(F.substring(text, start + 1, at + F.length(said) + 250 - start))
    return F.coalesce(*after, F.when(said != "", around))


def parse_reports(reports: DataFrame, content: str = "content", filer: str = "flr_nm") -> DataFrame:
    """One fact for each report: metadata passed through, parsed fields, and sorted flags for what was found.

    The auditor is the filer; another signature in the text is flagged as ``auditor_mismatch``. A null or empty document
    gives an unknown opinion and empty sections. Stages are columns of their own, so that a text is stripped of its
    markup once.
    """
    kept = (*PASSED, "doc_path", filer)
    meta = {c: F.coalesce(F.col(c), F.lit("")) if c in reports.columns else F.lit("") for c in kept}
    staged = reports.withColumns(meta).withColumn("full_text", F.coalesce(T.bytes_to_text(F.col(content)), F.lit("")))
    text = F.col("full_text")
    staged = with_landmarks(staged).withColumn("paragraph", opinion_paragraph(text)).withColumns(
        {
            "signature": F.when(F.col(filer) != "", F.regexp_replace(T.last_match_in_runs(text, D.SIGNATURE_PATTERN, D.SIGNATURE_CHARACTERS, D.SIGNATURE_ENDING), T.SPACES, "")).otherwise(""),
            "paragraph": deciding(text, F.col("paragraph")),
            "gc": going_concern(text),
            "kam_raw": section(text, "kam"),
            "emphasis_raw": section(text, "emphasis"),
            "period": fiscal_period(F.col("report_name"), text, F.col("rcept_dt")),
        }
    )
    opinion, auditor = T.classify(F.col("paragraph"), D.OPINION_RULES, D.UNKNOWN), F.col(filer)
    flags = F.array(
        F.when(auditor != "", "auditor"),
        F.when((F.col("signature") != "") & (F.regexp_replace(auditor, T.SPACES, "") != F.col("signature")), "auditor_mismatch"),
        F.when(opinion != D.UNKNOWN, "opinion"),
        F.when(F.col("gc").isNotNull(), "going_concern"),
        F.when(F.col("kam_raw") != "", "kam"),
        F.when(F.col("period").isNotNull(), "fiscal_year"),
    )
    return staged.select(
        *PASSED,
        F.col("period.year").alias("fiscal_year"), F.col("period.month").alias("settlement_month"), auditor.alias("auditor"), opinion.alias("audit_opinion"),
        F.substring("paragraph", 1, 400).alias("opinion_snippet"), F.col("gc").isNotNull().alias("going_concern"), F.coalesce("gc", F.lit("")).alias("going_concern_snippet"),
        (F.col("kam_raw") != "").alias("kam_present"), "kam_raw", "emphasis_raw", F.array().cast("array<string>").alias("kam_tags"),
        F.sort_array(F.filter(flags, lambda x: x.isNotNull())).alias("parse_flags"), "doc_path",
    )


#: What a line of facts may hold; texts default to nothing, the opinion to unknown.
_LINE = "rcept_no string, corp_code string, corp_name string, corp_cls string, stock_code string, report_name string, rcept_dt string, category string, fiscal_year string, settlement_month string, auditor string, audit_opinion string, opinion_snippet string, going_concern string, going_concern_snippet string, kam_present string, kam_raw string, emphasis_raw string, kam_tags array<string>, parse_flags array<string>, source_url string, doc_path string"


def whole_number(said: Column, kind: Column) -> Column:
    """A JSON value, as text and with its kind, as a whole number; null for what is none."""
    text = T.strip(said)
    written = F.when(text.rlike(r"^[+-]?\d+(_\d+)*\z"), F.replace(text, F.lit("_"), F.lit("")).try_cast("int"))
    return F.when(kind == "STRING", written).when(kind == "BOOLEAN", (said == "true").cast("int")).otherwise(said.try_cast("double").try_cast("int"))


def read_facts(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(facts, corrupt lines): JSON lines read back with defaults.

    Blank lines are skipped. A line that is no JSON object, or whose year or month is no number, is corrupt. Numbers lose
    their fraction, true and false are 1 and 0, and a text may hold single underscores between its digits.
    """
    own = lines.filter(~T.blank(F.col(line))).withColumn("__v", F.try_parse_json(F.col(line))).withColumn("__kind", F.schema_of_variant("__v")).withColumn("__x", F.from_json(line, _LINE))
    whole = lambda c: whole_number(F.col(f"__x.{c}"), F.schema_of_variant(F.try_variant_get("__v", f"$.{c}", "variant")))
    bad = lambda c: F.col(f"__x.{c}").isNotNull() & whole(c).isNull()
    fine = F.coalesce(F.col("__kind").startswith("OBJECT") & ~bad("fiscal_year") & ~bad("settlement_month"), F.lit(False))
    columns = []
    for name, kind in (part.split() for part in _LINE.split(", ")):
        value = F.col(f"__x.{name}")
        if name in ("fiscal_year", "settlement_month"):
            value = whole(name)
        elif name in ("going_concern", "kam_present"):
            value = F.coalesce(~F.lower(value).isin("", "false", "0", "0.0", "[]", "{}"), F.lit(False))
        elif kind == "array<string>":
            value = F.coalesce(value, F.array().cast(kind))
        else:
            value = F.coalesce(F.when(value != "", value), F.lit(D.UNKNOWN if name == "audit_opinion" else ""))
        columns.append((F.sort_array(F.array_distinct(value)) if name == "parse_flags" else value).alias(name))
    return own.filter(fine).select(*columns), own.filter(~fine).select(line)


def to_audit_records(facts: DataFrame) -> DataFrame:
    """Facts as structured audit records."""
    year = F.col("fiscal_year").cast("string")
    return facts.select(
        "corp_code", "corp_name", "corp_cls", F.coalesce(year, F.lit("")).alias("bsns_year"), F.lit("").alias("reprt_code"),
        F.when(year.isNotNull(), F.concat(year, F.lit("년 "), F.col("category"))).otherwise("").alias("business_year_label"), "rcept_no", "auditor",
        F.col("audit_opinion"), F.lit("").alias("special_matter"), F.col("emphasis_raw").alias("emphasis_matter"), F.col("kam_raw").alias("core_audit_matter"),
        F.when(year.isNotNull() & F.col("settlement_month").isNotNull(), F.concat(year, F.lit("."), F.lpad(F.col("settlement_month").cast("string"), 2, "0"))).otherwise("").alias("settlement_date"), "source_url",
    )
