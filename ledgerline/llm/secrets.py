"""Secret scans with DataFrame functions alone: rule spans, and tokens that look random to a character Markov model.

The rules find assignments, access keys and long hexadecimal runs. Beside them, every run of ``TOKEN`` characters is
scored by the mean log-likelihood ratio of two first-order character Markov models, one of random strings and one of
ordinary identifiers; both are fitted by grouped counts over one half of the labelled samples. The other half sets the
threshold (at most ``FALSE_ALARMS`` of the ordinary strings lie above it; where the two kinds do not overlap, it is half
way between them) and the number of different characters that a
token needs, and tells the share of random strings that are missed. A token above the threshold adds a span of kind
``random``, also where a rule span lies; in other tokens, runs of ``PART`` characters are judged for themselves, so that a
key at the end of a path or a long name is found. Rule spans always stay.

Spans are in code points, end exclusive. Positions come from the lengths of what lies between the matches, added up in
blocks, and masks are laid over the text block by block, so that a text with very many matches costs no quadratic work.
No row leaves its partition.

Defined results: a null or empty text has no spans (counts 0, empty span string, the hash of an empty string) and stays
as it is when documents are redacted; a null id stays null; equal rows are scanned once each; an empty table gives no
rows; other columns, whatever their names, are not read by ``scan`` and are kept by ``redact``. U+FDD0, which is no
character, counts as masked.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import by_place

#: The rules, in the order that kinds are listed.
RULES = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
KINDS = [*RULES, "random"]
MIN_VALUE = 6
TOKEN, PART = r"[A-Za-z0-9+/_=-]{20,}", r"[A-Za-z0-9+]{20,}"
#: What any span needs at least: most texts are done after this one look.
ANY = r"(?i:password|passwd|secret|token|api_?key)[\"'\x20:=]|AKIA[A-Z0-9]{16}|[A-Za-z0-9+/_=-]{20}"
#: Ordinary strings that may lie above the threshold; random strings that may have too few different characters.
FALSE_ALARMS, FEW_DISTINCT = 0.001, 0.001
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MASK, FILL = "[SECRET]", "\ufdd0"
#: Characters of a text that masks are laid over at once.
CHARS = 4096
#: Labelled rows that a model may be fitted on at most.
MOST_SAMPLES = 20_000
#: Parts of ordinary identifiers for the default labelled sample.
PARTS = "account add address after all apply array async base batch before begin block body buffer build byte cache call change channel char check child class clear client close code collect column command common config connect content context control copy count create current data date default delete detail directory document double download element enable encode end engine entry error event exception execute factory field file filter find first flag float format from function generate get global group handle handler hash header height hidden host image import index info init input insert instance integer internal item iterator job key label last length level library limit line link list listener load local location lock log loop main manager map mask match matrix max memory menu merge message method min mode model module name network next node number object offset open option order output owner package page panel param parent parse password path pattern pixel plugin point pool port position prefix print process profile project property provider query queue random range read record region register release remove render replace report request reset resource response result return root route row rule run sample save scale schema scope screen script search section select sequence server service session set shape shared size socket sort source stack start state static status step stop storage store stream string style success suffix support system table tag target task template test text thread time title token total transaction transform tree type unit update upload user util valid value vector version view visible wait width window word worker write zone".split()


def default_samples(n: int = 4000) -> list[tuple[str, str]]:
    """Labelled strings: random ones over the usual alphabets, and identifiers joined from ordinary parts."""
    draw, out = random.Random(5), []
    for i in range(n):
        alphabet = (ALPHABET[:62], ALPHABET[:26] + ALPHABET[52:62], "0123456789abcdef", ALPHABET[26:62], ALPHABET[:64])[i % 5]
        out.append(("".join(draw.choice(alphabet) for _ in range(draw.randint(20, 48))), "random"))
        parts = [draw.choice(PARTS) for _ in range(draw.randint(2, 6))]
        style = i % 6
        name = ("_".join(parts), "-".join(parts), "".join(p.capitalize() for p in parts), "_".join(parts).upper(), "/".join(parts), "".join(parts))[style]
        out.append((name + ("" if i % 4 else f"_{draw.randint(1, 2024)}"), "ordinary"))
    return out


@dataclass(frozen=True)
class Model:
    """Log ratios of all character pairs, the limits, and what they miss and wrongly take of the samples kept apart."""

    ratios: tuple[float, ...]
    threshold: float
    distinct: int
    missed: float
    false_alarms: float


def _ratios(known: DataFrame) -> tuple[float, ...]:
    """Log-likelihood ratio, random against ordinary, of each pair of alphabet characters (row: first character)."""
    size = len(ALPHABET)
    chars = known.select("label", F.expr(f"transform(split(text, ''), c -> if(length(c) = 1, locate(c, '{ALPHABET}'), 0) - 1)").alias("c")).filter("size(c) > 1")
    pairs = chars.select("label", F.explode(F.expr("transform(sequence(1, size(c) - 1), i -> struct(c[i - 1] AS a, c[i] AS b))")).alias("p")).select("label", "p.a", "p.b")
    counts = pairs.filter("a >= 0 and b >= 0").groupBy("label", "a", "b").count()
    seen = {label: [[0.5] * size for _ in range(size)] for label in ("random", "ordinary")}
    for r in counts.collect():  # two rows for each pair of alphabet characters at most
        seen[r["label"]][r["a"]][r["b"]] += r["count"]
    rate = lambda label, a, b: seen[label][a][b] / sum(seen[label][a])
    return tuple(math.log(rate("random", a, b) / rate("ordinary", a, b)) for a in range(size) for b in range(size))


def fit(samples: DataFrame, false_alarms: float = FALSE_ALARMS) -> Model:
    """A model from ``text`` and ``label`` (random or ordinary): every other string fits, the rest calibrates.

    Other labels and nulls are left out, and so is a pair with a character outside the alphabet. At most
    ``MOST_SAMPLES`` rows are allowed; without ordinary strings to calibrate on, the threshold is 0.
    """
    known = samples.filter(F.col("label").isin("random", "ordinary") & F.col("text").isNotNull()).select("label", "text")
    if known.limit(MOST_SAMPLES + 1).count() > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} labelled rows")
    apart = F.xxhash64("text", "label").bitwiseAND(F.lit(1)) == 1
    ratios = _ratios(known.filter(~apart))
    judged = known.filter(apart & F.col("text").rlike(rf"^{TOKEN}\z")).select("label", mean_ratio(F.col("text"), ratios).alias("ratio"), _distinct(F.col("text")).alias("distinct")).collect()
    ordinary, rare = sorted(r.ratio for r in judged if r.label == "ordinary"), sorted(r.distinct for r in judged if r.label == "random")
    threshold = ordinary[min(len(ordinary) - 1, math.ceil((1 - false_alarms) * len(ordinary)))] if ordinary else 0.0
    lowest = sorted(r.ratio for r in judged if r.label == "random")[int(false_alarms * len(rare))] if rare else threshold
    threshold = max(threshold, (threshold + lowest) / 2)
    distinct = rare[int(FEW_DISTINCT * len(rare))] if rare else 1
    share = lambda label: sum(r.ratio > threshold and r.distinct >= distinct for r in judged if r.label == label) / max(1, sum(r.label == label for r in judged))
    return Model(ratios, threshold, distinct, 1 - share("random"), share("ordinary"))


def default_model(spark: SparkSession) -> Model:
    return fit(spark.createDataFrame(default_samples(), "text string, label string"))


def _distinct(token: Column) -> Column:
    return F.size(F.array_distinct(F.split(token, "")))


def mean_ratio(token: Column, ratios: tuple[float, ...]) -> Column:
    """Mean log-likelihood ratio of a token's character pairs; the token is over the alphabet."""
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1)
    pairs = F.zip_with(codes, F.slice(codes, 2, 1_000_000_000), lambda a, b: F.when(b.isNull(), F.lit(0.0)).otherwise(F.get(table, a * size + b)))
    return F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) / F.greatest(F.length(token) - 1, F.lit(1))


def looks_random(token: Column, model: Model) -> Column:
    return (mean_ratio(token, model.ratios) > model.threshold) & (_distinct(token) >= model.distinct)


def _running(steps: Column) -> Column:
    """Running sums of an array of ints, block by block: sums inside the blocks, and what precedes each block."""
    block = 64
    zero, add = F.lit(0), lambda x, y: x + y
    blocks = F.transform(F.sequence(zero, F.floor((F.size(steps) - 1) / block).cast("int")), lambda b: F.slice(steps, b * block + 1, F.lit(block)))
    ahead = F.aggregate(blocks, F.array(zero), lambda sums, x: F.concat(sums, F.array(F.aggregate(x, F.element_at(sums, -1), add))))
    inside = F.zip_with(blocks, F.slice(ahead, F.lit(1), F.size(blocks)), lambda x, before: F.transform(x, lambda _, i: F.aggregate(F.slice(x, F.lit(1), i + 1), before, add)))
    return F.when(F.size(steps) > 0, F.flatten(inside)).otherwise(F.array().cast("array<int>"))


_PATTERNS = {**RULES, "random": TOKEN, "part": PART}


def _spans(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, which have no other columns than ``row`` and ``text``, with matches and spans.

    For each pattern k: ``m_k`` (matches), ``ok_k`` (which of them count) and ``g_k`` (what lies between them); and
    ``base`` and ``added``: sorted arrays of (start, kind, end), kinds by number. Arrays that a lambda needs are zipped
    in as its arguments: a column named inside a lambda could be worked out again for every element.
    """
    some, none, zero = F.coalesce(F.col("text").rlike(ANY), F.lit(False)), F.array().cast("array<string>"), F.lit(0)
    all_of = lambda p, group: F.coalesce(F.when(some, F.regexp_extract_all(F.col("text"), F.lit(p), F.lit(group))), none)
    lengths = lambda c: F.transform(c, lambda x: F.length(x))
    found = docs.withColumns({f"m_{k}": all_of(p, 0) for k, p in _PATTERNS.items()} | {"values": all_of(RULES["assign"], 2)})
    found = found.withColumns({f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.split(F.col("text"), p, -1)).otherwise(none) for k, p in _PATTERNS.items()} | {"ok_random": F.transform("m_random", lambda m: looks_random(m, model))})
    within = F.zip_with("ok_random", F.transform("m_random", lambda m: F.size(F.regexp_extract_all(m, F.lit(PART), F.lit(0)))), lambda ok, n: F.array_repeat(ok, n))
    steps = lambda k: F.zip_with(F.concat(lengths(F.col(f"g_{k}")), F.when(F.size(f"g_{k}") == 0, F.array(zero)).otherwise(F.array().cast("array<int>"))), F.concat(F.array(zero), lengths(F.col(f"m_{k}"))), lambda g, before: g + before)
    found = found.withColumns({f"t_{k}": steps(k) for k in _PATTERNS} | {"within": F.flatten(within), "ok_assign": F.transform("values", lambda v: F.length(v) >= MIN_VALUE)})
    found = found.withColumns({f"s_{k}": F.slice(_running(F.col(f"t_{k}")), F.lit(1), F.size(f"m_{k}")) for k in _PATTERNS} | {"ok_part": F.zip_with("m_part", "within", lambda m, inside: ~inside & looks_random(m, model))})
    found = found.withColumns({f"ok_{k}": F.transform(f"m_{k}", lambda _: F.lit(True)) for k in ("access", "hex")})
    whole = lambda k, kind: F.zip_with(F.col(f"m_{k}"), F.col(f"s_{k}"), lambda m, s: F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s + F.length(m)).alias("end")))
    picked = lambda k, kind: F.transform(F.filter(F.zip_with(whole(k, kind), F.col(f"ok_{k}"), lambda s, ok: F.struct(s.alias("span"), ok.alias("ok"))), lambda x: x["ok"]), lambda x: x["span"])
    return found.withColumns({"base": F.sort_array(F.concat(*(picked(k, k) for k in RULES))), "added": F.sort_array(F.concat(picked("random", "random"), picked("part", "random")))})


def _said(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of each kind, the hash of the rule spans, and all spans as text."""
    found = _spans(docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")), model or default_model(docs.sparkSession))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        F.col("row").alias(id_col), number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"), F.size("added").cast("long").alias("n_random"),
        F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def _filled(k: str) -> Column:
    """The text with the matches of one pattern that count filled, its length kept; null where there are none."""
    fill = lambda m: F.repeat(F.lit(FILL), F.length(m))
    hidden = lambda m, ok: F.when(ok, fill(m)).otherwise(m)
    made = F.zip_with(f"m_{k}", f"ok_{k}", hidden)
    if k == "assign":
        head = F.zip_with("m_assign", "values", lambda m, v: F.substring(m, F.lit(1), F.length(m) - F.length(v)))
        made = F.zip_with(head, F.zip_with("values", "ok_assign", hidden), lambda a, b: F.concat(a, b))
    pieces = F.zip_with(f"g_{k}", F.concat(made, F.array(F.lit(""))), lambda gap, m: F.array(gap, m))
    return F.when(F.exists(f"ok_{k}", lambda ok: ok), F.array_join(F.flatten(pieces), ""))


def _laid_over(text: Column, mask: Column) -> Column:
    """The text with every character filled that the mask fills, block by block; the text itself where the mask is null."""
    blocks = lambda c: F.regexp_extract_all(c, F.lit(f"(?s).{{1,{CHARS}}}"), F.lit(0))
    chars = lambda a, b: F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(y == FILL, y).otherwise(x)), "")
    laid = F.zip_with(blocks(text), blocks(mask), lambda a, b: F.when(b.contains(FILL), chars(a, b)).otherwise(a))
    return F.when(mask.isNotNull(), F.array_join(laid, "")).otherwise(text)


def redact(docs: DataFrame, model: Model | None = None, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents, all columns kept, with what ``scan`` finds masked: the value of an assignment, else the whole span.

    Spans that overlap or touch get one mask. ``n_chars``, where the documents have it, is brought up to date for the
    texts that change.
    """
    names, docs = docs.columns, by_place(docs, text_col, chars_col)
    found = _spans(docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")), model or default_model(docs.sparkSession))
    found = found.select("row", "text", *(_filled(k).alias(f"f_{k}") for k in _PATTERNS)).withColumn("masked", F.col("text"))
    for k in _PATTERNS:
        found = found.withColumn("masked", _laid_over(F.col("masked"), F.col(f"f_{k}")))
    changed = F.greatest(*(F.col(f"f_{k}").isNotNull() for k in _PATTERNS))
    found = found.select("row", changed.alias("changed"), F.when(changed, F.regexp_replace("masked", f"{FILL}+", MASK)).otherwise(F.col("text")).alias("text"))
    own = {text_col: F.col("text")}
    if chars_col in docs.columns:
        own[chars_col] = F.when(F.col("changed"), F.length("text").cast(dict(docs.dtypes)[chars_col])).otherwise(F.col("row")[chars_col])
    return found.select(*(own.get(c, F.col("row")[c]).alias(c) for c in docs.columns)).toDF(*names)
