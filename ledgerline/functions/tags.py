"""Tag lists in JSON: defensive parsing, the controlled vocabulary, prompts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dictionaries import TAGS
from .dates import dashed
from .text import amount, strip

#: Keys under which an object may hold its list.
WRAPPERS = ("tags", "kam_tags", "labels", "result")
#: What an empty reply is dropped as; keys that are no data; parts of the names of amounts.
EMPTY_REPLY = "<empty response>"
META_KEYS = ("status", "message", "crtfc_key")
AMOUNTS = ("amount", "amt", "_cnt", "_qy", "stkqy", "stkrt", "lmp_cnt", "lmp_rate")
REGISTRATION_AMOUNTS = ("amount", "amt", "_cnt", "_qy", "stkqy", "stkrt")


def _as_array(raw: Column) -> Column:
    """A JSON text as array of strings: a list as it is, an object's first list under a wrapper key, a string alone."""
    value = F.try_parse_json(raw)
    kind = F.schema_of_variant(value)
    listed = F.try_variant_get(value, "$", "array<string>")
    wrapped = F.coalesce(*(F.try_variant_get(value, f"$.{k}", "array<string>") for k in WRAPPERS))
    return F.when(kind.startswith("ARRAY"), listed).when(kind.startswith("OBJECT"), wrapped).when(kind == "STRING", F.array(F.try_variant_get(value, "$", "string")))


def tag_array(reply: Column) -> Column:
    """The list in a reply: the whole text, else its first fenced block, else what lies between the outer brackets."""
    fenced = F.nullif(F.regexp_extract(reply, r"(?si)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    bracketed = F.nullif(F.regexp_extract(reply, r"(?s)\[.*\]", 0), F.lit(""))
    return F.coalesce(_as_array(reply), _as_array(fenced), _as_array(bracketed))


def split_tags(tags: Column, vocabulary: Sequence[str] = TAGS) -> Column:
    """Struct (tags, dropped): known tags in vocabulary order, the others in order of first sight."""
    known = F.array(*(F.lit(t) for t in vocabulary))
    cleaned = F.filter(F.transform(tags, lambda t: F.trim(t)), lambda t: t.isNotNull() & (t != ""))
    return F.struct(F.filter(known, lambda t: F.array_contains(cleaned, t)).alias("tags"), F.array_distinct(F.filter(cleaned, lambda t: ~F.array_contains(known, t))).alias("dropped"))


def parse_reply(reply: Column, vocabulary: Sequence[str] = TAGS, most: int = 200, nothing: str = EMPTY_REPLY) -> Column:
    """Struct (tags, dropped); a reply without a list is dropped itself: stripped, its first ``most`` characters."""
    plain = strip(F.coalesce(reply, F.lit("")))
    failed = F.when(plain == "", F.lit(nothing)).otherwise(F.substring(plain, 1, most))
    tags = tag_array(reply)
    return F.when(tags.isNotNull(), split_tags(tags, vocabulary)).otherwise(F.struct(F.array().cast("array<string>").alias("tags"), F.array(failed).alias("dropped")))


def prompt(system: str, text: Column) -> Column:
    """A two-message chat prompt as JSON."""
    return F.to_json(F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), text.alias("content"))))


def coerce_record(raw: Column) -> Column:
    """A JSON object as map of strings: nulls become empty strings."""
    return F.transform_values(F.from_json(raw, "map<string,string>"), lambda _, v: F.coalesce(v, F.lit("")))


def tagging_prompt(instruction: str, definitions: Mapping[str, str], text: Column) -> Column:
    """The prompt for tags: the instruction, then a line for each tag and its definition; the text as it is."""
    return prompt("\n".join([instruction, *(f"- {tag}: {said}" for tag, said in definitions.items())]), text)


def without_keys(record: Column, keys: Sequence[str] = META_KEYS) -> Column:
    return F.map_filter(record, lambda k, _: ~k.isin(*keys))


def format_record(record: Column, amounts: Sequence[str] = AMOUNTS) -> Column:
    """Values by their key's name: nothing is a dash, dates of eight characters get dashes, amounts thousands separators."""

    def made(k: Column, v: Column) -> Column:
        plain = F.when(F.coalesce(v, F.lit("")) == "", F.lit("-")).otherwise(v)
        dated = F.when((k.endswith("_de") | k.endswith("_dt")) & (F.length(plain) == 8), dashed(plain)).otherwise(plain)
        is_amount = F.lit(False)
        for part in amounts:
            is_amount = is_amount | k.contains(part)
        return F.when(is_amount, amount(dated)).otherwise(dated)

    return F.transform_values(record, made)


def page_payload(raw: Column) -> Column:
    """Struct (records, total_count, total_page) of a page: 0 and 1 where missing or blank; one object is a list of one."""
    page = F.from_json(raw, "list string, total_count string, total_page string")
    own = page["list"]
    many, one = F.from_json(own, "array<map<string,string>>"), F.from_json(own, "map<string,string>")
    records = F.when(own.startswith("["), many).when(own.startswith("{"), F.array(one)).otherwise(F.array().cast("array<map<string,string>>"))
    plain = F.transform(F.filter(records, lambda r: r.isNotNull()), lambda r: F.transform_values(r, lambda _, v: F.coalesce(v, F.lit(""))))
    number = lambda name, default: F.coalesce(F.nullif(page[name], F.lit("")).try_cast("long"), F.lit(default)).cast("long").alias(name)
    return F.struct(plain.alias("records"), number("total_count", 0), number("total_page", 1))


def labels(code: Column, names: Mapping[str, str]) -> Column:
    """The code's name; an unknown code as it is."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)
