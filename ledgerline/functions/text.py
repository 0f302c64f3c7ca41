"""String functions: Column to Column, all inside the JVM. Positions are 1-based code points; 0 means none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the four separator controls.
SPACES = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def collapse(c: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def markup_to_text(c: Column) -> Column:
    """Tags and entities become spaces, white space is collapsed; bytes are read as UTF-8 with replacement.

    ``<>`` is no tag and stays.
    """
    text = F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"&[#A-Za-z0-9]+;", " ")
    return collapse(text)


def bytes_to_text(c: Column) -> Column:
    return markup_to_text(F.make_valid_utf8(c.cast("string")))


def landmark(text: Column, mark: str, start: Column | int = 1) -> Column:
    """Where ``mark`` stands followed by a space or the end, from ``start`` on."""
    return F.call_function("locate", F.lit(mark + " "), F.concat(text, F.lit(" ")), F.lit(start) if isinstance(start, int) else start)


def next_landmark(text: Column, start: Column, marks: Sequence[str], but: str | None = None) -> Column:
    """The nearest landmark from ``start`` on, other than ``but``; one past the end where there is none."""
    found = [F.nullif(landmark(text, m, start), F.lit(0)) for m in marks if m != but]
    return F.coalesce(F.least(*found), F.length(text) + 1)


def section(text: Column, header: str, marks: Sequence[str], most: int = 6000) -> Column:
    """What follows a header up to the next landmark; empty where the header is missing."""
    at = landmark(text, header)
    start = at + len(header)
    body = F.substring(text, start, F.least(next_landmark(text, start, marks, header) - start, F.lit(most)))
    return F.when(at > 0, strip(body)).otherwise("")


def first_landmark(text: Column, marks: Sequence[str]) -> Column:
    """Struct (at, mark) of the earliest mark; of several at one place the first in the list; null where none is."""
    found = F.array(*(F.struct(F.nullif(landmark(text, m), F.lit(0)).alias("at"), F.lit(i).alias("rank"), F.lit(m).alias("mark")) for i, m in enumerate(marks)))
    return F.array_min(F.filter(found, lambda x: x["at"].isNotNull()))


#: Characters that Unicode keeps out of texts: they set off what ``Landmarks`` writes into a text. If a text holds them
#: nevertheless, they are taken for other characters while places are found.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"


class Landmarks:
    """Where marks stand in a text, each followed by a space or the end: found by one pattern in one pass over the text.

    For many marks of which much is asked; a few questions about frequent words are better put to ``section`` and
    ``first_landmark``, which stop at the first place. The pattern looks at spaces alone, and there at what stands before.

    ``found`` is an array of structs: for the text's beginning and for each mark, in order, the mark (null for the
    beginning) and the number of characters from there to the next mark's end. It is best a column of its own; all else is
    read from it. A mark's number is its place in the array; null is the number of a missing one.
    """

    def __init__(self, marks: Sequence[str]):
        self.marks = tuple(dict.fromkeys(marks))
        if any(m != x and f"{m} " in f"{x} " for m in self.marks for x in self.marks):
            raise ValueError("a mark may not stand inside another one")
        by_size = [[m for m in self.marks if len(m) == n] for n in sorted({len(m) for m in self.marks})]
        self.pattern = r"(?= |\z)(?:" + "|".join("(?<=(" + "|".join(rf"\Q{m}\E" for m in own) + "))" for own in by_size) + ")"
        self._noted = _OPEN + "".join(f"${i + 1}" for i in range(len(by_size))) + _CLOSE

    def found(self, text: Column) -> Column:
        clean = F.when(text.contains(_OPEN) | text.contains(_CLOSE), F.translate(text, _OPEN + _CLOSE, "\ufffd\ufffd")).otherwise(text)
        parts = F.split(F.regexp_replace(clean, self.pattern, self._noted), _OPEN)
        return F.transform(parts, lambda x, i: F.struct(F.when(i > 0, F.substring_index(x, _CLOSE, 1)).alias("mark"), F.length(F.substring_index(x, _CLOSE, -1)).alias("size")))

    # Each of these takes numbers that are columns of their own: they are used several times.

    @staticmethod
    def first(found: Column, marks: Sequence[str]) -> Column:
        """The number of the first of the marks."""
        places = [F.nullif(F.array_position(found["mark"], m), F.lit(0).cast("long")) for m in marks]
        return (F.least(*places) if len(places) > 1 else places[0]).cast("int")

    @staticmethod
    def next(found: Column, number: Column, marks: Sequence[str]) -> Column:
        """The number of the first of the marks behind the numbered one."""
        return F.array_min(F.transform(found, lambda x, i: F.when((i >= number) & x["mark"].isin(*marks), i + 1)))

    @staticmethod
    def end(found: Column, number: Column) -> Column:
        """The place behind the numbered mark."""
        return F.aggregate(F.slice(found["size"], F.lit(1), number - 1), F.lit(1), lambda a, x: a + x)

    @classmethod
    def start(cls, text: Column, found: Column, number: Column) -> Column:
        """The place of the numbered mark; one past the end of the text for null."""
        return F.coalesce(cls.end(found, number) - F.length(F.get(found["mark"], number - 1)), F.length(text) + 1)


def classify(text: Column, rules: Sequence[tuple[str, Sequence[Sequence[str]]]], otherwise: str) -> Column:
    """The first rule of which every group has a marker in the text."""
    out = F.lit(otherwise)
    for name, groups in reversed(rules):
        fits = F.lit(True)
        for group in groups:
            some = F.lit(False)
            for marker in group:
                some = some | text.contains(marker)
            fits = fits & some
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def first_contained(text: Column, names: Sequence[str], otherwise: str) -> Column:
    return classify(text, [(n, [[n]]) for n in names], otherwise)


def has_term(text: Column, term: str, longer: Sequence[str] = ()) -> Column:
    """Whether ``term`` occurs other than as the start of one of the longer terms."""
    if not longer:
        return text.contains(term)
    rest = "|".join(rf"\Q{x[len(term):]}\E" for x in longer)
    return text.rlike(rf"\Q{term}\E(?!{rest})")


def terms_found(text: Column, dictionary: Sequence[tuple[str, str]], exclusions: Mapping[str, Sequence[str]] = {}) -> Column:
    """Names of the dictionary's terms that occur, in dictionary order."""
    found = F.array(*(F.when(has_term(text, term, exclusions.get(term, ())), F.lit(name)) for name, term in dictionary))
    return F.filter(found, lambda x: x.isNotNull())


def snippet(text: Column, term: Column, radius: int = 80, fallback: int = 240) -> Column:
    """Text around the first raw occurrence of a term; the beginning where it does not occur. Stripped."""
    at = F.call_function("locate", term, text, F.lit(1))
    start = F.greatest(F.lit(1), at - radius)
    around = F.substring(text, start, at + F.length(term) + radius - start)
    return strip(F.when(at > 0, around).otherwise(F.substring(text, F.lit(1), F.lit(fallback))))


def last_match(text: Column, pattern: str) -> Column:
    return F.coalesce(F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(-1)), F.lit(""))


def last_match_in_runs(text: Column, pattern: str, characters: str, ending: str) -> Column:
    """``last_match`` of a slow pattern that takes nothing but ``characters`` and always stops at ``ending``.

    A quick pattern finds the runs of such characters up to their last ending; the slow one reads these alone.
    """
    runs = F.regexp_extract_all(text, F.lit(f"(?U)(?<!{characters}){characters}*{ending}"), F.lit(0))
    found = F.filter(F.transform(runs, lambda x: last_match(x, pattern)), lambda x: x != "")
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def present(c: Column) -> Column:
    """Neither blank nor a dash."""
    return ~strip(F.coalesce(c, F.lit(""))).isin("", "-")


def join_present(*columns: Column) -> Column:
    return F.array_join(F.filter(F.array(*columns), lambda x: x != ""), " ")


def short_hash(*columns: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *columns), 256), 1, 8)


def content_hash(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *columns), 256)


def amount(c: Column) -> Column:
    """Thousands separators; two decimals where there is a point; a dash for nothing; other text as it is."""
    plain = F.regexp_replace(strip(c), ",", "")
    whole = plain.rlike(r"^[+-]?\d+\z")
    number = plain.rlike(r"^[+-]?(\d+\.\d*|\.\d+)\z")
    return F.when(c.isNull() | strip(c).isin("", "-"), "-").when(whole, F.format_number(plain.try_cast("decimal(38,0)"), 0)).when(number, F.format_number(plain.try_cast("double"), 2)).otherwise(c)


def hide_parameter(c: Column, name: str, instead: str = "***") -> Column:
    """Masks the value of a query parameter in urls and messages."""
    return F.regexp_replace(c, rf"{name}=[^&\s]*", f"{name}={instead}")


def hide_value(c: Column, secret: str, instead: str = "***") -> Column:
    """Masks a secret wherever it stands; an empty secret masks nothing."""
    return F.replace(c, F.lit(secret), F.lit(instead)) if secret else c


def hide_key(parameters: Column, name: str, instead: str = "***") -> Column:
    """Masks the value of one key in a map of parameters."""
    return F.transform_values(parameters, lambda k, v: F.when(k == name, F.lit(instead)).otherwise(v))


def account_name(name: Column, detail: Column) -> Column:
    """An account's name, indented and with its detail in brackets where there is one."""
    return F.when(~F.coalesce(detail, F.lit("")).isin("", "-"), F.concat(F.lit("  "), name, F.lit(" ("), detail, F.lit(")"))).otherwise(name)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
