"""Personal data replaced by format-preserving pseudonyms.

Values are found by pattern, validated, brought into a canonical form, and permuted by a keyed Feistel network inside
their own format: a value always gets the same pseudonym in every document, two values never share one, no value is its
own pseudonym, and whoever holds the key can go back. Card numbers keep their separators and stay valid under the Luhn
check, IBANs under their check digits; dates stay dates between 1900 and 2099, in the same notation; addresses stay IPv4
addresses; social security numbers stay in the ranges that are given out; telephone numbers keep country code and layout;
mail addresses keep their domain, and letters and digits of the local part stay letters and digits. What fails
validation stays as it is.

The canonical form is what links notations of one value: mail addresses are compared without regard to case, telephone
numbers as country and national digits (a number without country code is one of ``HOME_COUNTRY``), cards, IBANs and
dates by their digits. The pseudonym is written in the notation of the place where the value stood.

Defined results: a null text stays null, an empty one empty; a null id stays null; equal rows become equal rows; an empty
table gives no rows; other columns are not read by ``pseudonymise`` and are kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import annotate, pieces
from .columns import by_place

ROUNDS = 10
KINDS = ("card", "date", "ip", "phone", "email", "iban", "ssn")
#: Country code of telephone numbers that are written without one.
HOME_COUNTRY = "1"
#: What may be one of the kinds, in the order in which they are tried at a position.
PATTERN = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d))"
    r"|(?P<date>(?<![\d/.-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![\d/]|[.-]\d))"
    r"|(?P<phone>(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.])(?:\d{13,19}|\d{4}(?P<between>[ -])\d{4}(?P=between)\d{4}(?P=between)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d))",
    re.ASCII,
)
MIGHT = re.compile(r"[0-9@]")
_FIRST, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


class Feistel:
    """A keyed permutation of 0 .. size - 1 for each (kind, size): rounds over bits, walked until inside the range."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _round(self, kind: str, size: int, step: int, half: int, bits: int) -> int:
        said = f"{kind}:{size}:{step}:{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=(bits + 7) // 8).digest()) & ((1 << bits) - 1)

    def _once(self, kind: str, size: int, x: int, back: bool) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        left, right = x >> half, x & ((1 << half) - 1)
        for step in reversed(range(self.rounds)) if back else range(self.rounds):
            if back:
                left, right = right ^ self._round(kind, size, step, left, half), left
            else:
                left, right = right, left ^ self._round(kind, size, step, right, half)
        return left << half | right

    def _walked(self, kind: str, size: int, x: int, back: bool) -> int:
        while True:
            x = self._once(kind, size, x, back)
            if x < size:
                return x

    def __call__(self, kind: str, size: int, x: int, back: bool = False) -> int:
        """The successor (``back``: predecessor) of x in a keyed order of all values: a permutation without fixed points."""
        if size < 2:
            return x
        return self._walked(kind, size, (self._walked(kind, size, x, False) + (-1 if back else 1)) % size, True)


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(it), shape)


def _card(value: str, permute: Callable) -> str | None:
    digits = re.sub(r"[^0-9]", "", value)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = str(permute("card", 10 ** (len(digits) - 1), int(digits[:-1]))).zfill(len(digits) - 1)
    return _refill(value, body + luhn_digit(body))


def _date(value: str, permute: Callable) -> str | None:
    separator = value[4] if value[4] in "-/" else value[2]
    parts = value.split(separator)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)
    year, month, day = (int(parts[i]) for i in order)
    if separator == "/" and order[0] == 2 and month > 12 >= day:
        order, month, day = (2, 0, 1), day, month
    try:
        number = (date(year, month, day) - _FIRST).days
    except ValueError:
        return None
    if not 0 <= number < _DAYS:
        return None
    made = _FIRST + timedelta(permute("date", _DAYS, number))
    new = dict(zip(order, (f"{made.year:04d}", f"{made.month:02d}", f"{made.day:02d}")))
    return separator.join(new[i] for i in range(3))


def _ip(value: str, permute: Callable) -> str | None:
    octets = [int(x) for x in value.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return None
    number = permute("ip", 1 << 32, int.from_bytes(bytes(octets)))
    return ".".join(map(str, number.to_bytes(4)))


def _phone(value: str, permute: Callable) -> str | None:
    country = re.match(r"\+[0-9]{1,3}(?=[^0-9])|\+1|\+[0-9]{2}", value)
    head = country[0] if country else ""
    code, digits = head[1:] or HOME_COUNTRY, re.sub(r"[^0-9]", "", value[len(head) :])
    if not 7 <= len(digits) <= 15 - len(code) or code.startswith("0") or (code == "1" and len(digits) != 10) or len(set(digits)) == 1:
        return None
    return head + _refill(value[len(head) :], str(permute("phone" + code, 10 ** len(digits), int(digits))).zfill(len(digits)))


def _ssn(value: str, permute: Callable) -> str | None:
    area, group, serial = (int(x) for x in value.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute("ssn", 898 * 99 * 9999, number), 9999)
    area, group = divmod(number, 99)
    return f"{area + 1 + (area + 1 > 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _letters(shape: str, text: str, kind: str, permute: Callable) -> str | None:
    """Digits stay digits and letters letters, in lower case; all else stays. Null where there is nothing to permute."""
    small, digits, size, number = "abcdefghijklmnopqrstuvwxyz", "0123456789", 1, 0
    radix = [10 if c in digits else 26 if c in small else 1 for c in text]
    for c, r in zip(text, radix):
        if r > 1:
            number, size = number * r + (int(c) if r == 10 else small.index(c)), size * r
    if size < 2:
        return None
    number, out = permute(kind + shape, size, number), []
    for c, r in zip(reversed(text), reversed(radix)):
        if r > 1:
            number, x = divmod(number, r)
            c = str(x) if r == 10 else small[x]
        out.append(c)
    return "".join(reversed(out))


def _shape(text: str) -> str:
    return re.sub("[a-z]", "a", re.sub("[0-9]", "9", text))


def iban_check(country: str, rest: str) -> str:
    """The two check digits of an IBAN."""
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(value: str, permute: Callable) -> str | None:
    plain = value.replace(" ", "")
    country, rest = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_check(country, rest) != plain[2:4]:
        return None
    made = _letters(_shape(rest.lower()), rest.lower(), f"iban{country}", permute)
    made = country + iban_check(country, made.upper()) + made.upper()
    it = iter(made)
    return "".join(" " if c == " " else next(it) for c in value)


def _email(value: str, permute: Callable) -> str | None:
    local, _, domain = value.rpartition("@")
    labels = domain.split(".")
    if len(local) > 64 or len(domain) > 253 or local[0] == "." or local[-1] == "." or ".." in local or any(not x or len(x) > 63 or x[0] == "-" or x[-1] == "-" for x in labels):
        return None
    plain = local.lower()
    made = _letters(_shape(plain), plain, f"email@{domain.lower()}:", permute)
    return made and "".join(m.upper() if c.isupper() else m for c, m in zip(local, made)) + "@" + domain


_MAKERS = {"card": _card, "date": _date, "ip": _ip, "phone": _phone, "email": _email, "iban": _iban, "ssn": _ssn}


class Pseudonyms:
    """Replaces values in texts; ``back=True`` restores them."""

    def __init__(self, key: bytes, back: bool = False, cached: int = 100_000):
        permute = Feistel(key)
        self._made = lru_cache(maxsize=cached)(lambda kind, value: _MAKERS[kind](value, lambda k, size, x: permute(k, size, x, back)))

    def __call__(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The new text, and kind, start and end (code points of the old text) of what was replaced."""
        if not text or not MIGHT.search(text):
            return text, []
        out, at, spans = [], 0, []
        for m in PATTERN.finditer(text):
            made = self._made(m.lastgroup, m[0])
            if made is not None:
                out += [text[at : m.start()], made]
                at = m.end()
                spans.append((m.lastgroup, m.start(), at))
        return "".join([*out, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the new text, how many values of each kind were replaced, and where they were."""

    def make():
        replace = Pseudonyms(key)

        def apply(texts):
            made = [replace(t) for t in texts]
            counts = [pa.array([sum(k == kind for k, _, _ in spans) for _, spans in made], pa.int64()) for kind in KINDS]
            return [pa.array([t for t, _ in made], pa.string()), *counts, pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in spans) for _, spans in made], pa.string())]

        return apply

    return annotate(docs, make, "text string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string", [], id_col, text_col)


def mask(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, with pseudonyms in their texts."""
    names, docs = docs.columns, by_place(docs, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = Pseudonyms(key)
        for batch, texts in pieces(batches, text_col):
            yield batch.set_column(at, batch.schema.field(at), pa.array([replace(t)[0] for t in texts], batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema).toDF(*names)
