"""Operator 10: personal data replaced by keyed, type-consistent surrogates.

Detected entities (e-mail and IP addresses, phone, card, account and social security
numbers, names behind an honorific) get surrogates that depend on nothing but the key,
the kind and the entity: one entity has one surrogate in every document, so mentions
still refer to the same thing, and no table of entities is needed to write the texts.
A surrogate keeps the format (length, case, separators, country code, check digit,
address range), the script of every letter and, for names, the gender of the given name.

Within a kind and shape the mapping is one to one and nothing is its own surrogate: the
entities of a shape (every letter of any script has an alphabet) lie on one keyed cycle,
and a surrogate is the next entity on it, or the next one that the kind allows (a host
with the same kept end, an address in the same range, a name that isn't a listed given
name); listed given names lie on a cycle of their list. Shapes stay, so surrogates of
different shapes differ too. ``collisions`` checks this on the corpus: distinct entities
against their surrogates; ``masked`` refuses to write if that proves wrong.

Defined results: a null text stays null, texts without entities stay as they are, equal
rows are replaced alike, an empty table stays empty; all columns of the input pass
through, whatever their names.
"""

from __future__ import annotations

import hmac
import math
import re
import sys
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Alphabets, honorifics and given names.
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "áéíóú", "ÁÉÍÓÚ", "àèìòù", "ÀÈÌÒÙ", "äöü", "ÄÖÜ", "çñ", "ÇÑ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
GIVEN = (
    ("Anna", "Clara", "Diane", "Elena", "Emma", "Helen", "Ingrid", "Julia", "Laura", "Maria", "Nora", "Paula", "Sarah", "Sofia", "Teresa", "Ursula"),
    ("Adam", "Bruno", "Carlos", "Daniel", "David", "Felix", "Hugo", "Ivan", "James", "John", "Karl", "Louis", "Martin", "Oscar", "Peter", "Thomas"),
    ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
    ("Борис", "Виктор", "Иван", "Игорь", "Олег", "Павел", "Пётр", "Юрий"),
)
HONORIFICS = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora", "Господин", "Госпожа")
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?!\.?\w)",
    "card": r"(?<![\w.])[0-9]{4}(?:([ -]?)[0-9]{4})(?:\1[0-9]{4}){2}(?!\w)|(?<![\w.])3[47][0-9]{13}(?!\w)",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w.+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}(?!\w)"
             r"|(?<![\w.+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?!\w)",
    "name": r"(?<!\w)(?:" + "|".join(HONORIFICS) + r")\.?\x20(?P<name>[^\W\d_]+(?:[\x20-][^\W\d_]+){0,2})",
}
#: A text without the hint can't hold the kind.
HINTS = {"email": "@", "ip": ".", "ssn": "-", "phone": None, "card": None, "iban": None, "name": None}
DIGITS = ("iban", "ip", "card", "ssn", "phone")
PLACE = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}
MARKS = "._%+-"


@cache
def other_letters() -> dict[str, tuple[str, int]]:
    """Alphabets of all letters (as names may hold) that ``ALPHABETS`` doesn't list: by script, category and block of 128.

    What would be alone in its alphabet goes by script and category, then with all that is left.
    """
    left = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isdecimal() and c not in PLACE]
    script = lambda c: re.split("[ -]", unicodedata.name(c, ""))[0]
    out = {}
    for key in (lambda c: (script(c), unicodedata.category(c), ord(c) >> 7), lambda c: (script(c), unicodedata.category(c)), lambda c: 0):
        groups = defaultdict(list)
        for c in left:
            groups[key(c)].append(c)
        left = [c for g in groups.values() if len(g) < 2 for c in g]
        for g in groups.values():
            if len(g) > 1:
                alphabet = "".join(g)
                out.update((c, (alphabet, i)) for i, c in enumerate(g))
    return out


def placed(c: str) -> tuple[str, int] | None:
    """Alphabet of a character and its place in it."""
    return PLACE.get(c) or (other_letters().get(c) if c > "\x7f" else None)


class Surrogates:
    """Detects entities and makes their surrogates, by one key."""

    def __init__(self, key: bytes):
        self.key = key
        self.patterns = {k: re.compile(p) for k, p in KINDS.items()}
        self.some_digit, self.some_title = re.compile("[0-9]"), re.compile("|".join(HONORIFICS))
        self.of = lru_cache(maxsize=50_000)(self._of)

    def _number(self, *parts: str) -> int:
        return int.from_bytes(hmac.digest(self.key, "\0".join(parts).encode(), "sha256")[:8], "big")

    # -- one-to-one building blocks ------------------------------------------------
    def _pass(self, tag: str, digits: list[int], sizes: list[int], sign: int = 1) -> list[int]:
        """Each digit moved by an amount that depends on the (unmoved) digits before it; ``sign`` -1 takes it back."""
        out: list[int] = []
        before = digits if sign > 0 else out
        h = hmac.new(self.key, tag.encode(), "sha256")
        for i, (d, n) in enumerate(zip(digits, sizes, strict=True)):
            out.append((d + sign * int.from_bytes(h.digest()[:8], "big")) % n)
            h.update(b",%d" % before[i])
        return out

    def cycled(self, tag: str, digits: list[int], sizes: list[int]) -> list[int]:
        """The next number on one keyed cycle through all numbers with these digit sizes.

        A keyed permutation, a step that has no divisor in common with their count, and the
        permutation taken back: one to one, and no number is its own next one.
        """
        total = math.prod(sizes)
        if total < 2:
            return digits
        back = self._pass(tag + "/back", digits[::-1], sizes[::-1])[::-1]
        at = 0
        for d, n in zip(self._pass(tag + "/forth", back, sizes), sizes, strict=True):
            at = at * n + d
        step = int.from_bytes(hmac.digest(self.key, (tag + "/step").encode(), "sha512"), "big") % total
        while math.gcd(step, total) != 1:
            step += 1
        at = (at + step) % total
        new = []
        for n in reversed(sizes):
            at, d = divmod(at, n)
            new.append(d)
        back = self._pass(tag + "/forth", new[::-1], sizes, -1)
        return self._pass(tag + "/back", back[::-1], sizes[::-1], -1)[::-1]

    def shifted(self, tag: str, s: str, place=None) -> str:
        """Another string of the same shape, one to one; characters without an alphabet stay."""
        at = [(place or placed)(c) for c in s]
        shape = "\0".join(c if p is None else p[0] for c, p in zip(s, at, strict=True))
        new = iter(self.cycled(f"{tag}/{shape}", [p[1] for p in at if p], [len(p[0]) for p in at if p]))
        return "".join(c if p is None else p[0][next(new)] for c, p in zip(s, at, strict=True))

    # -- kinds ---------------------------------------------------------------------
    @staticmethod
    def _kept(domain: str) -> str:
        """The end of a domain that stays."""
        low = domain.lower()
        size = next((len(z) for z in (".example.com", ".example.org", ".example.net") if low.endswith(z)), None)
        return domain[-size:] if size else domain[domain.rindex("."):]

    def _email(self, s: str) -> str:
        local, domain = s.split("@", 1)
        keep = self._kept(domain)
        # one domain has one surrogate; walks on until as much of it stays
        new = domain
        while True:
            new = self.shifted("host", new[:len(new) - len(keep)]) + keep
            if self._kept(new) == keep:
                break
        marks = None if any(map(placed, local)) else lambda c: (MARKS, MARKS.index(c))
        return self.shifted("local", local, marks) + "@" + new

    @staticmethod
    def _range(n: int) -> int:
        """Reserved ranges keep their prefix: bits of it, or 0."""
        return next((bits for net, bits in ((10, 8), (127, 8), (0xC0A8, 16), (0xAC1, 12), (0, 8)) if n >> (32 - bits) == net), 0)

    def _ip(self, s: str) -> str:
        parts = s.split(".")
        fixed = self._range(self._address(parts))
        # an octet written as 0d stays one
        sizes = [10 if len(x) > 1 and x[0] == "0" else 256 for x in parts]
        form = ["0{}" if n == 10 else "{}" for n in sizes]
        # whole octets of the range stay; in the others it walks on until it's in the same range
        stay = fixed // 8
        head, now = parts[:stay], [int(x) for x in parts[stay:]]
        tag = f"ip{fixed}/{'.'.join(head)}/{sizes}"
        while True:
            now = self.cycled(tag, now, sizes[stay:])
            new = head + [f.format(x) for f, x in zip(form[stay:], now, strict=True)]
            if self._range(self._address(new)) == fixed:
                return ".".join(new)

    @staticmethod
    def _address(parts: list[str]) -> int:
        return int.from_bytes(bytes(map(int, parts)), "big")

    @staticmethod
    def _luhn(digits: str) -> int:
        """What the check digit of these digits is."""
        total = sum(sum(divmod(int(c) * (2 if i % 2 == 0 else 1), 10)) for i, c in enumerate(reversed(digits)))
        return -total % 10

    def _card(self, s: str) -> str:
        digits = [c for c in s if c.isdigit()]
        body = "".join(digits[:-1])
        off = (int(digits[-1]) - self._luhn(body)) % 10  # 0 for a valid number
        body = body[0] + self.shifted("card", body[1:])
        return self._fill(s, body + str((self._luhn(body) + off) % 10))

    @staticmethod
    def _fill(shape: str, digits: str) -> str:
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def _phone(self, s: str) -> str:
        head = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]|", s)[0]
        digits = "".join(c for c in s[len(head):] if c.isdigit())
        return head + self._fill(s[len(head):], self.shifted("phone" + head, digits))

    def _iban(self, s: str) -> str:
        flat = s.replace(" ", "")
        value = lambda x: int("".join(str(int(c, 36)) for c in x))
        body = self.shifted("iban", flat[4:])
        right = lambda x: 98 - value(x + flat[:2] + "00") % 97
        check = (int(flat[2:4]) - right(flat[4:]) + right(body)) % 100  # right for a valid number
        it = iter(flat[:2] + f"{check:02d}" + body)
        return "".join(c if c == " " else next(it) for c in s)

    def _word(self, w: str) -> str:
        for names in GIVEN:
            if w in names:
                order = sorted(names, key=lambda x: self._number("given", x))
                return order[(order.index(w) + 1) % len(order)]  # one cycle: never itself
        new = self.shifted("name", w)
        while any(new in names for names in GIVEN):
            new = self.shifted("name", new)
        return new

    def _name(self, s: str) -> str:
        return re.sub(r"[^\W\d_]+", lambda m: self._word(m[0]), s)

    def _of(self, kind: str, value: str) -> str:
        return {"email": self._email, "ip": self._ip, "card": self._card, "phone": self._phone, "iban": self._iban,
                "ssn": lambda s: self._fill(s, self.shifted("ssn", s.replace("-", ""))), "name": self._name}[kind](value)

    # -- texts ---------------------------------------------------------------------
    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """Entities from left to right; of overlapping ones the first kind listed holds."""
        if not text:
            return []
        digit = self.some_digit.search(text) is not None
        found: list[tuple[int, int, str]] = []
        for kind, pattern in self.patterns.items():
            hint = HINTS[kind]
            if (hint and hint not in text) or (kind in DIGITS and not digit) or (kind == "name" and not self.some_title.search(text)):
                continue
            for m in pattern.finditer(text):
                start, end = m.span("name" if kind == "name" else 0)
                if kind == "name":  # of the words behind the honorific, those with a capital
                    words = re.match(r"(?:[^\W\d_]+[\x20-]?)+", text[start:end])[0]
                    end = start + len(re.match(r"(?:(?![a-zа-яà-öø-ÿ])[^\W\d_]+(?:[\x20-](?=[^\W\d_a-zа-яà-öø-ÿ]))?)*", words)[0])
                if end > start and not any(s < end and start < e for s, e, _ in found):
                    found.append((start, end, kind))
        return sorted(found)

    def replaced(self, text: str | None) -> tuple[str | None, list[tuple[int, int, str]]]:
        found = self.spans(text)
        out, at = [], 0
        for start, end, kind in found:
            out += [text[at:start], self.of(kind, text[start:end])]
            at = end
        return ("".join(out) + text[at:] if found else text), found


def masking(key: bytes):
    """A column function: text to ``struct<text, kinds>``, the surrogate text and the kinds in order."""
    @F.pandas_udf("struct<text:string,kinds:array<string>>")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = Surrogates(key)
        for b in batches:
            got = [s.replaced(t) for t in b]
            yield pd.DataFrame({"text": [t for t, _ in got], "kinds": [[k for _, _, k in f] for _, f in got]})

    return mask


def entities(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``kind, entity, surrogate``: distinct entities of the corpus."""
    @F.pandas_udf("array<struct<kind:string,entity:string,surrogate:string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = Surrogates(key)
        for b in batches:
            yield pd.Series([[{"kind": k, "entity": t[i:j], "surrogate": s.of(k, t[i:j])} for i, j, k in s.spans(t)] for t in b])

    return docs.select(F.explode(find(F.col(text_col))).alias("e")).select("e.*").distinct()


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that two entities of a kind share, and entities that are their own surrogate."""
    return found.groupBy("kind", "surrogate").agg(
        F.count("*").alias("n"), F.max(F.expr("entity = surrogate")).alias("same")).where("n > 1 or same")


def masked(docs: DataFrame, key: bytes, text_col: str = "text", check: bool = True) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text_col`` and the kinds found in ``pii_kinds`` (a name not yet taken)."""
    if check and (bad := collisions(entities(docs, key, text_col)).take(3)):
        raise ValueError(f"surrogates aren't distinct under this key: {bad}")
    new, kinds = f"__m{uuid.uuid4().hex}", "pii_kinds"
    while kinds in docs.columns:
        kinds += "_"
    out = docs.withColumn(new, masking(key)(F.col(text_col)))
    return out.select(*[F.col(f"{new}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], F.col(f"{new}.kinds").alias(kinds))
