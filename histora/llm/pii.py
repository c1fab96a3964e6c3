"""Surrogates for personal data: every detected entity gets a keyed replacement of its own kind and format.

A surrogate is a keyed permutation of the entity within the set of texts of the same kind and shape: digits
stay digits, letters stay letters of the same script (vowels vowels, consonants consonants in names), signs and
case stay where they are, a card number that passes its check digit still does, an address stays an address,
a listed first name becomes a listed first name of the same gender. A permutation maps distinct entities to
distinct surrogates and the same entity to the same surrogate in every document, task and run with the key, so
neither a table of replacements nor a shuffle is needed; ``checked`` asserts it over a stored result. The
permutation of a set with more than one member has no fixed point, so no entity is left as it was.

Kinds: email, ip, phone, card (only with a right check digit), ssn, iban, secret (keys and tokens), name (announced by a title; other mentions
of the name or of any of its words in the document follow, each word with the same surrogate). Defined cases: null stays null, texts without entities are returned
as they are, the leftmost and longest of overlapping candidates wins, repeated rows are treated alike, other
columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.llm.common import fresh, ship, stored

KEY = b"histora surrogate key"
_ROUNDS = 32

# Titles with the gender they tell, and first names by script and gender.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra",
          "Госпожа", "Κυρία"),
    "": ("Dr", "Prof", "Professor", "Doctor"),
}
FIRST_NAMES = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "David", "Thomas", "Daniel", "Paul", "Peter", "Martin",
                     "Hans", "Klaus", "Jean", "Pierre", "Luc", "Carlos", "Juan", "Pablo", "Luis", "Marco"),
    ("latin", "f"): ("Mary", "Anna", "Linda", "Susan", "Karen", "Laura", "Julia", "Sarah", "Emma", "Alice",
                     "Greta", "Heidi", "Claire", "Sophie", "Marie", "Carmen", "Lucia", "Elena", "Rosa", "Paula"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Николай", "Павел", "Борис"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Вера"),
}
_ALPHABETS = (
    ("latin", "aeiou", "bcdfghjklmnpqrstvwxyz"),
    ("accented", "áàâäãåéèêëíìîïóòôöõúùûü", "çñßýÿ"),
    ("cyrillic", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь"),
    ("greek", "αεηιουωάέήίόύώ", "βγδζθκλμνξπρςστφχψ"),
)
_SETS = [s for _, v, c in _ALPHABETS for s in (v, c)]
_SET_OF = {ch: s for s in _SETS for ch in s}
_DIGITS, _LETTERS, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"

_NAME_WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω][a-zà-öø-ÿа-яёα-ωά-ώ]+(?:[-'’][A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)?"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_NAME = re.compile(rf"(?<!\w)({_TITLE})(\.? )({_NAME_WORD}(?: {_NAME_WORD}){{0,2}})")
_EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+\-]+\Z")
_EMAIL_RIGHT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)+")
_SECRET = re.compile(r"(?<![0-9A-Za-z_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64}"
                     r"|(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{32,128})(?![0-9A-Za-z_])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
# What begins with a digit, a plus or a bracket, by kind; the first that fits at a place is taken.
_NUMBERS = (
    ("ip", re.compile(r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
                      r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\.?[0-9])")),
    ("ssn", re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}(?![0-9])")),
    ("phone", re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])")),
    ("card", re.compile(r"(?:[2-6][0-9]{3}(?:[ \-]?[0-9]{4}){3}|3[47][0-9]{2}[ \-]?[0-9]{6}[ \-]?[0-9]{5}"
                        r"|[2-6][0-9]{12,18})(?![0-9A-Za-z])")),
)
_NUMBER_START = re.compile(r"(?<![0-9A-Za-z.+])(?:\+|\()?[0-9]")
_ANY = re.compile(rf"[0-9@]|(?<!\w)(?:{_TITLE})\.? ")


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, ch in enumerate(reversed(digits)):
        x = int(ch) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def passes_luhn(text: str) -> bool:
    digits = "".join(ch for ch in text if ch in _DIGITS)
    return luhn(digits[:-1]) == int(digits[-1])


class Permuter:
    """Keyed permutations of texts within their own kind and shape."""

    def __init__(self, key: bytes):
        self.key = key
        self.surrogate = lru_cache(maxsize=1 << 16)(self._surrogate)

    def _round(self, tag: str, size: int, r: int, value: int) -> int:
        """x and k - x change places by a keyed bit of the two: its own inverse."""
        width = min(64, (size.bit_length() + 7) // 8 + 8)
        head = hashlib.blake2b(f"{tag}|{size}|{r}".encode(), key=self.key[:64], digest_size=width).digest()
        other = (int.from_bytes(head, "big") - value) % size
        top = max(value, other)
        bit = hashlib.blake2b(f"{tag}|{size}|{r}|{top}".encode(), key=self.key[:64], digest_size=1).digest()[0] & 1
        return other if bit else value

    def _number(self, tag: str, size: int, value: int) -> int:
        """A keyed permutation of 0 .. size-1 without fixed points: scramble, step to the next, unscramble."""
        for r in range(_ROUNDS):
            value = self._round(tag, size, r, value)
        value = (value + 1) % size
        for r in reversed(range(_ROUNDS)):
            value = self._round(tag, size, r, value)
        return value

    def apply(self, tag: str, symbols: list[str], sets: list[str]) -> list[str]:
        """``symbols[i]`` out of ``sets[i]``, permuted together as one mixed-radix number."""
        value, size = 0, 1
        for ch, s in zip(symbols, sets):
            value, size = value * len(s) + s.index(ch), size * len(s)
        image = self._number(tag, size, value)
        out = []
        for s in reversed(sets):
            image, at = divmod(image, len(s))
            out.append(s[at])
        return out[::-1]

    def shape(self, tag: str, text: str, letters=lambda ch: _LETTERS, skip: int = 0) -> str:
        """Digits and letters of ``text`` permuted in place, beyond the first ``skip`` of them."""
        at, symbols, sets = [], [], []
        for i, ch in enumerate(text):
            low = ch.lower()
            s = _DIGITS if ch in _DIGITS else letters(low) if low.isalpha() else None
            if s and low in s:
                at.append(i)
                symbols.append(low)
                sets.append(s)
        at, symbols, sets = at[skip:], symbols[skip:], sets[skip:]
        if not at:
            return text
        out = list(text)
        form = ",".join(s[0] for s in sets)      # the sets, by their first members
        for i, ch in zip(at, self.apply(f"{tag}|{form}", symbols, sets)):
            out[i] = ch.upper() if text[i].isupper() and len(ch.upper()) == 1 else ch
        return "".join(out)

    def _first_name(self, word: str) -> str | None:
        for (script, g), names in FIRST_NAMES.items():      # by its own list, so that a word has one surrogate
            if word in names:
                at = self._number(f"first|{script}|{g}", len(names), names.index(word))
                return names[at]
        return None

    def _name_word(self, word: str) -> str:
        listed = {n for names in FIRST_NAMES.values() for n in names}
        out = word
        while True:       # walk on while the image is a listed name: one-to-one on the unlisted ones
            out = self.shape("name", out, lambda ch: _SET_OF.get(ch, ""))
            if out not in listed:
                return out

    def _surrogate(self, kind: str, text: str, gender: str = "") -> str:
        if kind == "name":
            return " ".join(self._first_name(w) or self._name_word(w) for w in text.split(" "))
        if kind == "email":
            local, _, host = text.rpartition("@")
            labels = host.split(".")
            labels[:-1] = [self.shape("host", x) for x in labels[:-1]]
            return self.shape("local", local) + "@" + ".".join(labels)
        if kind == "ip":
            value = 0
            for part in text.split("."):
                value = value * 256 + int(part)
            value = self._number("ip", 1 << 32, value)
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            digits = [ch for ch in text if ch in _DIGITS]
            shift = (int(digits[-1]) - luhn("".join(digits[:-1]))) % 10
            middle = self.shape(f"card{len(digits)}{digits[0]}", "".join(digits[1:-1]))
            body = digits[0] + middle
            body += str((luhn(body) + shift) % 10)
            rest = iter(body)
            return "".join(next(rest) if ch in _DIGITS else ch for ch in text)
        if kind == "phone":
            country = re.match(r"\+[0-9]{1,3}(?=[ .\-(])", text)
            return self.shape("phone", text, skip=len(country[0]) - 1 if country else 0)
        if kind == "iban":
            return text[:2] + self.shape("iban", text[2:])
        if kind == "secret":
            if re.fullmatch(r"[0-9a-fA-F]+", text):
                case = "".join if text.lower() == text else (lambda x: "".join(x).upper()) if text.upper() == text else None
                if case:
                    return case(self.apply(f"hex{len(text)}", list(text.lower()), [_HEX] * len(text)))
            head = next((p for p in ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-") if text.startswith(p)), "")
            return head + self.shape("secret", text[len(head):])
        return self.shape(kind, text)


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, gender) of the entities, leftmost first and without overlaps."""
    if not _ANY.search(text):
        return []
    found: list[tuple[int, int, str, str]] = []
    at = text.find("@")
    while at >= 0:
        left = _EMAIL_LEFT.search(text, max(0, at - 128), at)
        right = _EMAIL_RIGHT.match(text, at + 1)
        if left and right:
            found.append((left.start(), right.end(), "email", ""))
        at = text.find("@", at + 1)
    for m in _NUMBER_START.finditer(text):
        for kind, pattern in _NUMBERS:
            hit = pattern.match(text, m.start())
            if hit and (kind != "card" or passes_luhn(hit[0])):
                found.append((hit.start(), hit.end(), kind, ""))
                break
    found.extend((m.start(), m.end(), "secret", "") for m in _SECRET.finditer(text))
    found.extend((m.start(), m.end(), "iban", "") for m in _IBAN.finditer(text) if sum(map(str.isdigit, m[0])) >= 8)
    names: dict[str, str] = {}
    for m in _NAME.finditer(text):
        found.append((m.start(3), m.end(3), "name", _GENDER[m[1]]))
        words = m[3].split(" ")
        names.setdefault(m[3], _GENDER[m[1]])
        for word in words:
            names.setdefault(word, _GENDER[m[1]])
    if names:      # mentions without the title
        again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        found.extend((m.start(), m.end(), "name", names[m[0]]) for m in again.finditer(text))
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], 0
    for span in found:
        if span[0] >= end:
            out.append(span)
            end = span[1]
    return out


def replace(text: str, permuter: Permuter) -> tuple[str, list[tuple[str, int, int, str]]]:
    """(text with surrogates, [(kind, start and end in the given text, surrogate)])."""
    spans = detect(text)
    if not spans:
        return text, []
    parts, done, listed = [], 0, []
    for start, end, kind, gender in spans:
        surrogate = permuter.surrogate(kind, text[start:end], gender)
        parts += [text[done:start], surrogate]
        listed.append((kind, start, end, surrogate))
        done = end
    parts.append(text[done:])
    return "".join(parts), listed


ENTITY = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType())
                     .add("end", T.IntegerType()).add("surrogate", T.StringType()))


def pseudonymise(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY, entities: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``entities`` names a further column listing what was replaced.

    One pass without a shuffle; all other columns stay as they are, whatever their names.
    """
    ship(docs.sparkSession)

    @F.pandas_udf(T.StructType().add("text", T.StringType()).add("entities", ENTITY))
    def surrogates(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        permuter = Permuter(key)
        for batch in texts:
            rows = [replace(t, permuter) if t is not None else (None, []) for t in batch.tolist()]
            yield pd.DataFrame({"text": [r[0] for r in rows],
                                "entities": [[dict(zip(("kind", "start", "end", "surrogate"), e)) for e in r[1]] for r in rows]})

    own = fresh(docs.columns, "surrogates")
    done = docs.withColumn(own, surrogates(F.col(text_col)))
    kept = [done[own]["text"].alias(c) if c == text_col else done[c] for c in docs.columns]
    return done.select(*kept, *([done[own]["entities"].alias(entities)] if entities else []))


def surrogate_collisions(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """(kind, surrogate, originals): surrogates that stand for more than one entity; must be empty."""
    out = pseudonymise(docs.select(F.col(text_col).alias("text"), F.col(text_col).alias("original")), key=key,
                       entities="found")
    spans = out.select("original", F.explode("found").alias("e")).select(
        "e.kind", "e.surrogate", F.expr("substring(original, e.start + 1, e.end - e.start)").alias("entity"))
    return (spans.groupBy("kind", "surrogate").agg(F.min("entity").alias("least"), F.max("entity").alias("most"))
            .where("lower(least) <> lower(most)"))


def checked(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY, entities: str | None = None) -> DataFrame:
    """``pseudonymise``, stored; fails if in the stored result a surrogate stands for more than one entity.

    Of the given entities only digests are stored for the check.
    """
    listed = entities or fresh(docs.columns, "entities")
    given = fresh([*docs.columns, listed], "digests")
    out = pseudonymise(docs.withColumn(given, F.col(text_col)), text_col=text_col, key=key, entities=listed)
    digest = F.expr(f"transform(`{listed}`, e -> xxhash64(lower(substring(`{given}`, e.start + 1, e.end - e.start))))")
    out = stored(out.withColumn(given, digest), "pii-checked")
    pairs = (out.select(F.explode(F.arrays_zip(F.col(f"{listed}.kind").alias("kind"), F.col(f"{listed}.surrogate")
                                               .alias("surrogate"), F.col(given).alias("entity"))).alias("e"))
             .select("e.*"))
    twice = (pairs.groupBy("kind", "surrogate").agg(F.min("entity").alias("least"), F.max("entity").alias("most"))
             .where("least <> most").select("kind", "surrogate").take(5))
    if twice:
        raise ValueError(f"surrogates that stand for more than one entity: {[tuple(r) for r in twice]}")
    return out.select(*docs.columns, *([listed] if entities else []))
