"""Normalisation of names and addresses.

``Normaliser`` is plain Python, so it can be tested without Spark; :func:`normalised` applies it to a table through Arrow.
The functions after it are column expressions for parts that SQL expresses well.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft import schemas
from weft.functions import tables as t

# Sounds of the letters of the Indic blocks, which share one layout, by offset in the block.
_INDIC = {
    0x01: "n", 0x02: "n", 0x03: "h", 0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu", 0x0B: "r", 0x0E: "e", 0x0F: "e",
    0x10: "ai", 0x12: "o", 0x13: "o", 0x14: "au", 0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "ng", 0x1A: "c", 0x1B: "ch",
    0x1C: "j", 0x1D: "jh", 0x1E: "ny", 0x1F: "tt", 0x20: "tth", 0x21: "dd", 0x22: "ddh", 0x23: "nn", 0x24: "t", 0x25: "th", 0x26: "d",
    0x27: "dh", 0x28: "n", 0x29: "n", 0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "rr",
    0x32: "l", 0x33: "ll", 0x34: "lll", 0x35: "v", 0x36: "sh", 0x37: "ss", 0x38: "s", 0x39: "h", 0x3E: "aa", 0x3F: "i", 0x40: "ii",
    0x41: "u", 0x42: "uu", 0x43: "r", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au",
}
_LATIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
_MOJIBAKE = re.compile("(?:Â?|â)\x80[\x90-\x9f]|Â")
_TLD = re.compile(rf"\.(?:{'|'.join(t.TLDS)})\b")
_UNIT = re.compile(rf"(?:{'|'.join(map(re.escape, t.UNIT_PREFIXES))})(?![a-z])")
_LEGAL, _MARKERS, _SKIPPED = (frozenset(x) for x in (t.LEGAL_TOKENS, t.NAME_MARKERS, t.ADDRESS_FILLERS + t.NULL_TOKENS))
_NULLS, _US_CODES, _IN_CODES = frozenset(t.NULL_TOKENS), frozenset(t.US_STATES.values()), frozenset(t.IN_STATES.values())
_NO_NUMBER = re.compile(r"^(?:no|n|nº|n°|#)\s*(?=\d)")
_ORDINAL = re.compile(r"(\d+)(?:st|nd|rd|th)")
_DIGIT = re.compile("[0-9]")
_DOTTED = re.compile(r"\b(?:[a-z]\.){2,}[a-z]?")


def transliterated(text: str) -> str:
    """ASCII text for ``text``: marks are stripped, Indic letters spelt by sound, other characters dropped."""
    out = []
    for ch in text:
        code = ord(ch)
        if code < 128:
            out.append(ch)
        elif 0x900 <= code < 0xE00:
            out.append(_INDIC.get(code & 0x7F, str((code & 0x7F) - 0x66) if 0x66 <= code & 0x7F <= 0x6F else ""))
        elif ch.lower() in _LATIN:
            plain = _LATIN[ch.lower()]
            out.append(plain if ch == ch.lower() else plain.capitalize())
        else:
            out += [c for c in unicodedata.normalize("NFKD", ch) if ord(c) < 128]
    return "".join(out)


def script_of(text: str, first_only: bool = False) -> str:
    """Script of the first letter that isn't Latin (or of the first letter at all), else ``latin``."""
    for ch in text:
        name = unicodedata.name(ch, "").split(" ")[0] if ch.isalpha() else ""
        if name and name != "LATIN":
            return name
        if name and first_only:
            break
    return "latin"


@dataclass
class Part:
    """A comma-separated component of an address."""

    raw: str
    plain: str
    numbers: list[str] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    n_tokens: int = 0

    @property
    def is_unit(self) -> bool:
        return bool(_UNIT.match(self.raw.lower().strip().lstrip("#").strip()))

    @property
    def house(self) -> str:
        """Its first number, unless it is a unit or nothing but a postal code."""
        lone_code = len(self.numbers) == 1 and self.n_tokens == 1 and self.numbers[0].isdigit() and len(self.numbers[0]) >= 5
        return "" if self.is_unit or lone_code or not self.numbers else self.numbers[0]


class Normaliser:
    """``dictionary``: learnt spellings of non-Latin words. ``strict_country``: state codes hold in their country only."""

    def __init__(self, dictionary: dict[str, str] | None = None, strict_country: bool = False):
        self.dictionary, self.strict = dictionary or {}, strict_country

    def fold(self, text: str) -> str:
        if text.isascii():
            return text
        words = _MOJIBAKE.sub(" ", text).split()
        return " ".join(self.dictionary.get(w) or transliterated(w) for w in words)

    def name(self, raw: str | None) -> dict:
        raw = raw or ""
        text = self.fold(raw).lower()
        domain = bool(_TLD.search(text)) and " " not in text.strip().replace("www.", "")
        text = _TLD.sub(" ", text.replace("www.", " "))
        text = _DOTTED.sub(lambda m: m[0].replace(".", ""), text)
        text = re.sub(r"\b(?:[fda]/[kb]/a|t/a)\b", lambda m: " " if m[0] in ("f/k/a", "d/b/a", "a/k/a", "t/a") else m[0], text)
        for sign, word in (("&", " and "), ("+", " plus "), ("@", " at "), ("'", ""), ("’", "")):
            text = text.replace(sign, word)
        words = [self._letters_for_digits(w) for w in re.sub("[^a-z0-9]+", " ", text).split()]
        words = [w for w in words if w not in _MARKERS]
        core = [w for w in words if w not in _LEGAL] or words
        return {"name_norm": " ".join(words), "name_core": " ".join(core), "name_compact": "".join(core), "name_script": script_of(raw), "name_domain": int(domain)}

    @staticmethod
    def _letters_for_digits(word: str) -> str:
        return word.translate({48: "o", 49: "l"}) if sum(map(str.isalpha, word)) >= 3 else word

    def _plain(self, part: str) -> str:
        text = self.fold(part).lower().replace("&", " and ")
        return " ".join(re.sub("[^a-z0-9 ]+", " ", re.sub("['’]", "", text)).split())

    def state_of(self, raw: str, plain: str, country: str) -> str:
        code, india = plain.upper() if len(plain) == 2 else "", country == "India"
        us, fr = not self.strict or country == "US", not self.strict or country == "France"
        found = [
            t.IN_STATES_NATIVE.get(raw.strip()),
            code if us and not india and code in _US_CODES else None,
            t.US_STATES.get(plain) if us else None,
            t.IN_STATES.get(plain) if india or not self.strict else None,
            code if india and code in _IN_CODES else None,
            t.FR_REGIONS.get(plain) if fr else None,
        ]
        return next(filter(None, found), "") if plain else ""

    def _token(self, token: str) -> str:
        token = token.strip("-/")
        ordinal = _ORDINAL.fullmatch(token)
        return ordinal[1] if ordinal else t.NUMBER_WORDS.get(token) or t.SHORT_FORMS.get(token, token)

    def _read(self, part: Part) -> Part:
        text = _NO_NUMBER.sub("", self.fold(part.raw).lower().replace("&", " and ").replace("'", "").strip())
        tokens = re.sub(r"\b0+(?=\d)", "", re.sub(r"[^a-z0-9/\- ]+", " ", text)).split()
        part.n_tokens = len(tokens)
        for token in map(self._token, tokens):
            if _DIGIT.search(token):
                part.numbers.append(token)
            else:
                part.words += [w for w in re.split("[-/ ]+", token) if w and w not in _SKIPPED]
        return part

    def address(self, raw: str | None, country: str) -> dict:
        parts = [Part(c.strip(), self._plain(c)) for c in _MOJIBAKE.sub(" ", raw or "").split(",")]
        states = [(k, s, len(p.plain) == 2) for k, p in enumerate(parts) if (s := self.state_of(p.raw, p.plain, country))]
        at, state, _ = max(states, key=lambda x: (x[2], x[0]), default=(-1, "", False))
        read = [self._read(p) for k, p in enumerate(parts) if k != at and p.plain and p.plain not in _NULLS]
        words, numbers = (" ".join(dict.fromkeys(x for p in read for x in getattr(p, kind))) for kind in ("words", "numbers"))
        house = next((p.house for p in read if p.house), "")
        return {"addr_norm": words, "addr_nums": numbers, "house_no": house, "state": state, "addr_missing": int(not words and not numbers)}

    def record(self, entity_id: str, name: str | None, address: str | None, country: str | None) -> dict:
        return {"entity_id": entity_id, "country": country or ""} | self.name(name) | self.address(address, country or "")


def normalised(raw: DataFrame, dictionary: dict[str, str] | None = None, strict_country: bool = False) -> DataFrame:
    """Records of :data:`weft.schemas.RECORD` for raw rows. Nulls count as empty strings."""
    work = Normaliser(dictionary, strict_country)
    columns = schemas.RAW.names
    types = [pa.int8() if f.dataType.typeName() == "byte" else pa.string() for f in schemas.RECORD.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work.record(*values) for values in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(schemas.RECORD.names, types, strict=True)], names=schemas.RECORD.names)

    return schemas.require(raw, schemas.RAW).na.fill("").mapInArrow(run, schemas.RECORD)


# -- Column expressions ------------------------------------------------------------------------------------------------


def tokens(text: Column) -> Column:
    """White-space tokens; none for an empty text."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda x: x != "")


def plain_words(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def unaccented(text: Column) -> Column:
    """Latin letters without the accents of French, German and Spanish."""
    # Accented letters and their plain forms, place by place.
    return F.translate(F.replace(text, F.lit("ß"), F.lit("ss")), "àâäáãçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ", "aaaaaceeeeiiiinooooouuuuyyAAAAACEEEEIIIINOOOOOUUUUY")


def is_domain(text: Column) -> Column:
    bare = F.replace(F.trim(text), F.lit("www."), F.lit(""))
    return (text.rlike(rf"\.({'|'.join(t.TLDS)})\b") & (F.instr(bare, " ") == 0)).cast("int")


def without_domain(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("www."), F.lit(" ")), rf"\.({'|'.join(t.TLDS)})\b", " ")


def joined_acronyms(text: Column) -> Column:
    """``l.l.c.`` becomes ``llc``."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\b(?:[a-z]\.){2,}[a-z]?|(?s:.))"), F.lit(1))
    return F.concat_ws("", F.transform(pieces, lambda p: F.when(F.length(p) > 1, F.replace(p, F.lit("."), F.lit(""))).otherwise(p)))


def letters_for_digits(words: Column) -> Column:
    """0 and 1 inside words of three letters or more become o and l."""
    letters = lambda w: F.length(F.regexp_replace(w, "[^a-z]", ""))
    return F.transform(words, lambda w: F.when(letters(w) >= 3, F.translate(w, "01", "ol")).otherwise(w))


def without_legal_forms(words: Column) -> Column:
    kept = F.filter(words, lambda w: ~w.isin(t.LEGAL_TOKENS))
    return F.when(F.size(kept) > 0, kept).otherwise(words)


def short_forms(words: Column) -> Column:
    """Address words in short form; fillers and null words dropped, first occurrences kept in order."""
    forms = F.create_map(*(F.lit(x) for pair in t.SHORT_FORMS.items() for x in pair))
    short = F.transform(words, lambda w: F.coalesce(forms[w], w))
    return F.array_distinct(F.filter(short, lambda w: (w != "") & ~w.isin(t.ADDRESS_FILLERS + t.NULL_TOKENS)))


def block_state(state: Column) -> Column:
    """The state under which a record is blocked."""
    out = state
    for old, new in t.BLOCK_MERGE.items():
        out = F.when(state == old, new).otherwise(out)
    return out


def script_column(text: Column) -> Column:
    """Script of the first letter outside Latin, by Unicode block."""
    first = F.regexp_extract(text, r"([\p{L}&&[^\p{IsLatin}]])", 1)
    names = {"DEVANAGARI": "Devanagari", "BENGALI": "Bengali", "GURMUKHI": "Gurmukhi", "GUJARATI": "Gujarati", "ORIYA": "Oriya", "TAMIL": "Tamil", "TELUGU": "Telugu", "KANNADA": "Kannada", "MALAYALAM": "Malayalam", "ARABIC": "Arabic", "CYRILLIC": "Cyrillic", "GREEK": "Greek", "HEBREW": "Hebrew"}
    out = F.when(first == "", "latin")
    for name, script in names.items():
        out = out.when(first.rlike(rf"\p{{Is{script}}}"), name)
    return out.otherwise("OTHER")
