"""Personal information inside free text (problem 6).

Each text runs through small transducers that undo disguises: look-alike characters, invisible
characters, ligatures, spelled-out digits and at/dot words. They keep, for every normalised
character, the source characters it stands for, so what is found in the normalised text is cut out
of, or replaced in, the text exactly as it stands.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.sources.tables import text_table

PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[NAME]"}

#: Given names usual in Canadian submissions, English, French and others.
GIVEN_NAMES = """
abigail aisha alain alexander alexandre alice amina amy andrea andrew angela anita ann anna anne anthony antoine
barbara benjamin benoît brian camille carlos caroline catherine chantal charles charlotte chen christine christopher
claire daniel david deborah denis diane donald dorothy édouard edward elena élise elizabeth emily emma éric étienne
fatima françois frank frédéric gabrielle geneviève george gérard grace gregory guillaume hannah heather helen hélène
henry ingrid isabelle jack jacques james jane jean jennifer jessica joan john jonathan joseph josephine joshua julie
karen katherine kevin kofi laura leila linda lisa louis louise lucie luis madeleine marc margaret maria marie mark
mary mathieu mathilde matthew mei michael michel ming mohammed monique nancy nathalie nathaniel nicole noémie oksana
olga oliver olivier omar pamela patricia patrick paul peter philippe pierre priya rachel rajesh raymond rebecca
richard robert roger ruth samuel sandra sarah scott sharon simon sophie stephanie stéphanie stephen steven susan
sylvie theodore thérèse thomas timothy valérie victor victoria vincent virginia wei william yan yusuf yves zoé
"""
#: Words that make a preceding or following name part of the name of a place or body.
BODY_WORDS = "memorial hospital foundation fund centre center clinic institute school university college library street road avenue lane drive crescent boulevard way award prize scholarship trust society association pavilion wing house".split()
BODY_BEFORE = "fondation hôpital centre clinique institut école université collège rue avenue boulevard boul chemin place pavillon fonds prix bourse street hospital foundation".split()

_SINGLE = str.maketrans(
    {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    | dict.fromkeys("              　", " ")
    | dict.fromkeys("‐‑‒–—―−﹘﹣", "-")
    | dict.fromkeys("‘’ʼ", "'")
)
# Cyrillic and Greek letters that look like Latin ones.
_LOOKS = dict(zip("АВЕКМНОРСТХаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaeopcyxijsABEZHIKMNOPTYXo", strict=True))
_MIXED = re.compile(rf"(?=[\w@.+-]*[A-Za-z@])(?=[\w@.+-]*[{''.join(_LOOKS)}])[\w@.+-]+")
# Ligatures, those of damaged prints included, and invisible characters, which stand for nothing.
_WIDE = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "Ɵ": "ti"} | dict.fromkeys("­​‌‍‎‏⁠﻿", "")
_ODD = re.compile(f"[{re.escape(''.join(map(chr, _SINGLE)))}]")
_LOOKALIKE = re.compile(f"[A-Za-z@][{''.join(_LOOKS)}]|[{''.join(_LOOKS)}][A-Za-z@]")
_WIDE_RE = re.compile("|".join(map(re.escape, _WIDE)))
_DIGIT_WORDS = dict(zip("zero one two three four five six seven eight nine zéro un deux trois quatre cinq six sept huit neuf oh".split(), "01234567890123456789" + "0", strict=True))
_DIGIT_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"\b(?:{_DIGIT_WORD})(?:[\s,-]+(?:{_DIGIT_WORD}|\d)){{6,}}\b", re.I)
# Words that show that "at ... point" is prose, before and after "point", and ends of addresses.
_BEFORE_POINT = "this|that|some|one|any|what|which|the|a|an|each|every|no|such|another|ce|un|le|quel|este|ese|un|algún|o|um|esse|algum|boiling|melting|freezing|starting|turning|breaking|entry|mid|end"
_AFTER_POINT = "in|of|is|was|are|were|the|to|and|or|we|they|you|he|she|it|i|for|with|on|by|as|at|a|an|when|where|that|this|during|from|if|our|their|people|many|most|de|du|des|d|le|la|les|l|que|qu|où|et|ou|par|qui|à|au|final|sur|dans|pour|ne|en|el|los|y|se|do|da|e|na|no"
_ENDS = "ca|com|org|net|info|edu|gov|fr|es|pt|br|mx|uk|ua|cn|example|test"
_POINT = r"(?-i:point|punto|ponto)"
_BRACKETED_AT = r"[\[({<]\s*(?:at|@|arobase|arroba|chez)\s*[\])}>]"
_HOST_POINT = rf"(?!(?:{_BEFORE_POINT})\b)[\w-]+(?:\s+(?:dot|{_POINT})\s+(?!(?:{_AFTER_POINT})\b)[\w-]+)+"
_AT = re.compile(rf"\s*{_BRACKETED_AT}\s*|(?<=\w) @ (?=\w)|(?<=\w)\s+at\s+(?=[\w-]+(?:\s+dot\s+[\w-]+)+|{_HOST_POINT})|(?<=\w)\s+(?:arobase|arroba)\s+(?=[\w-]+(?:\s+(?:dot|point|punto|ponto)\s+[\w-]+)+)", re.I)
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|point|punto|ponto|\.)\s*[\])}>]\s*|(?<=\w)\s+dot\s+(?=[\w-]+)", re.I)
# "point" is a word of prose too: it is a dot only before a disguised @, or in the host after an @.
_POINT_LOCAL = re.compile(rf"(?<=\w)\s+(?:point|punto|ponto)\s+(?=[\w-]+(?:\s+(?:point|punto|ponto)\s+[\w-]+)*(?:\s*{_BRACKETED_AT}| @ |\s+(?:arobase|arroba)\s|\s+at\s+{_HOST_POINT}))", re.I)
_POINT_HOST = re.compile(rf"@[\w-]+(?:(?:\s+(?:dot|point|punto|ponto)\s+(?!(?:{_AFTER_POINT})\b)[\w-]+)+|(?:\.[\w-]+)+\s+(?:point|punto|ponto)\s+(?:{_ENDS})\b)", re.I)
_POINT_WORD = re.compile(r"\s+(?:dot|point|punto|ponto)\s+", re.I)
# The guard before them: outside brackets, every disguise but " @ " needs a word for the dot.
_IN_BRACKETS = re.compile(rf"{_BRACKETED_AT}|[\[({{<]\s*(?:dot|point|punto|ponto|\.)\s*[\])}}>]", re.I)
_POINT_WORDS = ("point", "punto", "ponto", "poınt", "poi̇nt")

_EMAIL = re.compile(r"(?<![\w.+-])[\w+%'-]+(?:\.[\w+%'-]+)*@[\w-]+(?:\.[\w-]+)+")
_PHONE = re.compile(r"(?<![\w/.+-])(?:\+?1[\s.-]{0,2})?(?:\([2-9]\d\d\)|[2-9]\d\d)[\s./-]{0,2}[2-9]\d\d[\s./-]?\d{4}(?![\w]|-\d)")
# With another country's code: digits in groups, eight to fifteen with the code.
_ABROAD = re.compile(r"(?<![\w/.+-])\+(?!1\D)[2-9]\d{0,2}(?:[\s./-]{0,2}\(?\d{1,4}\)?){2,6}(?![\w]|-\d)")
# Social security numbers in three groups, which files are numbered by too and so need a cue; numbers of payment cards in four.
_GROUPED = re.compile(r"(?<![\w-])(?:(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}|[2-6]\d{3}(?P<g>[\s-])\d{4}(?P=g)\d{4}(?P=g)\d{4})(?![\w]|-\d)")
_FOURS = re.compile(r"\d{4}[\s-]\d{4}")
_ID = re.compile(r"(?<![\w-])(?:\d{4}[\s-]?\d{3}[\s-]?\d{3}[\s-]?[A-Z]{2}|[A-Z]{2}[\s-]?\d{6}|\d{3}(?P<s>[\s-]?)\d{3}(?P=s)\d{3})(?![\w]|-\d)")
_ID_CUE = re.compile(r"(?:\bSIN\b|\bSSN\b|\bNAS\b|\bID\b|social insurance|social security|assurance sociale|health card|assurance maladie|carte santé|passport|passeport|permit|permis|identit|licen[cs]e)(?:\s+no\.)?[^.;|\d]{0,40}$", re.I)
_NO_ID_CUE = re.compile(r"(?:grant|file|dossier|subvention|invoice|facture|order|case|bill|projet de loi)(?:\s+(?:no|number|numéro)\.?)?\s*[:#]?\s*$", re.I)
_CAP = r"[A-ZÀ-ÖØ-Þ]"
_WORD = rf"{_CAP}[\w'-]+"
_DIRECTION = rf"(?:\s+(?i:North|South|East|West|Nord|Sud|Est|Ouest|NE|NW|SE|SW|NO|SO|[NSEWO]\.?(?!\s+{_CAP}[\w'-]+\s*[;,|-]))(?!\w))?"
_UNIT = r"(?:,?\s+(?i:Suite|Unit|Apt\.?|Apartment|app\.?|bureau|unité|#)\s*\d+\w?)?"
_KINDS = r"(?i:Street|Avenue|Ave|Road|Crescent|Cres|Lane|Drive(?!\s+for\s)|Boulevard|Blvd|Court|Place|Terrace|Way|Parkway|Highway|Circle|Trail|Square)(?!\w)|(?i:St|Rd|Dr|Cr|Ct|Pl|Ln|Hwy)(?:\.|(?!\w))"
_ENGLISH = re.compile(rf"(?<![\w-])\d+[A-Z]?(?:-\d+)?\s+(?:{_WORD}\s+){{1,3}}?(?:{_KINDS}){_DIRECTION}{_UNIT}")
_VOIES = r"(?i:rue|avenue|av\.|boul\.|boulevard|chemin|ch\.|place|rang|allée|côte|promenade|route|impasse|ruelle)"
_FRENCH = re.compile(rf"(?<![\w-])\d+(?:-\d+)?,?\s+{_VOIES}\s+(?i:(?:des|de\s+la|de\s+l'|du|de|d'|la|le|les|l')\s*)?{_WORD}{_DIRECTION}{_UNIT}")
# Streets of other languages: the number follows the street.
_STREET_FIRST = (
    re.compile(rf"(?<![\w-])(?:{_CAP}[\w-]*(?:straße|strasse|str\.|gasse|allee|platz|damm|ufer)|(?:{_CAP}\w+er\s)(?:Straße|Allee|Platz|Weg))\s+\d+\s?[a-z]?(?:-\d+)?(?!\w)"),
    re.compile(rf"(?<![\w-])(?:Calle|Avenida|Av\.|Avda\.|Paseo|Plaza|Carrera|Rua|Travessa|Praça|Alameda|Largo)\s+(?:(?:de\s+la|de\s+los|de|del|do|da|dos|das|la|el|los|las)\s+)*{_CAP}[\w'-]+(?:\s+(?:(?:de|del|da|do|dos|das|e|y)\s+)?{_CAP}[\w'-]+){{0,3}},?\s+(?:n\.?[ºo°]\s*)?\d+\w?(?!\w)"),
    re.compile(r"(?<![\w-])(?:вул\.|вулиця|просп\.|проспект|бульвар|пров\.|провулок|площа)\s+[А-ЯҐЄІЇ][\w'’-]+(?:\s+[А-ЯҐЄІЇ][\w'’-]+){0,2},?\s+(?:буд\.\s*)?\d+\w?(?:,\s*кв\.\s*\d+)?(?!\w)"),
    re.compile(r"[\u4e00-\u9fff]{2,8}(?:路|街|大道|巷|弄)\d+号(?:\d+(?:室|楼|单元))*"),
)
# What a text must hold for each of them to be looked for.
_STREET_WORDS = (
    ("straße ", "strasse ", "str. ", "gasse ", "allee ", "platz ", "damm ", "ufer ", "er Straße ", "er Allee ", "er Platz ", "er Weg "),
    ("Calle ", "Avenida ", "Av. ", "Avda. ", "Paseo ", "Plaza ", "Carrera ", "Rua ", "Travessa ", "Praça ", "Alameda ", "Largo "),
    ("вул", "просп", "бульвар", "пров", "площа"),
    ("号",),
)
_NAME = re.compile(rf"(?<![\w'-])(?:(?P<given>{_CAP}[\w'-]*\w)|(?P<initial>{_CAP})\.)(?P<middle>\s+{_CAP}\.)?\s+(?P<family>{_CAP}[\w'-]*\w)")
_NAME_CUE = re.compile(r"(?:\bmy name is|\bje m'appelle|\bcontact person\s*:|\bpersonne-ressource\s*:|\bsigned,?|\bsigné,?|\bneighbour|\bvoisine?|\b(?:Mr|Mrs|Ms|Mx|Dr|Dre|Mme|Prof)\.?)\s+$", re.I)
_COUNTED = re.compile(r"\s*(?:de\s+)?(?:dollar|%|per\b|pour\b|people|person|million|\$)", re.I)
_NEXT_WORD = re.compile(r"[\s,]*([^\W\d_]+)")
_LAST_WORD = re.compile(r"([^\W\d_]+)\.?\s*$")


def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


@cache
def _given() -> frozenset[str]:
    return frozenset(map(_plain, GIVEN_NAMES.split()))


class Tape:
    """A text and, for each of its characters, the span of the source it stands for."""

    def __init__(self, source: str) -> None:
        self.source, self.text = source, source
        self.starts: list[int] | None = None
        self.ends: list[int] | None = None

    def rewrite(self, pattern: re.Pattern, to) -> None:
        """Replace every match m by to(m); replacements of the same length keep each character's own span."""
        found = [(m.start(), m.end(), to(m)) for m in pattern.finditer(self.text)]
        if not found:
            return
        starts = self.starts if self.starts is not None else range(len(self.text))
        ends = self.ends if self.ends is not None else range(1, len(self.text) + 1)
        text, s, e, at = [], [], [], 0
        for a, b, new in found:
            text += [self.text[at:a], new]
            s += starts[at:a]
            e += ends[at:a]
            if len(new) == b - a:
                s += starts[a:b]
                e += ends[a:b]
            else:
                s += [starts[a]] * len(new)
                e += [ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.starts, self.ends = [*s, *starts[at:]], [*e, *ends[at:]]

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])


def normalised(source: str) -> Tape:
    """The text with disguises undone; each transducer runs only on texts that hold what it looks for."""
    tape = Tape(source)
    if not source.isascii():
        if _ODD.search(source):
            tape.text = source.translate(_SINGLE)
        tape.rewrite(_WIDE_RE, lambda m: _WIDE[m[0]])
        if _LOOKALIKE.search(tape.text):
            tape.rewrite(_MIXED, lambda m: "".join(_LOOKS.get(c, c) for c in m[0]))
    low = tape.text.lower()
    points = any(x in low for x in _POINT_WORDS)
    if points or "dot" in low or " @ " in low or _IN_BRACKETS.search(tape.text):
        if points:
            tape.rewrite(_POINT_LOCAL, lambda _: ".")
        tape.rewrite(_AT, lambda _: "@")
        if "@" in tape.text:
            tape.rewrite(_DOT, lambda _: ".")
            if points:
                tape.rewrite(_POINT_HOST, lambda m: _POINT_WORD.sub(".", m[0]))
    if sum(map(_DIGIT_WORDS.__contains__, low.replace("-", " ").replace(",", " ").split())) > 6:
        tape.rewrite(_SPELLED, lambda m: "".join(_DIGIT_WORDS.get(w, w) for w in re.split(r"[\s,-]+", m[0].lower())))
    return tape


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _names(t: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _NAME.search(t, at):
        given, family = m["given"], m["family"]
        end = m.end() - 2 * (family[-2:] in ("'s", "'S"))
        at = m.end() if m["initial"] else m.start() + len(given or "")
        if given and given.isupper() != family.isupper() and len(given) > 1:
            continue
        before = t[max(0, m.start() - 40) : m.start()]
        known = m["initial"] or _plain(given) in _given() or any(_plain(p) in _given() for p in given.split("-"))
        if not known and not _NAME_CUE.search(before):
            continue
        if family.lower() in BODY_WORDS or (not m["initial"] and _plain(family) in ("the", "our", "we", "i", "in", "and", "at", "of", "for", "such", "many", "most", "there", "this", "it")):
            continue
        following, previous = _NEXT_WORD.match(t, m.end()), _LAST_WORD.search(before)
        if following and following[1].lower() in BODY_WORDS and not t[m.end() : following.start(1)].count(","):
            continue
        if previous and previous[1].lower() in BODY_BEFORE:
            continue
        at = m.end()
        yield m.start(), end


def find_items(source: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every item in the source text, in order and without overlaps."""
    tape = normalised(source)
    t = tape.text
    found: list[tuple[int, int, str]] = []
    if "@" in t:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(t)]
    for m in _PHONE.finditer(t):
        found.append((m.start(), m.end(), "phone"))
    if "+" in t:
        found += [(m.start(), m.end(), "phone") for m in _ABROAD.finditer(t) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    for m in _GROUPED.finditer(t) if "SSN" in t or "ocial" in t or _FOURS.search(t) else ():
        digits = re.sub(r"\D", "", m[0])
        before = t[max(0, m.start() - 60) : m.start()]
        if not _NO_ID_CUE.search(before) and (_luhn(digits) if len(digits) == 16 else _ID_CUE.search(before)):
            found.append((m.start(), m.end(), "id_number"))
    for m in _ID.finditer(t):
        digits = re.sub(r"\D", "", m[0])
        before = t[max(0, m.start() - 60) : m.start()]
        if _ID_CUE.search(before) or (not _NO_ID_CUE.search(before) and (len(digits) != 9 or (_luhn(digits) and not _COUNTED.match(t, m.end())))):
            found.append((m.start(), m.end(), "id_number"))
    for pattern in (_FRENCH, _ENGLISH):
        for m in pattern.finditer(t):
            found.append((m.start(), m.end(), "address"))
    for pattern, hints in zip(_STREET_FIRST, _STREET_WORDS, strict=True):
        if any(h in t for h in hints):
            found += [(m.start(), m.end(), "address") for m in pattern.finditer(t)]
    found += [(a, b, "person") for a, b in _names(t)]
    rank = {"email": 0, "phone": 1, "id_number": 2, "address": 3, "person": 4}
    kept: list[tuple[int, int, str]] = []
    for a, b, kind in sorted(found, key=lambda f: (rank[f[2]], f[0], -f[1])):
        k = bisect_left(kept, (a, b, kind))
        if (k == len(kept) or kept[k][0] >= b) and (k == 0 or kept[k - 1][1] <= a):
            kept.insert(k, (a, b, kind))
    return [(kind, *tape.span(a, b)) for a, b, kind in kept]


def masked(source: str, items: list[tuple[str, int, int]]) -> str:
    """The text with every item replaced by its kind's placeholder; all else stays as it is."""
    out, at = [], 0
    for kind, a, b in items:
        out += [source[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join([*out, source[at:]])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("found_text", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        texts, items = [], []
        for t in batch.column(1).to_pylist():
            found = find_items(t) if t else []
            texts.append(masked(t, found) if found else t)
            items.append([{"kind": k, "found_text": t[a:b], "start": a, "stop": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(items, kind)], ["id", "masked", "items"])


def find_personal(records: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, masked, items): the text with placeholders, and its items with their places in the source.

    Null texts stay null and empty ones empty, both without items; repeated rows each give one row;
    whole texts are read, however long; other columns are ignored. One narrow pass, no shuffle.
    """
    source = records.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_run, "id string, masked string, items array<struct<kind:string,found_text:string,start:int,stop:int>>").withColumnRenamed("id", id_col)


def _both(spark: SparkSession, sf: str) -> DataFrame:
    parts = [find_personal(text_table(spark, sf, t, "doc_id", "card_text"), "doc_id", "card_text").select(F.lit(t).alias("tbl"), "doc_id", "masked", "items") for t in ("corpus_fixture", "topup_sheet")]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    found = _both(spark, sf).select("tbl", "doc_id", F.explode("items").alias("i"))
    return found.select("tbl", "doc_id", "i.kind", "i.found_text").distinct()


def p6_masked(spark: SparkSession, sf: str) -> DataFrame:
    """Every record's text with placeholders; repeated rows come out once."""
    return _both(spark, sf).select("tbl", "doc_id", F.col("masked").alias("masked_text")).distinct()
