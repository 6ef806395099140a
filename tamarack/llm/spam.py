"""Keyword-stuffed and link-list pages (problem 9).

Every page is compressed in blocks, links, codes and prices after the first of their kind and words said
before in the block standing as one sign each, and its ratio is divided by what pages of its language and length usually reach. A page whose
redundancy is extreme is flagged if low sentence punctuation confirms it: the share of its text that
stands in punctuated sentences which say something new on the page. Both conditions must hold. What is usual comes from distinct pages of sentences, so copies cannot move it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.plans.lineage import cut
from tamarack.sources.tables import text_table

BLOCK_CHARS = 1000
#: Below this share of the usual ratio a page is extremely redundant.
EXTREME_RATIO = 0.75
#: With less of its text in new sentences, a page's sentence punctuation is low.
LOW_SENTENCES = 0.45
#: A sentence repeats what stands at most so many characters before it.
MEMORY_CHARS = 2000
#: Fewer pages than this say nothing about what is usual: length and language, then length and script, then script, then USUAL.
LEAST_PAGES = 20
#: Ratio of ordinary prose of 1,024 characters and more, what it gains with every halving of the length, and how far above it a usual ratio can be.
USUAL, PER_HALVING, SPREAD = 0.5, 0.08, 0.1
#: Only pages with at least this share of their text in sentences, and a ratio that prose can have, say what is usual.
PROSE, LEAST_PROSE = 0.5, 0.1
#: Lengths are told apart by powers of two from 16 characters on; what is longer than 4,096 is alike in blocks.
SHORTEST, LONGEST = 4, 12

# An end mark before a new start, or one that needs no blank after it.
_END = re.compile(r"[.!?…։؟۔][\"'”’»)\]]*(?=\s+[^\sa-zß-öø-ÿа-яґєії]|\s*$)|[।॥።፧။។。！？｡]")
_ASCII_LETTER = re.compile(r"[A-Za-z]")
_RUN = re.compile(r"[0-9A-Za-z]{60,}")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_LETTERS = re.compile(r"([^\W\d_]+)")
# Links and tags; prices; codes of letters and digits. Plain numbers are what tables consist of.
_LINK_OR_PRICE = r"(?P<link>(?:https?://|www\.)\S+|#\w+)|(?P<price>[$€£]\s?\d[\d.,]*)"
_PLAIN_ITEM = re.compile(_LINK_OR_PRICE)
_ITEM = re.compile(rf"{_LINK_OR_PRICE}|(?P<code>\b(?:[^\W\d]++\d|\d++[^\W\d])\w*+)")
# What a text without items cannot hold: a letter beside a digit, or one of the signs.
_MIXED, _SIGNS = re.compile(r"\d[^\W\d]|[^\W\d]\d"), ("http", "www.", "#", "$", "€", "£")
# Scripts by ranges of their letters; those of UNSPACED set no blanks between words.
_SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x8FF),
    ("devanagari", 0x900, 0x97F), ("indic", 0x980, 0xDFF), ("thai", 0xE00, 0xEFF), ("burmese", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x139F), ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7A3),
)
UNSPACED = ("thai", "burmese", "khmer", "kana", "han")


@cache
def _script(c: str) -> str | None:
    """The script of a letter; None for what is no letter."""
    return next((s for s, a, b in _SCRIPTS if a <= ord(c) <= b), "other") if c.isalpha() else None


def script_of(text: str) -> str:
    """The script of most letters; a letter of an unspaced script counts twice, as it stands for more of a word."""
    if text.isascii():
        return "latin" if _ASCII_LETTER.search(text) else "none"
    found: Counter[str] = Counter()
    for c, n in Counter(text).items():
        if name := _script(c):
            found[name] += n * (1 + (name in UNSPACED))
    return max(found, key=lambda k: (found[k], k)) if found else "none"


def _compact(text: str) -> bytes:
    """The text with one byte a character wherever 256 signs suffice, so that ratios of scripts can be compared."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        pass
    signs = sorted(set(text))
    if len(signs) <= 256:
        return text.translate({ord(c): k for k, c in enumerate(signs)}).encode("latin-1")
    return text.encode("utf-16-le", "surrogatepass")


def _once(text: str) -> str:
    """The text with every link, price or code after the first of its kind as one sign: a list of them says one thing again and again."""
    codes = _MIXED.search(text)
    if not codes and not any(sign in text for sign in _SIGNS):
        return text
    seen: set[str | None] = set()

    def to(m: re.Match) -> str:
        if m.lastgroup in seen:
            return "0"
        seen.add(m.lastgroup)
        return m[0]

    return (_ITEM if codes else _PLAIN_ITEM).sub(to, text)


def _said(block: str) -> str:
    """The block with every word that stands earlier in it as one sign."""
    known: set[str] = set()
    parts = _LETTERS.split(block)
    low = _LETTERS.split(block.lower())
    if len(low) != len(parts):  # a letter that is several signs in lower case
        low = list(map(str.lower, parts))
    parts[1::2] = ["\x02" if w in known else known.add(w) or as_is for as_is, w in zip(parts[1::2], low[1::2], strict=True)]
    return "".join(parts)


def block_ratio(text: str) -> float:
    """Compressed over plain size, in blocks; the last block takes what is too short for one of its own.

    Runs that are longer than any word, such as filler and keys, say nothing about repeated words and are left out.
    """
    text = _RUN.sub(" ", text)
    size, kept = len(_compact(text)), _once(text)
    n = max(1, len(kept) // BLOCK_CHARS)
    cuts = [k * BLOCK_CHARS for k in range(n)] + [len(kept)]
    packed = 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        block = zlib.compressobj(6, zlib.DEFLATED, -15)
        packed += len(block.compress(_compact(_said(kept[a:b])))) + len(block.flush())
    return packed / size


def _sentences(text: str) -> Iterator[tuple[str, int]]:
    """(sentence, 1 if it counts as one) of the lines of a text, blanks tidied; what stands after the last end mark of a line comes with -1."""
    for line in text.splitlines():
        line = " ".join(line.split())
        start = 0
        for m in _END.finditer(line):
            sentence = line[start : m.end()]
            yield sentence, not sentence.lstrip()[:1].islower()
            start = m.end()
        yield line[start:], -1


def sentence_share(text: str, unspaced: bool = False) -> float:
    """The share of the text in sentences: no lower-case start, an end mark and at least four words, or any number where words have no blanks between them."""
    good = total = 0
    for sentence, counts in _sentences(text):
        total += len(sentence)
        if counts == 1 and (unspaced or sentence.count(" ", 1) >= 3):
            good += len(sentence)
    return good / total if total else 0.0


def new_share(text: str, unspaced: bool = False) -> float:
    """The share of the text in sentences that say something new: at least half of the pairs of neighbouring words are not within the last MEMORY_CHARS, of which a letter of an unspaced script counts twice."""
    good = total = at = 0
    seen: dict[object, int] = {}
    for sentence, counts in _sentences(text):
        total += len(sentence)
        if counts < 0:
            continue
        words = ["0" if w.isdigit() else w for w in _WORD.findall(sentence.lower())]
        pairs = list(zip(words, words[1:], strict=False)) or words
        if pairs and (unspaced or len(words) >= 4):
            fresh = sum(at - seen.get(p, -MEMORY_CHARS - 1) > MEMORY_CHARS for p in pairs)
            good += len(sentence) * (counts and 2 * fresh >= len(pairs))
            seen.update(dict.fromkeys(pairs, at))
        at += len(sentence) * (1 + unspaced)
    return good / total if total else 0.0


def _size(n: int) -> int:
    return max(SHORTEST, min(n.bit_length() - 1, LONGEST))


def prior_ratio(size: int) -> float:
    """The ratio of ordinary prose of 2**size characters."""
    return USUAL + PER_HALVING * max(0, 10 - size)


def _print(text: str) -> str:
    """A fingerprint that texts share if they differ in case and blanks only."""
    return xxhash.xxh3_128_hexdigest(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, lang in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if not text or text.isspace():
                continue
            script, code = script_of(text), (lang or "").strip().lower()[:2]
            language = f"{script}-{code}" if code.isascii() and code.isalpha() else script
            size, ratio = _size(len(text)), block_ratio(text)
            # sentences are compared only where the page is more redundant than any usual ratio lets pass
            new = new_share(text, script in UNSPACED) if ratio < EXTREME_RATIO * (prior_ratio(size) + SPREAD) else None
            rows.append((key, len(text), size, script, language, ratio, sentence_share(text, script in UNSPACED), new, _print(text)))
        kinds = (batch.schema.types[0], pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string())
        names = ["id", "n", "size", "script", "language", "ratio", "punctuated", "sentences", "print"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def spam_scores(pages: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    """Rows (id, n_chars, ratio, usual, sentences, new_sentences, spam) of every page; pages of all lengths are measured alike.

    new_sentences is null where a page's ratio is above what any usual ratio lets pass as redundant. Null,
    empty and blank texts give no row; repeated rows each give one; other columns are ignored; an empty
    table gives an empty result. Very long texts are read whole.
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("lang"))
    kind = source.schema["id"].dataType.simpleString()
    measured = cut(source.mapInArrow(_measure, f"id {kind}, n int, size int, script string, language string, ratio double, punctuated double, sentences double, print string"))
    prose = measured.filter((F.col("punctuated") >= PROSE) & (F.col("ratio") >= LEAST_PROSE))
    once = prose.groupBy("size", "script", "language", "print").agg(F.min("ratio").alias("ratio"))
    joined = measured
    # at most 9 lengths x 17 scripts x the two-letter codes
    for level, cell in enumerate((("size", "script", "language"), ("size", "script"), ("script",))):
        usual = once.groupBy(*cell).agg(F.percentile_approx("ratio", 0.5, 200).alias(f"usual_{level}"), F.count("*").alias("pages")).filter(f"pages >= {LEAST_PAGES}").drop("pages")
        joined = joined.join(F.broadcast(usual), list(cell), "left")
    prior = F.lit(USUAL) + F.lit(PER_HALVING) * F.greatest(F.lit(0), 10 - F.col("size"))
    usual = F.least(F.coalesce("usual_0", "usual_1", "usual_2", prior), prior + F.lit(SPREAD))
    spam = (F.col("ratio") < F.lit(EXTREME_RATIO) * usual) & (F.col("sentences") < LOW_SENTENCES)
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), "ratio", usual.alias("usual"), F.col("punctuated").alias("sentences"), F.col("sentences").alias("new_sentences"), F.coalesce(spam, F.lit(False)).alias("spam"))


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    return spam_scores(text_table(spark, sf, "documents", "doc_id", "text", "lang"), "doc_id", "text", "lang")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_scores(spark, sf).filter("spam").select("doc_id").distinct()
