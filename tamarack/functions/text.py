"""Text expressions: Column in, Column out, all evaluated inside the JVM.

White space, words and line ends are spelled out as character classes, so that they mean the same
here, in Python and in a SQL engine with another regular-expression dialect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.basic import let

#: Characters that str.split() and str.strip() treat as white space.
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same, one by one.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: White space within a line.
GAP = WS.replace(r"\t-\r", r"\t\x{0b}-\r")
#: Characters of words.
WORD = r"\p{L}\p{N}_"
#: A page marker on its own line.
MARKER = r"\[\[page [0-9]+\]\]"
# printers' ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
# Contact details, in the order they are scrubbed.
EMAIL = rf"[{WORD}.+%-]+@[{WORD}-]+\.[{WORD}.]+"
PHONE = r"(?:\+?1[-. \t-\r]?)?\(?[0-9]{3}\)?[-. \t-\r][0-9]{3}[-. \t-\r][0-9]{4}"
POSTAL = r"[A-Z][0-9][A-Z][ \t-\r]?[0-9][A-Z][0-9]"
STREETS = "Street|St|Avenue|Ave|Boulevard|Blvd|Drive|Dr|Road|Rd|Lane|Ln|Place|Pl|Way|Court|Ct|Suite|Ste"
ADDRESS = rf"[0-9]+[ \t-\r]+(?:[{WORD}]+[ \t-\r]+){{0,3}}(?:{STREETS})"


def _edged(pattern: str) -> str:
    """The pattern with no word character on either side."""
    return rf"(?<![{WORD}]){pattern}(?![{WORD}])"


TOKENS_PER_WORD = 1.33
SHORT_WORDS = 150
CARD_WORDS = 250


def strip(c: Column) -> Column:
    """str.strip(): white space off both ends."""
    return F.trim(c, F.lit(WS_CHARS))


def one_line_end(c: Column) -> Column:
    """Every line end as \\n; texts without others are passed through."""
    others = r"[\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
    return F.when(c.rlike(others), F.regexp_replace(c, rf"\r\n|{others}", "\n")).otherwise(c)


def lines(c: Column) -> Column:
    """str.splitlines() as an array: every line end counts, a last empty line does not."""
    one = one_line_end(c)
    return F.when(F.length(one) == 0, F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(one, r"\n\z", ""), "\n", -1))


def words(c: Column) -> Column:
    """str.split(): the array of words."""
    bare = strip(c)
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, rf"[{WS}]+", -1))


def word_count(c: Column) -> Column:
    """Number of words."""
    return let(strip(c), lambda x: F.when(F.length(x) == 0, 0).otherwise(F.size(F.split(x, rf"[{WS}]+", -1))))


def approx_tokens(c: Column) -> Column:
    """Rough number of model tokens of a text, from its words."""
    return F.floor(word_count(c) * F.lit(TOKENS_PER_WORD)).cast("int")


def is_short(c: Column, least: int = SHORT_WORDS) -> Column:
    return word_count(c) < least


def unmarked(c: Column) -> Column:
    """Page markers as blanks."""
    return F.regexp_replace(c, MARKER, " ")


def hash_form(c: Column) -> Column:
    """The form under which texts count as equal: no markers, lower case, single blanks."""
    return strip(F.regexp_replace(F.lower(unmarked(c)), rf"[{WS}]+", " "))


def text_hash(c: Column) -> Column:
    return F.sha2(hash_form(c), 256)


def line_print(c: Column) -> Column:
    """Fingerprint of a line: stripped, lower case, runs of digits as #."""
    return F.regexp_replace(F.lower(strip(c)), r"\p{Nd}+", "#")


def fix_ligatures(c: Column) -> Column:
    for bad, good in LIGATURES.items():
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def join_hyphens(c: Column) -> Column:
    """Words that a line end cut in two, put together."""
    return F.when(c.contains("-\n"), F.regexp_replace(c, rf"([{WORD}])-\n([{WORD}])", "$1$2")).otherwise(c)


def tidy_space(c: Column) -> Column:
    """Blanks and tabs as one blank, at most one empty line, every line end as \\n, no blanks at line ends, stripped."""
    # runs of one blank are left alone, and each pattern only meets texts that can hold it
    c = F.regexp_replace(c, r"(?: [ \t]|\t)[ \t]*", " ")
    c = let(F.when(c.contains("\n\n\n"), F.regexp_replace(c, r"\n{3,}", "\n\n")).otherwise(c), one_line_end)
    rare = GAP.replace(r"\x{20}", r"\x{1f}")
    return let(c, lambda x: strip(F.when(x.contains(" \n") | x.rlike(f"[{rare}]"), F.regexp_replace(x, rf"(?<![{GAP}])[{GAP}]++(?=\n|\z)", "")).otherwise(x)))


def scrubbed(c: Column) -> Column:
    """(text, n): the text with contact details replaced kind after kind, and the number of replacements."""
    # an address can only start where a run of its characters does, or where the last one ended
    email = rf"(?:(?<![{WORD}.+%-])|\G){EMAIL}"

    def step(c: Column, can: Callable[[Column], Column], pattern: str) -> Column:
        return let(c, lambda x: F.when(can(x), F.regexp_replace(x, pattern, CONTACT)).otherwise(x))

    def steps(c: Column) -> Column:
        out = step(c, lambda x: x.contains("@"), email)
        out = step(out, lambda x: x.rlike(r"[0-9]{3}[-. \t-\r][0-9]{4}"), PHONE)
        out = step(out, lambda x: x.rlike(r"[A-Z][0-9][A-Z]"), _edged(POSTAL))
        out = step(out, lambda x: x.rlike(rf"(?i)[ \t-\r](?:{STREETS})(?![{WORD}])"), "(?i)" + _edged(ADDRESS))
        # no pattern can match a placeholder, so those that were not there before are the replacements
        return let(out, lambda x: F.struct(x.alias("text"), (_n_contacts(x) - _n_contacts(c)).alias("n")))

    return let(c, steps)


def scrub_contacts(c: Column) -> tuple[Column, Column]:
    """The two parts of ``scrubbed``."""
    both = scrubbed(c)
    return both["text"], both["n"]


CONTACT = "[CONTACT]"


def _n_contacts(c: Column) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(CONTACT), F.lit("")))) / len(CONTACT)).cast("int")


def is_mangled(c: Column, short_share: float = 0.40, digit_share: float = 0.02) -> Column:
    """Many lines of under four words and many digits: a table or form that lost its layout."""
    dense = F.translate(c, " \n", "")
    digits = let(dense, lambda d: (F.length(d) - F.length(F.regexp_replace(d, r"(?:\p{Nd}|[²³¹⁰-⁹₀-₉①-⑨])+", ""))) / F.greatest(F.length(d), F.lit(1)))

    def short(one: Column) -> Column:
        # lines are counted by what they hold, not made: a full line has a word, a long one at least four
        full = F.regexp_count(one, F.lit(rf"(?<![^\n])[{GAP}]*+[^{WS}][^\n]*+"))
        long = F.regexp_count(one, F.lit(rf"(?<![^\n])[{GAP}]*+(?:[^{WS}]++[{GAP}]++){{3}}[^{WS}][^\n]*+"))
        return let(full, lambda n: (n > 0) & ((n - long) / F.greatest(n, F.lit(1)) > short_share))

    return F.when(digits > digit_share, let(one_line_end(c), short)).otherwise(F.lit(False) & c.isNotNull())


def is_caps_heading(c: Column, longest: int = 120, letters: int = 4, upper_share: float = 0.70) -> Column:
    # characters of a kind are counted by what the text loses without them
    without = lambda s, kind: F.length(s) - F.length(F.regexp_replace(s, f"{kind}+", ""))
    shares = lambda s: let(without(s, r"\p{L}"), lambda n: (n >= letters) & (without(s, r"\p{Lu}") >= n * F.lit(upper_share)))
    return let(strip(c), lambda s: F.length(s).between(1, longest) & shares(s))


def first_words(c: Column, n: int = CARD_WORDS) -> Column:
    """The first n words; the rest of the text is not cut up."""
    return F.array_join(F.slice(F.split(strip(unmarked(c)), rf"[{WS}]+", n + 1), 1, n), " ")


def card_simple(c: Column) -> Column:
    return first_words(c)


def card_tiered(title: Column, body: Column) -> Column:
    """A card with placeholders for the submitter and the title before the body."""
    return F.concat(F.lit("[ORG] [ORG]\n[TITLE] "), F.coalesce(title, F.lit("")), F.lit("\n\n"), first_words(body))


def doc_title(c: Column, most_lines: int = 4, most_chars: int = 200) -> Column:
    """The first block of a text, up to an empty line or a page marker, as one line."""
    opened = F.regexp_replace(one_line_end(c), rf"^(?:[{GAP}]*+(?:\[\[page[^\n]*+)?(?:\n|\z))++", "")
    head = F.transform(F.slice(F.split(opened, "\n", most_lines + 1), 1, most_lines), strip)
    stop = F.array_position(F.transform(head, lambda x: (F.length(x) == 0) | x.startswith("[[page")), True)
    block = F.when(stop > 0, F.slice(head, F.lit(1), (stop - 1).cast("int"))).otherwise(head)
    return F.substring(F.array_join(block, " "), 1, most_chars)


def snippet(c: Column, n: int, newline: str = " ") -> Column:
    return F.replace(F.substring(c, 1, n), F.lit("\n"), F.lit(newline))


def window_starts(n_words: Column, size: int = 600, overlap: int = 50) -> Column:
    """Start offsets of overlapping word windows; the window that reaches the end is the last."""
    step = size - overlap
    last = F.greatest(F.ceil((n_words - size) / F.lit(step)), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: k * step)


def org_names(c: Column) -> Column:
    """The parts of a joint organisation, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, " / ", -1), strip), lambda x: F.length(x) > 0)
