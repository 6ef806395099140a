"""Cleaning steps as Column expressions over whole texts; all run inside the JVM.

What a step must remember from line to line is put into the pattern or the array instead: matches that start
where the last one ended (\\G) follow a list of contents line by line, sorted fingerprints show how many pages
hold a line by what stands a fixed distance further on, and the last salutation is the last part of a split.
Patterns below expect texts whose lines end with \\n only, as ``tidy`` leaves them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.basic import let
from tamarack.functions.text import GAP, MARKER, WORD, WS, fix_ligatures, join_hyphens, line_print, lines, strip, tidy_space, word_count, words

#: A line on more than this share of the pages is a header or footer; counted in whole pages it is on at least half of them and one more.
PAGE_SHARE = 0.5
#: Lines of a title block at most, and the fewest long words that make it a title.
TITLE_LINES, TITLE_WORDS = 8, 4
#: Share of the title's words in the first lines of a page, and of their words in the title, from which on they repeat the title.
ECHO_SHARE = 0.8
#: A page's first lines are compared from two up to so many, if they have so many long words.
ECHO_LINES, ECHO_WORDS = 6, 3
#: A salutation counts as the end of a text only if fewer words follow.
TAIL_WORDS = 200

# Starts of lines that end a title block.
TITLE_END = (
    r"(?i)^(?:report\s+of|standing\s+committee|parliament|speaker|published\s+under|january|february|march|april|may|june|july|"
    r"august|september|october|november|december|\d{4}$|[a-z]+,\s+chair|submitted\s+by|prepared\s+by)"
)
# Heading of a list of contents, and its lines: leaders with a page number, page numbers, roman numerals.
CONTENTS = r"(?i:table\s+of\s+contents|contents)"
LEADER = r"[^\n]{3,}\.{5,}\s*\d+"
ROMAN = r"[ivxlcdmIVXLCDM]+"
# First line of a paragraph about the submitter.
ABOUT = rf"(?i:about)[{GAP}]+(?i:(?!approximately|around|\d))[{WORD}][{WORD}{GAP}&,.()/'-]{{1,80}}"
# Headings with which the substance of a report starts, and those with which it is over.
CONTENT_START = r"SUMMARY|INTRODUCTION|BACKGROUND|OVERVIEW|EXECUTIVE SUMMARY|PREAMBLE|GOVERNMENT RESPONSE|CONTEXT|MANDATE|THE EVIDENCE|FINDINGS?"
RECOMMENDATIONS = r"list\s+of\s+recommendations"
BACK_MATTER = (
    r"APPENDIX\s+[A-Z0-9]|ANNEX\s+[A-Z0-9]|LIST\s+OF\s+WITNESSES|DISSENTING\s+(?:REPORT|OPINION)|SUPPLEMENTARY\s+(?:REPORT|OPINION)|MINORITY\s+OPINION|"
    r"BRIEFS\s+RECEIVED|WRITTEN\s+SUBMISSIONS\s+RECEIVED|LIST\s+OF\s+(?:WRITTEN\s+)?SUBMISSIONS|LIST\s+OF\s+BRIEFS|REQUEST\s+FOR\s+GOVERNMENT\s+RESPONSE"
)
# Salutations.
SALUTATION = "sincerely|respectfully submitted|respectfully yours|yours truly|regards|best regards|yours sincerely|submitted respectfully|thank you for your consideration"

_DIGITS = r"[\p{Nd}²³¹⁰-⁹₀-₉①-⑨]+"
_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def _spaced(pattern: str) -> str:
    """A fixed pattern with its \\s and \\d as Python means them."""
    return pattern.replace(r"\s", f"[{WS}]").replace(r"\d", r"\p{Nd}")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?<![{WS}])[{WS}]++\z", "")


def pages_of(c: Column) -> Column:
    """The parts of a text between page markers."""
    return F.split(c, MARKER, -1)


def markers_of(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(MARKER), 0)


def running_prints(pages: Column) -> Column:
    """Fingerprints of the lines on more than PAGE_SHARE of two or more pages."""
    once = F.flatten(F.transform(pages, lambda p: F.array_distinct(F.filter(F.transform(lines(p), line_print), lambda x: F.length(x) > 0))))
    enough = F.floor(F.size(pages) * F.lit(PAGE_SHARE)).cast("int") + 1
    common = let(F.array_sort(once), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i + enough - 1) == x)))
    return F.when(F.size(pages) >= 2, common).otherwise(F.array().cast("array<string>"))


def without_prints(pages: Column, prints: Column) -> Column:
    """An array of (page, removed): each page without the lines of these fingerprints; as it is where there are none."""

    def page(p: Column) -> Column:
        return let(lines(p), lambda rows: let(F.filter(rows, lambda x: ~F.array_contains(prints, line_print(x))), lambda kept: F.struct(F.array_join(kept, "\n").alias("page"), (F.size(rows) - F.size(kept)).alias("removed"))))

    return F.transform(pages, lambda p: F.when(F.size(prints) > 0, page(p)).otherwise(F.struct(p.alias("page"), F.lit(0).alias("removed"))))


def long_words(c: Column) -> Column:
    """The distinct words of five letters and more, in lower case."""
    return F.array_distinct(F.filter(words(F.regexp_replace(F.lower(c), rf"[^{WORD}{WS}]", " ")), lambda w: F.length(w) >= 5))


def title_words(page: Column) -> Column:
    """Long words of the first block of a page, up to a line that no title has."""

    def block(rows: Column) -> Column:
        head = F.slice(rows, F.greatest(F.array_position(F.transform(rows, lambda x: F.length(x) > 0), True), F.lit(1)).cast("int"), F.lit(TITLE_LINES))
        stop = let(head, lambda h: F.array_position(F.transform(h, lambda x: (F.length(x) == 0) | x.rlike(_spaced(TITLE_END))), True))
        return long_words(F.array_join(F.when(stop > 0, F.slice(head, F.lit(1), (stop - 1).cast("int"))).otherwise(head), " "))

    return let(F.transform(lines(page), strip), block)


def without_echoes(pages: Column) -> Column:
    """An array of (page, echo): pages after the first lose a repeated title at their top, with the empty lines after it.

    Of the first two to ECHO_LINES full lines the smallest number that matches the title goes.
    """

    def page(p: Column, title: Column) -> Column:
        def cut(rows: Column) -> Column:
            full = F.slice(F.filter(F.transform(rows, lambda x, k: F.struct(k.alias("k"), x.alias("line"))), lambda r: F.length(strip(r["line"])) > 0), F.lit(1), F.lit(ECHO_LINES + 1))

            def matched(f: Column) -> Column:
                def echoes(n: Column) -> Column:
                    seen = long_words(F.array_join(F.transform(F.slice(f, F.lit(1), n), lambda r: r["line"]), " "))
                    return let(seen, lambda w: let(F.size(F.array_intersect(w, title)), lambda both: (F.size(w) >= ECHO_WORDS) & (both / F.size(w) >= ECHO_SHARE) & (both / F.size(title) >= ECHO_SHARE)))

                most = F.least(F.size(f), F.lit(ECHO_LINES))
                found = F.when(most >= 2, F.get(F.filter(F.sequence(F.lit(2), F.greatest(most, F.lit(2))), echoes), F.lit(0)))
                rest = let(F.get(f, found)["k"], lambda k: F.when(k.isNull(), "").otherwise(F.array_join(F.slice(rows, k + 1, F.size(rows)), "\n")))
                return let(found, lambda n: F.when(n.isNotNull(), F.struct(rest.alias("page"), F.lit(1).alias("echo"))).otherwise(F.struct(p.alias("page"), F.lit(0).alias("echo"))))

            return let(full, matched)

        return let(lines(p), cut)

    as_is = lambda p: F.struct(p.alias("page"), F.lit(0).alias("echo"))
    title = F.when(F.size(pages) >= 2, title_words(F.get(pages, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    return let(title, lambda t: F.transform(pages, lambda p, k: F.when((k > 0) & (F.size(t) >= TITLE_WORDS), page(p, t)).otherwise(as_is(p))))


def joined(pages: Column, markers: Column) -> Column:
    """The text of pages with every marker on a line of its own."""

    def part(p: Column, k: Column) -> Column:
        before = F.get(pages, k - 1)
        gap = F.when((F.length(before) > 0) & ~before.endswith("\n"), "\n").otherwise("")
        return F.when(k == 0, p).otherwise(F.concat(gap, F.get(markers, k - 1), F.lit("\n"), p))

    return F.array_join(F.transform(pages, part), "")


def tidy(c: Column) -> Column:
    """Ligatures written out, words cut by a hyphen joined, white space tidied."""
    return tidy_space(join_hyphens(fix_ligatures(c)))


def _by_line(c: Column, heading: str, follow: str, to: str) -> Column:
    """Replacements of whole lines, each with its line end, in texts that hold the heading; the text's last line gets an end for the time being."""

    def cut(c: Column) -> Column:
        ended = F.when(c.endswith("\n"), c).otherwise(F.concat(c, F.lit("\n")))
        return let(ended, lambda x: F.when(x.rlike(heading), F.regexp_replace(F.regexp_replace(x, f"{heading}|{follow}", to), r"\n\z", "")).otherwise(c))

    return let(c, lambda x: F.when(F.length(x) > 0, cut(x)).otherwise(x))


_FOLLOWS = r"\G(?!\A)"
_MARKER_LINE = rf"[{GAP}]*{MARKER}[{GAP}]*\n"


def without_contents(c: Column) -> Column:
    """Without lists of contents: their heading and the lines of such a list that follow it; page markers among them stay and don't end it."""
    member = rf"[{GAP}]*(?:{_spaced(LEADER).replace(f'[{WS}]', f'[{GAP}]')}|{_DIGITS}|{ROMAN})?[{GAP}]*\n"
    heading = rf"(?dm)^[{GAP}]*{CONTENTS}[{GAP}]*\n".replace(r"\s", f"[{GAP}]")
    return _by_line(c, heading, rf"{_FOLLOWS}({_MARKER_LINE})|{_FOLLOWS}{member}", "$1")


def without_about(c: Column) -> Column:
    """Without paragraphs about the submitter: from their first line to a page marker or the second of two empty lines, which goes too."""
    heading = rf"(?dm)^[{GAP}]*{_spaced(ABOUT)}[{GAP}]*\n"
    return _by_line(c, heading, rf"{_FOLLOWS}(?<!\n\n\n)(?!{_MARKER_LINE})[^\n]*\n", "")


def without_front(c: Column) -> Column:
    """From the first heading of the substance on."""
    heading = rf"(?dm:^(?:{CONTENT_START})[{WS}]*$)"
    return let(c, lambda x: F.when(x.rlike(heading), F.regexp_replace(x, rf"(?s)\A.*?(?={heading})", "")).otherwise(x))


def without_back(c: Column) -> Column:
    """Without appendices and lists, looked for after the list of recommendations."""
    listed = rf"(?dim:^{_spaced(RECOMMENDATIONS)}[{WS}]*$)"
    back = rf"(?dim:^(?:{_spaced(BACK_MATTER)})(?![{WORD}]))"

    def cut(c: Column) -> Column:
        after = F.regexp_replace(c, rf"(?s)\A((?>.*?{listed}).*?){back}.*\z", "$1")
        anywhere = F.regexp_replace(c, rf"(?s)\A(.*?){back}.*\z", "$1")
        return F.when(c.rlike(back), let(F.when(c.rlike(listed), after).otherwise(anywhere), lambda x: F.when(F.length(x) < F.length(c), rstrip(x)).otherwise(c))).otherwise(c)

    return let(c, cut)


def without_signature(c: Column) -> Column:
    """Without the last salutation and what follows, if that has fewer words than a tenth of the text, and than TAIL_WORDS."""
    salutation = rf"(?dim)^(?:{SALUTATION})[,.]?[{WS}]*$"

    def cut(c: Column) -> Column:
        most = F.least(F.lit(TAIL_WORDS), F.greatest(F.lit(1), F.floor(word_count(c) * F.lit(0.10)).cast("int")))
        parts = F.split(c, f"(?={salutation})", -1)
        return let(parts, lambda p: F.when((F.size(p) > 1) & (word_count(F.element_at(p, -1)) < most), rstrip(F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), ""))).otherwise(c))

    return let(c, lambda x: F.when(x.rlike(salutation), cut(x)).otherwise(x))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def aliases(c: Column, names: Column) -> Column:
    """What stands in brackets after a name as an alias of it, letter case aside, in order of appearance."""
    found = F.transform(names, lambda n: F.regexp_extract_all(c, F.concat(F.lit("(?iu)"), _quoted(n), F.lit(rf"[{WS}]*\(([A-Z][A-Z0-9]{{1,7}})\)")), 1))
    return F.array_distinct(F.flatten(found))


def masked(c: Column, names: Column) -> Column:
    """Names of three letters and more as [ORG], the longest first."""
    ordered = F.array_sort(F.filter(F.transform(names, lambda n, k: F.struct((-F.length(n)).alias("n"), k.alias("k"), n.alias("name"))), lambda s: s["n"] <= -3))
    return F.aggregate(ordered, c, lambda text, s: F.regexp_replace(text, F.concat(F.lit(f"(?iu){_EDGE}"), _quoted(s["name"]), F.lit(_EDGE)), F.lit("[ORG]")))


def without_running(text: Column) -> Column:
    """(text, hf_removed, title_echoes): running lines and title echoes removed from the pages of a text, which are joined again."""

    def paged(text: Column) -> Column:
        def done(bare: Column) -> Column:
            total = lambda of, what: F.aggregate(of, F.lit(0), lambda n, p: n + p[what])
            kept = without_echoes(F.transform(bare, lambda p: p["page"]))
            return let(kept, lambda k: F.struct(joined(F.transform(k, lambda p: p["page"]), markers_of(text)).alias("text"), total(bare, "removed").alias("hf_removed"), total(k, "echo").alias("title_echoes")))

        return let(pages_of(text), lambda pages: let(running_prints(pages), lambda prints: let(without_prints(pages, prints), done)))

    return F.when(text.rlike(MARKER), let(text, paged)).otherwise(F.struct(text.alias("text"), F.lit(0).alias("hf_removed"), F.lit(0).alias("title_echoes")))
