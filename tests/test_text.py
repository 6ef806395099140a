"""Text expressions against plain Python on odd inputs."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tamarack.functions import scalars, text

SAMPLES = [
    "",
    " ",
    "one",
    " a  b\tc\n",
    "pracﬁce inter-\nnational  x\t y\n\n\n\nend ",
    "\xa0nbsp em　wide sep\x85nel",
    "Mail a.b+c@d.example.ca. Call (613) 555-0199 or 1-613-555-0199, K1A 0B1, at 12 Main Street or 27 in the way.",
    "[[page 2]] A\r\nB\rC\x0bD\x0cE\x1cF",
    "HEADING\n[CONTACT]\nCOVID-19\n[ORG]\nnot a heading\nÉTUDE ÉTÉ",
    "été-\nfoo bar-\n baz",
    "1 2\n3\n4 5 ²\nx",
    "Title line\nsecond\n\nbody",
    "[[page 1]]\n\n  first \n[[page 2]]\nx",
]


def _random(n: int) -> list[str]:
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "ﬁ", "-", "\n", "\n", " ", " ", "\t", "\xa0", " ", "9", "²", ".", "@", "[[page 3]]", "Word", "\r\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def _run(spark, column):
    texts = SAMPLES + _random(300)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r["k"]: r["v"] for r in df.select("k", column(F.col("t")).alias("v")).collect()}
    return [(t, got[k]) for k, t in enumerate(texts)]


def test_words_strip_and_lines(spark):
    for t, got in _run(spark, text.words):
        assert list(got) == t.split(), repr(t)
    for t, got in _run(spark, text.strip):
        assert got == t.strip(), repr(t)
    for t, got in _run(spark, text.lines):
        assert list(got) == t.splitlines(), repr(t)


def test_hash_form(spark):
    def plain(t):
        return hashlib.sha256(re.sub(r"\s+", " ", re.sub(r"\[\[page \d+\]\]", " ", t).lower()).strip().encode()).hexdigest()

    for t, got in _run(spark, text.text_hash):
        assert got == plain(t), repr(t)


def test_tidy_by_brute_force(spark):
    def plain(t):
        for bad, good in text.LIGATURES.items():
            t = t.replace(bad, good)
        t = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", re.sub(r"(\w)-\n(\w)", r"\1\2", t)))
        return "\n".join(map(str.rstrip, t.splitlines())).strip()

    for t, got in _run(spark, lambda c: text.tidy_space(text.join_hyphens(text.fix_ligatures(c)))):
        assert got == plain(t), repr(t)


def test_scrub_by_brute_force(spark):
    patterns = (r"[\w.+%-]+@[\w-]+\.[\w.]+", r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}", r"\b[A-Z]\d[A-Z]\s?\d[A-Z]\d\b", rf"(?i)\b\d+\s+(?:\w+\s+){{0,3}}(?:{text.STREETS})\b")

    def plain(t):
        total = 0
        for p in patterns:
            t, n = re.subn(p, "[CONTACT]", t)
            total += n
        return t, total

    for t, got in _run(spark, text.scrubbed):
        assert (got["text"], got["n"]) == plain(t), repr(t)


def test_mangled_and_headings(spark):
    def mangled(t):
        sizes = [len(x.split()) for x in t.splitlines() if x.strip()]
        dense = [c for c in t if c not in " \n"]
        return bool(sizes) and sum(n < 4 for n in sizes) / len(sizes) > 0.4 and sum(map(str.isdigit, dense)) / max(1, len(dense)) > 0.02

    def heading(t):
        letters = [c for c in t if c.isalpha()]
        return len(t.strip()) <= 120 and len(letters) >= 4 and sum(map(str.isupper, letters)) / len(letters) >= 0.7

    for t, got in _run(spark, text.is_mangled):
        assert got == mangled(t), repr(t)
    for t, got in _run(spark, text.is_caps_heading):
        assert got == heading(t), repr(t)


def test_cards_and_titles(spark):
    for t, got in _run(spark, lambda c: text.first_words(c, 3)):
        assert got == " ".join(re.sub(r"\[\[page \d+\]\]", " ", t).split()[:3]), repr(t)
    got = dict(_run(spark, text.doc_title))
    assert got["Title line\nsecond\n\nbody"] == "Title line second"
    assert got["[[page 1]]\n\n  first \n[[page 2]]\nx"] == "first"
    assert got[""] == ""


def test_word_windows(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 600, 601, 1150, 1151, 1700, 1701)], "n int").select("n", text.window_starts(F.col("n")).alias("o"))
    assert {r["n"]: len(r["o"]) for r in df.collect()} == {0: 1, 1: 1, 600: 1, 601: 2, 1150: 2, 1151: 3, 1700: 3, 1701: 4}


def test_scalars(spark):
    row = spark.createDataFrame([("Women's  Health: a Study of Long Titles, Part 2",)], "t string").select(scalars.slugify(F.col("t")).alias("s")).first()
    assert row["s"] == "womens_health_a_study_of_lon"
    dates = {"Published on: Monday, May 9, 2022 at 8:05 a.m. (EDT)": "2022-05-09", "Published on: later": None, "2023-02-30": None, "2023-02-28": "2023-02-28", "9 May 2022": "2022-05-09", "May 9 2022": "2022-05-09", "2022/05/09": "2022-05-09", "May 2022": None}
    df = spark.createDataFrame([(k,) for k in dates], "t string").select("t", scalars.published_date(F.col("t")).alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == dates
    arr = spark.range(1).select(F.array(*[F.lit(x) for x in (1, 2, 3, 4, 10)]).alias("a"))
    got = arr.select(*[scalars.exclusive_quantile(F.col("a"), i, n).alias(f"q{i}") for i, n in ((1, 4), (2, 4), (3, 4), (95, 100))]).first()
    assert [round(x, 6) for x in got] == [1.5, 3.0, 7.0, 14.2]
    bars = spark.createDataFrame([(5, 0), (1, 8), (3, 16)], "n int, t int").select(scalars.bar(F.col("n"), F.col("t")).alias("b")).collect()
    assert [len(r["b"]) for r in bars] == [0, 2, 4]


def test_urls_tags_and_percent(spark):
    df = spark.createDataFrame([("//x/y", True, True), ("/y", False, True), ("https://z", False, False)], "u string, d boolean, m boolean")
    got = [tuple(r) for r in df.select(scalars.absolute_url(F.col("u"), "https://b"), scalars.status_tag(F.col("d"), F.col("m"))).collect()]
    assert got == [("https://x/y", "DROP"), ("https://b/y", "MANG"), ("https://z", "OK")]
    assert spark.range(1).select(scalars.percent(F.lit(1), F.lit(8)), scalars.percent(F.lit(1), F.lit(0))).first()[:] == ("12.5%", "—")
