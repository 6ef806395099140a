from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tamarack.functions import cleaning, text
from tamarack.operators import chunks, clean

C = F.col


def apply(spark, expression, *values):
    """The expression over a column t of these values."""
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string")
    rows = df.select("k", expression(C("t")).alias("out")).orderBy("k").collect()
    return [r["out"] for r in rows]


def test_running_lines_need_more_than_half_of_the_pages(spark):
    pages = lambda t: F.split(t, r"\|", -1)
    got = apply(spark, lambda t: cleaning.running_prints(pages(t)), "H 1\na|H 2\nb|c", "H\na|b", "H\na|H\nb||", "H", "H\nH|H|x")
    assert got == [["h #"], [], [], [], ["h"]]
    got = apply(spark, lambda t: cleaning.without_prints(pages(t), F.array(F.lit("h #"))), "H 3\nx|H 4\n|y\n\nz")[0]
    assert [tuple(r) for r in got] == [("x", 1), ("", 1), ("y\n\nz", 0)]


def test_pages_round_trip(spark):
    got = apply(spark, lambda t: cleaning.joined(cleaning.pages_of(t), cleaning.markers_of(t)), "a\n[[page 2]]\nb[[page 3]]c", "[[page 2]]x", "", "a\n[[page 2]]", "[[page 2]][[page 3]]b")
    assert got == ["a\n[[page 2]]\n\nb\n[[page 3]]\nc", "[[page 2]]\nx", "", "a\n[[page 2]]\n", "[[page 2]]\n[[page 3]]\nb"]


def test_title_echo_goes_from_later_pages_only(spark):
    title = "Strengthening National Pharmacare\nCoverage Standards Together"
    pages = [f"{title}\n\nbody", f"{title}\n\nsecond page", "other text\nhere", f"{title}", "Strengthening National Pharmacare\nwords"]
    got = apply(spark, lambda t: cleaning.without_echoes(F.split(t, r"\|", -1)), "|".join(pages), title)
    assert [tuple(r) for r in got[0]] == [(pages[0], 0), ("second page", 1), (pages[2], 0), ("", 1), (pages[4], 0)]
    assert [tuple(r) for r in got[1]] == [(title, 0)]
    assert apply(spark, cleaning.title_words, "\n\nAnnual review of clinics\nParliament of Canada\nmore words", "Standing Committee on x", "") == [["annual", "review", "clinics"], [], []]


def test_contents_about_front_back(spark):
    contents = apply(spark, cleaning.without_contents, "x\nTable of Contents\nIntro ........ 3\n\niv\n[[page 2]]\n7\nOne ...... 4\nBody\nAfter ..... 9", "", "contents", "Contents\ncivil\n12\nContents\ny\nmild", "x\nContents\n\n")
    assert contents == ["x\n[[page 2]]\nBody\nAfter ..... 9", "", "", "y\nmild", "x"]
    about = apply(spark, cleaning.without_about, "a\nAbout Foo Society\nwe\n\nare\n\n\nb\nAbout 20 people came", "About Foo Society\nx\n[[page 2]]\ny", "a\nAbout Us\n\nx\nAbout Them\n\n\n\nb", "", "x\nabout approximately ten")
    assert about == ["a\nb\nAbout 20 people came", "[[page 2]]\ny", "a\n\nb", "", "x\nabout approximately ten"]
    assert apply(spark, cleaning.without_front, "cover\nSUMMARY\nx\nCONTEXT\n", "Summary\nx", "CONTEXT") == ["SUMMARY\nx\nCONTEXT\n", "Summary\nx", "CONTEXT"]
    back = apply(spark, cleaning.without_back, "Appendix A early\nLIST OF RECOMMENDATIONS\nr\nAPPENDIX B\nz", "a\nList of witnesses, and more\nAnnex B", "a \nlist of recommendations\nlist of recommendations\n", "briefs received", "Appendixes\nannexb")
    assert back == ["Appendix A early\nLIST OF RECOMMENDATIONS\nr", "a", "a \nlist of recommendations\nlist of recommendations\n", "", "Appendixes\nannexb"]


@pytest.mark.parametrize("step", [cleaning.without_contents, cleaning.without_about, cleaning.without_front, cleaning.without_back, cleaning.without_signature, cleaning.tidy])
def test_steps_take_very_long_texts(spark, step):
    long = "About Foo Society\n" + "line of text\n" * 50_000 + "Contents\n" + "7\n" * 50_000 + "APPENDIX A\n" + "x " * 100_000
    assert apply(spark, lambda t: F.length(step(t)), long)[0] < len(long) + 1


def test_signature_must_be_near_the_end(spark):
    body = "word " * 100
    got = apply(spark, cleaning.without_signature, f"{body}\nSincerely,\nJo", f"Regards\n{body}", f"{body}\nRegards\nmore\nYours truly,\nJo", "")
    assert got == [body.rstrip(), f"Regards\n{body}", f"{body}\nRegards\nmore", ""]


def test_masking_takes_aliases_and_whole_words(spark):
    df = spark.createDataFrame([("CDA and CDAA, canadian dental association. B", "The Canadian Dental Association (CDA) said", "Canadian Dental Association / B"), (r"a\Eb (Ott) A.B. x", r"a\Eb (Ott)", r"a\Eb / A.B."), ("x", "x", None)], "t string, of string, org string")
    names = F.coalesce(text.org_names(C("org")), F.array().cast("array<string>"))
    more = cleaning.aliases(C("of"), names)
    got = [tuple(r) for r in df.select(more, cleaning.masked(C("t"), F.concat(names, more))).collect()]
    assert got == [(["CDA"], "[ORG] and CDAA, [ORG]. B"), (["Ott"], "[ORG] ([ORG]) A.B. x"), ([], "x")]


def test_line_ends_become_one(spark):
    assert apply(spark, cleaning.tidy, "a \r\nb\x0cc\x85d e  f\t\tg\n\n\n\nh \n\r\n\r\ni ") == ["a\nb\nc\nd\ne f g\n\nh\n\n\ni"]


def _clean(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, text string, organization string, source_type string, clean_text string")
    return clean.clean_documents(df)


def test_clean_text_order(spark):
    page = "H\nBrief by Foo Group (FGX)\nCall 613-555-0199.\n[[page 2]]\nH\nFGX said pracﬁce inter-\nnational"
    brief, report = sorted(_clean(spark, [("a", page, "Foo Group", "hesa_brief", "x"), ("b", page, "Foo Group", "hesa_report", "x")]).collect(), key=lambda r: r["doc_id"])
    assert (brief["hf_removed"], brief["contact_count"], brief["title_echoes"], brief["dropped_short"]) == (2, 1, 0, True)
    assert brief["layout_mangled"]  # digits of the phone number count, as layout is judged before scrubbing
    assert brief["clean_text"] == "Brief by Foo Group (FGX)\nCall [CONTACT].\n[[page 2]]\n\nFGX said pracfice international"
    assert brief["masked_text"] == "Brief by [ORG] ([ORG])\nCall [CONTACT].\n[[page 2]]\n\n[ORG] said pracfice international"
    assert report["masked_text"] is None and report["clean_text"] == brief["clean_text"]


def test_clean_documents_edge_rows(spark):
    rows = [("a", None, None, None, "x"), ("b", "", None, None, "x"), ("c", "w " * 200, "Org", "hesa_brief", "x"), ("c", "w " * 200, "Org", "hesa_brief", "x")]
    got = _clean(spark, rows)
    assert got.columns == [f.split()[0] for f in clean.SCHEMA.split(", ")]
    found = got.collect()
    assert sorted(r["doc_id"] for r in found) == ["b", "c", "c"]
    assert next(r for r in found if r["doc_id"] == "b")["dropped_short"]
    assert got.limit(0).count() == 0


REPORT = """Cover text
LIST OF RECOMMENDATIONS
Recommendation 1
Do this ........ 12
Recommendation 2: and that
more
INTRODUCTION
Body text here
Recommendation 1
after it
CONCLUSION
"""


def _chunks(spark, kind, text, monkeypatch):
    monkeypatch.setattr(chunks, "LEAST_BYTES", 0)
    df = spark.createDataFrame([("d", kind, text, "x")], "doc_id string, source_type string, text string, seq string")
    return sorted(chunks.chunk_documents(df).collect(), key=lambda r: r["seq"])


def test_report_sections(spark, monkeypatch):
    rows = _chunks(spark, "hesa_report", REPORT, monkeypatch)
    assert [r["chunk_id"] for r in rows] == ["d_rec_001", "d_rec_002", "d_0003", "d_0004"]
    assert rows[0]["text"] == "Recommendation 1\nDo this" and rows[1]["rec_numbers"] == [2]
    assert rows[2]["section_title"] == "INTRODUCTION" and rows[3]["text"] == "after it"


def test_report_without_later_heading_starts_at_its_list(spark, monkeypatch):
    rows = _chunks(spark, "hesa_report", "x\nLIST OF RECOMMENDATIONS\nRecommendation 3\nyes\nplain end", monkeypatch)
    assert [r["is_recommendation"] for r in rows] == [True, False, False]
    twice = _chunks(spark, "hesa_report", "x\nList of recommendations\nHEADING\nLIST OF RECOMMENDATIONS\nRecommendation 4\nyes\nBODY PART\ntail", monkeypatch)
    assert [(r["section_title"], r["text"]) for r in twice] == [("Recommendation 4", "Recommendation 4\nyes"), ("BODY PART", "tail")]


def test_response_sections(spark, monkeypatch):
    text = "start\nRecommendations 5 to 8 are accepted\nwe agree\nRecommendations (1, 2 and 4)\nfine\nRecommendations (none)\nRecommendation 3: ok\nNEXT PART\ntail\nRecommendations 1 to 99999999"
    rows = _chunks(spark, "gov_response", text, monkeypatch)
    assert [r["rec_numbers"] for r in rows] == [[], [5, 6, 7, 8], [1, 2, 4], [], [3], [], [1, 99999999]]
    assert [r["chunk_id"] for r in rows] == ["d_0001", "d_rec_005", "d_rec_001", "d_rec", "d_rec_003", "d_0006", "d_rec_001"]


def test_windows_and_pages(spark, monkeypatch):
    sizes = [[r["token_approx"] for r in _chunks(spark, "policy", "w " * n, monkeypatch)] for n in (1, 600, 601, 1150, 1151)]
    assert list(map(len, sizes)) == [1, 1, 2, 2, 3]
    rows = _chunks(spark, "policy", "a\n[[page 2]]\nHEADING\nb\n[[page 3]]\nc\n[[page 4]]\nNEXT\nd\r\n[[page x]]", monkeypatch)
    assert [(r["section_title"], r["page_start"], r["page_end"]) for r in rows] == [("", 0, 0), ("HEADING", 2, 3), ("NEXT", 4, 4)]


def test_chunk_documents_skips_short_and_null(spark):
    df = spark.createDataFrame([("a", None, "policy"), ("b", "x" * 199, "policy"), ("c", "y " * 700, None), ("d", "y " * 300, "hesa_brief")], "doc_id string, text string, source_type string")
    got = chunks.chunk_documents(df).collect()
    assert sorted(r["chunk_id"] for r in got) == ["c_0001", "c_0002", "d_0001"]
    assert chunks.chunk_documents(df, types=chunks.CHUNKED_TYPES).count() == 0
