from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tamarack.functions.scalars import absolute_url, published_date
from tamarack.schemas import CHUNK, MANIFEST, ORG_LOOKUP
from tamarack.sources import files, html, sinks
from tamarack.streaming import ingest


def test_page_text_prefers_the_content_area():
    page = "<body><p>no</p><main><h2>T <b>x</b></h2><p>a<p>b<script>z</script><ul><li>one<li>two</ul><table><tr><th>1<td>2<tr><td></table>loose<figure><p>skip</p></figure></main></body>"
    assert html.page_text(page) == "## T x\na\nb\none\ntwo\n1\t2"
    assert html.page_text(page.replace("<p>no</p>", "<div id=publicationContent><p>yes</p></div>")) == "yes"
    assert html.page_text("") == html.page_text(None) == html.page_text("plain") == ""


def test_listing_parsers():
    listing = "<a href='x?studyActivityId=9'>no</a><a href='/StudyActivity?studyActivityId=1&b=2'>One</a><a href='/StudyActivity?studyActivityId=1'>Again</a>"
    assert [s["title"] for s in html.study_list(listing)] == ["One"]
    assert html.pdf_link("<a href='/a'> PDF </a>") == "/a"
    assert html.pdf_link("<a name='x'>pdf</a>") is None
    meta = html.study_meta("<h1> S </h1><a href='/DocumentViewer/en/44-1/HESA/report-1/'>x</a><a href='/DocumentViewer/en/44-1/HESA/report-1/response-2'>y</a>")
    assert meta == {"title": "S", "report_viewer_url": "/DocumentViewer/en/44-1/HESA/report-1/", "govresponse_viewer_url": "/DocumentViewer/en/44-1/HESA/report-1/response-2"}


def test_briefs(spark):
    single = "<div class='brief-item'><a class='btn btn-brief' href='//x.example/{0}.pdf'>b</a><div class='name'>Group {0}</div><span class='published'>Published on: Monday, May 9, 2022 at 8:05 a.m. (EDT)</span></div>"
    joint = "<div class='brief-item'><a class='btn-brief' href='/j.pdf'>b</a><ul><li class='joint-name'>A</li><li class='joint-name'>B</li></ul></div>"
    page = "".join(single.format(k) for k in range(20)) + joint
    rows = html.parse_briefs(spark.createDataFrame([(1, page)], "page int, h string"), "page", "h")
    got = rows.select("*", absolute_url(F.col("pdf_href"), "https://h.example").alias("url"), published_date(F.col("published_text")).alias("iso")).orderBy("position").collect()
    assert len(got) == 21 and all(r["url"].startswith("https:") for r in got)
    assert [r["organization"] for r in got if r["is_joint"]] == ["A / B"]
    assert (got[0]["organization"], got[0]["iso"], got[20]["iso"]) == ("Group 0", "2022-05-09", None)


def test_manifest_last_line_wins(spark, tmp_path):
    lines = [{"doc_id": "a", "language": None}, {"doc_id": "b", "joint": True}, {"doc_id": "a", "language": "en", "extra": 1}]
    (tmp_path / "m.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    got = files.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert got.columns == [f.name for f in MANIFEST]
    assert {r["doc_id"]: (r["language"], r["joint"]) for r in got.collect()} == {"a": ("en", None), "b": (None, True)}
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), CHUNK).count() == 0


def test_csv_and_lookup(spark, tmp_path):
    (tmp_path / "l.csv").write_text('org,stakeholder_type\n" A, ""x"" ",b\n"two\nlines",c\n A ,d\n')
    got = {r["org"]: r["stakeholder_type"] for r in files.read_lookup(spark, str(tmp_path / "l.csv"), ORG_LOOKUP, "org").collect()}
    assert got == {'A, "x"': "b", "two\nlines": "c", "A": "d"}
    assert files.read_csv(spark, str(tmp_path / "no.csv"), ORG_LOOKUP).count() == 0


def test_text_and_raw_folders(spark, tmp_path):
    (tmp_path / "d1.txt").write_text("one\ntwo")
    (tmp_path / "d2.pdf").write_bytes(b"12345")
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path)).collect()] == [("d1", "one\ntwo")]
    totals = {r["file_type"]: (r["n_files"], r["n_bytes"]) for r in files.file_totals(files.read_raw(spark, str(tmp_path))).collect()}
    assert totals == {"txt": (1, 7), "pdf": (1, 5), None: (2, 12)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b", "u3")], "doc_id string, source_url string")
    assert sinks.append_new(df, str(tmp_path / "t"), "doc_id").count() == 2
    sinks.append_new(df, str(tmp_path / "t"), "doc_id")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    known = spark.createDataFrame([("a", "zz"), ("q", "u3")], "doc_id string, source_url string")
    assert sinks.new_documents(df, known).count() == 0
    with pytest.raises(ValueError):
        sinks.write_snapshot(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "t"))
    corpus = spark.createDataFrame([("b", 'x "y"\nz'), ("a", None)], "doc_id string, card_text string")
    sinks.write_corpus(corpus, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, multiLine=True, quote='"', escape='"')
    assert {r["doc_id"]: r["card_text"] for r in back.collect()} == {"a": None, "b": 'x "y"\nz'}
    chunk = spark.createDataFrame([("d_1", "d")], "chunk_id string, doc_id string")
    sinks.write_chunks(chunk, str(tmp_path / "k"))
    sinks.write_chunks(chunk, str(tmp_path / "k"))
    assert spark.read.json(str(tmp_path / "k")).count() == 1
    split = spark.createDataFrame([("d", "train"), ("e", "dev")], "doc_id string, split string")
    sinks.write_splits(split, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 2
    sheet = sinks.labelling_sheet(spark.createDataFrame([("d", "o", "t", "weak")], "doc_id string, org string, card_text string, topic_seed string"))
    assert sheet.columns == ["doc_id", "org", "card_text", "gold_topic", "gold_stakeholder", "notes"]


def test_pdf_blocks(spark):
    rows = [("d", 1, 9.0, 5.0, 0, "b"), ("d", 1, 1.0, 5.0, 0, " a "), ("d", 2, 0.0, 0.0, 0, "c" * 300), ("d", 2, 0.0, 9.0, 1, "img"), ("s", 1, 0.0, 0.0, 0, "x"), ("s", 2, 0.0, 0.0, 0, "")]
    got = {r["doc_id"]: (r["text"], r["needs_ocr"]) for r in files.pdf_text(spark.createDataFrame(rows, "doc_id string, page int, x0 double, y0 double, block_type int, text string")).collect()}
    assert got == {"d": ("a\nb\n[[page 2]]\n" + "c" * 300, False), "s": (None, True)}


def test_stream_ingests_each_document_once(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def go():
        rows = ingest.fetch_once(ingest.manifest_stream(spark, str(source)))
        ingest.run(rows, lambda b: b.select("doc_id"), str(out), str(tmp_path / "ck")).awaitTermination(60)

    (source / "1.jsonl").write_text('{"doc_id": "a"}\n{"doc_id": "a"}\n{"doc_id": "b"}\n{"doc_id": null}\n')
    go()
    (source / "2.jsonl").write_text('{"doc_id": "b"}\n{"doc_id": "c"}\n')
    go()
    assert sorted(r["doc_id"] for r in spark.read.parquet(str(out)).select("doc_id").collect()) == ["a", "b", "c"]


def test_pages_of_any_depth():
    assert html.page_text("<body><p>a " + "<span>" * 5000 + "deep<script>x</script>" + "</span>" * 5000 + " b</p></body>") == "a deep b"
