"""Structured text and listings out of HTML, by the standard library's parser.

A page is parsed into a small tree once; every extractor is a walk over it. Extractors run in Arrow
passes, one row in, its texts or records out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that hold no text of a document.
DROPPED = frozenset("nav header footer script style noscript".split())
CONTAINERS = frozenset("div section article main blockquote aside".split())
HEADINGS = {f"h{k}": "#" * k + " " for k in range(1, 7)}
#: A start tag of the key ends an open element of the values.
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS = CONTAINERS | set(HEADINGS) | {"ul", "ol", "table", "p", "nav", "header", "footer", "form", "pre"}
#: Ends of elements are looked for inside these only.
SCOPES = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "p": CONTAINERS | {"td", "th", "li"}}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []

    def all(self, *tags: str) -> Iterator[Node]:
        """Descendants in document order, without recursion limits."""
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, Node):
                if not tags or child.tag in tags:
                    yield child
                stack.append(iter(child.children))

    def classed(self, name: str) -> Iterator[Node]:
        return (n for n in self.all() if name in (n.attrs.get("class") or "").split())

    def text(self, gap: str = " ") -> str:
        """All text of the element, its pieces stripped and joined."""
        out, stack = [], [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, str):
                out.append(child.strip())
            else:
                stack.append(iter(child.children))
        return gap.join(t for t in out if t)

    def own_text(self) -> str:
        return "".join(c for c in self.children if isinstance(c, str)).strip()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        outermost = len(self.open)
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in SCOPES.get(tag, BLOCKS - {"p"}):
                break
            if self.open[k].tag in ends:
                outermost = k
        del self.open[outermost:]
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _rows(node: Node) -> Iterator[str]:
    """Lines of an element: headings, paragraphs, list items, table rows; containers are entered, all else is passed over."""
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, Node) and child.tag not in DROPPED:
            if child.tag in HEADINGS or child.tag in ("p", "li"):
                text = _kept_text(child)
                yield HEADINGS.get(child.tag, "") + text if text else ""
            elif child.tag in ("ul", "ol"):
                yield from (_kept_text(c) for c in child.children if isinstance(c, Node) and c.tag == "li")
            elif child.tag == "table":
                yield from ("\t".join(t for t in map(_kept_text, row.all("td", "th")) if t) for row in child.all("tr"))
            elif child.tag in CONTAINERS:
                stack.append(iter(child.children))


def _kept_text(node: Node) -> str:
    if not any(n.tag in DROPPED for n in node.all()):
        return node.text()
    out, stack = [], [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            out.append(child.strip())
        elif child.tag not in DROPPED:
            stack.append(iter(child.children))
    return " ".join(t for t in out if t)


def page_text(html: str | None) -> str:
    """Structured text of a page: of #publicationContent, else <main>, else <body>, else nothing."""
    root = parse(html or "")
    area = next((n for n in root.all() if n.attrs.get("id") == "publicationContent"), None) or next(root.all("main"), None) or next(root.all("body"), None)
    return "\n".join(r for r in _rows(area) if r) if area else ""


def study_list(html: str | None) -> list[dict]:
    """Studies linked from a listing, in page order, the first link with a title for each id."""
    out: dict[str, str] = {}
    for a in parse(html or "").all("a"):
        href, title = a.attrs.get("href") or "", a.text("")
        if "StudyActivity?studyActivityId=" in href and title:
            out.setdefault(href.split("studyActivityId=")[1].split("&")[0], title)
    return [{"position": k, "study_id": i, "title": t} for k, (i, t) in enumerate(out.items())]


# Addresses of a study's report and of the response to it.
_REPORT = re.compile(r"/DocumentViewer/en/\d+-\d+/HESA/report-\d+/$")
_RESPONSE = re.compile(r"/DocumentViewer/en/\d+-\d+/HESA/report-\d+/response-")


def study_meta(html: str | None) -> dict:
    """Title of a study's page and its first links to a report and to a response."""
    root = parse(html or "")
    links = [a.attrs.get("href") or "" for a in root.all("a")]
    heading = next(root.all("h1"), None)
    return {
        "title": heading.text("") if heading else "",
        "report_viewer_url": next((h for h in links if _REPORT.search(h)), None),
        "govresponse_viewer_url": next((h for h in links if _RESPONSE.search(h)), None),
    }


def pdf_link(html: str | None) -> str | None:
    """The first link that ends in .pdf or reads pdf."""
    for a in parse(html or "").all("a"):
        href = a.attrs.get("href")
        if href is not None and (href.lower().endswith(".pdf") or a.text("").lower() == "pdf"):
            return href
    return None


def briefs(html: str | None) -> list[dict]:
    """Briefs of a listing: submitter (joint ones joined by ' / '), link and the published line."""
    out = []
    for k, item in enumerate(parse(html or "").classed("brief-item")):
        link = next((a for a in item.classed("btn-brief") if a.tag == "a"), None)
        if link is None:
            continue
        joint = [n for n in item.classed("joint-name") if n.tag == "li"]
        single = next(item.classed("name"), None)
        published = next(item.classed("published"), None)
        names = [t for t in (n.own_text() for n in joint) if t] if joint else [single.own_text() if single else ""]
        out.append({"position": k, "organization": " / ".join(names), "pdf_href": link.attrs.get("href") or "", "is_joint": bool(joint), "published_text": published.text("") if published else None})
    return out


def html_column(df: DataFrame, id_col: str, html_col: str, extract: Callable, kind: str, out: str) -> DataFrame:
    """(id, out) with ``extract`` applied to each page, ``kind`` its SQL type; null pages are treated as empty."""
    source = df.select(F.col(id_col), F.col(html_col).cast("string").alias("html"))
    arrow = {"string": pa.string()}.get(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow)] if arrow else [batch.column(0), _as(found, kind)], [id_col, out])

    return source.mapInArrow(run, f"{id_col} {source.schema[id_col].dataType.simpleString()}, {out} {kind}")


STUDIES = "array<struct<position:int,study_id:string,title:string>>"
META = "struct<title:string,report_viewer_url:string,govresponse_viewer_url:string>"
BRIEFS = "array<struct<position:int,organization:string,pdf_href:string,is_joint:boolean,published_text:string>>"


def _as(found: list, kind: str) -> pa.Array:
    fields = [tuple(f.split(":")) for f in re.search(r"struct<(.*?)>+$", kind)[1].split(",")]
    types = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    struct = pa.struct([(n, types[t]) for n, t in fields])
    return pa.array(found, pa.list_(struct) if kind.startswith("array") else struct)


def extract_pages(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return html_column(df, id_col, html_col, page_text, "string", "text")


def prefer_pdf(text: Column, pdf: Column, n_words: Column, least: int = 500) -> Column:
    """The page's text, or the linked PDF's where the page holds under ``least`` words and there is one."""
    return F.when((n_words < least) & pdf.isNotNull(), pdf).otherwise(text)


def parse_studies(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return html_column(df, id_col, html_col, study_list, STUDIES, "s").select(id_col, F.explode("s").alias("s")).select(id_col, "s.*")


def parse_study_pages(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return html_column(df, id_col, html_col, study_meta, META, "m").select(id_col, "m.*")


def parse_briefs(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return html_column(df, id_col, html_col, briefs, BRIEFS, "b").select(id_col, F.explode("b").alias("b")).select(id_col, "b.*")


def parse_pdf_links(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return html_column(df, id_col, html_col, pdf_link, "string", "pdf_href")
