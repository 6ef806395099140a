"""Small literal inputs for what the tables cannot supply, for Spark queries and their SQL alike."""

from __future__ import annotations

TITLES = (
    "Committee Business",
    "Election of Chair",
    "Briefing by the Minister",
    "Briefing on Vaccines",
    "Study of Bill C-64",
    "An Act (Bill S-203)",
    "Main Estimates 2023-24",
    "committee business in lower case",
    "Subject Matter of Supplementary Estimates (B)",
    "Meeting Requested by Four Members",
    "Women's Health",
    "Departmental Plan 2022",
)
LISTED = ("Briefing on Vaccines", " Women's Health ")
PUBLISHED = (
    "Published on: Monday, May 9, 2022 at 8:05 a.m. (EDT)",
    "Published on: Friday, April 22, 2022 at 12:16 p.m. (EST)",
    "Published on: soon",
    "",
    "2023-02-30",
    "2023-02-28",
    "May 2022",
    "9 May 2022",
    "May 9 2022",
    "2022/05/09",
    "2022.5.9",
    "Sept. 3rd, 2021",
    "on the 21st December, 2020 or so",
    "32 May 2022",
    "20220509",
    "Published on: Tuesday, February 30, 2021 at 1:00 p.m. (EST)",
)
BLOCKS = [
    ("two", 1, 50.0, 100.0, 0, "  Second line \n"),
    ("two", 1, 50.0, 20.0, 0, "Title " + "word " * 30),
    ("two", 1, 10.0, 100.0, 0, "first of the line"),
    ("two", 1, 10.0, 300.0, 1, "an image"),
    ("two", 2, 10.0, 10.0, 0, "Page two " + "word " * 30),
    ("scan", 1, 10.0, 10.0, 0, "stamp"),
    ("scan", 2, 10.0, 10.0, 0, "   "),
    ("one", 1, 10.0, 10.0, 0, "short page"),
    ("blank", 1, 10.0, 10.0, 1, ""),
]
PAGES = [
    (1, "<html><body><nav>menu</nav><div><h2>Access to <b>care</b></h2><p>One<p>Two<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>3</table>loose text<section><blockquote><p>in <script>no</script>side</p></blockquote></section><footer>end</footer></div></body></html>"),
    (2, "<body><p>outside</p><main><h1>Main</h1><p>inside &amp; more</p></main></body>"),
    (3, "<body><main><p>not this</p></main><div id='publicationContent'><h3>Part</h3><ol><li>x <i>y</i></li></ol></div></body>"),
    (4, "<ul><li><a href='/StudyActivity?studyActivityId=11&x=1'>First</a></li><li><a href='/StudyActivity?studyActivityId=12'> Second </a></li><li><a href='/StudyActivity?studyActivityId=11'>Again</a></li><li><a href='/StudyActivity?studyActivityId=13'></a></li></ul>"),
    (5, "<h1>Study title</h1><a href='/DocumentViewer/en/44-1/HESA/report-3/'>r</a><a href='//www.example.org/DocumentViewer/en/44-1/HESA/report-3/response-8512'>g</a><a href='/DocumentViewer/en/44-1/HESA/report-4/'>r</a><a href='/x/Report.PDF'>download</a>"),
    (
        6,
        "<div class='brief-item'><a class='btn btn-brief' href='//www.example.org/a.pdf'>b</a><div class='name'>Dental <span>x</span>Group</div><span class='published'>Published on: Monday, May 9, 2022 at 8:05 a.m. (EDT)</span></div>"
        "<div class='brief-item'><a class='btn-brief' href='/b.pdf'>b</a><ul><li class='joint-name'>A</li><li class='joint-name'> B </li><li class='joint-name'><b>no</b></li></ul><span class='published'>later</span></div>"
        "<div class='brief-item'><div class='name'>No link</div></div>",
    ),
    (7, ""),
    (8, None),
]

#: Pages around every text, so that running lines, title echoes, contents lists, paragraphs about the submitter, front and back matter, contacts and
#: salutations all occur: what stands before the name of the organisation, between it and the text, and after the text, by parity of the id.
WRAP = (
    "Committee brief 1\nAnnual review of northern pharmacy services\nDelivered across remote communities\n\n",
    " (ORGX) writes to you.\nTable of  Contents\nIntroduction ......... 3\niv\n\n[[page 2]]\nCommittee brief 2\n12\nOther matters ....... 9\nKept line\n[[page 3]]\nCommittee brief 3\nAnnual review of northern pharmacy services\nDelivered across remote communities\n\nINTRODUCTION\n",
    "\n[[page 4]]\nCommittee brief 4\nAbout the Example Society\nwe care\n\nabout people\n[[page 5]]Committee brief 5\nAbout 20 people came.\nABOUT US AND OTHERS\nwe \n \n\t\nafter it\nORGX and orgx-like bodies agree.\n",
)
WRAP_EVEN = "LIST OF RECOMMENDATIONS\nRecommendation 1\nfund it, call 613-555-0199 or a.b@c.example, K1A 0B1, 12 Main Street\nAppendix B\nfigures"
WRAP_ODD = "Appendix A\nList of recommendations\nfund it; write to 40 Elm Rd\nSincerely,\nJo of ORGX"
