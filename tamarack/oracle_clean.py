"""The cleaning of documents in DuckDB's SQL: lines as rows, states as windows over them."""

from __future__ import annotations

from tamarack import fixtures
from tamarack.functions import cleaning
from tamarack.functions.text import EMAIL, MARKER, SHORT_WORDS, STREETS, WS
from tamarack.operators.clean import MASKED_TYPE, REPORT_TYPES
from tamarack.oracle import line_print, lines, mangled, n_words, q, strip, tidy, words

_NL = "chr(10)"
_RTRIM = rf"[{WS}]+$"
_MARK = r"^\[\[page [0-9]+\]\]$"
_DIGITS = r"[\p{Nd}²³¹⁰-⁹₀-₉①-⑨]+"


def _fixed(pattern: str) -> str:
    """A fixed pattern in RE2's dialect."""
    return pattern.replace(r"\s", f"[{WS}]").replace(r"\d", r"\p{Nd}")


def _long_words(x: str) -> str:
    return f"list_distinct(list_filter({words(rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_{WS}]', ' ', 'g')")}, lambda y: length(y) >= 5))"


def _rows(name: str, text: str, source: str) -> str:
    """CTE ``name`` (doc_id, i, line, s): the lines of ``text`` as rows."""
    return f"{name} AS (SELECT doc_id, i, line, {strip('line')} AS s FROM (SELECT doc_id, unnest({lines(text)}) AS line, generate_subscripts({lines(text)}, 1) AS i FROM {source}))"


def _text(name: str, rows: str, base: str, keep: str = "true") -> str:
    """CTE ``name`` (doc_id, t): the kept rows as a text for every document of ``base``."""
    return f"{name} AS (SELECT b.doc_id, coalesce(kept_text, '') AS t FROM {base} b LEFT JOIN (SELECT doc_id, string_agg(line, {_NL} ORDER BY i) AS kept_text FROM {rows} WHERE {keep} GROUP BY 1) USING (doc_id))"


def ctes(source: str) -> str:
    """CTEs that end in ``cleaned``, for a table (doc_id, text, organization, source_type) without null texts and with distinct ids."""
    n_title = f"list_position(list_transform(h, lambda y: y = '' OR regexp_matches(y, {q(_fixed(cleaning.TITLE_END))})), true)"
    reports = ", ".join(map(q, REPORT_TYPES))
    member = rf"^(?:.{{3,}}\.{{5,}}[{WS}]*\p{{Nd}}+|{_DIGITS}|[ivxlcdmIVXLCDM]+)?$"
    about = rf"(?i)^about[{WS}]+[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_{WS}&,.()/'-]{{1,80}}$"
    no_about = rf"(?i)^about[{WS}]+(?:approximately|around|\p{{Nd}})"
    heads = f"'(?i)^(?:table[{WS}]+of[{WS}]+contents|contents)$'"
    steps = (EMAIL, r"(?:\+?1[-. \t-\r]?)?\(?[0-9]{3}\)?[-. \t-\r][0-9]{3}[-. \t-\r][0-9]{4}", r"\b[A-Z][0-9][A-Z][ \t-\r]?[0-9][A-Z][0-9]\b", rf"(?i)\b[0-9]+[ \t-\r]+(?:[\p{{L}}\p{{N}}_]+[ \t-\r]+){{0,3}}(?:{STREETS})\b")
    scrub, last = [], "cut3"
    for k, p in enumerate(steps):
        n = "0" if k == 0 else "n"
        scrub.append(f"scrub{k} AS MATERIALIZED (SELECT doc_id, {n} + len(regexp_extract_all(t, {q(p)})) AS n, regexp_replace(t, {q(p)}, '[CONTACT]', 'g') AS t FROM {last})")
        last = f"scrub{k}"
    named = "list_filter(list_transform(string_split(coalesce(organization, ''), ' / '), lambda y: " + strip("y") + "), lambda y: y <> '')"
    return f"""src AS (SELECT doc_id::VARCHAR AS doc_id, text, organization, source_type, {named} AS names FROM {source}),
    pg AS (SELECT doc_id, string_split_regex(text, {q(MARKER)}) AS ps, regexp_extract_all(text, {q(MARKER)}) AS ms FROM src),
    page AS (SELECT doc_id, len(ps) AS n, unnest(ps) AS page, generate_subscripts(ps, 1) AS k, ms FROM pg),
    pline AS (SELECT doc_id, k, n, i, line, {line_print('line')} AS print FROM (SELECT doc_id, k, n, unnest({lines('page')}) AS line, generate_subscripts({lines('page')}, 1) AS i FROM page)),
    hf AS (SELECT doc_id, print FROM pline WHERE print <> '' AND n >= 2 GROUP BY doc_id, print HAVING count(DISTINCT k) > any_value(n) * 0.5),
    kept AS (SELECT l.*, h.print IS NOT NULL AS gone FROM pline l LEFT JOIN hf h USING (doc_id, print)),
    bare AS (SELECT p.doc_id, p.k, p.n, CASE WHEN p.doc_id IN (SELECT doc_id FROM hf) THEN coalesce(t, '') ELSE page END AS page, coalesce(removed, 0) AS removed
      FROM page p LEFT JOIN (SELECT doc_id, k, string_agg(line, {_NL} ORDER BY i) FILTER (NOT gone) AS t, count(*) FILTER (gone) AS removed FROM kept GROUP BY 1, 2) USING (doc_id, k)),
    head AS (SELECT doc_id, list_slice(r, coalesce(list_position(list_transform(r, lambda y: y <> ''), true), 1), coalesce(list_position(list_transform(r, lambda y: y <> ''), true), 1) + 7) AS h
      FROM (SELECT doc_id, list_transform({lines('page')}, lambda y: {strip('y')}) AS r FROM bare WHERE k = 1 AND n >= 2)),
    title AS (SELECT doc_id, {_long_words("coalesce(array_to_string(CASE WHEN " + n_title + " > 0 THEN list_slice(h, 1, " + n_title + " - 1) ELSE h END, ' '), '')")} AS tw FROM head),
    bline AS (SELECT doc_id, k, unnest({lines('page')}) AS line, generate_subscripts({lines('page')}, 1) AS i FROM bare WHERE k > 1),
    full_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS nb FROM bline WHERE {strip('line')} <> ''),
    win AS (SELECT a.doc_id, a.k, a.nb AS m, {_long_words(f"string_agg(b.line, ' ' ORDER BY b.nb)")} AS w FROM full_ a JOIN full_ b ON a.doc_id = b.doc_id AND a.k = b.k AND b.nb <= a.nb WHERE a.nb BETWEEN 2 AND 6 GROUP BY 1, 2, 3),
    echo AS (SELECT doc_id, k, min(m) AS m FROM win JOIN title USING (doc_id) WHERE len(tw) >= 4 AND len(w) >= 3 AND len(list_intersect(w, tw)) / len(w)::DOUBLE >= 0.8::DOUBLE AND len(list_intersect(w, tw)) / len(tw)::DOUBLE >= 0.8::DOUBLE GROUP BY 1, 2),
    rest AS (SELECT e.doc_id, e.k, coalesce(string_agg(l.line, {_NL} ORDER BY l.i) FILTER (l.i >= f.i), '') AS t FROM echo e JOIN bline l USING (doc_id, k) LEFT JOIN full_ f ON f.doc_id = e.doc_id AND f.k = e.k AND f.nb = e.m + 1 GROUP BY 1, 2),
    sound AS (SELECT b.doc_id, b.k, coalesce(r.t, page) AS page, removed, (r.t IS NOT NULL)::INT AS echo FROM bare b LEFT JOIN rest r USING (doc_id, k)),
    piece AS (SELECT doc_id, k, CASE WHEN k = 1 THEN page ELSE CASE WHEN before <> '' AND NOT ends_with(before, {_NL}) THEN {_NL} ELSE '' END || ms[k - 1] || {_NL} || page END AS t FROM (SELECT s.*, ms, lag(page) OVER (PARTITION BY s.doc_id ORDER BY k) AS before FROM sound s JOIN pg USING (doc_id))),
    whole AS (SELECT doc_id, {tidy('j')} AS t FROM (SELECT doc_id, string_agg(t, '' ORDER BY k) AS j FROM piece GROUP BY 1)),
    alias AS (SELECT s.doc_id, names || list_distinct(flatten(list_transform(names, lambda n: regexp_extract_all(t, '(?i)' || regexp_escape(n) || '[{WS}]*\\(([A-Z][A-Z0-9]{{1,7}})\\)', 1)))) AS names FROM src s JOIN whole USING (doc_id)),
    {_rows('line0', 't', 'whole')},
    toc AS (SELECT *, last_value(CASE WHEN regexp_matches(s, {q(_MARK)}) THEN NULL WHEN regexp_matches(s, {heads}) THEN 'in' WHEN NOT regexp_matches(s, {q(member)}) THEN 'out' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS ev FROM line0),
    {_text('cut0', 'toc', 'whole', f"regexp_matches(s, {q(_MARK)}) OR (NOT regexp_matches(s, {heads}) AND NOT (regexp_matches(s, {q(member)}) AND coalesce(ev, 'out') = 'in'))")},
    {_rows('line1', 't', 'cut0')},
    ab AS (SELECT *, last_value(CASE WHEN regexp_matches(s, {q(_MARK)}) THEN 'm' WHEN regexp_matches(s, {q(about)}) AND NOT regexp_matches(s, {q(no_about)}) THEN 'a' END IGNORE NULLS) OVER w AS ev,
      max(CASE WHEN regexp_matches(s, {q(_MARK)}) OR (regexp_matches(s, {q(about)}) AND NOT regexp_matches(s, {q(no_about)})) THEN i END) OVER w AS a0, s = '' AND lag(s) OVER w = '' AS two FROM line1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    ab2 AS (SELECT *, min(CASE WHEN two AND i >= a0 + 2 THEN i END) OVER (PARTITION BY doc_id, a0) AS stop FROM ab),
    {_text('cut1', 'ab2', 'whole', "NOT (coalesce(ev, 'm') = 'a' AND i <= coalesce(stop, i))")},
    {_rows('line2', 't', 'cut1')},
    kind AS (SELECT l.*, source_type IN ({reports}) AS rep FROM line2 l JOIN src USING (doc_id)),
    start AS (SELECT doc_id, min(i) AS a FROM kind WHERE rep AND regexp_matches(line, {q(rf'^(?:{cleaning.CONTENT_START})$')}) GROUP BY 1),
    front AS (SELECT k.*, coalesce(a, 1) AS a FROM kind k LEFT JOIN start USING (doc_id) WHERE i >= coalesce(a, 1)),
    listed AS (SELECT doc_id, min(i) AS r FROM front WHERE rep AND regexp_matches(line, {q(f'(?i)^{_fixed(cleaning.RECOMMENDATIONS)}$')}) GROUP BY 1),
    back AS (SELECT f.doc_id, min(i) AS b FROM front f LEFT JOIN listed USING (doc_id) WHERE rep AND i > coalesce(r, 0) AND regexp_matches(line, {q(rf'(?i)^(?:{_fixed(cleaning.BACK_MATTER)})(?:[^\p{{L}}\p{{N}}_]|$)')}) GROUP BY 1),
    front2 AS (SELECT f.doc_id, i, line FROM front f LEFT JOIN back USING (doc_id) WHERE i < coalesce(b, i + 1)),
    {_text('cut2', 'front2', 'whole')},
    cut3 AS (SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM back) THEN regexp_replace(t, {q(_RTRIM)}, '') ELSE t END AS t FROM cut2),
    {', '.join(scrub)},
    {_rows('line3', 't', 'scrub3')},
    sal AS (SELECT doc_id, max(i) AS z FROM line3 WHERE regexp_matches(line, {q(rf'(?i)^(?:{cleaning.SALUTATION})[,.]?[{WS}]*$')}) GROUP BY 1),
    tail AS (SELECT doc_id, z, string_agg(line, {_NL} ORDER BY i) AS tl FROM line3 JOIN sal USING (doc_id) WHERE i >= z GROUP BY 1, 2),
    sign AS (SELECT doc_id, z FROM tail JOIN scrub3 USING (doc_id) WHERE {n_words('tl')} < least(200, greatest(1, floor({n_words('t')} * 0.10::DOUBLE)))),
    line4 AS (SELECT l.* FROM line3 l LEFT JOIN sign USING (doc_id) WHERE i < coalesce(z, i + 1)),
    {_text('cut4', 'line4', 'whole')},
    final AS (SELECT doc_id, {tidy('t', prints=False)} AS t FROM cut4),
    sums AS (SELECT doc_id, sum(removed)::INT AS hf_removed, sum(echo)::INT AS title_echoes FROM sound GROUP BY 1),
    cleaned AS (SELECT s.doc_id, f.t AS clean_text, CASE WHEN source_type = {q(MASKED_TYPE)} THEN list_reduce([f.t] || list_sort(list_transform(list_filter(a.names, lambda n: length(n) >= 3), lambda n, k: lpad((1000000 - length(n))::VARCHAR, 8, '0') || lpad(k::VARCHAR, 8, '0') || n)), lambda x, n: regexp_replace(x, '(?i)\\b' || regexp_escape(n[17:]) || '\\b', '[ORG]', 'g')) END AS masked_text,
      {n_words('s.text')}::INT AS words_before, {n_words('f.t')}::INT AS words_after, hf_removed, title_echoes, c.n::INT AS contact_count, {mangled('b.t')} AS layout_mangled, {n_words('f.t')} < {SHORT_WORDS} AS dropped_short
      FROM src s JOIN final f USING (doc_id) JOIN alias a USING (doc_id) JOIN sums USING (doc_id) JOIN scrub3 c USING (doc_id) JOIN cut3 b USING (doc_id))"""



def oracle_sql() -> dict[str, str]:
    docs = "(SELECT doc_id, text, organization, source_type FROM documents WHERE text IS NOT NULL)"
    hf = "hf_removed"
    before, between, after, even, odd = (q(x).replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '") for x in (*fixtures.WRAP, fixtures.WRAP_EVEN, fixtures.WRAP_ODD))
    name = "coalesce(organization, 'Example Society')"
    wrapped = f"(SELECT doc_id, {before} || {name} || {between} || text || {after} || CASE WHEN doc_id % 2 = 0 THEN {even} ELSE {odd} END AS text, {name} AS organization, source_type FROM documents WHERE text IS NOT NULL)"
    return {
        "clean_wrapped": f"WITH {ctes(wrapped)} SELECT * FROM cleaned",
        "clean_documents": f"WITH {ctes(docs)} SELECT * FROM cleaned",
        "cleaning_summary": f"""WITH {ctes(docs)} SELECT count(*) AS n_docs, count(*) FILTER (dropped_short) AS n_short, count(*) FILTER (layout_mangled) AS n_mangled, sum(contact_count)::BIGINT AS n_contacts, sum(title_echoes)::BIGINT AS n_echoes,
            count(*) FILTER (title_echoes > 0) AS docs_with_echoes, count(*) FILTER ({hf} > 0) AS docs_with_hf, sum({hf})::BIGINT AS n_hf, coalesce(avg({hf}) FILTER ({hf} > 0), 0) AS avg_hf FROM cleaned""",
    }
