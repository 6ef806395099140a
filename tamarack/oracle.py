"""The same results in DuckDB's SQL. Snippets below build the scalar expressions; every query is one statement."""

from __future__ import annotations

import json

from tamarack import fixtures
from tamarack.functions import scalars
from tamarack.functions.text import EMAIL, LIGATURES, MARKER, STREETS, WS
from tamarack.operators.labels import EXEMPT_TITLES, FALLBACK, HEALTH_TOPICS, INDIVIDUAL, keyword_pattern

_ENDS = r"\r\n|[\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_TRAIL = r"[\t\x{0b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_NL = "chr(10)"


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {to if to == _NL else q(to)}, '{flags}')"


def strip(x: str) -> str:
    return sub(x, rf"^[{WS}]+|[{WS}]+$", "")


def lines(x: str) -> str:
    one = f"regexp_replace({x}, {q(_ENDS)}, {_NL}, 'g')"
    return f"CASE WHEN length({x}) = 0 THEN []::VARCHAR[] ELSE string_split(regexp_replace({one}, '\\n\\z', ''), {_NL}) END"


def words(x: str) -> str:
    return f"CASE WHEN {strip(x)} = '' THEN []::VARCHAR[] ELSE string_split_regex({strip(x)}, {q(rf'[{WS}]+')}) END"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def hash_form(x: str) -> str:
    return strip(sub(f"lower({sub(x, MARKER, ' ')})", rf"[{WS}]+", " "))


def line_print(x: str) -> str:
    return sub(f"lower({strip(x)})", r"\p{Nd}+", "#")


def n_found(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def tidy(x: str, prints: bool = True) -> str:
    """White space tidied; with ``prints`` ligatures and words cut by a hyphen first."""
    if prints:
        for bad, good in LIGATURES.items():
            x = f"replace({x}, {q(bad)}, {q(good)})"
        x = rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    x = rf"regexp_replace(regexp_replace(regexp_replace({x}, '[ \t]+', ' ', 'g'), '\n{{3,}}', {_NL} || {_NL}, 'g'), {q(_ENDS)}, {_NL}, 'g')"
    return strip(rf"regexp_replace({x}, '{_TRAIL}(\n|\z)', '\1', 'g')")


def mangled(x: str) -> str:
    rows = f"list_filter({lines(x)}, lambda y: {strip('y')} <> '')"
    dense = f"replace(replace({x}, ' ', ''), chr(10), '')"
    digits = r"\p{Nd}|[²³¹⁰-⁹₀-₉①-⑨]"
    return f"coalesce(len({rows}) > 0 AND len(list_filter({rows}, lambda y: {n_words('y')} < 4)) / len({rows})::DOUBLE > 0.4::DOUBLE AND {n_found(dense, digits)} / greatest(length({dense}), 1)::DOUBLE > 0.02::DOUBLE, false)"


def first_words(x: str, n: int = 250) -> str:
    return f"coalesce(array_to_string(list_slice({words(sub(x, MARKER, ' '))}, 1, {n}), ' '), '')"


def is_heading(x: str) -> str:
    s = strip(x)
    return f"(length({s}) BETWEEN 1 AND 120 AND {n_found(s, r'\p{L}')} >= 4 AND {n_found(s, r'\p{Lu}')} >= 0.70::DOUBLE * {n_found(s, r'\p{L}')})"


def title(x: str) -> str:
    rows = f"list_transform({lines(x)}, lambda y: {strip('y')})"
    return f"""(SELECT left(coalesce(array_to_string(list_filter(t, lambda y, k: k < coalesce(list_position(list_transform(t, lambda z: z = '' OR starts_with(z, '[[page')), true), 99)), ' '), ''), 200)
        FROM (SELECT list_slice(r, p, p + 3) AS t FROM (SELECT r, coalesce(list_position(list_transform(r, lambda z: z <> '' AND NOT starts_with(z, '[[page')), true), 1000000) AS p FROM (SELECT {rows} AS r))))"""


def topic(text: str, loose: bool) -> str:
    cases = []
    for code, strong, plain in HEALTH_TOPICS:
        holds = [f"regexp_matches({text}, {q('(?i)' + keyword_pattern(k))})" for k in strong + (plain if loose else ())]
        if not loose and plain:
            holds.append("(" + " + ".join(f"regexp_matches({text}, {q('(?i)' + keyword_pattern(k))})::INT" for k in plain) + ") >= 2")
        cases.append(f"WHEN {' OR '.join(holds)} THEN {q(code)}")
    return f"CASE {' '.join(cases)} END"


def title_topic(t: str) -> str:
    return f"CASE WHEN length({t}) > 0 AND lower({t}) NOT IN ({', '.join(map(q, EXEMPT_TITLES))}) THEN {topic(t, True)} END"


def topics_cte() -> str:
    return f"""cards AS (SELECT doc_id, study_title, {first_words('text')} AS card FROM documents WHERE text IS NOT NULL),
    topics AS (SELECT doc_id, coalesce({topic('card', False)}, {title_topic('study_title')}, {q(FALLBACK)}) AS content_first,
        coalesce({title_topic('study_title')}, {topic('card', True)}, {q(FALLBACK)}) AS title_first FROM cards)"""


LATEST = "latest AS (SELECT * FROM manifest WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) = 1)"
TOPICED = "topiced AS (SELECT * REPLACE (nullif(regexp_replace(lower(trim(topic_seed)), '[ -]', '_', 'g'), '') AS topic_seed) FROM corpus_fixture)"
GOLD = "gold AS (SELECT DISTINCT doc_id FROM gold_test_fixture WHERE doc_id IS NOT NULL)"
DUPS = f"{LATEST}, dups AS (SELECT doc_id FROM latest WHERE length(duplicate_of) > 0)"
DIRTY = """dirty AS (SELECT DISTINCT near_dup_cluster FROM corpus_fixture WHERE length(near_dup_cluster) > 0 AND doc_id NOT IN (SELECT doc_id FROM dups) AND doc_id IN (SELECT doc_id FROM gold))"""
ELIGIBLE = f"""{DUPS}, {GOLD}, {TOPICED}, {DIRTY}, eligible AS (SELECT DISTINCT ON (doc_id) * FROM topiced WHERE doc_id NOT IN (SELECT doc_id FROM dups) AND doc_id NOT IN (SELECT doc_id FROM gold)
    AND coalesce(near_dup_cluster, '') NOT IN (SELECT near_dup_cluster FROM dirty)),
  united AS (SELECT *, CASE WHEN coalesce(near_dup_cluster, '') = '' THEN 'd:' || doc_id ELSE 'c:' || near_dup_cluster END AS unit FROM eligible),
  units AS (SELECT unit, first(topic ORDER BY n DESC, topic) AS topic, sum(n)::BIGINT AS n_docs, min(least) AS first_id
    FROM (SELECT unit, coalesce(topic_seed, '') AS topic, count(*) AS n, min(doc_id) AS least FROM united GROUP BY ALL) GROUP BY unit)"""
SPLIT = f"""{ELIGIBLE}, ranked AS (SELECT unit, topic, row_number() OVER (PARTITION BY topic ORDER BY md5('42|' || unit)) AS rk, greatest(1, round_even(count(*) OVER (PARTITION BY topic) * 0.1::DOUBLE, 0)) AS n_dev FROM units),
  split AS (SELECT doc_id, unit, r.topic, CASE WHEN rk <= n_dev THEN 'dev' ELSE 'train' END AS split FROM united JOIN ranked r USING (unit))"""
POOL = f"{TOPICED}, pool AS (SELECT DISTINCT ON (doc_id) * FROM topiced WHERE coalesce(near_dup_cluster, '') = '' AND topic_seed IS NOT NULL)"


def allocation(source: str, target: int, floor: int, order: str) -> str:
    """CTEs that end in ``quotas`` (source.*, quota)."""
    return f"""a0 AS (SELECT *, least({floor}, n_docs) AS a FROM {source}),
    a1 AS (SELECT *, n_docs - a AS room, {target} - sum(a) OVER () AS rest, sum(n_docs - a) OVER () AS rooms FROM a0),
    a2 AS (SELECT *, CASE WHEN rest > 0 AND rooms > 0 THEN rest * room / rooms::DOUBLE ELSE 0 END AS r FROM a1),
    a3 AS (SELECT *, floor(r) AS i, greatest(rest - sum(floor(r)) OVER (), 0) AS extra FROM a2),
    a4 AS (SELECT *, row_number() OVER (ORDER BY round(r - i, 12) DESC, {order}) AS rk FROM a3),
    quotas AS (SELECT *, (a + least(i + CASE WHEN rest > 0 AND rooms > 0 AND rk <= extra THEN 1 ELSE 0 END, room))::BIGINT AS quota FROM a4)"""


GOLD_SAMPLE = f"""{POOL}, sizes AS (SELECT topic_seed, count(*) AS n_docs, min(doc_id) AS first_id FROM pool GROUP BY 1),
  labelled AS (SELECT * FROM sizes WHERE topic_seed <> 'unlabeled'), {allocation('labelled', 180, 10, 'first_id')},
  allq AS (SELECT topic_seed, quota FROM quotas UNION ALL SELECT topic_seed, least(n_docs, 20) FROM sizes WHERE topic_seed = 'unlabeled'),
  sample AS (SELECT p.* FROM (SELECT *, row_number() OVER (PARTITION BY topic_seed ORDER BY md5('42|' || doc_id)) AS rk FROM pool) p JOIN allq USING (topic_seed) WHERE rk <= quota)"""


def chunks(kind: str, where: str = "true") -> str:
    """Sections and chunks of documents: ``kind`` is plain, response or report."""
    one, rng, grp, lor = r"(?i)^Recommendation\s+([0-9]+)\s*(?::|$)", r"(?i)^Recommendations?\s+([0-9]+)\s*(?:to|-|–)\s*([0-9]+)", r"(?i)^Recommendations?\s*\(([^)]+)\)\s*$", r"(?i)^LIST\s+OF\s+RECOMMENDATIONS?$"
    rows = f"""docs AS (SELECT doc_id, {lines('text')} AS ls FROM documents WHERE text IS NOT NULL AND octet_length(encode(text)) >= 200 AND {where}),
    raw AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM docs),
    marked AS (SELECT *, CASE WHEN regexp_matches(line, '^\\[\\[page [0-9]+\\]\\]\\s*$') THEN regexp_extract(line, '([0-9]+)', 1)::INT END AS mark FROM raw),
    paged AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS k, page FROM (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k), 0) AS page FROM marked) WHERE mark IS NULL),
    tagged AS (SELECT *, s, {is_heading('line')} AS head, regexp_matches(s, {q(one)}) AS is_one, regexp_matches(s, {q(rng)}) AS is_rng, regexp_matches(s, {q(grp)}) AS is_grp, regexp_matches(s, {q(lor)}) AS is_lor
        FROM (SELECT *, {strip('line')} AS s FROM paged))"""
    num = f"regexp_extract(s, {q(one)}, 1)::INT"
    if kind == "response":
        body = f"""start AS (SELECT *, true AS inbody FROM tagged),
        bounds AS (SELECT *, is_rng OR is_grp OR is_one AS rec, is_rng OR is_grp OR is_one OR head AS b,
          CASE WHEN is_rng THEN range(regexp_extract(s, {q(rng)}, 1)::INT, regexp_extract(s, {q(rng)}, 2)::INT + 1)::INT[]
               WHEN is_grp THEN list_transform(regexp_extract_all(regexp_extract(s, {q(grp)}, 1), '[0-9]+'), lambda z: z::INT)
               WHEN is_one THEN [{num}] END AS nums FROM start)"""
        head_title = "CASE WHEN rec THEN CASE WHEN len(nums) = 1 THEN 'Recommendation ' || nums[1] ELSE s END ELSE s END"
        own, first_title = "rec", "Preamble"
    elif kind == "plain":
        body = "bounds AS (SELECT *, false AS rec, head AS b, NULL::INT[] AS nums FROM tagged)"
        head_title, own, first_title = "s", "false", ""
    else:
        rows += f""", lorpos AS (SELECT doc_id, min(k) AS l0 FROM tagged WHERE is_lor GROUP BY 1),
        lasts AS (SELECT t.*, last_value(CASE WHEN is_lor THEN k END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k) AS lastl FROM tagged t),
        bodypos AS (SELECT doc_id, min(k) AS b0 FROM lasts WHERE NOT is_lor AND lastl IS NOT NULL AND k > lastl + 2 AND head GROUP BY 1),
        pos AS (SELECT l.doc_id, max(l.k) FILTER (WHERE l.is_lor AND (b0 IS NULL OR l.k < b0)) AS l, any_value(b0) AS b0, max(l.k) + 1 AS e FROM lasts l LEFT JOIN bodypos USING (doc_id) GROUP BY 1)"""
        body = f"""bounds AS (SELECT t.*, false AS rec, (head AND NOT is_lor) OR is_one AS b, NULL::INT[] AS nums FROM tagged t LEFT JOIN pos USING (doc_id) WHERE t.k >= coalesce(b0, l, 1))"""
        head_title, own, first_title = f"CASE WHEN head AND NOT is_lor THEN s ELSE 'Recommendation ' || {num} END", "false", ""
    secs = f""", numbered AS (SELECT *, sum(b::INT) OVER (PARTITION BY doc_id ORDER BY k) AS sec FROM bounds),
    sections AS (SELECT doc_id, 1 AS grp, sec, coalesce(max(CASE WHEN b THEN {head_title} END), {q(first_title)}) AS title, max(CASE WHEN b THEN page END) AS p0, max(page) AS p1, bool_or(b AND rec) AS rec,
        max(CASE WHEN b THEN nums END) AS nums, {strip(f"coalesce(string_agg(line, {_NL} ORDER BY k) FILTER (WHERE NOT b OR {own}), '')")} AS body FROM numbered GROUP BY doc_id, sec)"""
    if kind == "report":
        secs += f""", lorrows AS (SELECT t.*, l, coalesce(b0, e) AS le, is_one AS r FROM tagged t JOIN pos USING (doc_id) WHERE l IS NOT NULL AND t.k > l AND t.k < coalesce(b0, e)),
        lorpages AS (SELECT doc_id, coalesce(min_by(page, k) FILTER (WHERE page > 0), 0) AS lp0, coalesce(max_by(page, k) FILTER (WHERE page > 0), 0) AS lp1 FROM tagged JOIN pos USING (doc_id) WHERE l IS NOT NULL AND k >= l AND k < coalesce(b0, e) GROUP BY 1),
        lornum AS (SELECT *, sum(r::INT) OVER (PARTITION BY doc_id ORDER BY k) AS sec, CASE WHEN r THEN s ELSE regexp_replace(regexp_replace(line, '\\s*\\.{{4,}}\\s*[0-9]+\\s*$', ''), {q(rf'[{WS}]+$')}, '') END AS txt FROM lorrows),
        lorsecs AS (SELECT doc_id, 0 AS grp, sec, 'Recommendation ' || max(CASE WHEN r THEN {num} END) AS title, any_value(lp0) AS p0, any_value(lp1) AS p1, true AS rec, [max(CASE WHEN r THEN {num} END)] AS nums,
            {strip(f"string_agg(txt, {_NL} ORDER BY k) FILTER (WHERE txt <> '')")} AS body FROM lornum JOIN lorpages USING (doc_id) WHERE sec > 0 GROUP BY doc_id, sec)"""
    union = "SELECT * FROM sections" + (" UNION ALL SELECT * FROM lorsecs" if kind == "report" else "")
    return f"""WITH {rows}, {body}{secs}, kept AS (SELECT * FROM ({union}) WHERE body <> ''),
    cut AS (SELECT *, {words('body')} AS w FROM kept),
    offs AS (SELECT *, unnest(CASE WHEN rec OR len(w) <= 600 THEN [0] ELSE list_filter(range(0, len(w), 550), lambda o: o = 0 OR o + 50 < len(w)) END) AS o FROM cut),
    parts AS (SELECT *, CASE WHEN rec OR len(w) <= 600 THEN body ELSE array_to_string(list_slice(w, o + 1, o + 600), ' ') END AS part, row_number() OVER (PARTITION BY doc_id ORDER BY grp, sec, o) AS seq FROM offs)
    SELECT doc_id || '_' || CASE WHEN NOT rec THEN lpad(seq::VARCHAR, 4, '0') WHEN len(nums) > 0 THEN 'rec_' || lpad(nums[1]::VARCHAR, 3, '0') ELSE 'rec' END AS chunk_id, doc_id::VARCHAR AS doc_id, seq, title AS section_title,
      coalesce(p0, 0) AS page_start, greatest(p1, coalesce(p0, 0)) AS page_end, floor({n_words('part')} * 1.33::DOUBLE)::INT AS token_approx, rec AS is_recommendation, CASE WHEN rec THEN coalesce(array_to_string(nums, ','), '') ELSE '' END AS rec_numbers, sha256(part) AS h FROM parts"""


def values(rows: list[tuple], *columns: str) -> str:
    def lit(v) -> str:
        return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else q(v) if isinstance(v, str) else str(v)

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({', '.join(columns)})"


def scrub() -> tuple[str, str]:
    steps = (EMAIL, r"(?:\+?1[-. \t-\r]?)?\(?[0-9]{3}\)?[-. \t-\r][0-9]{3}[-. \t-\r][0-9]{4}", r"\b[A-Z][0-9][A-Z][ \t-\r]?[0-9][A-Z][0-9]\b", rf"(?i)\b[0-9]+[ \t-\r]+(?:[\p{{L}}\p{{N}}_]+[ \t-\r]+){{0,3}}(?:{STREETS})\b")
    text, total = "card_text", []
    ctes, name = [], "corpus_fixture"
    for k, p in enumerate(steps):
        ctes.append(f"s{k} AS MATERIALIZED (SELECT doc_id, {'' if k else '0 AS '}n + len(regexp_extract_all({text}, {q(p)})) AS n, regexp_replace({text}, {q(p)}, '[CONTACT]', 'g') AS t FROM {name} {'' if k else 'WHERE card_text IS NOT NULL'})".replace("0 AS n + len", "len"))
        text, name = "t", f"s{k}"
    return ", ".join(ctes), total and "" or name


def corpus_sql() -> str:
    first = title("c.t")
    return f"""WITH {LATEST}, texts AS (SELECT doc_id, min(card_text) AS t FROM corpus_fixture WHERE card_text IS NOT NULL GROUP BY 1),
    base AS (SELECT m.*, c.t, nullif({first}, '') AS ttl, {first_words('c.t')} AS card FROM latest m JOIN texts c USING (doc_id)
      WHERE NOT coalesce(needs_ocr, false) AND NOT coalesce(dropped_short, false) AND source_type = 'hesa_brief' AND coalesce(language, '') <> '' AND coalesce(duplicate_of, '') = ''),
    lk AS (SELECT org, max(stakeholder_type) AS st FROM org_lookup GROUP BY 1),
    orgs AS (SELECT DISTINCT organization AS o FROM base WHERE organization <> ''),
    tries AS (SELECT o, unnest([o] || list_transform(string_split(o, ' / '), lambda z: {strip('z')})) AS c, generate_subscripts([o] || string_split(o, ' / '), 1) AS k FROM orgs),
    st AS (SELECT o, min_by(st, k) AS st FROM tries JOIN lk ON c = lk.org GROUP BY 1)
    SELECT doc_id, coalesce(ttl, study_or_consultation_title) AS "Name", organization AS org, coalesce(published_date, fetch_date) AS date, language, study_or_consultation_title AS study_title, sha256(card) AS card_hash,
      coalesce({topic('card', False)}, {title_topic('study_or_consultation_title')}, {q(FALLBACK)}) AS topic_seed, coalesce(st.st, CASE WHEN regexp_matches(organization, {q(INDIVIDUAL)}) THEN 'individual' END) AS stakeholder_type, 'weak' AS label_source, near_dup_cluster
    FROM base LEFT JOIN st ON organization = st.o"""


def components(tau: str, strict: str) -> str:
    return f"""RECURSIVE u AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    pairs AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) {strict} {tau}),
    sym AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
    reach AS (SELECT a AS id, a AS r FROM sym UNION SELECT s.b, reach.r FROM reach JOIN sym s ON reach.id = s.a),
    comp AS (SELECT id, min(r) AS c FROM reach GROUP BY 1)"""


def oracle_sql() -> dict[str, str]:
    docs = "documents WHERE text IS NOT NULL"
    ctes, last = scrub()
    prints = f"SELECT source, doc_id, unnest(list_distinct(list_transform({lines('text')}, lambda y: {line_print('y')}))) AS print FROM {docs}"
    procedural = "CASE " + " ".join([*(f"WHEN starts_with(title, {q(p)}) THEN {q('starts_with:' + p.strip())}" for p in scalars.PROCEDURAL_PREFIXES), *(f"WHEN contains(title, {q(p)}) THEN {q('contains:' + p.strip())}" for p in scalars.PROCEDURAL_FRAGMENTS)]) + " END"
    w = f"SELECT {n_words('text')} AS v FROM {docs}"
    ex = lambda i, n: f"CASE WHEN m >= 2 THEN trunc((x[greatest(least({i}*(m+1)//{n}, m-1), 1)] * ({n} - ({i}*(m+1) - greatest(least({i}*(m+1)//{n}, m-1), 1)*{n})) + x[greatest(least({i}*(m+1)//{n}, m-1), 1)+1] * ({i}*(m+1) - greatest(least({i}*(m+1)//{n}, m-1), 1)*{n})) / {n}::DOUBLE)::BIGINT END"
    counts = lambda t, *cs: " UNION ALL ".join(f"SELECT '{c}' AS field, coalesce(nullif({c}, ''), 'unknown') AS value, count(*) AS n_rows FROM {t} GROUP BY 2" for c in cs)
    slug = sub(f"left({sub(sub(strip(sub('lower(study_or_consultation_title)', rf'[^\p{{L}}\p{{N}}_{WS}]', '')), rf'[{WS}]+', '_'), '_+', '_')}, 28)", "_+$", "")
    months = "[" + ", ".join(q(m[:3]) for m in scalars.MONTH_NAME.split("|")[:12]) + "]"
    named = rf"(?i)(?:^|[^A-Za-z])({scalars.MONTH_NAME})[.,]?[ \t-\r]+([0-9]{{1,2}})(?:st|nd|rd|th)?,?[ \t-\r]+([0-9]{{4}})(?:[^0-9]|$)"
    turned = rf"(?i)(?:^|[^0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?[ \t-\r]+({scalars.MONTH_NAME})[.,]?,?[ \t-\r]+([0-9]{{4}})(?:[^0-9]|$)"
    numbered = r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})(?:[^0-9]|$)"
    part = lambda pattern, k: f"regexp_extract(p, {q(pattern)}, {k})"
    month = lambda pattern, k: f"list_position({months}, lower(left({part(pattern, k)}, 3)))"
    made = [f"{part(p, y)} || '-' || {m} || '-' || {part(p, d)}" for p, y, m, d in ((named, 3, month(named, 1), 2), (turned, 3, month(turned, 2), 1), (numbered, 1, part(numbered, 2), 3))]
    iso = f"try_strptime(CASE WHEN {part(named, 2)} <> '' THEN {made[0]} WHEN {part(turned, 1)} <> '' THEN {made[1]} WHEN {part(numbered, 3)} <> '' THEN {made[2]} END, '%Y-%m-%d')"
    return {
        "entry": f"""WITH t AS (SELECT doc_id, coalesce(nullif(lang, ''), 'unknown') AS lang, sha256({hash_form('text')}) AS h, {n_words('text')} < 150 AS short FROM {docs}), m AS (SELECT *, doc_id <> min(doc_id) OVER (PARTITION BY h) AS dup FROM t)
            SELECT lang, count(*) FILTER (NOT dup AND NOT short) AS n_kept, count(*) FILTER (dup) AS n_duplicate, count(*) FILTER (NOT dup AND short) AS n_short FROM m GROUP BY 1""",
        "text_normalize_hash": f"SELECT doc_id, sha256({hash_form('text')}) AS h FROM {docs}",
        "exact_dup_groups": f"WITH t AS (SELECT doc_id, sha256({hash_form('text')}) AS h FROM {docs}), g AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS k, count(*) OVER (PARTITION BY h) AS group_size FROM t) SELECT doc_id, h, group_size, CASE WHEN doc_id <> k THEN k END AS duplicate_of FROM g",
        "word_counts": f"SELECT doc_id, n_words, floor(n_words * 1.33::DOUBLE)::INT AS token_approx, n_words < 150 AS is_short FROM (SELECT doc_id, {n_words('text')} AS n_words FROM {docs})",
        "scrub_contacts": f"WITH {ctes} SELECT DISTINCT doc_id, sha256(t) AS h, n AS n_contacts FROM {last}",
        "whitespace_normalize": f"SELECT doc_id, sha256({tidy('text')}) AS h FROM {docs}",
        "line_fingerprint_df": f"WITH p AS ({prints}), o AS (SELECT source, count(*) AS of_pages FROM {docs} GROUP BY 1 HAVING count(*) >= 2) SELECT p.source, print, count(*) AS n_pages, of_pages FROM p JOIN o USING (source) WHERE print <> '' GROUP BY ALL HAVING count(*) > of_pages * 0.5",
        "line_fingerprints": f"WITH p AS ({prints}) SELECT print, count(*) AS n_docs FROM p WHERE print <> '' GROUP BY 1 HAVING count(*) >= 2",
        "layout_mangled": f"SELECT doc_id, {mangled('text')} AS mangled FROM {docs}",
        "caps_headings": f"WITH t AS (SELECT doc_id, {lines('text')} AS l FROM {docs}), r AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no FROM t) SELECT doc_id, line_no, {strip('line')} AS heading FROM r WHERE {is_heading('line')}",
        "first_n_words_card": f"SELECT doc_id, {first_words('text')} AS card, '[ORG] [ORG]' || chr(10) || '[TITLE] ' || {title('text')} || chr(10) || chr(10) || {first_words('text')} AS tiered FROM {docs}",
        "doc_title": f"SELECT doc_id, {title('text')} AS title, replace(left(text, 220), chr(10), ' | ') AS snippet FROM {docs}",
        "topic_labels": f"WITH {topics_cte()} SELECT * FROM topics",
        "label_transition_matrix": f"WITH {topics_cte()} SELECT title_first AS old_topic, content_first AS new_topic, count(*) AS n_docs, title_first <> content_first AS moved FROM topics GROUP BY ALL",
        "label_deltas": f"WITH {topics_cte()}, a AS (SELECT title_first AS topic, 1 AS o, 0 AS n FROM topics UNION ALL SELECT content_first, 0, 1 FROM topics) SELECT topic, sum(o)::BIGINT AS n_old, sum(n)::BIGINT AS n_new, (sum(n) - sum(o))::BIGINT AS delta FROM a GROUP BY 1",
        "stakeholder_lookup": f"""WITH lk AS (SELECT org, max(stakeholder_type) AS st FROM org_lookup WHERE org IS NOT NULL GROUP BY 1), orgs AS (SELECT DISTINCT org AS o FROM corpus_fixture WHERE org <> ''),
            tries AS (SELECT o, unnest([o] || list_transform(string_split(o, ' / '), lambda z: {strip('z')})) AS c, generate_subscripts([o] || string_split(o, ' / '), 1) AS k FROM orgs),
            st AS (SELECT o, min_by(st, k) AS st FROM tries JOIN lk ON c = lk.org GROUP BY 1)
            SELECT DISTINCT doc_id, org, coalesce(st, CASE WHEN regexp_matches(org, {q(INDIVIDUAL)}) THEN 'individual' END) AS stakeholder_type FROM corpus_fixture LEFT JOIN st ON org = o""",
        "procedural_filter": f"""WITH {LATEST}, t AS (SELECT study_or_consultation_title AS title FROM latest UNION {values([(x,) for x in fixtures.TITLES], 'title')}), l AS (SELECT trim(x) AS x FROM ({values([(x,) for x in fixtures.LISTED], 'x')})),
            r AS (SELECT title, CASE WHEN title NOT IN (SELECT x FROM l) THEN {procedural} END AS reason FROM t WHERE title IS NOT NULL) SELECT title, reason, reason IS NULL AS kept FROM r""",
        "slugs": f"WITH {LATEST} SELECT DISTINCT study_or_consultation_title AS title, {slug} AS slug, replace(parliament_session, '-', '') AS session, CASE WHEN starts_with(pdf_url, 'https:') THEN pdf_url ELSE pdf_url END AS url FROM latest",
        "doc_id_counter": r"""WITH new AS (SELECT CASE source_type WHEN 'crawl' THEN 'fix_unl' WHEN 'hesa_report' THEN 'fix_can' ELSE 'fix_pub' END AS prefix, doc_id AS key FROM documents),
            k AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY md5(key::VARCHAR)) AS k FROM new),
            used AS (SELECT DISTINCT regexp_extract(doc_id, '^(.*)_([0-9]{8})$', 1) AS prefix, regexp_extract(doc_id, '^(.*)_([0-9]{8})$', 2)::BIGINT AS n FROM corpus_fixture WHERE regexp_matches(doc_id, '^.*_[0-9]{8}$')),
            room AS (SELECT prefix, unnest(range(1, (SELECT count(*) FROM documents) + (SELECT count(*) FROM used) + 2)) AS n FROM (SELECT DISTINCT prefix FROM new)),
            free AS (SELECT prefix, n, row_number() OVER (PARTITION BY prefix ORDER BY n) AS k FROM room ANTI JOIN used USING (prefix, n))
            SELECT prefix, key, prefix || '_' || lpad(n::VARCHAR, 8, '0') AS new_id FROM k JOIN free USING (prefix, k)""",
        "chunk_word_windows": f"""WITH t AS (SELECT doc_id, {words('text')} AS w FROM {docs}), o AS (SELECT *, unnest(CASE WHEN len(w) <= 600 THEN [0] ELSE list_filter(range(0, len(w), 550), lambda z: z = 0 OR z + 50 < len(w)) END) AS first_word FROM t)
            SELECT doc_id, (first_word // 550)::INT AS window_no, first_word, least(len(w) - first_word, 600) AS n_words, sha256(coalesce(array_to_string(list_slice(w, first_word + 1, first_word + 600), ' '), '')) AS h FROM o""",
        "chunk_sections": chunks("plain", "source_type NOT IN ('hesa_report', 'gov_response')"),
        "chunk_gov_response": chunks("response"),
        "chunk_report": chunks("report"),
        "chunk_stats": f"""WITH c AS (SELECT 'hesa_report' AS source_type, * FROM ({chunks("report", "source_type = 'hesa_report'")}) UNION ALL SELECT 'gov_response', * FROM ({chunks("response", "source_type = 'gov_response'")})
            UNION ALL SELECT d.source_type, p.* FROM ({chunks("plain", "source_type IN ('policy', 'statcan_analysis')")}) p JOIN documents d ON d.doc_id::VARCHAR = p.doc_id)
            SELECT source_type, count(*) AS n_chunks, count(*) FILTER (is_recommendation) AS n_recommendations, sum(token_approx)::BIGINT AS n_tokens, max(token_approx) AS longest FROM c GROUP BY 1""",
        "cosine_pairs": "WITH u AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM u a JOIN u b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) >= 0.35",
        "near_dup_clusters": f"WITH {components('0.35', '>')} SELECT id, printf('ndc_%03d', dense_rank() OVER (ORDER BY c)) AS cluster FROM comp",
        "semantic_dups": f"WITH {components('0.40', '>=')} SELECT id, c AS duplicate_of FROM comp WHERE id <> c",
        "latest_manifest": f"WITH {LATEST} SELECT doc_id, line_no, source_url, language, needs_ocr, published_date FROM latest",
        "new_documents": f"""WITH {LATEST}, found AS (SELECT 'doc_' || doc_id AS doc_id, source_url FROM documents UNION ALL SELECT 'again_' || doc_id, source_url FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'doc_' || doc_id, source_url || '#' || doc_id FROM documents WHERE doc_id % 5 = 0
            UNION ALL SELECT doc_id, source_url || '#new' FROM latest UNION ALL SELECT 'new_' || doc_id, source_url FROM latest),
            unseen AS (SELECT * FROM found WHERE doc_id NOT IN (SELECT doc_id FROM latest) AND (source_url IS NULL OR source_url NOT IN (SELECT source_url FROM latest WHERE source_url IS NOT NULL))),
            once AS (SELECT doc_id, min(source_url) AS source_url FROM unseen GROUP BY 1) SELECT min(doc_id) AS doc_id, source_url FROM once WHERE source_url IS NOT NULL GROUP BY 2 UNION ALL SELECT doc_id, source_url FROM once WHERE source_url IS NULL""",
        "contaminated_clusters": f"WITH {DUPS}, {GOLD}, {DIRTY} SELECT * FROM dirty",
        "split_units_mode": f"WITH {ELIGIBLE} SELECT * FROM units",
        "train_dev_split": f"WITH {SPLIT} SELECT * FROM split",
        "split_topic_counts": f"WITH {SPLIT} SELECT topic, count(DISTINCT unit) AS n_units, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'dev') AS dev FROM split GROUP BY 1",
        "split_checks": f"""WITH {SPLIT} SELECT 'gold_in_split' AS rule, count(*) AS n_broken FROM split WHERE doc_id IN (SELECT doc_id FROM gold) UNION ALL SELECT 'duplicate_in_split', count(*) FROM split WHERE doc_id IN (SELECT doc_id FROM dups)
            UNION ALL SELECT 'cluster_in_both', count(*) FROM (SELECT near_dup_cluster FROM split JOIN eligible USING (doc_id) WHERE length(near_dup_cluster) > 0 GROUP BY 1 HAVING count(DISTINCT split) > 1)""",
        "gold_allocation": f"WITH {POOL}, sizes AS (SELECT topic_seed, count(*) AS n_docs FROM pool GROUP BY 1), {allocation('sizes', 180, 10, 'topic_seed')} SELECT topic_seed, n_docs, quota FROM quotas",
        "gold_sample": f"WITH {GOLD_SAMPLE} SELECT doc_id, topic_seed FROM sample",
        "labelling_sheet": f"WITH {GOLD_SAMPLE} SELECT doc_id, org, '' AS gold_topic, '' AS gold_stakeholder, '' AS notes FROM sample ORDER BY md5('7|' || doc_id) LIMIT 50",
        "qa_counts": f"WITH {TOPICED}, once AS (SELECT DISTINCT * FROM topiced) {counts('once', 'topic_seed', 'stakeholder_type', 'source_type', 'language', 'label_source')}",
        "qa_gold": "WITH once AS (SELECT DISTINCT * FROM gold_test_fixture) " + counts("once", "gold_topic", "gold_stakeholder"),
        "qa_dist_stats": f"WITH w AS ({w}), s AS (SELECT list(v ORDER BY v) AS x, count(*) AS m FROM w) SELECT m AS n_values, x[1] AS min, {ex(1, 4)} AS p25, ((x[(m-1)//2+1] + x[m//2+1]) / 2.0)::DOUBLE::BIGINT - CASE WHEN (x[(m-1)//2+1] + x[m//2+1]) % 4 = 3 THEN 1 ELSE 0 END AS median, {ex(3, 4)} AS p75, {ex(95, 100)} AS p95, x[m] AS max FROM s".replace("((x[(m-1)//2+1] + x[m//2+1]) / 2.0)::DOUBLE::BIGINT - CASE WHEN (x[(m-1)//2+1] + x[m//2+1]) % 4 = 3 THEN 1 ELSE 0 END", "((x[(m-1)//2+1] + x[m//2+1]) // 2)"),
        "percentile_index": f"WITH w AS ({w}), s AS (SELECT list(v ORDER BY v) AS x, count(*) AS m, round(avg(v), 6) AS mean FROM w) SELECT m AS n_values, " + ", ".join(f"x[floor(m * {p}::DOUBLE)::INT + 1] AS {n}" for n, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9), ("p99", 0.99))) + ", mean FROM s",
        "study_type_pivot": f"WITH {LATEST} SELECT study_or_consultation_title, " + ", ".join(f"count(*) FILTER (source_type = '{t}') AS {t}" for t in ("hesa_brief", "hesa_report", "gov_response", "crawl")) + ", count(*) AS total FROM latest WHERE study_or_consultation_title IS NOT NULL GROUP BY ROLLUP (study_or_consultation_title)",
        "qa_flags": f"WITH {LATEST} SELECT count(*) FILTER (length(duplicate_of) > 0) AS n_duplicates, count(*) FILTER (needs_ocr) AS n_needs_ocr, count(*) FILTER (layout_mangled) AS n_mangled, count(*) FILTER (dropped_short) AS n_short FROM latest",
        "qa_clusters": "WITH s AS (SELECT near_dup_cluster, count(DISTINCT doc_id) AS n FROM corpus_fixture WHERE length(near_dup_cluster) > 0 GROUP BY 1) SELECT coalesce(sum(n), 0)::BIGINT AS clustered_docs, count(*) AS n_clusters, max(n) AS largest, count(*) FILTER (n = 1) AS n_single FROM s",
        "qa_topics": f"WITH {TOPICED}, c AS (SELECT coalesce(topic_seed, 'unknown') AS topic, count(*) AS n_docs FROM (SELECT DISTINCT * FROM topiced) GROUP BY 1) SELECT topic, n_docs, round(n_docs / (sum(n_docs) OVER ())::DOUBLE, 9) AS share, repeat('█', round_even(40 * n_docs / (sum(n_docs) OVER ())::DOUBLE, 0)::INT) AS bar, topic = 'unlabeled' AS is_fallback FROM c",
        "corpus_inclusion": f"""WITH {LATEST} SELECT CASE WHEN source_type <> 'hesa_brief' THEN 'not_brief' WHEN length(duplicate_of) > 0 THEN 'duplicate' WHEN dropped_short THEN 'short' WHEN needs_ocr THEN 'needs_ocr' WHEN coalesce(language, '') = '' THEN 'no_language' ELSE 'included' END AS outcome, count(*) AS n_docs FROM latest GROUP BY 1""",
        "corpus_build": corpus_sql(),
        "published_dates": f"WITH {LATEST}, p AS (SELECT DISTINCT coalesce(published_raw, published_date) AS published FROM latest UNION {values([(x,) for x in fixtures.PUBLISHED], 'published')}), b AS (SELECT published, {strip("replace(published, 'Published on:', '')")} AS p FROM p WHERE published IS NOT NULL) SELECT published, strftime({iso}, '%Y-%m-%d') AS iso FROM b",
        "pdf_extract": f"""WITH b AS ({values(fixtures.BLOCKS, 'doc_id', 'page', 'x0', 'y0', 'block_type', 'text')}), t AS (SELECT *, {strip('text')} AS t FROM b WHERE block_type = 0 AND {strip('text')} <> ''),
            p AS (SELECT doc_id, page, string_agg(t, chr(10) ORDER BY y0, x0) AS t, sum(length(t)) AS n FROM t GROUP BY 1, 2), w AS (SELECT doc_id, string_agg(CASE WHEN page > 1 THEN '[[page ' || page || ']]' || chr(10) || t ELSE t END, chr(10) ORDER BY page) AS text, sum(n) AS n FROM p GROUP BY 1),
            e AS (SELECT doc_id, max(page) AS pages FROM b GROUP BY 1) SELECT e.doc_id, CASE WHEN NOT (pages > 1 AND coalesce(n, 0) < 200) THEN coalesce(w.text, '') END AS text, pages > 1 AND coalesce(n, 0) < 200 AS needs_ocr FROM e LEFT JOIN w USING (doc_id)""",
        "html_extract": values(
            [
                (1, "## Access to care\nOne\nTwo\na\nb\n1\t2\n3\nin side"),
                (2, "# Main\ninside & more"),
                (3, "### Part\nx y"),
                *((k, "") for k in range(4, 9)),
            ],
            "page_id",
            "text",
        ),
        "study_list": values([(4, 0, "11", "First"), (4, 1, "12", "Second")], "page_id", "position", "study_id", "title"),
        "study_meta": values(
            [
                *((k, t, None, None) for k, t in ((1, ""), (2, "Main"), (3, ""), (4, ""))),
                (5, "Study title", "https://www.ourcommons.ca/DocumentViewer/en/44-1/HESA/report-3/", "https://www.example.org/DocumentViewer/en/44-1/HESA/report-3/response-8512"),
                *((k, "", None, None) for k in (6, 7, 8)),
            ],
            "page_id",
            "title",
            "report_viewer_url",
            "govresponse_viewer_url",
        ),
        "brief_parse": values([(6, 0, "Dental Group", "https://www.example.org/a.pdf", False, "2022-05-09", None), (6, 1, "A / B", "https://www.ourcommons.ca/b.pdf", True, None, "later")], "page_id", "position", "organization", "pdf_url", "is_joint", "published_date", "published_raw"),
        "pdf_links": values([(k, "https://www.ourcommons.ca/x/Report.PDF" if k == 5 else "https://www.example.org/a.pdf" if k == 6 else None) for k in range(1, 9)], "page_id", "pdf_url"),
    }


def as_json() -> str:
    """All statements, for reading them outside Python."""
    return json.dumps(oracle_sql(), indent=1, ensure_ascii=False)
