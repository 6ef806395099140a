"""Variant spellings of names typed by people (problem 3).

Every name is rewritten into canonical forms: accents, titles, legal forms, articles and acronyms in
brackets go, abbreviations and nicknames are written out, rare words are corrected to common ones a
slip of the keys away, and parts are put in one order. A full name's forms are its canonical key and
the shorter rewritings it could be typed as (initial for the given name, no type word, acronym).
Names meet by equi-joins on forms; where several entities offer a shorter form, it goes to the one
whose spellings outnumber those of all others by far, and else to none; its score is the rarity of that rewriting.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.functions.basic import nonblank
from tamarack.llm.pii import GIVEN_NAMES
from tamarack.plans.lineage import cut
from tamarack.plans.skew import lookup_join, split_join
from tamarack.sources.tables import table

# Written-out forms of abbreviations in names of organisations.
ABBREVIATIONS = {
    "ab": "alberta", "acad": "academy", "admin": "administration", "agcy": "agency", "all": "alliance", "allnce": "alliance", "ass'n": "association",
    "assn": "association", "assoc": "association", "bd": "board", "can": "canadian", "cdn": "canadian", "center": "centre", "ctr": "centre", "cntr": "centre",
    "cncl": "council", "coun": "council", "coal": "coalition", "coaln": "coalition", "coll": "college", "comm": "committee", "cttee": "committee", "cmte": "committee",
    "ctrl": "control", "dept": "department", "div": "division", "fdn": "foundation", "fndn": "foundation", "found": "foundation", "fed": "federation",
    "fed'n": "federation", "gov": "government", "gov't": "government", "govt": "government", "grp": "group", "hosp": "hospital", "inst": "institute",
    "intl": "international", "int'l": "international", "min": "ministry", "nat'l": "national", "natl": "national", "netwk": "network", "ntwk": "network",
    "nthn": "northern", "org": "organization", "pharm": "pharmacy", "prov": "provincial", "rec": "recovery", "recov": "recovery", "rehab": "rehabilitation",
    "res": "research", "rsch": "research", "soc": "society", "socy": "society", "stud": "student", "sthn": "southern", "svc": "service", "svcs": "services",
    "ther": "therapy", "un": "union", "un'n": "union", "univ": "university",
}
# Given names that a nickname can stand for.
NICKNAMES = {
    "abby": ("abigail",), "alex": ("alexander", "alexandra", "alexandre"), "andy": ("andrew",), "barb": ("barbara",), "becky": ("rebecca",), "ben": ("benjamin", "benoit"),
    "beth": ("elizabeth",), "betty": ("elizabeth",), "bill": ("william",), "bob": ("robert",), "cathy": ("catherine",), "charlie": ("charles", "charlotte"),
    "chris": ("christopher", "christine"), "dan": ("daniel",), "dave": ("david",), "deb": ("deborah",), "debbie": ("deborah",), "dick": ("richard",), "don": ("donald",),
    "ed": ("edward",), "eddie": ("edward",), "ellie": ("elizabeth",), "fran": ("francois", "francis"), "frank": ("francois", "francis"), "fred": ("frederic", "frederick"),
    "gabe": ("gabriel",), "gaby": ("gabrielle",), "greg": ("gregory",), "hank": ("henry",), "jack": ("john",), "jamie": ("james",), "jen": ("jennifer",),
    "jenny": ("jennifer",), "jim": ("james",), "jo": ("josephine", "joanne"), "joe": ("joseph",), "josie": ("josephine",), "kate": ("katherine", "catherine"),
    "kathy": ("katherine", "catherine"), "katie": ("katherine",), "ken": ("kenneth",), "liz": ("elizabeth",), "maggie": ("margaret",), "matt": ("matthew", "mathieu"),
    "mike": ("michael",), "nat": ("nathaniel", "nathalie", "natalie"), "nate": ("nathaniel",), "nick": ("nicholas", "nicolas"), "pam": ("pamela",),
    "pat": ("patricia", "patrick"), "patty": ("patricia",), "peggy": ("margaret",), "pete": ("peter",), "raj": ("rajesh",), "ray": ("raymond",), "rich": ("richard",),
    "rick": ("richard",), "rob": ("robert",), "sam": ("samuel", "samantha"), "sandy": ("alexander", "sandra"), "steph": ("stephanie",), "steve": ("stephen", "steven"),
    "sue": ("susan",), "susie": ("susan",), "ted": ("theodore", "edward"), "theo": ("theodore",), "tim": ("timothy",), "tom": ("thomas",), "tony": ("anthony", "antoine"),
    "trish": ("patricia",), "vic": ("victor", "victoria"), "vicky": ("victoria",), "will": ("william",),
}
# Words that say what kind of body an organisation is.
TYPE_WORDS = frozenset("agency alliance association board centre clinic coalition college commission committee council department federation foundation group hospital institute ministry network organization society trust union university".split())
#: Compass letters in names of organisations.
COMPASS = {"n": "northern", "s": "southern", "e": "eastern", "w": "western"}
TITLES = frozenset("dr dre mr mrs ms mx mme mlle prof professor hon sir rev".split())
LEGAL = frozenset("inc ltd llc corp incorporated limited ltee".split())
SMALL = frozenset("the of and de du des la le les et for".split())
#: Words corrected are at least this long, by one slip; by two from the second length on.
ONE_SLIP, TWO_SLIPS = 4, 6
#: A form that several keys offer belongs to the one with so many times the spellings of all others together.
CLEAR = 4

_BRACKETS = re.compile(r"\([^)]*\)")
_ACRONYM = re.compile(r"[A-Z]{2,8}")


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).lower().replace("’", "'")


_GIVEN = frozenset(map(plain, GIVEN_NAMES.split())) | {g for options in NICKNAMES.values() for g in options}
_KEPT = _GIVEN | set(NICKNAMES) | set(ABBREVIATIONS) | TITLES | LEGAL | SMALL
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)*'?")


def words_of(name: str) -> list[str]:
    """Words of a name in order: brackets left out, hyphens between words marked on the second ('-city')."""
    out = []
    text = plain(_BRACKETS.sub(" ", name))
    for m in _TOKEN.finditer(text):
        joined = m.start() > 0 and text[m.start() - 1] == "-" and m.start() > 1 and not text[m.start() - 2].isspace()
        out.append(("-" if joined else "") + m[0])
    return out


def slips(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words; most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        before, last = last, row
    return min(last[-1], most + 1)


def _deletions(word: str) -> set[str]:
    out = {word}
    for n in range(1, 3 if len(word) >= TWO_SLIPS else 2):
        out |= {"".join(c for k, c in enumerate(word) if k not in drop) for drop in combinations(range(len(word)), n)}
    return out


def _explode_deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w, d, n = [], [], []
        for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = _deletions(word)
            w += [word] * len(found)
            n += [count] * len(found)
            d += found
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.string())], ["word", "n", "gone"])


def _allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [[], [], [], []]
        for word, n, to, m in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            far = slips(word, to)
            near = far == 1 and (n <= max(3, m // 4)) or far == 2 and len(word) >= TWO_SLIPS and (4 * n <= m or (n <= 2 and 2 * n <= m))
            if near:
                for c, v in zip(keep, (word, to, far, m), strict=True):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(keep, (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)], ["word", "to", "far", "m"])


def corrections(counts: DataFrame) -> DataFrame:
    """(word, n, root) of all words: root is the commoner word that a rare one is a slip of, followed twice, else the word."""
    counts = cut(counts)
    usable = counts.filter((F.length("word") >= ONE_SLIP) & ~F.col("word").isin(*sorted(LEGAL | SMALL | TITLES)))
    gone = usable.mapInArrow(_explode_deletions, "word string, n long, gone string")
    rare = gone.filter(~F.col("word").isin(*sorted(_KEPT)))
    common = gone.select(F.col("word").alias("to"), F.col("n").alias("m"), "gone")
    better = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("to") < F.col("word")))
    pairs = rare.join(common, "gone").filter((F.col("word") != F.col("to")) & better).select("word", "n", "to", "m").distinct()
    allowed = pairs.mapInArrow(_allowed, "word string, to string, far int, m long")
    best = cut(allowed.groupBy("word").agg(F.min(F.struct("far", -F.col("m"), "to")).alias("b")).select("word", F.col("b.to").alias("to")))
    second = best.select(F.col("word").alias("to"), F.col("to").alias("next"))
    roots = best.join(second, "to", "left").select("word", F.coalesce("next", "to").alias("root"))
    third = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
    roots = roots.join(third, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return counts.join(roots, "word", "left").select("word", "n", F.coalesce("root", "word").alias("root"))


def rewritings(name: str, words: list[str]) -> tuple[str, list[str], list[str]]:
    """(key, offers, wants) of a name from its corrected words.

    key is the canonical key of the name as it stands; offers are the shorter forms a full name could
    be typed as; wants are the forms under which a short name looks for its full name.
    """
    if _ACRONYM.fullmatch(name.strip()):
        return f"acronym|{plain(name.strip())}", [], [f"acronym|{plain(name.strip())}"]
    bare = [ABBREVIATIONS.get(w.lstrip("-"), w.lstrip("-")).rstrip("'") for w in words]
    kept = [(w, raw.startswith("-")) for w, raw in zip(bare, words, strict=True) if w not in LEGAL and w not in TITLES and w not in SMALL]
    tokens = [w for w, _ in kept]
    if not tokens:
        # nothing to compare by, so the name stands for itself
        return f"itself|{name}", [], []
    types = [w for w in tokens if w in TYPE_WORDS]
    given = [w for w in tokens if w in _GIVEN or w in NICKNAMES]
    long = [w for w in tokens if len(w) > 1]
    if not types and tokens and tokens[0] not in ("canadian", "national"):
        if given and len(long) >= 2:
            # of several candidates the one at an end of the name is the given name
            g = next((w for w in (long[0], long[-1]) if w in given), given[0])
            rest = list(long)
            rest.remove(g)
            tail = "|".join(sorted(rest))
            options = NICKNAMES.get(g, (g,)) if g not in _GIVEN or g in NICKNAMES else (g,)
            if len(options) == 1:
                return f"person|{options[0]}|{tail}", [f"initial|{options[0][0]}|{tail}"], []
            return f"person|{g}|{tail}", [], [f"person|{o}|{tail}" for o in options]
        letters = [w for w in tokens if len(w) == 1]
        if letters and len(long) >= 1:
            form = f"initial|{letters[0]}|{'|'.join(sorted(long))}"
            return form, [], [form]
        form = "untyped|" + "|".join(sorted(tokens))
        # a person's name whose given name no list holds: either end may be the given name
        ends = {0, len(tokens) - 1} if 2 <= len(tokens) <= 3 and len(long) == len(tokens) and not any(w.isdigit() for w in tokens) else ()
        return form, [f"initial|{tokens[k][0]}|{'|'.join(sorted(tokens[:k] + tokens[k + 1 :]))}" for k in sorted(ends)], [form]
    tokens = [COMPASS.get(w, w) for w in tokens]
    kept = [(COMPASS.get(w, w), joined) for w, joined in kept]
    key = "org|" + "|".join(sorted(tokens))
    offers = ["untyped|" + "|".join(sorted(w for w in tokens if w not in TYPE_WORDS))] if types and len(tokens) > len(types) + 1 else []
    if "," not in _BRACKETS.sub("", name).replace(", Inc", "").replace(", Ltd", "") and "of" not in bare:
        offers += sorted({"acronym|" + "".join(w[0] for w in tokens), "acronym|" + "".join(w[0] for w, joined in kept if not joined)})
    return key, offers, []


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [rewritings(n, w) for n, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.list_(pa.string())), pa.array([m[2] for m in made], pa.list_(pa.string()))], ["name", "key", "offers", "wants"])


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words_of(n) for n in batch.column(0).to_pylist()], pa.list_(pa.string()))], ["name", "words"])


def link_names(names: DataFrame, col: str) -> DataFrame:
    """Rows (name, entity, score) of the distinct names; all spellings of one entity share its value, the smallest of them.

    score is 1 for a name linked by its canonical key. A short form's score says how rare the rewriting is that links it: the share of the
    entity's spellings among all spellings that can be rewritten to it, 0 where no entity has a clear lead and the name stays alone.
    Null, empty and blank names are left out, repeated ones count once, names that differ only in what
    no rule covers stay apart, other columns are ignored and an empty table gives an empty result.
    """
    distinct = cut(names.select(F.col(col).cast("string").alias("name")).filter(nonblank(F.col("name")).isNotNull()).distinct())
    split = cut(distinct.mapInArrow(_tokenise, "name string, words array<string>"))
    placed = split.select("name", F.posexplode("words").alias("pos", "raw")).withColumn("word", F.regexp_replace("raw", "^-", ""))
    counts = placed.groupBy("word").agg(F.count("*").alias("n"))
    total = placed.count()
    roots = cut(corrections(counts))
    rooted = lookup_join(placed, roots, "word", "n", total, F.col("name")).withColumn("w", F.concat(F.when(F.col("raw").startswith("-"), "-").otherwise(""), F.coalesce("root", "word")))
    grouped = rooted.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("pos", "w"))).alias("ws")).select("name", F.col("ws.w").alias("words"))
    all_words = distinct.join(grouped, "name", "left").select("name", F.coalesce("words", F.array().cast("array<string>")).alias("words"))
    forms = cut(all_words.mapInArrow(_forms, "name string, key string, offers array<string>, wants array<string>"))
    full = forms.filter("size(wants) = 0")
    offered = forms.select("key", F.explode("offers").alias("form")).union(full.filter("key like 'person|%'").select("key", F.col("key").alias("form")))
    scored = offered.groupBy("form", "key").agg(F.count("*").alias("n"))
    clear = scored.groupBy("form").agg(F.max(F.struct("n", "key")).alias("b"), F.sum("n").alias("total")).filter(F.col("b.n") >= CLEAR * (F.col("total") - F.col("b.n")))
    wanted = forms.filter("size(wants) > 0").select("name", "key", F.explode("wants").alias("form"))
    candidates = wanted.join(clear.select("form", F.col("b.key").alias("full"), F.col("b.n").alias("n")), "form", "left")
    found = candidates.groupBy("name").agg(F.min("key").alias("key"), F.max(F.when(F.col("full").isNotNull(), F.struct("n", "full"))).alias("b"), F.sum("n").alias("total"), F.min("full").alias("least"), F.max("full").alias("most"))
    one = (F.col("least") == F.col("most")) | (F.col("b.n") >= CLEAR * (F.col("total") - F.col("b.n")))
    score = F.when(one, F.col("b.n") / F.greatest("total", F.col("b.n"))).otherwise(F.lit(0.0))
    short = found.select("name", F.when(one, F.col("b.full")).otherwise(F.col("key")).alias("key"), score.alias("score"))
    keyed = cut(full.select("name", "key", F.lit(1.0).alias("score")).union(short))
    heads = keyed.groupBy("key").agg(F.min("name").alias("entity"))
    return keyed.join(heads, "key").select("name", "entity", "score")


def linked_pairs(linked: DataFrame) -> DataFrame:
    """All pairs of names of an entity, the smaller first; entities of very many spellings are dealt out."""
    a, b = linked.select("entity", F.col("name").alias("name_a")), linked.select("entity", F.col("name").alias("name_b"))
    return split_join(a, b, "entity", linked.count(), F.col("name_a")).filter("name_a < name_b").select("name_a", "name_b")


def all_names(spark: SparkSession, sf: str) -> DataFrame:
    """The names of the three fields, joint values by part."""
    parts = [table(spark, sf, t, "org") for t in ("corpus_fixture", "org_unknowns", "org_lookup")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()
    return whole.select(F.explode(F.split("org", " / ", -1)).alias("name"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return linked_pairs(cut(link_names(all_names(spark, sf), "name").select("name", "entity")))


def p3_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct name with its entity, the score of the link and the number of spellings of the entity."""
    linked = link_names(all_names(spark, sf), "name")
    return linked.withColumn("n_spellings", F.count("*").over(W.partitionBy("entity")))
