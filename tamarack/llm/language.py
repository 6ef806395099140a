"""Document and segment languages from text alone (problem 4).

A multinomial logistic regression on hashed character n-grams within words, weighted by TF-IDF, is
trained here by follow-the-regularised-leader with elastic-net penalties on a bounded sample of
labelled rows; rows whose label a model of the other half of them contradicts are left out of the final one. A
temperature fitted on held-out rows turns its scores into confidences. The weights, of fixed size,
travel to the workers, which keep the score of every word they have met, so a line costs one look-up
per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.functions.basic import hash_unit
from tamarack.sources.tables import text_table

LANGUAGES = ("de", "en", "es", "fr", "pt", "uk", "zh")
#: Other forms of the codes (three letters, English name).
LABEL_FORMS = {
    "de": ("deu", "ger", "german"),
    "en": ("eng", "english"),
    "es": ("spa", "spanish"),
    "fr": ("fra", "fre", "french"),
    "pt": ("por", "portuguese"),
    "uk": ("ukr", "ukrainian"),
    "zh": ("zho", "chi", "chinese"),
}
#: Labelled rows used for training, per label.
ROWS_PER_LABEL = 400
#: So many times as many labelled texts are looked at.
SPARE = 4
#: Of a labelled text, the longest line of its first so many characters is trained on.
TRAINING_CHARS = 4000
FEATURES = 1 << 14
LONGEST_GRAM = 4
EPOCHS, BATCH = 6, 32
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.02
#: Confidences are calibrated on held-out lines cut to these lengths, as lines to be labelled are of any length.
PIECE_CHARS = (20, 40, 80, 160, 1 << 30)
#: How far a line's own language must lead the record's main one to count, as a difference of the model's scores before calibration:
#: by all words, and by its lower-case words, which names are not among; not so where a language writes all nouns with capitals.
LINE_MARGIN, PLAIN_MARGIN, CAPITAL_NOUNS = 1.4, 0.35, ("de",)
#: With this many n-grams in lower-case words, about eight words, the lead by those words, or half the margin where nouns have capitals, is enough, whatever the names beside them.
LONG_LINE = 100
#: Lines with fewer letters keep the record's main language, unless they are in a script that it isn't written in.
LINE_LETTERS = 12
#: Lower-case words that a short Latin line needs to count in a record of another script; names and acronyms have none.
LINE_WORDS = 2

_LETTERS = re.compile(r"[^\W\d_]+")
_LINES = re.compile(r"\r\n|\n|\r")
# Scripts that only one of the languages is written in.
_SCRIPTS = (("zh", re.compile(r"[㐀-鿿]")), ("uk", re.compile(r"[Ѐ-ӿ]")))
_LATIN = [k for k, c in enumerate(LANGUAGES) if c not in ("uk", "zh")]
_ADDRESS = re.compile(r"\S*@\S*|https?:\S*")


def short_line(line: str, main: int, score: np.ndarray) -> int:
    """The language of a line too short for n-grams: main, unless most letters are in a script that main isn't written in."""
    words, plain = line_words(line)
    letters = "".join(words)
    for code, script in _SCRIPTS:
        if 2 * len(script.findall(letters)) > len(letters):
            return LANGUAGES.index(code)
    if main not in _LATIN and sum(plain) >= LINE_WORDS and 2 * sum(c < "ɐ" for c in letters) > len(letters):
        return max(_LATIN, key=lambda k: score[k])
    return main


def leads(lead: np.ndarray, plain_lead: np.ndarray, plain_grams: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Which lines count as their own best language: all words lead by far, or enough lower-case words lead."""
    nouns = np.isin(best, [LANGUAGES.index(c) for c in CAPITAL_NOUNS])
    long = (plain_grams >= LONG_LINE) & ((plain_lead >= PLAIN_MARGIN) | nouns & (lead >= LINE_MARGIN / 2))
    return long | (lead >= LINE_MARGIN) & ((plain_lead >= PLAIN_MARGIN) | nouns)


def label_code(label: Column) -> Column:
    """The language a label names, whatever its form; null where it names none."""
    bare = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    forms = {form: code for code, others in LABEL_FORMS.items() for form in (code, *others)}
    pairs = [x for form, code in forms.items() for x in (F.lit(form), F.lit(code))]
    return F.try_element_at(F.create_map(*pairs), bare)


def line_words(line: str) -> tuple[list[str], list[bool]]:
    """The words of a line in lower case, without addresses, and which of them were so written."""
    words = _LETTERS.findall(_ADDRESS.sub(" ", line) if "@" in line or "http" in line else line)
    low = list(map(str.lower, words))
    return low, list(map(eq, words, low))


@cache
def _grams(word: str) -> np.ndarray:
    text = f" {word} "
    found = [text[k : k + n] for n in range(1, LONGEST_GRAM + 1) for k in range(len(text) - n + 1)]
    return np.array([xxhash.xxh3_64_intdigest(g) % FEATURES for g in found if g != " "], dtype=np.int64)


class Model:
    """Weights (features x languages, the last row the bias), idf and temperature."""

    def __init__(self, weights: np.ndarray, idf: np.ndarray, temperature: float = 1.0) -> None:
        self.weights, self.idf, self.temperature = weights.astype(np.float32), idf.astype(np.float32), temperature

    def word(self, word: str) -> np.ndarray:
        """The word's share of the scores, and its number of n-grams."""
        g = _grams.__wrapped__(word)
        return np.append((self.weights[g] * self.idf[g, None]).sum(axis=0), len(g)).astype(np.float32)

    def scores(self, sums: np.ndarray) -> np.ndarray:
        """Calibrated scores from rows of summed word shares."""
        raw = sums[:, :-1] / np.sqrt(np.maximum(sums[:, -1:], 1)) + self.weights[-1]
        return raw / self.temperature


def _vectors(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for k, t in enumerate(texts):
        words, _ = line_words(t)
        if words:
            g = np.concatenate([_grams(w) for w in words])
            out[k] = np.bincount(g, minlength=FEATURES) / np.sqrt(len(g))
    return out


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _leader(x: np.ndarray, y: np.ndarray, use: np.ndarray, classes: int) -> np.ndarray:
    """Follow-the-regularised-leader over mini-batches of the rows ``use``; the last row of the result is the unpenalised bias."""
    rows = x.shape[1] + 1
    z, n, w = (np.zeros((rows, classes), dtype=np.float32) for _ in range(3))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(use), max(1, len(use) // BATCH)):
            p = _softmax(x[part] @ w[:-1] + w[-1])
            p[np.arange(len(part)), y[part]] -= 1
            g = np.vstack([x[part].T @ p, p.sum(axis=0)]) / len(part)
            step = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
            z += g - step * w
            n += g * g
            l1 = np.full((rows, 1), L1, dtype=np.float32)
            l1[-1] = 0
            w = np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)).astype(np.float32)
    return w


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    def loss(t: float) -> float:
        return float(-np.log(_softmax(scores / t)[np.arange(len(y)), y] + 1e-9).mean())

    return min((float(t) for t in np.geomspace(0.05, 20, 80)), key=loss)


def train(rows: list[tuple[str, str]]) -> Model:
    """A model from (text, code) rows; with no rows every language scores alike."""
    texts = [max(_LINES.split(t), key=len) for t, _ in rows]
    y = np.array([LANGUAGES.index(c) for _, c in rows], dtype=np.int64)
    if not len(y):
        return Model(np.zeros((FEATURES + 1, len(LANGUAGES))), np.ones(FEATURES))
    # one matrix of rows x features, weighted in place: at most languages x ROWS_PER_LABEL x FEATURES x 4 bytes
    x = _vectors(texts)
    idf = np.log((1 + len(texts)) / (1 + np.count_nonzero(x, axis=0))).astype(np.float32) + 1
    x *= idf
    rows_ = np.arange(len(y))
    held = (rows_ % 5 == 4) & (len(y) >= 10)
    # each half is judged by a model of the other, which has not learnt its wrong labels by heart
    halves = [rows_[rows_ % 2 == k] for k in (0, 1)] if len(y) >= 10 else [rows_, rows_]
    clean = np.zeros(len(y), dtype=bool)
    for own, other in (halves, halves[::-1]):
        w = _leader(x, y, other, len(LANGUAGES))
        p = _softmax(x[own] @ w[:-1] + w[-1])
        clean[own] = p[np.arange(len(own)), y[own]] > 0.5 * p.max(axis=1)
    fit, test = rows_[clean & ~held], rows_[clean & held]
    w = _leader(x, y, fit, len(LANGUAGES)) if len(fit) else w
    if not len(test):
        return Model(w, idf)
    pieces = [_vectors([texts[k][:n] for k in test]) * idf @ w[:-1] + w[-1] for n in PIECE_CHARS]
    return Model(w, idf, _temperature(np.concatenate(pieces), np.tile(y[test], len(pieces))))


def training_rows(records: DataFrame, text: str, code: str, per_label: int = ROWS_PER_LABEL) -> list[tuple[str, str]]:
    """At most ``per_label`` distinct texts of each label, chosen by hash and cut to TRAINING_CHARS; never more than languages x per_label rows reach the driver.

    Labels are counted without a look at the texts; of each, the texts below a bound on the hash are read, SPARE times as many as
    needed, since copies count once and short texts not at all.
    """
    named = records.filter(F.col(code).isin(*LANGUAGES))
    counts = named.groupBy(code).count().collect()
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(code) == r[code], F.lit(min(1.0, SPARE * per_label / r["count"]))).otherwise(share)
    u = hash_unit(F.col(text))
    near = named.filter((F.length(F.col(text)) >= 40) & (u < share)).select(F.substring(F.col(text), 1, TRAINING_CHARS).alias("t"), F.col(code).alias("c"), u.alias("u")).distinct()
    kept = near.withColumn("rn", F.row_number().over(W.partitionBy("c").orderBy("u", "t"))).filter(F.col("rn") <= per_label)
    return [(r["t"], r["c"]) for r in kept.orderBy("u", "t", "c").select("t", "c").collect()]


def _label_lines(model: Model):
    """For each record: main language and its confidence, and the language, confidence and letters of each non-blank line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        shares = np.zeros((1024, len(LANGUAGES) + 1), dtype=np.float32)
        schema = pa.schema([("id", pa.string()), ("code", pa.string()), ("main", pa.string()), ("main_conf", pa.float64()), ("langs", pa.list_(pa.string())), ("confs", pa.list_(pa.float64()))])
        for batch in batches:
            if len(known) > 500_000:
                known.clear()
            ids, plain, starts, letters, owner, short = [], [], [], [], [], {}
            docs = batch.column(1).to_pylist()
            for d, text in enumerate(docs):
                for line in _LINES.split(text) if text else ():
                    if not line or line.isspace():
                        continue
                    words, as_is = line_words(line)
                    starts.append(len(ids))
                    plain += as_is
                    letters.append(sum(map(len, words)))
                    if 0 < letters[-1] < LINE_LETTERS:
                        short[len(owner)] = line
                    owner.append(d)
                    for w in words:
                        k = known.get(w)
                        if k is None:
                            k = known[w] = len(known)
                            if k >= len(shares):
                                shares = np.vstack([shares, np.zeros_like(shares)])
                            shares[k] = model.word(w)
                        ids.append(k)
            out: list[list] = [[] for _ in schema]
            if owner:
                summed, lower = (np.zeros((len(owner), shares.shape[1]), dtype=np.float32) for _ in range(2))
                filled = np.flatnonzero(np.diff([*starts, len(ids)]) > 0)
                if len(filled):
                    each, at = shares[ids], np.array(starts)[filled]
                    summed[filled] = np.add.reduceat(each, at, axis=0)
                    lower[filled] = np.add.reduceat(each * np.array(plain, dtype=np.float32)[:, None], at, axis=0)
                score, plain_score = model.scores(summed), model.scores(lower)
                capitals = lower[:, -1] < LINE_LETTERS
                plain_score[capitals] = score[capitals]
                prob, n, own = _softmax(score), np.array(letters), np.array(owner)
                best = score.argmax(axis=1)
                keys, codes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
                for a, b in zip(edge, edge[1:], strict=False):
                    mass = np.bincount(best[a:b], weights=n[a:b], minlength=len(LANGUAGES))
                    if not mass.any():
                        continue
                    main = int(mass.argmax())
                    rows = np.arange(a, b)
                    lead, plain_lead = (model.temperature * (x[rows, best[a:b]] - x[a:b, main]) for x in (score, plain_score))
                    sure = leads(lead, plain_lead, lower[a:b, -1], best[a:b])
                    lines = np.where(sure & (n[a:b] >= LINE_LETTERS), best[a:b], main)
                    for k in rows[(n[a:b] > 0) & (n[a:b] < LINE_LETTERS)]:
                        lines[k - a] = short_line(short[k], main, score[k])
                    weight = n[a:b] / n[a:b].sum()
                    row = (keys[own[a]], codes[own[a]], LANGUAGES[main], float((prob[a:b, main] * weight).sum()), [LANGUAGES[k] for k in lines], [float(prob[a + i, k]) for i, k in enumerate(lines)])
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run


def languages(records: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Rows (id, code, main, main_conf, langs, confs), one per row whose text has letters.

    code is the language the label names, or null. main is the language of most letters; langs and
    confs hold a language and a confidence for each non-blank line. Null and blank texts, and texts
    without letters, give no row; repeated rows each give one; other columns are ignored; without
    usable labels every language is equally likely and the first is named.
    """
    source = records.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), label_code(F.col(label_col)).alias("code")).filter("text is not null")
    model = train(training_rows(source, "text", "code"))
    return source.mapInArrow(_label_lines(model), "id string, code string, main string, main_conf double, langs array<string>, confs array<double>")


def segments(labelled: DataFrame) -> DataFrame:
    """Rows (id, seg_no, lang_code, confidence): seg_no 0 where the label is missing or wrong, 1 and on for the lines of mixed records."""
    whole = F.when(F.col("code").isNull() | (F.col("code") != F.col("main")), F.array(F.struct(F.lit(0).cast("long").alias("seg_no"), F.col("main").alias("lang_code"), F.col("main_conf").alias("confidence"))))
    lines = F.when(F.size(F.array_distinct("langs")) > 1, F.transform(F.arrays_zip("langs", "confs"), lambda x, i: F.struct((i + 1).cast("long").alias("seg_no"), x["langs"].alias("lang_code"), x["confs"].alias("confidence"))))
    empty = F.array().cast("array<struct<seg_no:bigint,lang_code:string,confidence:double>>")
    return labelled.select("id", F.explode(F.concat(F.coalesce(whole, empty), F.coalesce(lines, empty))).alias("s")).select("id", "s.seg_no", "s.lang_code", "s.confidence")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return languages(text_table(spark, sf, "corpus_fixture", "doc_id", "card_text", "language"), "doc_id", "card_text", "language")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return segments(_labelled(spark, sf)).select(F.col("id").alias("doc_id"), "seg_no", "lang_code").distinct()


def p4_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of every record with letters."""
    return _labelled(spark, sf).select(F.col("id").alias("doc_id"), F.col("main").alias("lang_code"), F.round("main_conf", 6).alias("confidence")).distinct()
