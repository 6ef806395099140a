"""Tokens, containers, languages, personal items and spam pages."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamarack.llm import bpe, language, packing, pii, spam

PATH = bpe.vocabulary_path("byte_bpe_50k")


@pytest.fixture(scope="module")
def judge():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_bpe_is_exact(judge):
    rng = random.Random(4)
    alphabet = "aaaabbeinst'  \n\t.,12\x1c ½²Ⅷ漢字éñ😀​_<>|'sé"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a" * 20_000, " " * 20_000, "ab" * 9_000, "!" * 5_000, "don't I'LL we've", "\ud800".encode("utf-8", "replace").decode()]
    own = bpe.load(PATH)
    for t, e in zip(texts, judge.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(t) == e.ids, repr(t[:80])


def test_bpe_store_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 70)
    own = bpe.ByteBPE(PATH)
    rng = random.Random(2)
    for k in range(500):
        own.encode(f"word{k} " + "".join(rng.choice("abcdefgxyz") for _ in range(12)))
    assert len(own) <= 51 and len(own.fits) <= 70


@pytest.mark.parametrize("name", ["word_bpe_49k", "none"])
def test_other_vocabularies_are_refused(name):
    with pytest.raises((ValueError, OSError)):
        bpe.ByteBPE(bpe.vocabulary_path(name))


def test_encode_column(spark, judge):
    rows = [(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "été", "x")]
    got = bpe.encode_column(spark.createDataFrame(rows, "doc_id long, text string, ids string"), "doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, list(r["ids"])) for r in got) == [(0, judge.encode("été").ids), (1, judge.encode("Hello world").ids), (2, []), (3, []), (3, [])]


def test_sizes_by_other_tokenizers(judge):
    import sentencepiece

    text = "Hello <|endoftext|> l'été, 12 words\n and  more"
    other = Tokenizer.from_file(bpe.vocabulary_path("word_bpe_49k"))
    other.encode_special_tokens = True
    assert bpe.token_counter("byte_bpe_50k")(text) == len(judge.encode(text).ids)
    assert bpe.token_counter("word_bpe_49k")(text) == len(other.encode(text, add_special_tokens=False).ids)
    assert bpe.token_counter("piece_bpe_32k")(text) == len(sentencepiece.SentencePieceProcessor(model_file=f"{bpe.DEFAULT_TOKENIZERS}/piece_bpe_32k.model").encode(text))
    assert bpe.token_counter("byte_bpe_multi_50k")(text) > 5
    with pytest.raises(ValueError):
        bpe.token_counter("none")


def _pack(spark, texts, plans, parts=3):
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, window_id string").repartition(parts)
    return packing.pack(df, plans).collect()


def test_packing(spark, judge):
    rng = random.Random(6)
    texts = [" ".join("word" for _ in range(rng.choice([1, 3, 10, 60, 130]))) for _ in range(300)] + [None, "", "word"]
    sizes = [len(judge.encode(t).ids) if t else 0 for t in texts]
    plans = [(1, "byte_bpe_50k", 64), (2, "byte_bpe_50k", 512)]
    rows = _pack(spark, texts, plans)
    for plan, _, capacity in plans:
        used, pieces = {}, {}
        for r in rows:
            if r["plan_id"] == plan:
                used[r["container_id"]] = used.get(r["container_id"], 0) + r["n_tokens"]
                pieces.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
        assert max(used.values()) <= capacity
        for k, n in enumerate(sizes):
            parts = sorted(pieces[k])
            assert sum(p[1] for p in parts) == n and len(parts) == max(1, -(-n // capacity))
            assert all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:], strict=False))
        assert len(used) <= 1.1 * -(-sum(sizes) // capacity) + 2


def test_packing_with_few_open_windows_and_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "OPEN_WINDOWS", 2)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = _pack(spark, ["word " * n for n in (3, 5, 7, 2, 6, 1, 4, 8, 2, 9)], [(1, "byte_bpe_50k", 10)], parts=7)
    assert sorted(r["doc_id"] for r in rows) == list(range(10))


def test_packing_edge_cases(spark):
    assert _pack(spark, [], [(1, "byte_bpe_50k", 10)]) == []
    with pytest.raises(ValueError):
        _pack(spark, ["x"], [(1, "byte_bpe_50k", 0)])


SENTENCES = {
    "en": ["The committee should fund rural clinics without delay.", "Many families wait for months before they see a doctor.", "We recommend that the government publish its data."],
    "fr": ["Le comité devrait financer les cliniques rurales sans tarder.", "Beaucoup de familles attendent des mois avant de voir un médecin.", "Nous recommandons que le gouvernement publie ses données."],
    "de": ["Der Ausschuss sollte die ländlichen Kliniken finanzieren.", "Viele Familien warten Monate, bis sie einen Arzt sehen.", "Wir empfehlen, dass die Regierung ihre Daten veröffentlicht."],
    "uk": ["Комітет має негайно фінансувати сільські клініки.", "Багато родин місяцями чекають на прийом до лікаря.", "Ми рекомендуємо уряду оприлюднити свої дані."],
    "zh": ["委员会应该立即资助乡村诊所。许多家庭要等几个月才能看医生，我们建议政府公开有关数据，并且听取居民的意见。", "没有医疗口译，新移民家庭只能去很远的地方看病，费用也高得多，所以我们请求委员会不要再推迟决定。"],
}


def _labelled(spark, extra):
    rng = random.Random(9)
    rows = []
    for code, own in SENTENCES.items():
        rows += [(f"{code}{k}", " ".join(rng.sample(own, len(own)) + [rng.choice(own)]), code, "x") for k in range(12)]
    return spark.createDataFrame(rows + extra, "doc_id string, card_text string, language string, main string")


def test_languages_and_segments(spark):
    mixed = f"{SENTENCES['fr'][0]} {SENTENCES['fr'][1]} {SENTENCES['fr'][2]}\n\n{SENTENCES['en'][0]}\n{SENTENCES['uk'][0]}"
    extra = [("m", mixed, "FR-ca", "x"), ("wrong", SENTENCES["de"][0], "English", "x"), ("und", SENTENCES["en"][1], "und", "x"), ("forms", SENTENCES["fr"][1], "fre", "x"), ("n", None, None, "x"), ("b", " \n ", None, "x"), ("digits", "12 34", None, "x"), ("m", mixed, "FR-ca", "x")]
    out = language.languages(_labelled(spark, extra), "doc_id", "card_text", "language")
    got = {(r["id"], r["seg_no"], r["lang_code"]) for r in language.segments(out).collect()}
    assert got == {("m", 1, "fr"), ("m", 2, "en"), ("m", 3, "uk"), ("wrong", 0, "de"), ("und", 0, "en")}
    assert all(0 <= r["main_conf"] <= 1 + 1e-6 for r in out.collect())


def test_held_out_accuracy(spark):
    from tamarack.sources.tables import table

    out = language.languages(table(spark, "/root/testdata/sf0.01", "corpus_fixture", "doc_id", "card_text", "language"), "doc_id", "card_text", "language")
    named = out.filter("code is not null")
    agree = named.filter(F.col("code") == F.col("main")).count() / named.count()
    assert agree > 0.9  # about one label in twenty is wrong by design


def test_languages_without_labels(spark):
    df = spark.createDataFrame([("a", "some text here", None)], "doc_id string, card_text string, language string")
    assert language.languages(df, "doc_id", "card_text", "language").count() == 1
    assert language.languages(df.limit(0), "doc_id", "card_text", "language").count() == 0


CASES = [
    ("Mail a.b+c@d.example. Or x (at) y (dot) example, q [at] r.example; z @ w.example!", [("email", "a.b+c@d.example"), ("email", "x (at) y (dot) example"), ("email", "q [at] r.example"), ("email", "z @ w.example")]),
    ("Follow @handle. Jоe＠mail.example", [("email", "Jоe＠mail.example")]),
    ("Call +1 (613) 555-0199 or 613.555.0198 ext. 7, fax 6135550197; 613–555–0196", [("phone", "+1 (613) 555-0199"), ("phone", "613.555.0198"), ("phone", "6135550197"), ("phone", "613–555–0196")]),
    ("call six one three five five five zero one four two now", [("phone", "six one three five five five zero one four two")]),
    ("In total 821 331 468 dollars; reports for 2019-2020-2021; from 416-503 to 642.564; file 3555-50", []),
    ("SIN: 066 331 083. Her health card 6484-244-841-RJ; passport ZA742694; grant no. ZA742695", [("id_number", "066 331 083"), ("id_number", "6484-244-841-RJ"), ("id_number", "ZA742694")]),
    ("Live at 15-8368 Beacon St. NW, Apt. 471 or 1424, rue du Moulin-Vert, app. 27. Mail 4912 Copperfield Ave. Ok", [("address", "15-8368 Beacon St. NW, Apt. 471"), ("address", "1424, rue du Moulin-Vert, app. 27"), ("address", "4912 Copperfield Ave")]),
    ("There were 12 in the way. 55 Nurses Drive for Change volunteers. The clinic on Saddler Street", []),
    ("Dr. É. Quilafferty and Zoé B.\nIsterander-Selvetti met. The Benjamin Urqetti Memorial Hospital, la Fondation Susan Varnel", [("person", "É. Quilafferty"), ("person", "Zoé B.\nIsterander-Selvetti")]),
    ("Ring +44 20 7946 0958 or +49 (30) 901820 or +33 1 70 18 99 00; in 2019 +44 per cent; +5 2020 3", [("phone", "+44 20 7946 0958"), ("phone", "+49 (30) 901820"), ("phone", "+33 1 70 18 99 00")]),
    ("SSN 219-09-9999, card 4111 1111 1111 1111, not 4111 1111 1111 1112; file no. 219-09-9998 and 219-09-9997 as such", [("id_number", "219-09-9999"), ("id_number", "4111 1111 1111 1111")]),
    ("Hauptstraße 12, 10115 Berlin; Calle de Alcalá 48 y Rua do Ouro, 15; вул. Хрещатик, 22; 北京市长安街10号", [("address", "Hauptstraße 12"), ("address", "Calle de Alcalá 48"), ("address", "Rua do Ouro, 15"), ("address", "вул. Хрещатик, 22"), ("address", "北京市长安街10号")]),
    ("MY NAME IS ÉTIENNE TORDETTI AND I WAIT", [("person", "ÉTIENNE TORDETTI")]),
    ("", []),
]


@pytest.mark.parametrize(("source", "items"), CASES)
def test_personal_items(source, items):
    found = pii.find_items(source)
    assert [(k, source[a:b]) for k, a, b in found] == items
    rest = pii.masked(source, found)
    for kind, text in items:
        assert text not in rest
        assert pii.PLACEHOLDERS[kind] in rest


def test_masking_keeps_the_rest_exactly():
    source = "ﬁrst  ​line – a＠b.example\n\tend"
    found = pii.find_items(source)
    assert pii.masked(source, found) == "ﬁrst  ​line – [EMAIL]\n\tend"


def test_find_personal_rows(spark):
    rows = [("a", "Tel: 613 555 0199", "x"), ("a", "Tel: 613 555 0199", "x"), ("b", None, "x"), ("c", "", "x"), (None, "x@y.example", "x")]
    got = pii.find_personal(spark.createDataFrame(rows, "doc_id string, t string, items string"), "doc_id", "t").collect()
    assert sorted((r["doc_id"] or "", r["masked"]) for r in got if r["masked"] is not None) == [("", "[EMAIL]"), ("a", "Tel: [PHONE]"), ("a", "Tel: [PHONE]"), ("c", "")]
    long = "word " * 200_000 + "a@b.example"
    assert [k for k, _, _ in pii.find_items(long)] == ["email"]


def _prose(rng, n):
    nouns, verbs, places = "committee clinic nurse report family budget region service waiting list".split(), "funds delays reviews expands needs leaves supports".split(), [f"{chr(65 + k)}town{k}" for k in range(26)]
    return " ".join(f"The {rng.choice(nouns)} in {rng.choice(places)} {rng.choice(verbs)} the {rng.choice(nouns)} of {rng.choice(places)} by {rng.randint(2, 999)} per cent." for _ in range(n))


def test_spam_pages(spark):
    rng = random.Random(12)
    good = [(k, _prose(rng, rng.randint(6, 30)), "en") for k in range(120)]
    keywords = "knee brace,eye drops,keto powder,foot cream,best price".split(",")
    bad = [
        (500, ", ".join(rng.choice(keywords) for _ in range(150)), "en"),
        (501, "\n".join(f"https://shop{rng.randint(1, 99)}.example/{rng.choice(keywords).replace(' ', '-')}?ref={rng.randint(1, 9999)}" for _ in range(60)), None),
        (502, " ".join("#" + rng.choice(keywords).replace(" ", "") for _ in range(150)), "xx"),
        (503, " ".join("Our knee brace beats other knee brace because knee brace means eye drops." for _ in range(40)), "en"),
        (504, " ".join(rng.choice("knee brace eye drops".split()) + rng.choice(["", "", "", ".", "!"]) for _ in range(300)), "en"),
    ]
    listed = (600, _prose(rng, 15) + "\nReferences\n" + "\n".join(f"{k}. Author, A. (20{k:02d}). Report on topic {k}. https://x.example/doc/{rng.randint(1, 99999)}" for k in range(10, 15)), "en")
    odd = [(700, None, "en"), (701, "", "en"), (702, "  ", None), (703, "Notes on care", "en"), (704, _prose(rng, 8) + " " + "x" * 900, "en")]
    df = spark.createDataFrame([(*r, True) for r in good + bad + [listed] + odd], "doc_id long, text string, lang string, spam boolean")
    got = {r["doc_id"] for r in spam.spam_scores(df, "doc_id", "text", "lang").filter("spam").collect()}
    assert got == {r[0] for r in bad}
    assert spam.spam_scores(df.limit(0), "doc_id", "text", "lang").count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_spam_copies_do_not_move_what_is_usual(spark, same):
    rng = random.Random(13)
    good = [(k, _prose(rng, rng.randint(14, 18)), "en") for k in range(60)]
    stuffed = [" ".join("Our knee brace beats other knee brace because knee brace means eye drops." for _ in range(18))] * 60
    hot = [(1000 + k, text if same else f"{text} Order {rng.randint(1000, 9999)}-{k} now please.", "en") for k, text in enumerate(stuffed)]
    other = [(2000, " ".join("We sell foot cream and the best foot cream is foot cream for feet." for _ in range(20)), "en"), (2001, "\n".join(f"Keto powder A{rng.randint(100, 999)} ${rng.randint(10, 99)}.10 sale" for _ in range(40)), "en")]
    df = spark.createDataFrame(good + hot + other, "doc_id long, text string, lang string")
    got = {r["doc_id"] for r in spam.spam_scores(df, "doc_id", "text", "lang").filter("spam").collect()}
    assert got == {r[0] for r in hot + other}


def test_long_foreign_lines_need_little_lead():
    import numpy as np

    en, de = language.LANGUAGES.index("en"), language.LANGUAGES.index("de")
    # lead, lead by lower-case words, their n-grams, best; figures of lines of sf0.1 and sf0.01
    lines = [(1.16, 1.04, 228, en, True), (1.22, 0.34, 128, de, True), (0.82, -0.31, 300, de, True), (1.5, 0.4, 30, en, True), (0.82, -0.42, 128, en, False), (0.26, 0.27, 156, en, False), (1.2, 1.2, 30, en, False)]
    lead, plain, grams, best = (np.array(c) for c in list(zip(*lines, strict=True))[:4])
    assert language.leads(lead, plain, grams, best).tolist() == [x[4] for x in lines]


def test_short_lines_of_another_script(spark):
    texts = {
        "zh": "\n".join([*SENTENCES["en"], "我们需要医生。"]),
        "uk": "\n".join([*SENTENCES["fr"], "Дякуємо!"]),
        "latin": "\n".join([*SENTENCES["zh"], "Thank you all", "WHO"]),
        "same": "\n".join([*SENTENCES["uk"], "Дякуємо!", "12"]),
    }
    own = {"zh": "en", "uk": "fr", "latin": "zh", "same": "uk"}
    out = language.languages(_labelled(spark, [(k, t, own[k], "x") for k, t in texts.items()]), "doc_id", "card_text", "language")
    got = {r["id"]: r["langs"] for r in out.filter(F.col("id").isin(*texts)).collect()}
    assert got["zh"][3] == "zh" and got["uk"][3] == "uk" and set(got["same"]) == {"uk"}
    assert got["latin"][2] not in ("zh", "uk") and got["latin"][3] == "zh"


def test_training_rows_count_copies_once(spark):
    rng = random.Random(3)
    texts = [_prose(rng, 2) for _ in range(200)]
    for hot in ([texts[0]] * 100, [texts[k] for k in range(10) for _ in range(10)]):
        df = spark.createDataFrame([(t, "en") for t in texts + hot], "t string, c string")
        rows = language.training_rows(df, "t", "c", per_label=50)
        assert len(rows) == len(set(rows)) == 50
        assert rows == language.training_rows(df.distinct(), "t", "c", per_label=50)


def test_pages_without_sentences_are_spam_only_if_redundant(spark):
    rng = random.Random(21)
    good = [(k, _prose(rng, rng.randint(6, 30)), "en") for k in range(60)]
    syllables = "bar den kel mor tun sil vax rod pim gur lan hef jot wic zub cor nal tef".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(3)).capitalize()
    plain = [
        (100, "\n".join(f"{word()} {word()}, {rng.choice('ABCDEFGH')}. {word()}" for _ in range(40)), "en"),
        (101, "\n".join(f"{word()}  {rng.randint(100, 99999)}  {rng.randint(10, 999)}  {rng.random() * 100:.1f}" for _ in range(40)), "en"),
    ]
    lists = [
        (200, "\n".join(f"Keto Powder {rng.choice('ABCD')}{rng.randint(100, 999)} ${rng.randint(10, 300)}.{rng.randint(10, 99)} in stock" for _ in range(15)), "en"),
        (201, " ".join(f"https://{word()}.example/{word()}/{word()}" for _ in range(8)), "en"),
    ]
    df = spark.createDataFrame(good + plain + lists, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in spam.spam_scores(df, "doc_id", "text", "lang").filter("spam").collect()} == {200, 201}


def test_short_pages_of_tags_or_links(spark):
    rows = [
        (1, "#kneebrace #eyedrops #ketopowder #footcream", True),
        (2, "https://shop1.example/knee-brace https://shop2.example/eye-drops", True),
        (3, "knee brace, eye drops, knee brace, eye drops, knee brace", True),
        (4, "Notes on care", False),
        (5, "The committee should fund rural clinics without delay.", False),
        (6, "See https://x.example/report", False),
        (7, "Brief of the Lindmoor Nurses Society to the committee", False),
    ]
    scores = spam.spam_scores(spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string"), "doc_id", "text")
    assert {r["doc_id"]: r["spam"] for r in scores.collect()} == {k: x for k, _, x in rows}


@pytest.mark.parametrize("address", ["jo (chez) host.example", "jo {@ } host.example", "jo <@> host.example", "jo ( @ ) host.example", "jo (  at ) host.example", "jo at host point ca", "jo arobase host punto es", "jo arroba host ponto pt", "jo point roy (chez) host point ca", "jo@host (.) example"])
def test_disguised_addresses_reach_the_rewrite(address):
    source = f"Write to: {address}, please."
    assert [(k, source[a:b]) for k, a, b in pii.find_items(source)] == [("email", address)]


@pytest.mark.parametrize("prose", ["Look at this point in time.", "Waits fell at Rocky Point in 2019.", "It was right at one point during talks.", "Du point de vue du comité, à ce point précis.", "We met at some point we forgot."])
def test_points_of_prose_are_no_addresses(prose):
    assert pii.find_items(prose) == []
    found = pii.find_items(source := f"a@b.example point de vue. {prose}")
    assert [(k, source[a:b]) for k, a, b in found] == [("email", "a@b.example")]


HINDI = "समिति को ग्रामीण क्लीनिकों के लिए बिना देरी के धन देना चाहिए। कई परिवार डॉक्टर से मिलने के लिए महीनों प्रतीक्षा करते हैं। हम सरकार से अपने आंकड़े प्रकाशित करने की सिफारिश करते हैं। पिछले वर्ष नर्सों की संख्या घट गई और अस्पतालों में भीड़ बढ़ी। दवाओं की कीमत गरीब घरों की पहुंच से बाहर है। बच्चों के टीके समय पर नहीं पहुंचते, इसलिए बीमारी फैलती है।"
THAI = "คณะกรรมการควรสนับสนุนเงินทุนให้คลินิกในชนบทโดยไม่ชักช้า หลายครอบครัวรอหลายเดือนกว่าจะได้พบแพทย์ เราแนะนำให้รัฐบาลเผยแพร่ข้อมูลของตนต่อสาธารณะ ปีที่แล้วจำนวนพยาบาลลดลงและโรงพยาบาลแออัดมากขึ้น ราคายาสูงเกินกว่าที่ครัวเรือนยากจนจะซื้อได้ วัคซีนสำหรับเด็กมาถึงช้าจึงเกิดโรคระบาดในหมู่บ้านห่างไกล"
POEM = "\n".join("the river carries what the winter kept\nan old grey boat, a letter and a shoe\nnobody on the eastern landing slept\nand still the lantern showed the barges through\n\nmy mother counted every passing sail\nand wrote the numbers inside almanacs\nthe neighbours brought her biscuits with the mail\nshe thanked them kindly, never turning back".split("\n"))
CODE = 'def merge(left, right):\n    """Two sorted lists as one."""\n    out, i, j = [], 0, 0\n    while i < len(left) and j < len(right):\n        if right[j] < left[i]:\n            out.append(right[j])\n            j += 1\n        else:\n            out.append(left[i])\n            i += 1\n    return out + left[i:] + right[j:]\n\n\nclass Store(dict):\n    def __missing__(self, key):\n        value = self[key] = compute(key, verbose=False)\n        return value\n\n\nif __name__ == "__main__":\n    print(merge(sorted(map(int, open("a.txt"))), sorted(range(9))))\n'


@pytest.mark.parametrize("pages", [0, 60])
def test_prose_of_other_scripts_poems_and_code_are_no_spam(spark, pages):
    rng = random.Random(31)
    rows = [(k, _prose(rng, rng.randint(6, 30)), "en") for k in range(pages)]
    rows += [(900 + k, t, None) for k, t in enumerate((HINDI, THAI, POEM, CODE, THAI + " " + POEM))]
    rows += [(800, "护膝，眼药水，护膝，护膝，眼药水，" * 20, "zh"), (801, "घुटने का ब्रेस सस्ता दाम, " * 25, "hi")]
    got = {r["doc_id"] for r in spam.spam_scores(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang").filter("spam").collect()}
    assert got == {800, 801}


def test_many_items_are_found_in_linear_time():
    import time

    text = " ".join(f"user{k}@host{k}.example" for k in range(20_000))
    began = time.perf_counter()
    assert len(pii.find_items(text)) == 20_000 and time.perf_counter() - began < 10
