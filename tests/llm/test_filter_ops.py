"""Language, quality, personal data."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.llm import langid, pii, quality, queries
from tests.conftest import SF01, SF001
from tests.llm import brute, fixtures


def test_language_held_out_accuracy(spark):
    docs = fixtures.read(SF01).set_index("doc_id")
    rows = queries.op7_language(spark, SF01).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [(r.lang_pred, docs.lang[r.doc_id]) for r in rows if r.held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.98


def test_language_does_not_depend_on_files(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    told = []
    for n in (1, 7):
        docs.repartition(n).write.parquet(f"{tmpdir_path}/{n}")
        told.append(sorted(map(tuple, langid.identify(spark.read.parquet(f"{tmpdir_path}/{n}")).collect())))
    assert told[0] == told[1]


def test_language_levels():
    """The family decides first; within it the pairwise winner, with ties by margin and name."""
    x = np.zeros(langid.DIMENSIONS)
    x[0] = 1.0

    def separator(a, b, margin):
        return langid.Separator(a, b, x * margin, 0.0)

    model = langid.Model({"germanic": ["de", "en", "nl"], "romance": ["es", "fr"]}, [separator("germanic", "romance", 2.0)],
                         {"germanic": [separator("de", "en", -1.0), separator("de", "nl", 3.0), separator("en", "nl", 0.5)],
                          "romance": [separator("es", "fr", 9.0)]})
    lang, score = model.predict(x)
    assert lang == "en" and 0 < score < 1
    assert model.predict(None) == ("und", 0.0)
    assert langid.family_of("fr") == "romance" and langid.family_of("xx") == "xx"


def test_language_features():
    assert langid.features("") is None and langid.features(None) is None and langid.features("12 !? \n") is None
    assert np.allclose(langid.features("Abc def"), langid.features("ABC,  def!"))
    assert abs((langid.features("é" * 100_000) ** 2).sum() - 1) < 1e-9


def test_language_awkward(spark):
    docs = fixtures.awkward(spark)
    rows = langid.identify(docs).collect()
    assert len(rows) == len(fixtures.awkward_rows())
    und = [r for r in rows if r.lang_pred == "und"]
    assert all(r.score == 0.0 for r in und) and {3, 4, 7} <= {r.doc_id for r in und}
    assert langid.identify(fixtures.empty(spark)).count() == 0
    unlabelled = langid.identify(fixtures.texts(spark, [(1, "abc"), (2, None)]).selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert [r.lang_pred for r in unlabelled] == ["und", "und"]
    single = langid.fit(fixtures.texts(spark, [(k, fixtures.prose(k, 20)) for k in range(10)]))
    told = langid.predict(docs.withColumnRenamed("spans", "lang_pred"), single, ["doc_id", "lang_pred", "score", "part"])
    assert told.columns == ["doc_id", "part", "lang_pred", "score"] and {r.lang_pred for r in told.collect()} == {"en", "und"}
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (3, 4, 7)").count() == 0
    assert kept.where("doc_id in (8, 9, 10, 12, 14)").count() == 6
    assert langid.accepted(fixtures.empty(spark)).count() == 0


def test_unlearned_languages_are_rejected(spark):
    """Texts unlike every learned language score low; without labels only letters count."""
    polish = ("wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem "
              "i sumieniem i powinni postępować wobec innych w duchu braterstwa")
    russian = "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью"
    rng = random.Random(1)
    gibberish = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(60))
    extra = spark.createDataFrame([(-k, t, None, None, None) for k, t in enumerate((polish, russian, gibberish), 1)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    learned = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    kept = langid.accepted(learned.unionByName(extra))
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() == learned.where(r"text rlike '[a-zA-Z]'").count()
    rows = fixtures.texts(spark, [(1, "abc"), (2, None), (3, ""), (4, "12 !?"), (5, "漢")]).withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in langid.accepted(rows).collect()} == {1, 5}


def test_short_texts_are_judged_by_their_length(spark):
    """Ordinary short sentences stay, as do labelled texts cut short; the same letters repeated or other scripts go."""
    learned = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(learned.where(~langid.held_out()))

    def kept(text):
        lang, score = model.predict(*langid.measured(text))
        return lang != "und" and score >= langid.MIN_SCORE

    for text in ("Hello world", "Good morning", "Thank you very much", "merci beaucoup", "Bonjour tout le monde", "Guten Morgen",
                 "Wo ist der Bahnhof?", "Vielen Dank für Ihre Hilfe", "Buenos días", "Muchas gracias por su ayuda",
                 "I went to the market yesterday and bought some apples."):
        assert kept(text), text
    for text in ("昨日市場に行ってりんごを買いました。", "Вчера я ходил на рынок и купил яблоки.", "Привет мир", "ᚠᚢᚦ",
                 "xkqz vvwpt zzqj bbrk qwxz", "qqqqzzzz xxxx", "Poszedłem wczoraj na targ i kupiłem jabłka.", ""):
        assert not kept(text), text
    texts = [r.text for r in learned.where(langid.held_out() & F.col("lang").isNotNull()).select("text").collect() if r.text]
    for n in (10, 20, 40, 80):
        cut = [t[:n] for t in texts if any(c.isalpha() for c in t[:n])]
        assert sum(not kept(t) for t in cut) <= 0.004 * len(cut), n
    # More letters of the same shares only ever narrow what is allowed.
    x, n = langid.measured("Hello world")
    profile = model.profiles["en"]
    likes = [profile.likeness(x, n * k) for k in (1, 2, 4, 16, 256)]
    assert likes == sorted(likes, reverse=True) and likes[-1] == profile.likeness(x)


def test_quality_query(spark):
    docs = fixtures.read(SF001)
    got = {r.doc_id: r for r in queries.op6_quality_lines(spark, SF001).collect()}
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        r, base = got[i], brute.base_quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base, i
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert r.base_failed == failed and (not failed or not r.kept)


def line_fixture():
    rows = []
    for i in range(60):
        own = fixtures.prose(i, 12)
        host = "a" if i % 2 else "b"
        text = f"{own}\nSubscribe  to our News {i}" if i < 40 else own
        if i in (3, 5):
            text = f"five own words are here\n{' '.join(['Subscribe to our news 9'] * 1)}\nsubscribe TO our news 12"
        rows.append((i, text, host))
    return rows


def test_line_frequency_against_brute_force(spark):
    rows = line_fixture()
    docs = spark.createDataFrame([(i, t, h, 1) for i, t, h in rows], "doc_id long, text string, source string, line long")
    limits = {"min_documents": 5, "max_share": 0.3}
    held = {}
    for i, t, h in rows:
        for x in {quality.normalised_line(x) for x in t.split("\n")}:
            held.setdefault((h, x), set()).add(i)
    hosts = {h: len({i for i, _, g in rows if g == h}) for h in "ab"}
    common = {k for k, v in held.items() if len(v) > 5 and len(v) > 0.3 * hosts[k[0]]}
    assert common == {("a", "subscribe to our news 0"), ("b", "subscribe to our news 0")}
    got = {r.doc_id: r for r in quality.quality(docs, **limits).collect()}
    for i, t, h in rows:
        gone = sum(len(brute.words(x)) for x in t.split("\n") if (h, quality.normalised_line(x)) in common)
        n = len(brute.words(t))
        assert got[i].n_words_removed == gone
        assert got[i].kept == (not got[i].base_failed and 100 * (n - gone) >= 50 * n)
    assert not got[3].kept and got[7].kept
    out = quality.without_common_lines(docs, **limits)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and texts[3] == "five own words are here" and texts[50] == rows[50][1] and "\n" not in texts[7]


def test_quality_awkward(spark):
    got = quality.quality(fixtures.awkward(spark)).collect()
    assert len(got) == len(fixtures.awkward_rows())
    by = {r.doc_id: r for r in got}
    assert by[4].n_words == 0 and by[4].base_failed and not by[4].kept
    assert by[14].n_repeat_words == 3_000 and by[8].n_words == 30_000
    assert quality.quality(fixtures.empty(spark)).count() == 0
    assert quality.without_common_lines(fixtures.awkward(spark)).count() == len(fixtures.awkward_rows())


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_private_data_query(spark):
    docs = fixtures.read(SF01)
    got = {r.doc_id: r for r in queries.op8_private_data(spark, SF01).collect()}
    assert len(got) == len(docs)
    found = 0
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        spans = brute.base_spans(text)
        found += len(spans)
        r = got[i]
        assert r.base_sha256 == brute.sha(joined(spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in pii.KINDS]
        assert r.spans.startswith(joined(spans))
    assert found > 20


TRICKY = [
    "a@b.c_d@e.f x@y", "a.b+c@d-e.f.g. @x.y", "aaa@bbb aaa@bbb.c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255", "1.2.3",
    "4111 1111-1111 1111 4111111111111112", "4111 1111 1111 1111 5", "12 34-56", "+1 (234) 567-8901. +12 +1234567890123456", "++49 30 1234567",
    "é漢 a@b.co \U0001f600 10.0.0.1", "", None, "a" * 3_000, "1" * 3_000, "1 " * 30_000, "a@" * 3_000, "a@b" + ".c" * 20_000, "+1" + "(" * 20_000,
]


def test_base_patterns_on_tricky_and_long_texts(spark):
    rng = random.Random(2)
    rows = TRICKY + ["".join(rng.choice(["a", "1", "@", ".", "-", "+", " ", "(", ")", "_", "4111111111111111", "é"]) for _ in range(rng.randint(0, 60)))
                     for _ in range(500)]
    docs = fixtures.texts(spark, list(enumerate(rows)))
    for r in pii.find(docs).collect():
        assert r.base_sha256 == brute.sha(joined(brute.base_spans(rows[r.doc_id]))), rows[r.doc_id]


def disclosure_rows():
    """Ann's address stands in four texts with a word that is nowhere else and one that is half the time elsewhere."""
    rows = [(k, f"{fixtures.prose(k, 20)} write ann@x.org about zanzibar and the Kleinigkeit") for k in range(4)]
    rows += [(k, f"{fixtures.prose(k, 20)} write about the Kleinigkeit") for k in range(10, 14)]
    rows += [(k, f"{fixtures.prose(k, 20)} write about the thing and more") for k in range(20, 100)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    rows = disclosure_rows()
    text = dict(rows)
    got = {r.doc_id: r for r in pii.find(fixtures.texts(spark, rows)).collect()}
    for k in range(4):
        at = text[k].index("zanzibar")
        assert got[k].spans.endswith(f"term:{at}:{at + 8}") and got[k].n_email == 1 and got[k].spans.count("term") == 1
    assert all(got[k].spans == "" for k in text if k >= 10)
    looser = {r.doc_id: r.spans.count("term") for r in pii.find(fixtures.texts(spark, rows), disclosure=0.5).collect()}
    assert all(looser[k] == 2 for k in range(4)) and looser[10] == 0
    clean = {r.doc_id: r.text for r in pii.sanitise(fixtures.texts(spark, rows), disclosure=0.5).collect()}
    assert "write <EMAIL> about  and the <TERM>" in clean[0] and clean[10] == text[10]


def test_copies_are_no_evidence(spark):
    rows = [(k, "write ann@x.org about zanzibar") for k in range(50)] + [(k, fixtures.prose(k, 20)) for k in range(50, 100)]
    assert all("term" not in r.spans for r in pii.find(fixtures.texts(spark, rows)).collect())


def test_one_text_is_no_evidence_and_two_are(spark):
    """Words of the only text of an entity stay, however rare; what two texts show with it is told, in any corpus size."""
    told = []
    for n in (200, 3_000):
        plain = [(k, "write about the thing here today please") for k in range(n)]
        rows = [*plain, (5_000, "write zoe@x.org about zanzibar today"), (5_001, "write bob@y.org about kilimanjaro"),
                (5_002, "please write bob@y.org on kilimanjaro today"), (5_003, "write eve@z.org about everest"), (5_004, "today about everest")]
        text = dict(rows)
        got = {r.doc_id: r.spans for r in pii.find(fixtures.texts(spark, rows)).collect() if r.doc_id >= 5_000}
        for k in (5_001, 5_002):
            at = text[k].index("kilimanjaro")
            assert got[k].endswith(f",term:{at}:{at + 11}") and got[k].count("term") == 1, k
        assert all("term" not in got[k] for k in (5_000, 5_003, 5_004))
        told.append(got)
    assert told[0] == told[1]


def test_groups_of_entities_are_protected(spark):
    """Each address is in one text, but its host is in several, always with the name of the firm."""
    rows = [(k, f"{fixtures.prose(k, 20)} user{k}@firm.example of Quillfeather writes") for k in range(5)]
    rows += [(k, f"{fixtures.prose(k, 20)} user{k}@mail{k}.example of here writes") for k in range(20, 60)]
    got = {r.doc_id: r for r in pii.find(fixtures.texts(spark, rows)).collect()}
    for k, text in rows:
        told = [text[int(a) : int(b)] for kind, a, b in (x.split(":") for x in got[k].spans.split(",")) if kind == "term"]
        assert told == (["Quillfeather"] if k < 5 else [])


def random_corpus(seed, n, names):
    """Texts of a small vocabulary, a third with an address of one of a few people; some of these named beside it."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        words = fixtures.prose(rng.randint(0, 5), rng.randint(3, 40), 60).split()
        if rng.random() < 0.3:
            who = rng.randint(0, 9)
            words.insert(rng.randint(0, len(words)), f"p{who}@host{who % 3}.org")
            if names and rng.random() < 0.9:
                words.insert(rng.randint(0, len(words)), f"Name{who}")
        rows.append((k, " ".join(words)))
    return rows + rows[: n // 10]  # copies are rows, but no evidence


def brute_terms(rows):
    import math
    import re

    def entities(text):
        return {x for m in re.findall(pii.EMAIL.replace(r"\G|", ""), text) for x in (f"email:{m.lower()}", f"group:email:{m.lower().split('@')[-1]}")}

    def terms(text):
        return {w for w in re.split(r"[\W_]+", re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", " ", text).lower()) if w}

    n_t, whole = {}, {}
    for _, text in rows:
        for w in {w for w in re.split(r"[\W_]+", text.lower()) if w}:
            n_t[w] = n_t.get(w, 0) + 1
        if entities(text):
            whole[text] = whole.get(text, 0) + 1
    out = {}
    for e in {e for text in whole for e in entities(text)}:
        own = [t for t in whole if e in entities(t)]
        for w in {w for t in own for w in terms(t)}:
            both = [t for t in own if w in terms(t)]
            k, copies = len(both), sum(whole[t] for t in both)
            t = max(n_t.get(w, 0), copies) - copies + k
            mean = len(own) * t / (len(rows) - sum(whole[x] for x in own) + len(own))
            tail = k + k * math.log(mean / k)
            if k >= 2 and mean < k and min(tail - mean, tail - math.log(2 * math.pi * k) / 2) <= math.log(pii.CHANCE) and k / t >= pii.DISCLOSURE:
                out[e, w] = k / t
    return out


@pytest.mark.parametrize("names", [True, False])
def test_terms_equal_brute_force(spark, names):
    """Planted names are told and little else; with entities dealt at random hardly anything is."""
    rows = random_corpus(names, 400, names)
    expected = brute_terms(rows)
    docs = fixtures.texts(spark, rows)
    found = pii.detected(docs, ["doc_id"], with_text=False)
    got = pii.disclosing_terms(docs, found, pii.base_spans(found))
    keys = [(e, w) for e, w in expected]
    hashed = spark.createDataFrame(keys, "e string, w string").select("e", "w", F.xxhash64("e").alias("entity"), F.xxhash64("w").alias("term")).collect() if keys else []
    assert {(r.entity, r.term): expected[r.e, r.w] for r in hashed} == pytest.approx({(r.entity, r.term): r.share for r in got.collect()})
    told = {w for _, w in expected}
    planted = {w for w in told if w.startswith("name")}
    assert len(planted) == (10 if names else 0) and len(told - planted) <= 1


def test_a_long_text_with_an_address(spark):
    """Work grows with the words of a text, not with their square."""
    import time

    took = {}
    for n in (1_000, 1_000, 40_000):
        words = " ".join(f"w{i}" for i in range(n))
        rows = [(1, f"a@b.org {words}"), (2, f"{words} a@b.org x"), *((k, f"plain {k}") for k in range(10, 300))]
        began = time.time()
        got = {r.doc_id: r for r in pii.find(fixtures.texts(spark, rows)).collect()}
        took[n] = time.time() - began
        assert got[1].spans.count("term") == got[2].spans.count("term") == n
    assert took[40_000] < took[1_000] + 6


def test_short_names_and_numbers_are_judged(spark):
    """Names of two and three letters, in any script, and letter-digit runs are terms; words that others have are not told."""
    rows = [(k, f"{fixtures.prose(k, 20)} ask lee@x.org or 李娜 or Wu or Kim under K47B and 4711 for the thing") for k in range(4)]
    rows += [(k, f"{fixtures.prose(k, 20)} write or ask for the thing and more") for k in range(20, 100)]
    got = {r.doc_id: r for r in pii.find(fixtures.texts(spark, rows)).collect()}
    for k, text in rows[:4]:
        told = [text[int(a) : int(b)] for kind, a, b in (x.split(":") for x in got[k].spans.split(",")) if kind == "term"]
        assert told == ["李娜", "Wu", "Kim", "under", "K47B", "4711"]
    assert all(got[k].spans == "" for k, _ in rows[4:])


def test_sanitise_overlaps_and_columns(spark):
    base = fixtures.awkward(spark)
    extra = spark.createDataFrame([(100, "call +4111 1111 1111 1111 or a@b.co", "en", None, 5, *fixtures.EXTRA)], fixtures.SCHEMA)
    docs = base.unionByName(extra)
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, by.values())) == docs.count()
    assert by[100][0].text == "call <CARD> or <EMAIL>" or by[100][0].text == "call <PHONE> or <EMAIL>" or by[100][0].text == "call +<CARD> or <EMAIL>"
    assert by[4][0].text is None and by[3][0].text == "" and by[12][0].text == dict((r[0], r[1]) for r in fixtures.awkward_rows())[12]
    assert pii.sanitise(fixtures.empty(spark)).count() == 0 and pii.find(fixtures.empty(spark)).count() == 0
    assert pii.find(base).count() == len(fixtures.awkward_rows())


def test_term_share_formula(spark):
    rows = disclosure_rows()
    docs = fixtures.texts(spark, rows)
    found = pii.detected(docs, ["doc_id"], with_text=False)
    told = pii.disclosing_terms(docs, found, pii.base_spans(found), disclosure=0.0).collect()
    shares = sorted({round(r.share, 6) for r in told}, reverse=True)
    assert shares == [1.0, 0.5]
