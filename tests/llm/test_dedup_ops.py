"""Substring dedup, near-duplicates, fingerprints."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.llm import fingerprints, graph, neardup, queries, substrings
from terrapanel.llm.common import exact_windows, materialise
from tests.conftest import SF001
from tests.llm import brute, fixtures


def random_texts(seed, n, vocabulary=6, longest=60):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh"[:vocabulary]) for _ in range(rng.randint(0, longest))) for _ in range(n // 3 + 1)]
    rows = []
    for i in range(n):
        text = rng.choice(pool) if rng.random() < 0.3 else " ".join(rng.choices(pool, k=2)) if rng.random() < 0.5 else fixtures.prose(rng.random(), 30, 9)
        rows.append((i * 397 % 5_000, text))
    return list(dict(rows).items())


def expect_removed(rows):
    return sorted((i, len(w), sum(g), brute.sha(" ".join(x for x, y in zip(w, g, strict=True) if not y)))
                  for (i, _), (w, g) in zip(rows, brute.removed_mask(rows), strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_random(spark, seed):
    rows = random_texts(seed, 150)
    got = substrings.remove_repeats(fixtures.texts(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expect_removed(rows)
    assert sum(r.n_removed for r in got) > 100


def test_substrings_query(spark):
    docs = fixtures.read(SF001)
    rows = list(zip(docs.doc_id, docs.text, strict=True))
    got = queries.op1_substring_dedup(spark, SF001).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expect_removed(rows)


def test_substrings_awkward(spark):
    rows = [((-(2**63) if r[0] is None else r[0]), r[1] or "") for r in fixtures.awkward_rows()]
    got = substrings.remove_repeats(fixtures.awkward(spark)).collect()
    back = [(-(2**63) if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got]
    assert sorted(back) == expect_removed(rows)
    assert substrings.remove_repeats(fixtures.empty(spark)).count() == 0


def test_substrings_text_keeps_layout_and_columns(spark):
    docs = fixtures.awkward(spark)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, by.values())) == len(fixtures.awkward_rows())
    assert by[4][0].text is None and by[7][0].text == "   \n\t "
    assert by[10][0].text == "start two " and by[9][0].text == "end one"
    assert by[8][0].text == by[8][1].text == fixtures.awkward_rows()[5][1]
    assert by[9][0].id == 7 and by[9][0].score == 0.5 and by[9][0].spans == "s"


def test_longest_repeats_doubles_until_none(spark):
    shared = fixtures.prose(7, 120)
    rows = [(1, shared), (2, "x " + shared), (3, " ".join(shared.split()[:30])), (4, fixtures.prose(8, 80)), (5, "short")]
    got = {r.doc_id: r.longest for r in substrings.longest_repeats(fixtures.texts(spark, rows)).collect()}
    assert got == {1: 104, 2: 104, 3: 26}
    assert substrings.longest_repeats(fixtures.empty(spark)).count() == 0


def test_substrings_hot_passage(spark):
    """One passage in every document: an entry a block, and all but the first lose it."""
    shared = fixtures.prose(9, 20)
    rows = [(i, f"{fixtures.prose(i + 50, 15)} {shared}") for i in range(400)]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(fixtures.texts(spark, rows)).collect()}
    assert got[0] == 0 and all(got[i] >= 20 for i in range(1, 400))


def test_exact_windows_never_collide():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 500)
    for n in (1, 2, 5):
        labels = exact_windows(ids, n)
        keys = [tuple(ids[k : k + n]) for k in range(len(ids) - n + 1)]
        assert len(set(zip(labels.tolist(), keys, strict=True))) == len(set(keys)) == len(set(labels.tolist()))
    large = np.arange(40_000)
    assert len(np.unique(exact_windows(large, 5))) == 40_000 - 4


def edited(rng, text, share):
    w = text.split()
    for k in range(len(w)):
        if rng.random() < share:
            w[k] = f"new{rng.randint(0, 10**6)}"
    return " ".join(w)


def near_rows(seed):
    """Chains of edits around the threshold, copies, a passage in many documents, short texts."""
    rng = random.Random(seed)
    rows, passage = [], fixtures.prose(seed + 900, 60)
    for g in range(12):
        text = fixtures.prose(seed * 100 + g, rng.randint(30, 150))
        for _ in range(rng.randint(1, 8)):
            rows.append(text)
            text = edited(rng, text, rng.choice([0, 0.01, 0.02, 0.04, 0.08]))
    rows += [f"{fixtures.prose(seed * 7 + k + 5000, 30)} {passage}" for k in range(40)]
    rows += ["", "a b", "A B", "a b c", None, "x y z w v", "X y Z w v"]
    rng.shuffle(rows)
    return [(i * 31 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("tile", [2048, 5])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    rows = near_rows(3 + tile)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(fixtures.texts(spark, rows)).collect()}
    assert got == brute.components(rows)


def test_near_duplicates_query(spark):
    docs = fixtures.read(SF001)
    expected = brute.components(list(zip(docs.doc_id, docs.text, strict=True)))
    got = queries.op4_near_duplicates(spark, SF001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_awkward(spark):
    got = neardup.near_duplicates(fixtures.awkward(spark)).collect()
    assert len(got) == len(fixtures.awkward_rows())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[3].kept and by[4].kept and by[7].kept and by[3].n_shingles == 0
    assert by[6].component_id == 5 and not by[6].kept
    # the row with a null doc_id takes the id of its component
    assert by[9].component_id == by[11].component_id == by[12].component_id == 9 and by[9].kept and not by[12].kept
    assert sorted((r.n_shingles > 0, r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles) == [(True, 9, False)]
    assert neardup.near_duplicates(fixtures.empty(spark)).count() == 0
    one = neardup.one_of_each(fixtures.awkward(spark))
    assert one.columns == fixtures.awkward(spark).columns
    assert one.where("doc_id = 8").count() == 1 and one.where("doc_id = 12").count() == 0
    assert neardup.one_of_each(fixtures.empty(spark)).count() == 0


def test_null_ids_join_nothing(spark):
    """Each row is a document: unrelated rows without an id, or with one id, stay apart."""
    a, b, c = (fixtures.prose(k, 60) for k in (71, 72, 73))
    rows = [(1, a), (2, a + " x"), (3, b), (4, b + " y"), (None, a + " z"), (None, b), (None, c), (9, c + " q"), (9, fixtures.prose(74, 60)),
            (None, fixtures.prose(75, 30)), (None, None), (3, b), (3, b)]
    got = sorted(neardup.near_duplicates(fixtures.texts(spark, rows)).collect(), key=str)
    expected = [(1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True), (3, 3, True), (4, 3, False), (9, 9, True), (9, 9, True),
                (None, 1, False), (None, 3, False), (None, 9, False), (None, None, True), (None, None, True)]
    assert sorted([(r.doc_id, r.component_id, r.kept) for r in got], key=str) == sorted(expected, key=str)


def test_one_of_each_keeps_user_columns(spark):
    names = ["row", "id", "order", "h1", "h2", "component_id", "_text_hash", "_row_key", "same"]
    rows = [(i, fixtures.prose(i // 2, 40), *[f"{c}{i}" for c in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    out = neardup.one_of_each(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect())) == [r for i, r in enumerate(rows) if i % 2 == 0]


def test_one_of_each_writes_a_text_once(spark, monkeypatch):
    """What stays in the shared folder is about as large as the documents, not twice."""
    written = []

    def size(df):
        return sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())

    def watched(df):
        out = materialise(df)
        written.append(size(out))
        return out

    rng = random.Random(17)
    rows = [(i, " ".join(f"{rng.getrandbits(48):x}" for _ in range(1500))) for i in range(200)]
    docs = materialise(fixtures.texts(spark, rows).repartition(4))
    monkeypatch.setattr(neardup, "materialise", watched)
    assert sorted((r.doc_id, r.text) for r in neardup.one_of_each(docs).collect()) == rows
    assert size(docs) < sum(written) < 1.5 * size(docs)


def test_one_of_each_keeps_a_row_of_every_group(spark):
    """Null and repeated doc_ids neither lose unrelated rows nor join unrelated groups."""
    awkward = [(r[0], r[1]) for r in fixtures.awkward_rows()]
    a, b = fixtures.prose(71, 60), fixtures.prose(72, 60)
    mixed = [(None, a), (None, b), (1, a + " x"), (2, b + " y"), (3, fixtures.prose(73, 40)), (3, fixtures.prose(74, 40)), (3, None), (None, None)]
    for rows in (awkward, mixed):
        groups: dict[int, list[int]] = {}
        for k, (_, component) in brute.components(list(enumerate(t for _, t in rows))).items():
            groups.setdefault(component, []).append(k)
        out = neardup.one_of_each(fixtures.texts(spark, rows)).collect()
        kept = [(r.doc_id, r.text) for r in out]
        assert len(kept) == len(groups)
        for members in groups.values():
            held = [rows[k] for k in members]
            least = min(held, key=lambda r: (r[0] is not None, r[0] or 0))[0]
            assert any(r in kept and r[0] == least for r in held), held


def test_radius_holds_for_the_enumerated_errors():
    """Any two signatures within the radius share a chunk with at most the allowed errors."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        apart = np.zeros(neardup.POSITIONS, bool)
        apart[rng.choice(neardup.POSITIONS, neardup.RADIUS, replace=False)] = True
        assert apart.reshape(neardup.CHUNKS, -1).sum(axis=1).min() <= neardup.ERRORS


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(7, 7), (500, 499)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, **{k: 1 for k in range(1, 60)}, 499: 499, 500: 499}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_query(spark):
    docs = fixtures.read(SF001).sort_values("doc_id", ascending=False)
    rows = list(zip(docs.doc_id, docs.text, strict=True))
    got = {r.doc_id: r for r in queries.op5_fingerprints(spark, SF001).collect()}
    near = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        new = text[: len(text) - n] + following[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(new))
        assert r.fingerprint == fingerprints.to_text(fingerprints.sketch(text))
        assert r.edited_fingerprint == fingerprints.to_text(fingerprints.sketch(new))
        a, b = brute.shingle_set(text), brute.shingle_set(new)
        if len(a) > 200:
            near.append(r.near_edited - len(a & b) / min(len(a), len(b)))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert abs(sum(near) / len(near)) < 0.03 and max(map(abs, near)) < 0.3


def test_fingerprints_without_reuse(spark):
    """More rows than one sample of the ranges, and no exchange is reused: each row once."""
    docs = spark.range(12_000).select((F.col("id") * 7919 % 100_003).alias("doc_id"), F.concat_ws(" ", *[F.hash("id", F.lit(k)) for k in range(7)]).alias("text"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = fingerprints.with_edited(docs).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert len(rows) == len({r.doc_id for r in rows}) == 12_000
    ordered = sorted(map(tuple, docs.collect()), reverse=True)
    texts = [t for _, t in ordered]
    shas = {r.doc_id: r.edited_sha256 for r in rows}
    for k, (i, t) in enumerate(ordered):
        following, cut = texts[(k + 1) % len(texts)], len(t) // 3
        assert shas[i] == hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()


def test_fingerprints_merge_and_compare():
    a, b = fixtures.prose(1, 2_000, 3_000), fixtures.prose(2, 100, 3_000)
    whole = fingerprints.sketch(f"{a} {b}")
    merged = fingerprints.merge(fingerprints.sketch(a), fingerprints.sketch(b))
    assert len(np.setdiff1d(merged, whole)) == 0 and len(np.setdiff1d(whole, merged)) <= 4
    assert fingerprints.containment(fingerprints.sketch(b), whole) == 1.0
    short = fingerprints.sketch("one two")
    assert len(short) == 1 and fingerprints.containment(short, fingerprints.sketch("one two")) == 1.0
    assert fingerprints.containment(fingerprints.sketch(""), short) == 0.0
    assert fingerprints.containment(fingerprints.sketch(""), fingerprints.sketch(" ")) == 1.0
    assert np.array_equal(fingerprints.from_text(fingerprints.to_text(whole)), whole)


def test_fingerprints_awkward(spark):
    got = fingerprints.with_edited(fixtures.awkward(spark)).collect()
    assert len(got) == len(fixtures.awkward_rows())
    of = {r[0]: r[1] for r in fixtures.awkward_rows()}
    nine = next(r for r in got if r.doc_id == 9)
    n = len(of[9]) // 3
    assert nine.edited_sha256 == brute.sha(of[9][: len(of[9]) - n] + of[8][:n])
    assert len({r.fingerprint for r in got if r.doc_id == 8}) == 1
    assert fingerprints.with_edited(fixtures.empty(spark)).count() == 0
    one = fingerprints.with_edited(fixtures.texts(spark, [(1, "abcdef")])).first()
    assert one.edited_sha256 == brute.sha("abcdab")
    plain = fingerprints.fingerprints(fixtures.awkward(spark), ["doc_id", "part"])
    assert plain.columns == ["doc_id", "part", "fingerprint"] and plain.count() == len(fixtures.awkward_rows())
