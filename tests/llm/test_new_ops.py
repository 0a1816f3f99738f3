"""Prefix trie, vectors and manifest against brute-force versions, with every awkward case."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from terrapanel.llm import trie, vectors
from terrapanel.llm.manifest import FIELDS, document_manifest
from terrapanel.llm.trie import prefix_trie
from terrapanel.llm.vectors import near_vectors
from tests.conftest import SF01
from tests.llm import fixtures


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Prefix trie

TURNS = "conv_id long, turn long, role string, text string, `key` string, path string, n long, least long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "k", None, 3, 4) for r in rows], TURNS)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute_trie(rows, rebuild):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + t[h:] if rebuild else t
    members, ends, children = {}, {}, {}
    for c, t in built.items():
        ends.setdefault(tuple(t), []).append(c)
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
            if d:
                children.setdefault(tuple(t[: d - 1]), set()).add(tuple(t[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, ())
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, ())), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items()), key=str)


def random_turns(seed, conversations, longest, words=2):
    rng, rows = random.Random(seed), []
    stems = [[rng.choice("abcé") * rng.randint(0, 3) for _ in range(longest)] for _ in range(3)]
    for c in range(conversations):
        stem, n, same = rng.choice(stems), rng.randint(1, longest), rng.randint(0, longest)
        for d in range(n):
            text = stem[d] if d < same else rng.choice("xy" * words)
            rows.append((c, d, "user" if d % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize(("conversations", "longest"), [(60, 5), (40, 70)])
def test_trie_equals_brute_force(spark, rebuild, conversations, longest):
    rows = random_turns(longest, conversations, longest)
    assert rows_of(prefix_trie(turns(spark, rows), rebuild)) == brute_trie(rows, rebuild)


@pytest.mark.parametrize("first", [1, 2])
def test_trie_with_short_stretches(spark, monkeypatch, first):
    monkeypatch.setattr(trie, "FIRST", first)
    rows = random_turns(5, 60, 20)
    assert rows_of(prefix_trie(turns(spark, rows), True)) == brute_trie(rows, True)


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_awkward(spark, rebuild):
    rows = [(1, 0, "user", "a"), (1, 1, None, None), (1, None, "system", "first"), (2, 0, "user", ""), (2, 0, "user", ""),
            (2, 0, "assistant", "tie"), (None, 0, "user", "no conversation"), (7, 5, "user", "é" * 20_000), (8, 5, "user", "é" * 20_000),
            (9, 0, "use", "ra"), (11, 0, "user", "a"), (2**40, 3, None, "x")]
    assert rows_of(prefix_trie(turns(spark, rows), rebuild)) == brute_trie(rows, rebuild)
    assert prefix_trie(turns(spark, rows).limit(0), rebuild).collect() == []


def test_trie_chain_of_prefixes(spark):
    """Each conversation goes on where another one ended: the deepest possible peeling."""
    rows = [(c, d, "user", str(d)) for c in range(40) for d in range(c + 1)]
    assert rows_of(prefix_trie(turns(spark, rows))) == brute_trie(rows, False)


# Vectors

VECTORS = "vec_id long, embedding array<float>, label int, `row` long, rep long, component long, `list` int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, 2, 3, 4) for i, v, label in rows], VECTORS)


def brute_links(rows, threshold=0.98):
    def usable(v):
        return v is not None and len(v) and None not in v and np.isfinite(np.array(v, "f4")).all() and np.any(np.array(v, "f4"))

    units = [np.array(v, "f4").astype(float) / np.linalg.norm(np.array(v, "f4").astype(float)) if usable(v) and label is not None else None for _, v, label in rows]
    n, part = [0] * len(rows), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            ok = units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
            if ok and units[a] @ units[b] >= threshold:
                n[a], n[b] = n[a] + 1, n[b] + 1
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [r[0] for r, p in zip(rows, part, strict=True) if p == part[k] and r[0] is not None]
        out.append((i, n[k], min(ids, default=None), i == min(ids, default=None)))
    return sorted(out, key=str)


def vector_rows(seed, n, dims=24, labels=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = rng.normal(size=dims)
        else:  # near copies on both sides of the threshold, of any length
            v = (centres[i % 6] + rng.normal(size=dims) * rng.choice([0.05, 0.14, 0.2])) * rng.uniform(0.1, 9)
        rows.append((i, v.tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    monkeypatch.setattr(vectors, "PER_LIST", 8)
    rows = vector_rows(1, 500)
    expected = brute_links(rows)
    assert max(r[1] for r in expected) > 10
    assert rows_of(near_vectors(table(spark, rows))) == expected


def test_vectors_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1, 0, 0], 1), (4, [2, 0, 0], 1), (4, [2, 0, 0], 1), (3, [1, 0, 0], 2), (2, [1, 0, 0], None), (1, None, 1), (0, [0, 0, 0], 1),
            (6, [1, None, 0], 1), (7, [1, nan, 0], 1), (8, [1, inf, 0], 1), (9, [], 1), (10, [1, 0], 1), (11, [1, 0], 1), (None, [1, 0.01, 0], 1),
            (None, [-1, 0, 0], 1), (None, [-1, 0, 0], 1), (12, [-0.0, 1, 0], 1), (13, [0, 1, 0], 1), (14, [1e30, 1e30, 0], 1), (15, [1e-40, 1e-40, 0], 1), (16, [1], 9)]
    got = rows_of(near_vectors(table(spark, rows)))
    expected = [(i, n, c, i == c) for i, n, c, _ in brute_links(rows)]
    assert got == expected
    assert near_vectors(table(spark, rows).limit(0)).collect() == []
    assert [tuple(r) for r in near_vectors(table(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


def test_vectors_recall_on_the_given_table(spark):
    whole = fixtures.read(SF01, "embeddings")
    rows = [(int(i), [float(x) for x in v], None if np.isnan(label) else int(label)) for i, v, label in zip(whole["vec_id"], whole["embedding"], whole["label"].astype(float), strict=True)]
    assert rows_of(near_vectors(spark.read.parquet(f"{SF01}/embeddings.parquet"))) == brute_links(rows)


# Manifest


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def field(value):
    return b"-" if value is None else b"%d:%s" % (len(str(value).encode()), str(value).encode())


def brute_manifest(rows):
    trees = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = claimed = sha(b"".join(map(field, (doc_id, source, lang, n_chars, text))))
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            claimed = sha(b"".join(map(field, (doc_id, source, lang, n_chars, lowered))))
        trees.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, claimed, doc_id))

    def levels(hashes):
        out = [hashes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def siblings(tree, i):
        for level in tree[:-1]:
            a = i // 16 * 16
            yield "".join(level[a:i]), "".join(level[i + 1 : a + 16])
            i //= 16

    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels([x[2] for x in sorted(trees[s])]) for s in names}
    top = levels([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (*_, leaf, claimed, doc_id) in enumerate(sorted(trees[s])):
            path, folded = [*siblings(built[s], i), *siblings(top, k)], claimed
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, built[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def test_manifest_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    expected = brute_manifest([tuple(r) for r in docs.select(*FIELDS).collect()])
    assert rows_of(document_manifest(docs)) == expected
    assert len({r[3] for r in expected}) == 1
    assert 0 < sum(not r[-1] for r in expected) < len(expected)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4_200])
def test_manifest_sizes(spark, n):
    """One source, and null, empty and single ones beside it; blocks of blocks of blocks at the largest size."""
    rows = [(i if i % 7 else None, "hot", None, i, f"Text {i}") for i in range(n)]
    for more in ([], [(1, None, "en", 1, "A"), (1, None, "en", 1, "A"), (2, "", None, None, None), (3, "Z", "", 0, "")]):
        docs = spark.createDataFrame([*rows, *more], "doc_id long, source string, lang string, n_chars long, text string")
        assert rows_of(document_manifest(docs)) == brute_manifest([*rows, *more])


def test_manifest_many_sources(spark):
    rows = [(i, f"s{i % 300}", "en", i, f"Text {i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(document_manifest(docs)) == brute_manifest(rows)


def test_manifest_awkward(spark):
    docs = fixtures.awkward(spark)
    assert rows_of(document_manifest(docs)) == brute_manifest([tuple(r) for r in docs.select(*FIELDS).collect()])
    assert document_manifest(fixtures.empty(spark)).collect() == []
