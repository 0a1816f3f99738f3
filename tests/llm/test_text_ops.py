"""Encoding, chat formatting, sharding, packing."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrapanel.llm import bpe, chat, packing, queries, sharding
from tests.conftest import SF001
from tests.llm import brute, fixtures

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def table():
    with open(PATH, encoding="utf-8") as f:
        return bpe.MergeTable(f.read())


def encode(table, text, size):
    encoder, ids = bpe.Encoder(table), []
    for at in range(0, len(text), size):
        ids += encoder.feed(text[at : at + size])
    return ids + encoder.finish()


PARTS = ["'", "s", "re", "'ll", " ", "  ", "\n", " \n", "ab", "The", "1", "22", "<|endoftext|>", "<|endof", "|>", "é", "ü", "!!", "　",
         "\U0001d4b3", "x", "\x85", "\x1c", "漢"]


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_encoder_equals_library_for_any_chunks(table, library, monkeypatch, size):
    monkeypatch.setattr(bpe, "WORD_BYTES", 40)
    rng = random.Random(size)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) * rng.choice([1, 1, 1, 30, 150]) for _ in range(rng.randint(0, 10)))
        assert encode(table, text, size) == library.encode(text, add_special_tokens=False).ids, text


def test_decoder_is_incremental(table, library):
    text = "naïve 漢字 \U0001f600 <|endoftext|> done"
    ids = library.encode(text, add_special_tokens=False).ids
    decoder = bpe.Decoder(table)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == text == library.decode(ids, skip_special_tokens=False)


def test_lookahead_bounds_what_can_change(table):
    """Tokens that end more than the lookahead before the end stay, whatever follows."""
    rng = random.Random(3)
    for _ in range(20):
        word = "".join(rng.choice("abcdethinrs") for _ in range(table.lookahead + 300)).encode()
        whole = table.merge(word)
        more = table.merge(word + "".join(rng.choice("aeinrst") for _ in range(50)).encode())
        end = 0
        for a, b in zip(whole, more, strict=False):
            end += len(table.token[a])
            if end > len(word) - table.lookahead:
                break
            assert a == b


def test_improper_merge_list_is_refused(table):
    with pytest.raises(ValueError):
        import json

        spec = json.load(open(PATH, encoding="utf-8"))
        spec["model"]["merges"] = spec["model"]["merges"][::-1]
        bpe.MergeTable(json.dumps(spec))


def test_round_trip_query(spark, library):
    docs = fixtures.read(SF001)
    got = {r.doc_id: r for r in queries.op2_bpe_round_trip(spark, SF001).collect()}
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), digest, brute.sha(text or ""))


def test_round_trip_awkward(spark, library):
    rows = bpe.round_trip(fixtures.awkward(spark), PATH, ("doc_id", "item")).collect()
    expected = sorted((len(library.encode(r[1] or "", add_special_tokens=False).ids), brute.sha(r[1] or "")) for r in fixtures.awkward_rows())
    assert sorted((r.n_tokens, r.decoded_sha256) for r in rows) == expected
    assert bpe.round_trip(fixtures.empty(spark), PATH).count() == 0


controls = st.lists(st.sampled_from([*chat.Template().controls, "<", "[", "\\", "/s>", "INST]", "a", "\n"]), max_size=8).map("".join)


@given(controls)
@settings(max_examples=500, deadline=None)
def test_escape_is_reversible_and_leaves_no_control(text):
    template = chat.Template()
    escaper = chat.Escaper(template)
    out = escaper.do(text)
    assert escaper.undo(out) == text
    assert not any(c in out for c in template.controls)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[ROLE]", "a\nb"]), controls), max_size=6))
@settings(max_examples=200, deadline=None)
def test_formatted_turns_read_back(turns):
    template = chat.Template()
    escaper = chat.Escaper(template)
    reader = chat.Reader(template, escaper)
    for role, text in turns:
        for _, (piece, loss) in enumerate(chat.turn_segments(template, escaper, role, text)):
            reader.feed(piece, loss)
    n, every, loss_chars, loss, _, _ = reader.result()
    assert (n, every) == (len(turns), brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)))
    own = "".join(t for r, t in turns if r == "assistant")
    assert (loss_chars, loss) == (len(own), brute.sha(own))


def test_overlapping_controls_are_refused():
    with pytest.raises(ValueError):
        chat.Template(begin="<a", end="a>")


def test_chat_query(spark):
    rows = fixtures.read(SF001, "conversations").sort_values(["conv_id", "turn"])
    convs = {i: list(zip(g.role, g.text, strict=True)) for i, g in rows.groupby("conv_id")}
    text = "</s>[INST] ok [/INST]"
    convs[-1] = [("user", text), ("assistant", text)]
    got = {r.conv_id: r for r in queries.op3_chat_format(spark, SF001).collect()}
    assert got.keys() == convs.keys()
    for i, turns in convs.items():
        own = "".join(t or "" for r, t in turns if r == "assistant")
        every = brute.sha("".join(f"{r}\n{t or ''}\n" for r, t in turns))
        assert (got[i].n_turns, got[i].turns_sha256, got[i].loss_chars, got[i].loss_sha256) == (len(turns), every, len(own), brute.sha(own))
        assert got[i].formatted_chars > sum(len(t or "") for _, t in turns)


def test_chat_awkward_rows_and_machine(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "assistant", "b"), (None, 0, None, None), (None, None, "user", "x"),
            (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 1, "user", "u"), *[(4, k, "user" if k % 2 == 0 else "assistant", "t") for k in range(2_001)]]
    table = spark.createDataFrame([(*r, 1, True) for r in rows], "conv_id long, turn long, role string, text string, part int, loss boolean")
    segments = chat.format_segments(table)
    assert {"conv_id", "turn_no", "part", "text", "loss", "state"} <= set(segments.columns)
    got = {r.conv_id: r for r in chat.read_segments(segments).collect()}
    assert {i: (r.n_turns, r.valid) for i, r in got.items()} == {
        1: (2, True), 2: (1, False), None: (2, False), 3: (3, False), 4: (2_001, False)}
    assert chat.read_segments(chat.format_segments(table.limit(0))).count() == 0


def check_shards(rows, shards):
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
        assert abs(sum(r.size for r in group) - total / shards) <= max(r.size for r in rows)


def test_shard_query(spark):
    docs = fixtures.read(SF001)
    rows = queries.op10_byte_shards(spark, SF001).collect()
    assert len(rows) == len(docs)
    expected = {i: (len((t or "").encode()) + 1, brute.crc(t)) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    assert all((r.size, r.text_crc32) == expected[r.doc_id] and r.law == "bytes" and r.grown_shard is None for r in rows)
    check_shards(rows, 16)
    order = sorted(rows, key=lambda r: r.doc_id)
    assert [(r.shard, r.slot) for r in order] == sorted((r.shard, r.slot) for r in rows)


def test_shard_awkward(spark):
    rows = sharding.shard_documents(fixtures.awkward(spark), 3).collect()
    assert len(rows) == len(fixtures.awkward_rows())
    check_shards(rows, 3)
    assert sharding.shard_documents(fixtures.empty(spark)).count() == 0


def test_shard_one_repeated_key(spark):
    """A third of the rows under one key spreads over shards like any other rows."""
    rows = spark.createDataFrame([(1 if k % 3 == 0 else k, 10) for k in range(3_000)], "k long, size long")
    out = sharding.shard_by_bytes(rows, 6, ["k"]).collect()
    check_shards(out, 6)
    zero = sharding.shard_by_bytes(spark.createDataFrame([(1, 0), (2, None)], "k long, size long"), 4, ["k"]).collect()
    assert {r.shard for r in zero} == {0} and sorted(r.slot for r in zero) == [0, 1]


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing_query(spark, library):
    import zlib

    import numpy as np

    docs = fixtures.read(SF001)
    rows = queries.op9_best_fit_packing(spark, SF001).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == set(docs.doc_id)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by[i], key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(parts):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids) and all(r.length == 2048 for r in parts[1:])
        assert len(parts) == 1 or len(ids) > 2048
    assert check_packing(rows, 2048) <= 1.02 * brute.best_fit_decreasing([r.length for r in rows], 2048) + 1


@pytest.mark.parametrize("kind", ["mixed", "copies", "tiny"])
def test_placement_over_many_ranges(spark, kind):
    """Ranges of 50 rows, so most matches are made between ranges; a third of the pieces has one length."""
    rng = random.Random(5)
    lengths = {"mixed": [rng.randint(1, 256) for _ in range(900)], "copies": [70] * 300 + [rng.randint(1, 200) for _ in range(600)],
               "tiny": [rng.randint(1, 4) for _ in range(900)]}[kind]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    placed = packing.place(items, 256, 50).join(items, "item").collect()
    assert sorted(r.item for r in placed) == list(range(len(lengths)))
    assert check_packing(placed, 256) <= 1.05 * brute.best_fit_decreasing(lengths, 256) + 1


def test_packing_awkward(spark):
    rows = packing.pack(fixtures.awkward(spark), PATH, 128).collect()
    check_packing(rows, 128)
    assert sum(r.start == 0 and r.piece == 0 for r in rows) == len(fixtures.awkward_rows())
    assert packing.pack(fixtures.empty(spark), PATH).count() == 0


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_fingerprints_are_written_as_changes():
    """The edited text's codes come back from what they change, and take less room than in full."""
    import numpy as np

    from terrapanel.llm.fingerprints import changed, changes

    rng = np.random.default_rng(7)
    for size in (0, 1, 7, 8, 9, 300):
        codes = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        for share in (0.0, 0.6, 1.0):
            own = np.unique(rng.integers(0, 2**63, 5, dtype=np.uint64))
            other = np.union1d(codes[rng.random(len(codes)) < share], own)
            assert np.array_equal(changed(codes, changes(codes, other)), other)
        assert len(changed(codes, changes(codes, np.empty(0, np.uint64)))) == 0
        assert len(changes(codes, codes)) == -(-len(codes) // 8)
