"""Byte-level BPE as a streaming transducer with bounded lookahead.

Text goes in by chunks and token ids come out as soon as no later byte can change
them.  The bound comes from the merge list itself (:func:`sufficient_lookahead`),
so memory is constant in the length of a text, also where a text is one single word.
Decoding is an incremental byte-to-text state machine.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame

from terrapanel.llm.common import TEXT_BATCH_ROWS, batches, map_batches, whole_text, worker_cache

#: The split pattern of the public byte-level tokenizer, as its file's description states it.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RUNS = {"space": r"\s*", "letters": r"\p{L}*", "numbers": r"\p{N}*", "others": r"[^\s\p{L}\p{N}]*"}

#: Characters fed at once, and the longest word that is merged in one piece.
SLICE_CHARS = 1 << 16
WORD_BYTES = 1 << 12
#: Words whose tokens a worker remembers, in each of two generations.
CACHED_WORDS = 600_000


def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token boundary that decide it, whatever follows them.

    Apply the merges rule by rule, in order, to two texts that agree up to some byte.  Their
    tokens agree up to a frontier.  A rule (u, v) moves the frontier left, by the length of u,
    only if u ends at it and v starts at it in one of the two; and the rule s = (u', v') after
    it only if v' starts where uv does, so that one of v' and uv begins with the other.  The
    longest such chain of rules in rank order bounds how far a difference travels.
    """
    by_word: dict[bytes, int] = {}
    by_prefix: dict[bytes, int] = {}
    longest = 1
    for u, v in merges:
        w = u + v
        reach = max(len(v), by_prefix.get(v, 0), *(by_word.get(v[:k], 0) for k in range(1, len(v) + 1))) + len(u)
        by_word[w] = max(by_word.get(w, 0), reach)
        for k in range(1, len(w) + 1):
            if by_prefix.get(w[:k], 0) < reach:
                by_prefix[w[:k]] = reach
        longest = max(longest, reach)
    return longest


class MergeTable:
    """Ranks, token bytes and special tokens of a tokenizer file's JSON."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, pre, dec = spec["model"], spec["pre_tokenizer"], spec["decoder"]
        plain = (pre["type"], dec["type"], model["type"], spec["normalizer"], pre["add_prefix_space"], pre["use_regex"])
        if plain != ("ByteLevel", "ByteLevel", "BPE", None, False, True) or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are read")
        of = byte_characters()
        raw = {token: bytes(of[c] for c in token) for token in model["vocab"]}
        ids = {raw[token]: i for token, i in model["vocab"].items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(raw[a], raw[b]) for a, b in pairs]
        made = {bytes([b]) for b in range(256)}
        for u, v in merges:  # what rule-by-rule application, and so the lookahead, rests on
            if u not in made or v not in made or u + v in made:
                raise ValueError("the merge list is not proper: a rule uses a token that a later rule makes")
            made.add(u + v)
        self.single = [ids[bytes([b])] for b in range(256)]
        self.pair_rank = {(ids[u], ids[v]): r for r, (u, v) in enumerate(merges)}
        self.made = [ids[u + v] for u, v in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(*ids.values(), *self.special.values())
        self.token = [b""] * size
        for t, i in ids.items():
            self.token[i] = t
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.lookahead = sufficient_lookahead(merges)

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one word: the lowest-ranked pair first, leftmost among equals."""
        single, pair_rank = self.single, self.pair_rank
        ids = [single[b] for b in data]
        if len(ids) <= 64:
            never = len(self.made)
            ranks = [pair_rank.get(p, never) for p in zip(ids, ids[1:], strict=False)]
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                k = ranks.index(best)
                ids[k : k + 2] = [self.made[best]]
                del ranks[k]
                if k:
                    ranks[k - 1] = pair_rank.get((ids[k - 1], ids[k]), never)
                if k < len(ranks):
                    ranks[k] = pair_rank.get((ids[k], ids[k + 1]), never)
            return ids
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(pair_rank[p], k, p) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in pair_rank]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            j = after[k]
            if ids[k] is None or j < 0 or (ids[k], ids[j]) != pair:
                continue
            ids[k], ids[j] = self.made[pair_rank[pair]], None
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (p := (ids[a], ids[b])) in pair_rank:
                    heapq.heappush(heap, (pair_rank[p], a, p))
        return [i for i in ids if i is not None]


class Uncut(Exception):
    """A piece between two spaces ends in white space, so the text can't be cut there."""


class WordCache(dict):
    """Text between two spaces -> token ids of a space and that text.

    Two generations: when the young one is full it becomes the old one, so frequent words stay
    and memory stays bounded.
    """

    def __init__(self, table: MergeTable):
        import regex

        super().__init__()
        self.table, self.old, self.split = table, {}, regex.compile(SPLIT_PATTERN)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            if not piece or piece[-1].isspace():
                raise Uncut
            # Plain Latin words, bare or before a mark, are by far the most frequent; the pattern cuts all others.
            if piece.isalpha() and max(piece) < "\u0250":
                ids = tuple(self.table.merge((" " + piece).encode())) if len(piece) < 1000 else tuple(self.word(" " + piece))
            elif piece[-1] in ".,!?:;" and piece[:-1].isalpha() and max(piece) < "\u0250":
                ids = self[piece[:-1]] + tuple(self.word(piece[-1]))
            else:
                words = self.split.findall(" " + piece)
                ids = tuple(i for w in words for i in (self[w[1:]] if w != " " + piece and w[0] == " " < w[1:2] else self.word(w)))
        if len(piece) <= WORD_BYTES:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def word(self, word: str) -> list[int]:
        data = word.encode()
        if len(data) <= WORD_BYTES:
            return self.table.merge(data)
        run = RunMerger(self.table)
        return run.feed(data) + run.finish()

    def text(self, text: str) -> list[int]:
        """A text that no word of the pattern crosses at either end."""
        first, *pieces = text.split(" ")
        if not first or not first[-1].isspace():
            try:
                ids = [i for w in self.split.findall(first) for i in self.word(w)]
                ids.extend(chain.from_iterable(map(self.__getitem__, pieces)))
                return ids
            except Uncut:
                pass
        return [i for w in self.split.findall(text) for i in (self[w[1:]] if w[0] == " " and len(w) > 1 and not w.isspace() else self.word(w))]


class RunMerger:
    """Tokens of one word that arrives in pieces; emits a token once the lookahead behind it is full."""

    def __init__(self, table: MergeTable):
        self.table, self.data = table, b""

    def feed(self, data: bytes) -> list[int]:
        self.data += data
        final = []
        while len(self.data) >= WORD_BYTES + self.table.lookahead:
            window = self.data[: WORD_BYTES + self.table.lookahead]
            done = 0
            for i in self.table.merge(window):
                end = done + len(self.table.token[i])
                if end > WORD_BYTES:
                    break
                done = end
                final.append(i)
            # A token boundary splits the merges: what follows it is merged as if it stood alone.
            self.data = self.data[done:]
        return final

    def finish(self) -> list[int]:
        ids = self.table.merge(self.data) if self.data else []
        self.data = b""
        return ids


class Encoder:
    """``feed`` text chunks, take the ids that are final; ``finish`` gives the rest."""

    def __init__(self, table: MergeTable, cache: WordCache | None = None):
        import regex

        self.table = table
        self.cache = cache if cache is not None else WordCache(table)
        self.runs = {k: regex.compile(v) for k, v in _RUNS.items()}
        self.special = regex.compile("|".join(map(regex.escape, table.special)) or r"(?!)")
        starts = {s[:k] for s in table.special for k in range(1, len(s))}
        self.partial = regex.compile("(?:" + ("|".join(map(regex.escape, sorted(starts, key=len, reverse=True))) or r"(?!)") + r")\Z")
        self.longest = max(map(len, table.special), default=0)
        self.held = self.text = self.space = ""
        self.run: tuple[RunMerger, str] | None = None

    def feed(self, chunk: str) -> list[int]:
        buffer, self.held = self.held + chunk, ""
        ids, at = [], 0
        for m in self.special.finditer(buffer):
            ids += self._ordinary(buffer[at : m.start()], last=True)
            ids.append(self.table.special[m[0]])
            at = m.end()
        rest = buffer[at:] if at else buffer
        if m := self.partial.search(rest, max(0, len(rest) - self.longest)):
            rest, self.held = rest[: m.start()], rest[m.start() :]
        return ids + self._ordinary(rest, last=False)

    def finish(self) -> list[int]:
        rest, self.held = self.held, ""
        return self._ordinary(rest, last=True)

    def _ordinary(self, chunk: str, last: bool) -> list[int]:
        """Ids of text without special tokens, as far as they are final."""
        buffer, self.text = self.text + chunk, ""
        ids: list[int] = []
        if self.run:
            merger, kind = self.run
            end = self.runs[kind].match(buffer).end()
            run, buffer = self.space + buffer[:end], buffer[end:]
            self.space = ""
            if kind == "space" and not (last and not buffer):  # its last character may belong to the next word
                self.space, run = run[-1:], run[:-1]
            ids += merger.feed(run.encode())
            if not buffer and not last:
                return ids
            ids += merger.finish()
            buffer, self.space, self.run = self.space + buffer, "", None
        if last:
            return ids + self.cache.text(buffer) if buffer else ids
        cut = buffer.rfind(" ")
        if cut > 0 and not buffer[cut - 1].isspace():  # no word crosses the place before such a space
            ids += self.cache.text(buffer[:cut])
            buffer = buffer[cut:]
        if len(buffer) <= WORD_BYTES:
            self.text = buffer
            return ids
        # No space for long: all words but the last two are final, and a longer one goes on as a run.
        words = self.cache.split.findall(buffer)
        tail = words[-2:]
        del words[-2:]
        long = len(tail[-1]) > WORD_BYTES
        for w in words + tail[:-1] * long:
            ids += self.cache.word(w)
        if long:
            ids += self._start_run(tail[-1])
        else:
            self.text = "".join(tail)
        return ids

    def _start_run(self, word: str) -> list[int]:
        kind = next(k for k, r in self.runs.items() if r.match(word, word[0] == " " and k != "space").end() == len(word))
        if kind == "space":
            word, self.space = word[:-1], word[-1]
        self.run = RunMerger(self.table), kind
        return self.run[0].feed(word.encode())


def tokens(encoder: Encoder, text: str) -> Iterator[list[int]]:
    """The ids of a text, list by list, as they become final."""
    for at in range(0, len(text), SLICE_CHARS):
        yield encoder.feed(text[at : at + SLICE_CHARS])
    yield encoder.finish()


class Decoder:
    """Ids to text; bytes of an unfinished character wait for the next ids."""

    def __init__(self, table: MergeTable):
        self.token = table.token
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.token.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _table(text: str) -> tuple[MergeTable, WordCache]:
    key = hashlib.sha256(text.encode()).hexdigest()

    def build() -> tuple[MergeTable, WordCache]:
        table = MergeTable(text)
        return table, WordCache(table)

    return worker_cache(f"bpe-{key}", build)


def round_trip(texts: DataFrame, tokenizer_path: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns``, n_tokens, ids_sha256, decoded_sha256 of each row's whole ``text`` (null: empty).

    One pass without a shuffle.  The file is read on the driver and broadcast: its size is that
    of one vocabulary, a few MB whatever the corpus.
    """
    spark = texts.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    kept = [texts.schema[c] for c in columns]
    rows = texts.select(*columns, whole_text().alias("_text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, cache = _table(shared.value)
        names = [b"%d" % i for i in range(len(table.token))]
        for frame in batches(frames, TEXT_BATCH_ROWS):
            n_tokens, ids_hash, text_hash = [], [], []
            for text in frame["_text"]:
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                encoder, decoder = Encoder(table, cache), Decoder(table)
                for ids in tokens(encoder, text):
                    if ids:
                        ids_sha.update(b"," * bool(n) + b",".join(map(names.__getitem__, ids)))
                        text_sha.update(decoder.feed(ids).encode())
                        n += len(ids)
                text_sha.update(decoder.finish().encode())
                n_tokens.append(n)
                ids_hash.append(ids_sha.hexdigest())
                text_hash.append(text_sha.hexdigest())
            out = frame[list(columns)].copy()
            out["n_tokens"], out["ids_sha256"], out["decoded_sha256"] = n_tokens, ids_hash, text_hash
            yield out

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in kept)
    return map_batches(rows, run, f"{schema}, n_tokens long, ids_sha256 string, decoded_sha256 string")
