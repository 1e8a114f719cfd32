"""Byte-level BPE: speculate with the longest match, verify pairs, merge only what fails.

Texts are split into words by the tokenizer's own pattern. New words of a batch are
encoded together. Greedy longest match proposes tokens. A proposal is the word's encoding
exactly when every adjacent pair of its tokens stands alone, i.e. the pair's bytes encode to just
that pair; this is tested for all pairs of all words at once, against a sorted table of known
pairs, and pairs not met before are settled by merging their few bytes. Words with a failing pair are merged
exactly. Words met again are kept in a table of bounded size, which is emptied when it is full.

The vocabulary is read from the tokenizer's file (a parameter, the path on the executors). Strings of
added tokens are cut out of a text first, the leftmost and longest first, as the file's library does.

Cases: a null text is empty and has no tokens, its digests are those of an empty string; very long
texts and words are encoded whole; repeated rows encode alike; an empty table gives an empty result; columns in
``keep`` pass unchanged. Decoding of broken UTF-8 puts U+FFFD as Python's "replace" does.
"""

from __future__ import annotations

import heapq
import json
import sys
from hashlib import sha256
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.shingles import TOKENIZERS, release

#: Words kept in a process's table, an entry of some 350 bytes each. A word is kept when it is new a second time, as far
#: as a table of marks tells.
KNOWN_WORDS = 250_000
MARKS = 1 << 22
#: Longer words are encoded but not kept.
KNOWN_LENGTH = 64
#: Failing words up to this length are merged together, longer ones one by one.
TOGETHER = 32
#: Characters of text encoded together, and texts turned into strings at a time.
BATCH_CHARS = 1 << 21
PART = 128
#: Known pairs of tokens; beyond it the table starts anew.
KNOWN_PAIRS = 1 << 20
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """One tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _letters()
        self.id_of = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.rank = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = (self.id_of[bytes(letters[c] for c in part)] for part in (left, right))
            self.rank[a, b] = rank, self.id_of[self.bytes_of[a] + self.bytes_of[b]]
        keys = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in self.rank.items())
        self.merge_keys, self.merge_ranks, self.merge_ids = (np.array(x, np.int64) for x in zip(*keys))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.words = regex.compile(PATTERN)
        marks = sorted(self.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.pairs = np.zeros(0, np.int64)
        self.pair_fits = np.zeros(0, bool)
        self.known: dict[str, tuple[str, bytes, int]] = {}
        self.marks_seen = bytearray(MARKS)
        self.failed = self.proposed = 0
        # Proposals consist of tokens that are reached by merging their own bytes.
        self.alone = {b: i for b, i in self.id_of.items() if self.merge(b) == [i]}
        self.longest_from: dict[bytes, int] = {}
        for token in self.alone:
            start = token[:2]
            self.longest_from[start] = max(self.longest_from.get(start, 1), len(token))

    def merge(self, word: bytes) -> list[int]:
        """Exact encoding: the pair of lowest rank merges first, the leftmost of equals."""
        ids = [self.byte_ids[b] for b in word]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        heap = [(*self.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
        heap = [(r, i, new) for r, new, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self.rank.get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (ids[left], ids[right]) in self.rank:
                    r, n = self.rank[ids[left], ids[right]]
                    heapq.heappush(heap, (r, left, n))
        return [i for i in ids if i >= 0]

    def merge_together(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words: in each round every word does its first merge of lowest rank."""
        none = np.int64(1) << 62
        length = np.array([len(w) for w in words], np.int64)
        ids = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), length)
        done_ids, done_owner = [], []
        while len(ids):
            key = np.append((ids[:-1] << 32) | ids[1:], 0)
            at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
            joined = self.merge_keys[at] == key
            joined[:-1] &= owner[1:] == owner[:-1]
            joined[-1] = False
            # Rank above place: the minimum is the lowest rank, the leftmost of equals.
            order = np.where(joined, (self.merge_ranks[at] << 32) | np.arange(len(ids)), none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(order, starts)
            ended = np.repeat(least == none, np.diff(np.append(starts, len(ids))))
            done_ids.append(ids[ended])
            done_owner.append(owner[ended])
            left = least[least != none] & 0xFFFFFFFF
            ids[left] = self.merge_ids[at[left]]
            kept = ~ended
            kept[left + 1] = False
            ids, owner = ids[kept], owner[kept]
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids, cuts = np.concatenate(done_ids)[order], np.cumsum(np.bincount(owner, minlength=len(words)))
        return [part.tolist() for part in np.split(ids, cuts[:-1])]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left, of tokens that encode to themselves."""
        found, at, end = [], 0, len(word)
        while at < end:
            for stop in range(min(end, at + self.longest_from.get(word[at:at + 2], 1)), at, -1):
                token = self.alone.get(word[at:stop])
                if token is not None:
                    found.append(token)
                    at = stop
                    break
        return found

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of adjacent tokens stands alone."""
        key = (left << 32) | right
        wanted, place = np.unique(key, return_inverse=True)
        at = np.searchsorted(self.pairs, wanted)
        new = np.ones(len(wanted), bool)
        inside = at < len(self.pairs)
        new[inside] = self.pairs[at[inside]] != wanted[inside]
        if new.any():
            fresh = wanted[new]
            fits = []
            for pair in fresh.tolist():
                a, b = pair >> 32, pair & 0xFFFFFFFF
                fits.append(self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b])
            pairs = np.concatenate([self.pairs, fresh])
            order = np.argsort(pairs)
            pairs, all_fits = pairs[order], np.concatenate([self.pair_fits, np.array(fits, bool)])[order]
            self.pairs, self.pair_fits = (pairs, all_fits) if len(pairs) <= KNOWN_PAIRS else (
                np.zeros(0, np.int64), np.zeros(0, bool))
            return all_fits[np.searchsorted(pairs, wanted)][place]
        return self.pair_fits[np.searchsorted(self.pairs, wanted)][place]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Encodings of a batch of words."""
        found = [self.propose(w) for w in words]
        length = np.array([len(f) for f in found], np.int64)
        ids = np.array([i for f in found for i in f], np.int64)
        owner = np.repeat(np.arange(len(found)), length)
        if len(ids) > 1:
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            bad = inner[~self._fit(ids[inner], ids[inner + 1])]
            failing = np.unique(owner[bad]).tolist()
            self.failed += len(failing)
            short = [i for i in failing if len(words[i]) <= TOGETHER]
            if short:
                for i, merged in zip(short, self.merge_together([words[i] for i in short])):
                    found[i] = merged
            for i in failing:
                if len(words[i]) > TOGETHER:
                    found[i] = self.merge(words[i])
        self.proposed += len(words)
        return found

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order, added tokens whole."""
        if self.marks is None or not any(t in text for t in self.added):
            return self.words.findall(text)
        found = []
        for i, part in enumerate(self.marks.split(text)):
            found += [part] if i % 2 else self.words.findall(part)
        return found

    def learn(self, pieces: set[str]) -> dict[str, tuple[str, bytes, int]]:
        """Ids joined by commas, their bytes and number, for words not known yet."""
        plain = [p for p in pieces if p not in self.added]
        rows = {
            p: (",".join(map(str, ids)), self.decode(ids), len(ids))
            for p, ids in zip(plain, self.encode_words([p.encode() for p in plain]))
        }
        return rows | {p: (str(i), p.encode(), 1) for p, i in self.added.items() if p in pieces}

    def encode(self, text: str) -> list[int]:
        pieces = self.pieces(text)
        rows = self.learn(set(pieces))
        return [int(i) for p in pieces for i in rows[p][0].split(",")]

    def digest_texts(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, digest of the ids and of the decoded text, for each text."""
        split = [self.pieces(t) for t in texts]
        new = set().union(*split) - self.known.keys()
        rows = self.learn(new) if new else {}
        kept, seen = {}, self.marks_seen
        for piece, row in rows.items():
            mark = hash(piece) & (MARKS - 1)
            if seen[mark] and len(piece) <= KNOWN_LENGTH:
                kept[piece] = row
            seen[mark] = 1
        table = self.known | rows
        if len(self.known) + len(kept) > KNOWN_WORDS:
            self.known, self.marks_seen = {}, bytearray(MARKS)
        self.known |= kept
        out = []
        for pieces in split:
            ids, decoded, count = zip(*[table[p] for p in pieces]) if pieces else ((), (), ())
            text = b"".join(decoded).decode("utf-8", "replace")
            out.append((
                sum(count), sha256(",".join(ids).encode()).hexdigest(), sha256(text.encode()).hexdigest()))
        return out


def tokenizer(path: str) -> ByteBPE:
    """The tokenizer of a file, kept as long as the process lives.

    Functions shipped by value have no module that outlasts a task, so the table is kept in one of its own. Operators that
    need the memory drop it (``make_room``).
    """
    loaded = sys.modules.setdefault(TOKENIZERS, ModuleType(TOKENIZERS)).__dict__
    if path not in loaded:
        loaded[path] = ByteBPE(path)
    return loaded[path]


def _digester(path: str):
    def digest(batches):
        bpe = tokenizer(path)
        for batch in batches:
            found, held, n = [], [], 0
            for start in range(0, batch.num_rows, PART):
                for text in batch.column(0).slice(start, PART).to_pylist():
                    held.append(text or "")
                    n += len(held[-1])
                    if n >= BATCH_CHARS:
                        found += bpe.digest_texts(held)
                        held, n = [], 0
            if held:
                found += bpe.digest_texts(held)
            n_tokens, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[1:], pa.array(n_tokens, pa.int64()), pa.array(ids, pa.string()),
                pa.array(decoded, pa.string()),
            ], [*batch.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256"])
            release()

    return digest


def _encoder(path: str):
    def encode(batches):
        bpe = tokenizer(path)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(0).fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names[1:], "ids"])

    return encode


def _decoder(path: str):
    def decode(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(i).decode("utf-8", "replace") for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())], [*batch.schema.names[1:], "decoded"])

    return decode


def _mapped(df: DataFrame, name: str, keep: tuple[str, ...], function, added: str, given: str) -> DataFrame:
    column = F.col(name).cast("string") if given == "string" else F.coalesce(F.col(name), F.array()).cast(given)
    rows = df.select(column.alias("_given"), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_given").schema)
    return rows.mapInArrow(function, kept + added)


def token_digests(documents: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_tokens, ids_sha256 and decoded_sha256 of each whole text; no shuffle."""
    return _mapped(documents, "text", keep, _digester(path),
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string", "string")


def encode(documents: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ids, an array of the token ids of each text."""
    return _mapped(documents, "text", keep, _encoder(path), "ids array<int>", "string")


def decode(encoded: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and decoded, the text of each array ``ids``."""
    return _mapped(encoded, "ids", keep, _decoder(path), "decoded string", "array<int>")
