"""Packing: documents' tokens in sequences of several context sizes, without padding.

A document is its token ids and an end id. Method, in batches of a task's documents:

1. Cut: a document longer than the longest context gives full windows of it, and a rest.
2. Route: whole documents and rests go to the tier (1024, 512, 256, 128, 64) that just holds them.
3. Pack each tier, the longest first: its pieces, longest first, open windows of the tier's size, and each window's gap is
   filled with the longest pieces of shorter tiers that fit, an exact fit if there is one. A filled window is a sequence.
4. Windows that no piece fills exactly are laid end to end and cut at every longest context, which cuts a piece each;
   the incomplete last one is packed with the next batch. At a task's end it is cut at powers of two, so each of its sequences
   is full as well.
5. Balance: a step holds as many sequences of one size as make ``STEP_TOKENS``; a batch's sequences go to the open
   steps by attention cost (sum of squared piece lengths), the dearest first and to the cheapest step.

A piece goes with its ids, so nothing is joined or shuffled: one pass over the texts, in which a task holds one batch. Sequence and
step numbers carry the task's partition, so they are unique, and a task that runs again gives the same rows. Which
documents share a sequence follows the partitions of the input. A hot source, language or group of copies has no effect.

Ids are those of the tokenizer's file (a parameter, the path on the executors), in which ids of merged tokens must follow the
order of merges; added tokens in a text have their own ids. Very long texts are encoded in parts, cut before single spaces
between words, where the tokenizer's pattern always starts a new word.

Cases: a null or empty text is the end id alone; texts of any length are packed whole; repeated rows are documents of their
own; an empty table gives an empty result; columns in ``keep`` pass unchanged, whatever their values, but not under a name of this
operator's own columns.
"""

from __future__ import annotations

import heapq
import json
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.bpe import PATTERN, _letters
from tickloom.llm.shingles import release

CONTEXT = 1024
TIERS = (1024, 512, 256, 128, 64)
END = 0
#: Tokens packed together, and of one step.
BATCH_TOKENS = 1 << 21
STEP_TOKENS = 64 * CONTEXT
#: Characters of a text encoded at once, and texts turned into strings at a time.
PART_CHARS = 1 << 20
PART = 128
#: Bits for a task's own count in a sequence or step number.
_COUNT_BITS = 40
_FIELDS = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_id")
_TYPES = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_id bigint"

#: (document, start, length)
Piece = tuple[int, int, int]


def encoding(path: str):
    """The tokenizer of a file, kept as long as the process lives."""
    import tiktoken

    loaded = sys.modules.setdefault("_tickloom_encodings", ModuleType("_tickloom_encodings")).__dict__
    if path not in loaded:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [spec["model"]["vocab"]["".join(m)] for m in merges]
        if merged != sorted(merged):
            raise ValueError("ids of merged tokens must follow the order of merges")
        loaded[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return loaded[path]


def token_ids(text: str, tokenizer) -> np.ndarray:
    """Ids of a whole text and the end id."""
    parts, start = [], 0
    while start < len(text):
        stop = len(text)
        at = start + PART_CHARS
        while at < stop:
            at = text.find(" ", at)
            if at < 0:
                break
            if not text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace():
                stop = at
                break
            at += 1
        parts.append(tokenizer.encode_to_numpy(text[start:stop], allowed_special="all").astype("<u4"))
        start = stop
    return np.concatenate([*parts, np.array([END], "<u4")])


def _longest(stacks: list[list[Piece]], present: int, room: int) -> int:
    """The greatest length up to ``room`` of which a piece is left, 0 if none; ``present`` has a bit for each length."""
    return (present & ((2 << room) - 1)).bit_length() - 1 if present & ((2 << room) - 2) else 0


def pack_tiers(pieces: list[Piece]) -> tuple[list[list[Piece]], list[list[Piece]]]:
    """Full windows of the tiers' sizes, and windows that no piece fills."""
    stacks: list[list[Piece]] = [[] for _ in range(CONTEXT + 1)]
    for piece in pieces:
        stacks[piece[2]].append(piece)
    present = sum(1 << n for n, stack in enumerate(stacks) if stack)
    full, open_ = [], []
    for tier, shorter in zip(TIERS, (*TIERS[1:], 0)):
        while (n := _longest(stacks, present, tier)) > shorter:
            window, gap = [], tier
            while n:
                window.append(stacks[n].pop())
                if not stacks[n]:
                    present ^= 1 << n
                gap -= n
                n = _longest(stacks, present, gap) if gap else 0
            (open_ if gap else full).append(window)
    return full, open_


def cut_line(windows: list[list[Piece]]) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows laid end to end and cut at every longest context: full sequences, and the pieces after the last cut."""
    full, line, room = [], [], CONTEXT
    for window in windows:
        for doc, start, length in window:
            while length >= room:
                full.append([*line, (doc, start, room)])
                start, length, line, room = start + room, length - room, [], CONTEXT
            if length:
                line.append((doc, start, length))
                room -= length
    return full, line


def cut_powers(line: list[Piece]) -> list[list[Piece]]:
    """Pieces shorter than the longest context together, cut into sequences whose lengths are powers of two."""
    left = sum(p[2] for p in line)
    full, line = [], line[::-1]
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        sequence = []
        while room:
            doc, start, length = line.pop()
            if length > room:
                line.append((doc, start + room, length - room))
                length = room
            sequence.append((doc, start, length))
            room -= length
        full.append(sequence)
    return full


class _Steps:
    """Steps of one sequence size: all but the last hold the same number of sequences."""

    def __init__(self, number):
        self.number, self.open, self.load = number, 0, 0

    def deal(self, costs: list[int], size: int) -> list[int]:
        """A step for each sequence."""
        per = max(1, STEP_TOKENS // size)
        heap, left = [], len(costs)
        if self.open:
            heap.append([self.load, self.id, per - self.open])
            left -= per - self.open
        for _ in range(-(-max(left, 0) // per)):
            heap.append([0, self.number(), per])
        last = heap[-1]
        spare = sum(h[2] for h in heap) - len(costs)
        last[2] -= spare
        heapq.heapify(heap)
        steps = [0] * len(costs)
        for i in sorted(range(len(costs)), key=lambda i: (-costs[i], i)):
            while not heap[0][2]:
                heapq.heappop(heap)
            step = heap[0]
            steps[i] = step[1]
            heapq.heapreplace(heap, [step[0] + costs[i], step[1], step[2] - 1])
        loads = dict.fromkeys(steps, 0)
        for i, step in enumerate(steps):
            loads[step] += costs[i]
        self.load = loads.get(last[1], 0) + (self.load if self.open and last[1] == self.id else 0)
        self.id, self.open = last[1], (per - spare) % per
        return steps


class _Packer:
    """Packs a task's documents batch by batch."""

    def __init__(self, partition: int):
        self.first = partition << _COUNT_BITS
        self.sequences = self.steps = 0
        self.of_size: dict[int, _Steps] = {}
        self.pieces: list[Piece] = []
        self.ids: list[np.ndarray] = []
        self.totals: list[int] = []
        self.rows: list[pa.RecordBatch] = []
        self.ready: list[list[Piece]] = []
        self.tokens = 0

    def _step(self) -> int:
        self.steps += 1
        return self.first + self.steps - 1

    def add(self, ids: np.ndarray) -> None:
        doc, n = len(self.ids), len(ids)
        self.ids.append(ids)
        self.totals.append(n)
        self.tokens += n
        whole = n - n % CONTEXT
        self.ready += [[(doc, at, CONTEXT)] for at in range(0, whole, CONTEXT)]
        if n > whole:
            self.pieces.append((doc, whole, n - whole))

    def flush(self, last: bool = False) -> pa.RecordBatch:
        """Rows of all full sequences; the pieces of the incomplete one stay, unless it is the last time."""
        full, open_ = pack_tiers(self.pieces)
        cut, line = cut_line(open_)
        sequences = self.ready + full + cut + (cut_powers(line) if last else [])
        sizes = [sum(p[2] for p in s) for s in sequences]
        steps = [0] * len(sequences)
        for size in sorted(set(sizes)):
            at = [i for i, n in enumerate(sizes) if n == size]
            dealt = self.of_size.setdefault(size, _Steps(self._step)).deal(
                [sum(p[2] * p[2] for p in sequences[i]) for i in at], size)
            for i, step in zip(at, dealt):
                steps[i] = step
        doc, rows = [], [[] for _ in _FIELDS]
        for sequence, size, step in zip(sequences, sizes, steps):
            offset = 0
            for d, start, length in sequence:
                doc.append(d)
                row = (start, length, self.ids[d][start:start + length].tobytes(), self.totals[d],
                       self.first + self.sequences, offset, size, step)
                for column, value in zip(rows, row):
                    column.append(value)
                offset += length
            self.sequences += 1
        kept = pa.Table.from_batches(self.rows).combine_chunks()
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in kept.take(pa.array(doc, pa.int64())).columns]
        found = pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(c, k) for c, k in zip(rows, kinds))], [*kept.schema.names, *_FIELDS])
        left = sorted({p[0] for p in line})
        number = {d: i for i, d in enumerate(left)}
        self.pieces = [(number[d], start, length) for d, start, length in line]
        self.ids, self.totals = [self.ids[d] for d in left], [self.totals[d] for d in left]
        self.rows = kept.take(pa.array(left, pa.int64())).combine_chunks().to_batches()
        self.ready, self.tokens = [], sum(p[2] for p in line)
        return found


def _packed(path: str):
    def pack(batches):
        tokenizer = encoding(path)
        packer = _Packer(TaskContext.get().partitionId())
        some = False
        for batch in batches:
            taken = 0
            for start in range(0, batch.num_rows, PART):
                for text in batch.column(0).slice(start, PART).to_pylist():
                    packer.add(token_ids(text or "", tokenizer))
                    if packer.tokens >= BATCH_TOKENS:
                        done = len(packer.ids) - sum(r.num_rows for r in packer.rows)
                        packer.rows.append(_without_first(batch.slice(taken, done)))
                        taken += done
                        yield packer.flush()
                        release()
            packer.rows.append(_without_first(batch.slice(taken)))
            some = True
        if some and packer.ids:
            yield packer.flush(last=True)
            release()

    return pack


def _without_first(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:])


def pack(documents: DataFrame, path: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each piece: ``keep``, start in its document's ids, length, ids (binary, little-endian 32-bit), doc_tokens, sequence_id,
    offset there, tier (the sequence's length) and step_id."""
    rows = documents.select(F.col(text_col).cast("string").alias("_text"), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_text").schema)
    return rows.mapInArrow(_packed(path), kept + _TYPES)
