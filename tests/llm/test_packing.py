"""Pieces against the tokenizers library: every id once, in gapless sequences without padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from llm_fixtures import documents  # noqa: F401
from tickloom.llm import packing
from tickloom.llm.queries import TOKENIZER, build_queries


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(TOKENIZER)
    found.no_truncation()
    found.no_padding()
    return found


def check(rows, ids_of):
    """Rows of the operator against the ids of each document, by its id."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
    assert of_doc.keys() == ids_of.keys()
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(of_doc[doc], key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, bytes(r.ids)) == (at, len(ids), part) and r.length > 0
            at += r.length
        assert at == len(ids)
    for rows in of_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rows[0].tier <= packing.CONTEXT and at & (at - 1) == 0
        assert len({r.step_id for r in rows}) == 1


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {d: library.encode(t, add_special_tokens=False).ids + [0] for d, t in texts.items()}
    check(packing.pack(docs, TOKENIZER).collect(), ids)
    check(packing.pack(docs.repartition(7, "doc_id"), TOKENIZER).collect(), ids)
    for r in build_queries()["op11_packing"](spark, SMALL).collect():
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)


def test_odd_rows(spark, documents, library, monkeypatch):
    """Null, empty, special, long and repeated texts; ids of null; batches smaller than a text."""
    words = " ".join(f"w{i}  ö" for i in range(9000))
    rows = [(1, None), (2, ""), (3, "<|endoftext|> a<|endoftext|>"), (4, words), (5, "\n\n  x  "), (6, "y" * 5000), (None, "z")]
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    monkeypatch.setattr(packing, "BATCH_TOKENS", 1500)
    monkeypatch.setattr(packing, "PART_CHARS", 1000)
    check(packing.pack(documents(*rows).coalesce(1), TOKENIZER).collect(), ids)
    assert packing.pack(documents(), TOKENIZER).collect() == []
    twice = packing.pack(documents((1, "a b"), (1, "a b")).coalesce(1), TOKENIZER).collect()
    assert sorted(r.length for r in twice) == [3, 3] or sum(r.length for r in twice) == 6
    kept = packing.pack(documents((1, "a")).selectExpr("*", "1 AS _given"), TOKENIZER, keep=("_given", "lang"))
    assert kept.columns[:2] == ["_given", "lang"] and kept.first()._given == 1


def test_parts_of_a_long_text(library):
    tokenizer = packing.encoding(TOKENIZER)
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", " ", "  ", "\n", "é", "7", "'s", "<|endoftext|>", ". "]) for _ in range(400))
        expected = library.encode(text, add_special_tokens=False).ids + [0]
        old, packing.PART_CHARS = packing.PART_CHARS, rng.randrange(1, 60)
        assert packing.token_ids(text, tokenizer).tolist() == expected
        packing.PART_CHARS = old


def test_tiers():
    """Exact partners are found, short pieces fill long windows first, and what is left is cut once per context."""
    full, open_ = packing.pack_tiers([(0, 0, 1000), (1, 0, 24), (2, 0, 500), (3, 0, 12), (4, 0, 40), (5, 0, 64)])
    assert sorted(sorted(p[0] for p in s) for s in full) == [[0, 1], [2, 3], [5]] and open_ == [[(4, 0, 40)]]
    rng = random.Random(2)
    pieces = [(i, 0, rng.choice([600, 700, rng.randrange(1, 1024)])) for i in range(3000)]
    full, open_ = packing.pack_tiers(pieces)
    cut, line = packing.cut_line(open_)
    assert len(cut) <= len(open_) and sum(p[2] for p in line) < packing.CONTEXT
    ended = packing.cut_powers(line)
    covered = defaultdict(list)
    for s in full + cut + ended:
        n = sum(p[2] for p in s)
        assert n & (n - 1) == 0
        for doc, start, length in s:
            covered[doc].append((start, length))
    for doc, _, length in pieces:
        at = 0
        for start, n in sorted(covered[doc]):
            assert start == at
            at += n
        assert at == length


def test_steps_are_balanced():
    rng, count = random.Random(3), iter(range(1000))
    steps = packing._Steps(lambda: next(count))
    loads, sizes = defaultdict(int), defaultdict(int)
    for n in (10, 100, 37, 64, 200, 3):
        costs = [rng.randrange(1, 1000) ** 2 for _ in range(n)]
        for step, cost in zip(steps.deal(costs, 1024), costs):
            loads[step] += cost
            sizes[step] += 1
    assert [sizes[s] for s in sorted(sizes)] == [64] * 6 + [30]
    assert max(loads[s] for s in range(6)) < 1.5 * min(loads[s] for s in range(6))
