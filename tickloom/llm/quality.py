"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

Terms are trigrams of character classes (letters by case, digits, groups of
punctuation, white space) over the whole text, and two counts of repetition: words equal to their
predecessor, and five-word shingles seen before in the text. They know nothing of language or vocabulary. Latent
semantic analysis of a bounded sample of labelled documents gives ``RANK`` directions;
the sample's vectors are broadcast, and each document is compared with all of them, in
blocks of one matrix product. The ``NEIGHBOURS`` nearest vote, weighted by
their cosine.

The sample is the ``SAMPLE`` labelled documents that may be learnt from with the smallest hash
of their id; it is all that reaches the driver, and its size does not depend on the input.
Scores of one document depend on its text and the sample alone.

Cases: a null, empty or blank text has a zero vector and scores the sample's share of label 1, as does
any text no neighbour of which has a positive cosine; equal cosines are settled by place in
the sample, which is ordered by hash, id and text; repeated rows score alike; a null doc_id counts as
the text "null" in the held-out rule, and learns nothing; labels repeated for an id must agree, else
their mean is rounded; without any label to learn from every text scores 1; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import shingles
from tickloom.llm.shingles import WIDTH, _words, chunks, make_room, release, text_buffers, tokens

SAMPLE = 4096
RANK = 48
NEIGHBOURS = 15
THRESHOLD = 0.7
BLOCK = 512
#: Weight of the two counts of repetition among the trigrams.
REPEAT_WEIGHT = 2.0

_CLASSES = 12
TERMS = _CLASSES**3 + 2


def _class_of(code: int) -> int:
    char = chr(code)
    kind = unicodedata.category(char)
    if char in "\n\r":
        return 1
    if char.isspace() or kind[0] in "ZC":
        return 0
    if kind in ("Lu", "Lt"):
        return 2
    if kind == "Ll":
        return 3
    if kind[0] in "LM":
        return 4
    if kind[0] == "N":
        return 5
    if char == ".":
        return 6
    if char in "!?":
        return 7
    if char in ",;:":
        return 8
    if char == "|":
        return 9
    if kind in ("Pd", "Pi", "Pf", "Ps", "Pe") or char in "'\"/":
        return 10
    return 11


_CLASS = np.array([_class_of(c) for c in range(0x3000)], np.uint8)


class Counts(NamedTuple):
    doc: np.ndarray
    term: np.ndarray
    count: np.ndarray


def _kinds(data: np.ndarray) -> np.ndarray:
    """Class of each character of whole UTF-8 sequences."""
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.where(code < len(_CLASS), _CLASS[np.minimum(code, len(_CLASS) - 1)], 4).astype(np.int64)


def _trigrams(kind: np.ndarray) -> np.ndarray:
    return (kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:]


def _long_table(data: np.ndarray) -> np.ndarray:
    """Trigram counts of one text, made of pieces that overlap by two characters."""
    table, low, left = np.zeros(TERMS, np.int64), 0, np.zeros(0, np.int64)
    while low < len(data):
        high = low + shingles.CHUNK_BYTES
        while high < len(data) and data[high] & 0xC0 == 0x80:
            high += 1
        kind = np.concatenate([left, _kinds(data[low:high])])
        table += np.bincount(_trigrams(kind), minlength=TERMS)
        low, left = high, kind[-2:]
    return table


def _chunk_counts(data: np.ndarray, bounds: np.ndarray) -> Counts:
    """Term counts of a chunk, sorted by document."""
    n = len(bounds) - 1
    if n == 1 and len(data) > shingles.CHUNK_BYTES:
        table = _long_table(data)
    else:
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        kind = _kinds(data)
        doc = np.repeat(np.arange(n), np.diff(heads[bounds]))
        inside = doc[:-2] == doc[2:]
        table = np.bincount(doc[:-2][inside] * TERMS + _trigrams(kind)[inside], minlength=n * TERMS)
    key = np.flatnonzero(table)
    count = table[key]
    if len(data):
        hashes, owner = _words(data, bounds)
        words = np.bincount(owner, minlength=n)
        same = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
        distinct = np.bincount(tokens(data, bounds)[0], minlength=n)
        again = np.maximum(words - WIDTH + 1, np.minimum(words, 1)) - distinct
        key = np.concatenate([key, np.arange(n) * TERMS + TERMS - 2, np.arange(n) * TERMS + TERMS - 1])
        count = np.concatenate([count, same, again])
        key, count = key[count > 0], count[count > 0]
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
    return Counts(key // TERMS, key % TERMS, count.astype(np.float32))


def _dense(counts: Counts, n: int, idf: np.ndarray) -> np.ndarray:
    """Rows of length one: square roots of term shares, weighted; a zero row for no terms."""
    rows = np.zeros((n, TERMS), np.float32)
    letters = counts.term < TERMS - 2
    total = np.maximum(np.bincount(counts.doc[letters], counts.count[letters], minlength=n), 1)
    share = np.sqrt(counts.count / total[counts.doc])
    share[~letters] *= REPEAT_WEIGHT
    rows[counts.doc, counts.term] = share
    rows *= idf
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


class Model(NamedTuple):
    idf: np.ndarray
    directions: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # rank x sample, columns of length one
    labels: np.ndarray
    share: float


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length < 1e-9, 1, length)


def fit(counts: list[tuple[list, list]], labels: np.ndarray) -> Model:
    """Model of a bounded sample; ``counts`` are (terms, counts) of each document."""
    n = len(counts)
    doc = np.repeat(np.arange(n), [len(t) for t, _ in counts])
    term = np.array([x for t, _ in counts for x in t], np.int64)
    count = np.array([x for _, c in counts for x in c], np.float32)
    found = np.bincount(term, minlength=TERMS)
    idf = np.log((1 + n) / (1 + found)).astype(np.float32) + 1
    rows = _dense(Counts(doc, term, count), n, idf)
    _, vectors = np.linalg.eigh(rows.T @ rows)
    directions = np.ascontiguousarray(vectors[:, ::-1][:, :RANK]).astype(np.float32)
    latent = _unit(rows @ directions)
    return Model(idf, directions, np.ascontiguousarray(latent.T), labels.astype(np.float32), float(labels.mean()))


def score_block(model: Model, rows: np.ndarray) -> np.ndarray:
    """Scores of a block of term rows, by exact cosines with every vector of the sample."""
    cosine = _unit(rows @ model.directions) @ model.vectors
    k = min(NEIGHBOURS, cosine.shape[1])
    edge = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, -k][:, None]
    weight = np.where(cosine > edge, np.maximum(cosine, 0), 0)
    at_edge = cosine == edge
    room = k - (cosine > edge).sum(1, keepdims=True)
    weight += np.where(at_edge & (np.cumsum(at_edge, axis=1) <= room), np.maximum(edge, 0), 0)
    total = weight.sum(1)
    return np.where(total > 0, (weight @ model.labels) / np.where(total > 0, total, 1), model.share)


def _term_lists(batches):
    make_room()
    for batch in batches:
        offsets, data = text_buffers(batch.column(1))
        for first, last in chunks(offsets):
            low = offsets[first]
            c = _chunk_counts(data[low:offsets[last]], offsets[first:last + 1] - low)
            cuts = np.searchsorted(c.doc, np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i).slice(first, last - first) for i in (0, 2, 3)),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(c.term.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(c.count)),
            ], ["hash", "doc_id", "label", "terms", "counts"])


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents (doc_id, label) with the smallest hashes, ``SAMPLE`` at most."""
    order = F.xxhash64(F.col("doc_id"))
    chosen = (
        labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id")
        .agg(F.round(F.avg("label")).cast("int").alias("label"))
        .withColumn("hash", order).orderBy("hash", "doc_id").limit(SAMPLE)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    terms = texts.select("hash", F.col("text").cast("string").alias("text"), "doc_id", "label").mapInArrow(
        _term_lists, "hash bigint, doc_id bigint, label int, terms array<int>, counts array<float>")
    # Repeated ids bring more rows than ids; the bound holds for rows too.
    rows = terms.orderBy("hash", "doc_id", F.xxhash64("terms", "counts")).limit(SAMPLE).toArrow()
    if not rows.num_rows:
        return fit([([], [])], np.ones(1))
    counts = list(zip(rows.column("terms").to_pylist(), rows.column("counts").to_pylist()))
    return fit(counts, rows.column("label").to_numpy())


def _scorer(shared):
    def score(batches):
        make_room()
        model = Model(*shared.value)
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for first, last in chunks(offsets):
                low = offsets[first]
                c = _chunk_counts(data[low:offsets[last]], offsets[first:last + 1] - low)
                found = []
                for start in range(0, last - first, BLOCK):
                    stop = min(start + BLOCK, last - first)
                    a, b = np.searchsorted(c.doc, [start, stop])
                    part = Counts(c.doc[a:b] - start, c.term[a:b], c.count[a:b])
                    found.append(score_block(model, _dense(part, stop - start, model.idf)))
                score = np.clip(np.concatenate(found).astype(np.float64), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(first, last - first) for i in range(2, batch.num_columns)),
                     batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                     pa.array(score)],
                    [*batch.schema.names[2:], "doc_id", "text", "score"])
            release()

    return score


def held_out() -> Column:
    """Rows of doc_id from which no label is learnt."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 4 == 2


def score_documents(documents: DataFrame, model: Model, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``documents`` as doc_id, the columns in ``keep``, and score; no shuffle."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(tuple(model))
    kept = [n for n in keep if n not in ("doc_id", "text")]
    given = documents.select("doc_id", F.col("text").cast("string").alias("text"), *kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.select(*kept, "doc_id", "text").schema)
    scored = given.mapInArrow(_scorer(shared), f"{schema}, score double")
    return scored.select("doc_id", *(n for n in keep if n != "doc_id"), "score")


def classify(documents: DataFrame, labels: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every document after learning from the labels (doc_id, label) that are not held out."""
    learnt = labels.withColumn("_held", held_out()).filter("NOT _held")
    model = learn(documents, learnt.select("doc_id", "label"))
    scored = score_documents(documents, model, keep=keep)
    return scored.withColumn("held_out", held_out()).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
