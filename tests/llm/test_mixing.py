from fractions import Fraction

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401
from tickloom.llm import mixing, queries


def plain_targets(sizes):
    """Targets by the definition, in fractions; sizes are in order of source."""
    weights = [i % 3 + 1 for i in range(len(sizes))]
    capped, total = set(), sum(sizes)
    while True:
        rest = total - sum(3 * sizes[i] for i in capped)
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        found = [3 * s if i in capped else Fraction(rest * w, free) for i, (s, w) in enumerate(zip(sizes, weights))]
        above = {i for i, t in enumerate(found) if t > 3 * sizes[i]}
        if not above:
            return found
        capped |= above


def test_targets_are_capped_and_shared_again(spark, documents):
    sizes = {"a": 900, "b": 2, "c": 10, "d": 40, None: 5}
    rows = [(i, "w " * 1, s) for s, n in sizes.items() for i in range(n)]
    mixed = mixing.mix(documents(*rows)).collect()
    expected = dict(zip(sizes, plain_targets(list(sizes.values()))))
    for source, size in sizes.items():
        own = [r for r in mixed if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert abs(own[0].target - float(expected[source])) < 1e-9
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(r.taken <= 3 * r.size for r in own)


def test_order_follows_the_schedule(spark, documents):
    rows = [(i, "w " * (i % 7 + 1), s) for s in "abc" for i in range(300)]
    order = mixing.in_training_order(mixing.mix(documents(*rows), keep=("source",))).collect()
    times = [r.time for r in order]
    assert times == sorted(times) and 0 <= times[0] and times[-1] < 1
    words = {s: sum(r.words for r in order if r.kept.source == s) for s in "abc"}
    early = {s: sum(r.words for r in order if r.kept.source == s and r.time < 0.5) / words[s] for s in "abc"}
    # Integrals of the weights up to one half.
    assert all(abs(early[s] - share) < 0.03 for s, share in zip("abc", (0.625, 0.5, 0.375)))


def test_odd_rows(spark, documents):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "x y", "b"), (4, "x y", "b"), (4, "x y", "b")]
    mixed = mixing.mix(documents(*rows), keep=("doc_id", "n_chars")).collect()
    assert len(mixed) == 6 and all(r.taken == 0 and r.times == [] for r in mixed if r.size == 0)
    assert sum(r.taken for r in mixed) == 6
    again = mixing.mix(documents(*reversed(rows)), keep=("doc_id", "n_chars")).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))
    assert mixing.mix(documents()).count() == 0
    none = mixing.mix(documents((1, None, "a"))).collect()
    assert [(r.target, r.taken) for r in none] == [(0.0, 0)]


def test_one_long_document_is_cut_to_the_word(spark, documents):
    long = " ".join(f"w{i}" for i in range(20_000))
    mixed = mixing.mix(documents((1, long, "a"), (2, "x " * 20_000, "b")))
    assert {r.doc_id: r.taken for r in mixed.collect()} == {1: 13_333, 2: 26_667}
    text = spark.range(1).select(mixing.first_words(F.lit(" a  b\tc\nd "), F.lit(3)).alias("t")).first().t
    assert text == " a  b\tc"


def test_rows_of_one_id_do_not_depend_on_the_order_of_the_input(spark, documents):
    rows = [(1, "a b c d", "s"), (1, "e f g h", "s"), (None, "i j k", "s"), (None, "l m n", "s"), (2, "o " * 30, "t"), (3, "p", "u")]
    found = [
        sorted(str((r.doc_id, r.kept.text, r.taken, r.times)) for r in mixing.mix(frame, keep=("text",)).collect())
        for frame in (documents(*rows), documents(*reversed(rows)), documents(*rows).repartition(5))]
    assert found[0] == found[1] == found[2]


def test_whole_cuts(spark, documents):
    rows = [(i, "w " * (i % 9 + 1), s) for s in "abc" for i in range(100)] + [(900, "v " * 2000, "d"), (901, "v", "d")]
    mixed = mixing.mix(documents(*rows), keep=("source",))
    before = {r.doc_id if r.doc_id >= 900 else (r.source, r.doc_id): r for r in mixed.collect()}
    after = {r.doc_id if r.doc_id >= 900 else (r.source, r.doc_id): r for r in mixing.with_whole_cuts(mixed).collect()}
    cut = {k: r for k, r in before.items() if 0 < r.part < r.size}
    assert cut and before.keys() == after.keys()
    for k, r in after.items():
        old = before[k]
        if k in cut and r.size <= r.target:
            assert r.part in (0, r.size) and abs(r.part - old.part) <= r.size / 2
        else:
            assert r.part == old.part
        assert len(r.times) == (r.whole + (r.part > 0) if r.size else 0) and r.times == old.times[:len(r.times)]
        assert r.taken == r.whole * r.size + r.part <= 3 * r.size
    assert any(0 < r.part < r.size for r in after.values()) == any(r.size > r.target for r in cut.values())


@pytest.mark.parametrize("total", [2**31 // 3 - 1, 2**31 // 3 + 1, 1_400_000_000, 2**31 - 1, 2**31, 2**63 // 3 - 1, 2**63 // 3 + 1, 9 * 10**18])
def test_targets_of_many_words(spark, total):
    sizes = {"a": total // 2, "b": total // 20, "c": total // 4}
    sizes["d"] = total - sum(sizes.values())
    found = {r.source: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    assert sum(r.source_size for r in found.values()) == total
    for source, target in zip(sizes, plain_targets(list(sizes.values()))):
        assert found[source].target == pytest.approx(float(target), rel=1e-15)


def test_pipeline_stage_of_many_words(spark, documents, monkeypatch):
    """Each word counts as a hundred million: 1.2 billion in all, of which the sources get 1, 2 and 3 sixths."""
    plain = mixing.words
    monkeypatch.setattr(mixing, "words", lambda text: plain(text) * 10**8)
    rows = [(10 * i + j, "w", s) for i, s in enumerate("abc") for j in range(4)]
    found = corpus_pipeline.mix_sources(spark, documents(*rows), "").collect()
    passes = {s: sorted(r.doc_id for r in found if r.source == s) for s in "abc"}
    assert [len(passes[s]) for s in "abc"] == [2, 4, 6] and all(r.text == "w" for r in found)
    assert passes["b"] == [10, 11, 12, 13] and set(passes["c"]) == {20, 21, 22, 23}


def test_op4_of_many_words(spark, documents, monkeypatch, tmp_path):
    """1.2 billion words, counted as in the test above; a third of the last source's passes come again."""
    plain = mixing.words
    monkeypatch.setattr(mixing, "words", lambda text: plain(text) * 10**8)
    documents(*[(10 * i + j, "w", s) for i, s in enumerate("abc") for j in range(4)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op4_mixing(spark, str(tmp_path)).collect()
    taken = {i: sorted(r.taken // 10**8 for r in found if r.doc_id // 10 == i) for i in range(3)}
    assert taken == {0: [0, 0, 1, 1], 1: [1, 1, 1, 1], 2: [1, 1, 2, 2]}
    assert {r.doc_id // 10: r.target for r in found} == {0: 2e8, 1: 4e8, 2: 6e8}
    times = [r.first_time for r in found]
    assert times[-2:] == [None, None] and times[:-2] == sorted(times[:-2])
