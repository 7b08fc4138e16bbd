"""Repeated passages where rows share an id or have none."""

import hashlib
import random

from ledgerlake.llm import suffixes

SCHEMA = "doc_id long, text string"


def letters(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghij ") for _ in range(n))


def test_rows_of_one_id_keep_their_own_bytes(spark):
    shared, one, other = letters(1, 300), letters(2, 500), letters(3, 500)
    rows = [(1, shared), (7, shared + one), (7, other), (None, other[:200]), (None, letters(4, 400))]
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffixes.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {
        (None, 200, 0, sha(other[:200])), (None, 400, 0, sha(rows[4][1])), (1, 300, 0, sha(shared)),
        (7, 800, 300, sha(one)), (7, 500, 200, sha(other[200:])),
    }


def test_equal_rows_of_one_id_keep_one_copy(spark):
    text = letters(5, 1000)
    for i in (3, None):
        got = suffixes.remove_repeats(spark.createDataFrame([(i, text)] * 4, SCHEMA).repartition(2)).collect()
        assert sorted(r.n_removed for r in got) == [0, 1000, 1000, 1000] and {r.doc_id for r in got} == {i}


def test_ranges_are_one_rows_own(spark):
    """No row of ``collect_list`` holds the ranges of more than one text."""
    rows = [(None if k % 3 else k, letters(9, 300)) for k in range(60)]
    texts = suffixes.by_document(spark.createDataFrame(rows, SCHEMA))
    ranges = suffixes.repeated_ranges(texts)
    assert texts.select("id_").distinct().count() == 60
    assert ranges.select("id_").distinct().count() == 59
