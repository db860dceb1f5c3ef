import hashlib
import random

import pytest

from veritab.llm import merkle


def test_roots_test_equality_and_differences_are_located():
    text = "\n".join(f"Sentence one of {i}. Sentence two of {i}!" for i in range(60))
    a = merkle.fingerprint(text)
    assert a == merkle.fingerprint(text) and merkle.likeness(a, a) == 1
    b = merkle.fingerprint(text.replace("two of 33", "2 of 33"))
    assert a.split(";")[0] != b.split(";")[0]
    assert merkle.differing_leaves(a, b) == [(2, 1, 1)]
    assert 0.98 < merkle.likeness(a, b) < 1
    assert sum(x != y for x, y in zip(a.split(";")[1:], b.split(";")[1:], strict=True)) == 1


@pytest.mark.parametrize("other", ["a\n\nb", "a\nb ", "a \nb", "a\n b", "", "\n", "A\nb", "a\nb\n"])
def test_any_change_changes_the_root(other):
    assert merkle.fingerprint("a\nb").split(";")[0] != merkle.fingerprint(other).split(";")[0]


def test_neighbours_equal_brute_force(spark):
    r = random.Random(2)
    rows = [(i * 3 % 101, "".join(r.choice("ab é.\n") for _ in range(r.choice([0, 1, 2, 50, 500])))) for i in range(101)]
    got = {x.doc_id: x for x in merkle.edited_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert x.fingerprint == merkle.fingerprint(text) and x.edited_fingerprint == merkle.fingerprint(edited)
        assert x.near_edited == merkle.likeness(x.fingerprint, x.edited_fingerprint)
        assert x.near_next == merkle.likeness(x.fingerprint, merkle.fingerprint(after))


def test_odd_rows(spark, odd, odd_rows, empty):
    got = merkle.edited_neighbours(odd).collect()
    assert len(got) == len(odd_rows)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert merkle.edited_neighbours(empty).count() == 0
    assert merkle.fingerprints(odd).count() == len(odd_rows)
    one = merkle.edited_neighbours(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1
