import hashlib

import pytest

from ledgerlake.llm.exact_dedup import exact_dedup, filter_bits

ROWS = [(1, "Aa b"), (2, "aA B"), (3, "ÄA"), (4, "äa"), (5, None), (6, ""), (7, "x"), (7, "x"), (None, "x"), (8, "long " * 20000), (9, "LONG " * 20000)]


def digest(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return hashlib.sha256(lower.encode()).hexdigest()


@pytest.mark.parametrize("max_bits", [1 << 16, 64])
def test_groups_ties_nulls_and_a_full_filter(docs_of, max_bits):
    got = exact_dedup(docs_of(ROWS), max_bits).collect()
    assert len(got) == len(ROWS)
    by = {}
    for doc_id, text in ROWS:
        by.setdefault(digest(text), []).append(doc_id)
    for r in got:
        group = by[r.text_sha256]
        assert r.group_size == len(group) and r.keep_id == max(x for x in group if x is not None)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(by)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([])).collect() == []


def test_filter_size_is_bounded():
    assert filter_bits(0) == 1 << 16 and filter_bits(10**6) == 1 << 25 and filter_bits(10**12) == 1 << 30


def test_no_python_in_the_plan(docs_of):
    plan = exact_dedup(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
