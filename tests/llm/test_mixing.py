import re

import pytest

from ledgerlake.llm.common import cut
from ledgerlake.llm.mixing import mix, mixed, schedule, sizes, source_targets


def fill(sizes_):
    """Targets by resharing the excess again and again."""
    total, weight, capped = sum(sizes_), {i: i % 3 + 1 for i in range(len(sizes_))}, set()
    while True:
        left = total - sum(3 * sizes_[i] for i in capped)
        open_ = sum(weight[i] for i in weight if i not in capped)
        target = {i: 3 * sizes_[i] if i in capped else left * weight[i] / open_ for i in weight}
        more = {i for i in weight if i not in capped and target[i] >= 3 * sizes_[i]}
        if not more:
            return target
        capped |= more


def test_targets_caps_and_taken_words(docs_of):
    rows = [(i, " ".join(["w"] * (i % 17 + 1)), "abcde"[min(4, i % 40)]) for i in range(2000)]
    rows += [(5000 + i, "x y", "z") for i in range(3)] + [(6000, "p q r", None), (6001, None, None), (6002, " \n", "a")]
    got = mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    size = [sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows if r[2] == s) for s in names]
    want = fill(size)
    for i, s in enumerate(names):
        mine = [r for r in got if source[r.doc_id] == s]
        assert {r.source_size for r in mine} == {size[i]}
        assert all(r.target == pytest.approx(want[i]) for r in mine)
        assert sum(r.taken for r in mine) == int(want[i] + 0.5)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs_of(rows).repartition(7)).collect()), key=str)


def test_schedule_follows_the_shares_everywhere(docs_of):
    rows = [(i, "a b c d", "abc"[i % 3]) for i in range(600)]
    per = cut(source_targets(cut(sizes(docs_of(rows)))))
    slots = schedule(per, 1200, 2).collect()
    assert sorted(r.rank for r in slots if r.k == 2) == list(range(600))
    for upto in range(100, 1201, 100):
        for k in range(3):
            assert abs(sum(r.slot < upto and r.k == k for r in slots) - upto * (k + 1) / 6) <= 3


def test_mixed_repeats_and_drops_rows(docs_of):
    docs = docs_of([(i, f"{i} b c d", "a") for i in range(300)] + [(900, "one two", "b"), (901, "x", "b"), (901, "x", "b"), (902, None, "b")])
    out = mixed(docs)
    assert out.columns == docs.columns
    rows = [r.doc_id for r in out.collect()]
    assert rows.count(900) == 3 and rows.count(901) == 6 and 902 not in rows
    assert abs(sum(r.text.count(" ") + 1 for r in out.collect()) - 1204) <= 4


def test_empty_tables(docs_of):
    assert mix(docs_of([])).collect() == [] and mixed(docs_of([])).collect() == []
    assert [r.taken for r in mix(docs_of([(1, None), (2, "")])).collect()] == [0, 0]


def test_no_python_in_the_plan(docs_of):
    plan = mix(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
