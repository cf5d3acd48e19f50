import hashlib
import re

from ledgerlake.llm.pii import KINDS, personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(docs, texts):
    rows = personal_data(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base = brute(texts[r.doc_id])
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256, (r.doc_id, base, r.spans)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k) for s in base) for k in KINDS]
        assert set(base) <= set(r.spans.split(",")) | {""}
    return {r.doc_id: [s for s in r.spans.split(",") if s and s not in brute(texts[r.doc_id])] for r in rows}


def test_corpus_matches_brute_force(corpus, texts):
    extra = check(corpus, texts)
    assert sum(map(len, extra.values())) <= 2


def test_edges_and_added_spans(docs_of):
    texts = {
        1: "a@b.c_d@e.f x..y@z.-q 1.2.3.45.6.7.8 999.1.1.1 12 4111 1111 1111 1111 4111-1111-1111-1112 0000000001.2.3.255",
        2: "mail me at joe (at) example (dot) com or tel. (555) 123-4567; card: 4111111111111112",
        3: "",
        4: "é😀 +49 30 1234567 + 12 +1 (2) 3 ++44 20 7946 0000",
        5: "1" * 20000 + " " + "a" * 20000 + "@b" + ".c" * 5000 + " " + "1-" * 10000 + "a" * 50000,
        6: "host 2001:0db8:0000:0000:0000:ff00:0042:8329 up\nx@y.zz\n4111 1111\n1111 1111",
        None: "me@here.org",
    }
    # enough plain cases to learn from
    texts |= {100 + i: f"card 4111 1111 1111 1111 and tel. +49 30 12345{i:02d}" for i in range(60)}
    docs = docs_of([(i, t) for i, t in texts.items()] + [(3, None), (1, texts[1])])
    extra = check(docs, texts)
    assert [s.split(":")[0] for s in extra[2]] == ["email", "card", "phone"]
    assert [s.split(":")[0] for s in extra[6]] == ["ip"]
    assert extra[1] == extra[3] == extra[5] == []


def test_empty_table(docs_of):
    assert personal_data(docs_of([])).collect() == []


def test_no_python_in_the_plan(docs_of):
    plan = personal_data(docs_of([(1, "a@b.cc")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
