import re

from ledgerlake.llm.licenses import PHRASES, TEXTS, in_order, scan


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = scan(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_edited_texts_are_found_and_scattered_words_are_not(docs_of):
    mit, gpl = TEXTS[1][0].split(), TEXTS[5][0].split()
    edited = mit[:12] + ["freely"] + mit[12:25] + mit[27:40] + ["any"] + mit[40:]
    rows = [
        (1, "intro " * 30000 + " ".join(edited) + " outro" * 1000),
        (2, " pad ".join(" ".join(mit[i : i + 4]) for i in range(0, len(mit), 8))),
        (3, "MIT license, MIT-License! the Apache\nLICENSE"),
        (4, " ".join(mit) + " and " + " ".join(gpl)),
        (5, None),
        (6, ""),
        (None, "general public license"),
        (3, "mit license"),
    ]
    got = scan(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].labels == "mit" and by[1][0].n_base == 0 and 0.6 <= by[1][0].score < 1
    assert by[2][0].labels == "" and by[2][0].score == 0
    assert sorted(r.n_base for r in by[3]) == [1, 3] and {r.labels for r in by[3]} == {"mit", "apache,mit"}
    assert by[4][0].labels == "gpl,mit" and by[4][0].score == 1
    assert (by[5][0].n_words, by[5][0].n_base, by[5][0].labels, by[5][0].first_word) == (0, 0, "", None)
    assert by[None][0].base_labels == "gpl"
    assert scan(docs_of([])).collect() == []


def test_copies_in_a_row_are_found_and_one_place_counts_once(docs_of):
    line, mit = "Licensed under CC BY 4.0\n", TEXTS[1][0].split()
    edited = " ".join(mit[:12] + ["freely"] + mit[12:25] + mit[27:])
    rows = [
        (1, line),
        (2, line * 4),
        (3, line * 3000),
        (4, "released under the mit or released under the mit"),
        (5, "under the mit license and released under the mit"),
        (6, "released under the mit license " * 40),
        (7, f"{edited} " * 5),
        (8, "Licensed under the CC BY 4.0 " * 9),
    ]
    by = {r.doc_id: r for r in scan(docs_of(rows)).collect()}
    assert [(by[i].labels, by[i].score) for i in (1, 2, 3, 6)] == [("cc-by", 1.0)] * 3 + [("mit", 1.0)]
    assert [(by[i].labels, by[i].score) for i in (4,)] == [("", 0.0)]
    assert (by[5].base_labels, by[5].score) == ("mit", 1.0)  # the base phrase is there
    assert by[7].labels == "mit" and 0.6 <= by[7].score < 1
    assert (by[8].labels, by[8].score) == ("", 0.0)


def test_hits_in_order_count_each_place_once():
    assert in_order([(0, 0), (5, 0)]) in ([(0, 0)], [(5, 0)])
    assert in_order([(4, 0), (0, 1)]) in ([(4, 0)], [(0, 1)])
    assert in_order([(0, 0), (1, 1), (3, 2), (7, 1), (9, 3)]) == [(0, 0), (1, 1), (3, 2), (9, 3)]
