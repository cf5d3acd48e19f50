import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from ledgerlake.llm import conversations as C

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, code int, kind string, mark string, seq int, rid string, audit string"
SPACES = " \t\n\x0b\x0c\r"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "m", 2, "r", "a") for r in rows], SCHEMA)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        how = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def cheapest(codes):
    """Least (cost, audit) by a forward table over (last role, audit); codes: (initial, fault)."""
    best = {"": (0, "")}
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def better(table, state, entry):
        if state not in table or entry < table[state]:
            table[state] = entry

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit) in list(table.items()):
                better(table, "a" if state == "u" else "u", (cost + 2, audit + "I"))
        return table

    for initial, fault in codes:
        best, new = inserted(best), {}
        for state, (cost, audit) in best.items():
            better(new, state, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial in follow[state] and initial:
                    better(new, initial, (cost + extra, audit + "K"))
                better(new, "a" if state == "u" else "u", (cost + 2 + extra, audit + "R"))
        best = new
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    """conv_id -> the report's row, from rows after damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, codes = set(), []
        for _, _, role, text in mine:
            body = text.rstrip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            codes.append((role[:1], fault))
        cost, audit = cheapest(codes)
        turns = {r[1] for r in mine} - {None}
        state, fixed, left = "", [], list(mine)
        for letter in audit:
            gives = "assistant" if state == "u" else "user"
            row = left.pop(0) if letter != "I" else (None, None, gives, "")
            if letter == "D":
                continue
            role = row[2] if letter in "KI" else gives
            state = role[0]
            fixed.append(f"{role}:{row[3]}")
        assert re.fullmatch("(s?(ua)+)?", "".join(f[0] for f in fixed)) and not left
        faults = [f for _, f in codes]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(codes))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(fixed).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_matches_brute_force_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(hurt(rows))
    got = report(C.op12_prefix_doubling_repair(spark, SF))
    assert got == {conv: want.get(conv, EMPTY) for conv, *_ in rows}
    assert any("I" in r[6] for r in got.values()) and any("R" in r[6] for r in got.values())


def test_every_short_sequence_is_repaired_at_least_cost():
    """All edit sequences of up to three rows, enumerated."""
    kinds = [(role, fault) for role in range(4) for fault in range(4)]
    words = ["".join(w) for n in range(6) for w in itertools.product("DIKR", repeat=n)]

    def run(codes, word):
        state, cost, at = C.START, 0, 0
        for letter in word:
            if letter == "I":
                state, cost = C.NEXT[state], cost + 2
                continue
            if at == len(codes):
                return None
            role, fault = codes[at]
            at += 1
            if letter == "D":
                cost += 3
                continue
            if fault in (1, 2) or letter == "K" and not (role == 0 and state == C.START or role in (1, 2) and C.NEXT[state] == role + 1):
                return None
            cost += (fault == 3) + 2 * (letter == "R")
            state = role + 1 if letter == "K" else C.NEXT[state]
        return (cost, word) if at == len(codes) and state in (C.START, C.AFTER_A) else None

    some = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)]
    rng = np.random.default_rng(1)
    some += [[kinds[i] for i in rng.integers(0, 16, 3)] for _ in range(60)]
    for codes in some:
        want = min(filter(None, (run(codes, w) for w in words)))
        got = C.solve([np.array([4 * r + f for r, f in codes], np.int64)])[0] if codes else (0, "")
        assert got == want, codes


def test_many_at_once_and_long_ones_in_blocks():
    rng = np.random.default_rng(2)
    weights = np.array([1, 0.2, 0.2, 0.3] + [6, 0.3, 0.3, 1] * 2 + [0.5, 0.1, 0.1, 0.2])
    rows = [rng.choice(16, n, p=weights / weights.sum()) for n in rng.integers(1, 60, 120)]
    want = [cheapest([("sua "[c // 4], C.FAULTS[c % 4]) for c in r]) for r in rows]
    assert C.solve(rows) == want
    for block in (1, 2, 7, 64):
        assert [C.solve_long(r, block) for r in rows[:40]] == want[:40]


def test_ties_nulls_repeats_hot_conversation_and_clashing_columns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"text {t % 50}." if t % 7 else "") for t in range(500)]
    rows += [(2, None, None, None), (2, None, "user", "a."), (None, 1, "system", "s."), (None, 2, "user", "q?"), (None, None, "x", "y")]
    rows += [(3, 5, "user", "same."), (3, 5, "user", "same."), (4, 0, "", "no role."), (5, 9, "uSER", "kept .  \n"), (6, None, None, " \t\r\n")]
    want = brute(hurt(rows))
    got = report(C.damaged_report(conversations(spark, rows).repartition(3)))
    assert got == {conv: want.get(conv, EMPTY) for conv, *_ in rows}


def test_repaired_rows_and_empty_table(spark):
    rows = conversations(spark, [(1, 0, "user", "hi."), (1, 1, "user", "again"), (2, 0, "assistant", "so.")])
    found = C.cut(C.audits(rows))
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {1: (3, "KR"), 2: (2, "IK")}
    got = sorted(tuple(r) for r in C.repaired(rows, found).collect())
    assert got == [(1, 0, "user", "hi."), (1, 1, "assistant", "again"), (2, 0, "user", ""), (2, 1, "assistant", "so.")]
    none = rows.where("conv_id > 9")
    assert C.repair_report(none, none).collect() == [] and C.repaired(none, C.cut(C.audits(none))).collect() == []


def test_a_very_long_conversation_is_dealt_to_many_tasks(spark):
    n = 3 * C.BLOCK
    rows = spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id, '.') as text")
    [r] = C.repair_report(rows).collect()
    assert (r.cost, r.audit, r.gaps, r.illegal) == (0, "K" * n, 0, 0)
    want = hashlib.sha256("\n".join(f"{'assistant' if i % 2 else 'user'}:turn {i}." for i in range(n)).encode()).hexdigest()
    assert r.repaired_sha256 == want


@pytest.mark.parametrize("text,fault", [("Done. \n\t", 0), ("!", 0), ("no end", 3), ("dot. then", 3), ("\u2003", 3), (" \r\x0b", 1)])
def test_faults_of_texts(spark, text, fault):
    [r] = C.row_codes(C._marked(conversations(spark, [(1, 0, "user", text)]))).collect()
    assert r.code == 4 + fault
