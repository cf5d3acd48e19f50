"""Cheapest repair of conversations whose turns were damaged.

A conversation is repaired by keeping, reroling, deleting and inserting rows until its roles read
``system`` (or not) and then ``user assistant`` again and again. With the rows read so far and the last
role as a node, the edits are arcs; a cost DP from the end gives every node its cost to go, and the
optimal arcs are those that lose nothing of it. Among the cheapest edit sequences the one whose letters
(the audit) are ASCII-least is found by prefix doubling: nodes are ranked by the first letter of their
least audit, then by the first 2, 4, 8, ... letters, a rank of twice the length being the pair of a
node's rank and the rank of the node that its pointer reaches. The ranks then choose each node's arc,
and the chosen path is read off doubled pointers, all conversations of a batch at once.

Spark sorts the rows by range, so a conversation of any length is dealt to many tasks; one byte per row
(role and fault) is then brought together per conversation, which is less than the audit that it yields.
Long conversations are solved block by block between stored costs. Texts go through one more sort, in
which each conversation's audit precedes its rows, and are streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import crc32_sql, cut, numbered, table

SPACE = " \t\n\x0b\x0c\r"
#: A row's code is 4 * role + fault.
ROLES, FAULTS = ("s", "u", "a", "other"), ("none", "blank", "duplicate", "truncated")
#: Last role of what a path has given so far, and the role that an insert or a rerole then gives.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
GIVES = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
REROLE, DELETE, INSERT, TRUNCATED, NEVER = 2, 3, 2, 1, 1 << 40
#: Letters in ASCII order.
LETTERS = "DIKR"
#: Rows of a block of a long conversation, and cells of paths that are read off at once.
BLOCK, CELLS = 1 << 14, 1 << 20


def _arcs() -> tuple[np.ndarray, np.ndarray]:
    """Costs and next states of D, K and R for every code and state."""
    cost, target = np.full((16, 4, 3), NEVER), np.zeros((16, 4, 3), np.int64)
    for code in range(16):
        role, fault = divmod(code, 4)
        for state in range(4):
            cost[code, state, 0], target[code, state, 0] = DELETE, state
            if fault in (1, 2):
                continue
            extra = TRUNCATED if fault == 3 else 0
            fits = role == 0 and state == START or role in (1, 2) and NEXT[state] == role + 1
            if fits:
                cost[code, state, 1], target[code, state, 1] = extra, role + 1
            cost[code, state, 2], target[code, state, 2] = REROLE + extra, NEXT[state]
    return cost, target


COST, TARGET = _arcs()
ACCEPT = np.array([0, 2 * INSERT, INSERT, 0])


def costs_to_go(codes: np.ndarray, sizes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least cost from every position and state to its segment's end.

    ``codes`` has a position per row and one (of any code) for each segment's end; ``end`` has the costs
    there, (segments, 4). Segments go in step from their ends, the longest first.
    """
    order = np.argsort(-sizes, kind="stable")
    lengths, ends = sizes[order], (np.cumsum(sizes + 1) - 1)[order]
    out = np.empty((len(codes), 4), np.int64)
    now = end[order]
    out[ends] = now
    for t in range(1, int(lengths[0]) + 1 if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -t, "right"))
        at = ends[:n] - t
        code = codes[at]
        now = (COST[code] + now[np.arange(n)[:, None, None], TARGET[code]]).min(axis=2)
        u, a = now[:, AFTER_U], now[:, AFTER_A]
        now[:, AFTER_U], now[:, AFTER_A] = np.minimum(u, a + INSERT), np.minimum(a, u + INSERT)
        for state in (START, AFTER_S):
            now[:, state] = np.minimum(now[:, state], now[:, AFTER_U] + INSERT)
        out[at] = now
    return out


def optimal_arcs(codes: np.ndarray, sizes: np.ndarray, cost: np.ndarray, inserts_at_end: bool) -> np.ndarray:
    """Target node (4 * position + state) of each node's optimal arc per letter, -1 where there is none."""
    n = len(codes)
    is_end = np.zeros(n, bool)
    is_end[np.cumsum(sizes + 1) - 1] = True
    after = np.minimum(np.arange(n) + 1, n - 1)[:, None]
    out = np.full((n, 4, 4), -1, np.int64)
    for letter, op in (("D", 0), ("K", 1), ("R", 2)):
        target = TARGET[codes, :, op]
        good = (COST[codes, :, op] + cost[after, target] == cost) & ~is_end[:, None]
        out[:, :, LETTERS.index(letter)] = np.where(good, 4 * after + target, -1)
    good = cost[:, NEXT] + INSERT == cost
    if not inserts_at_end:
        good &= ~is_end[:, None]
    out[:, :, LETTERS.index("I")] = np.where(good, 4 * np.arange(n)[:, None] + NEXT, -1)
    return out.reshape(4 * n, 4)


def least_letters(arcs: np.ndarray, roots: np.ndarray, longest: int) -> np.ndarray:
    """Codes of the letters (1 to 4, then zeros) of each root's ASCII-least path, (roots, power of two > longest).

    A node's state fixes the role that a letter gives, so no node has two arcs of one letter, and the
    first letter fixes the pointer of length 1.
    """
    nodes = np.arange(len(arcs))
    ends = (arcs < 0).all(axis=1)
    first = (arcs >= 0).argmax(axis=1)
    pointer = np.where(ends, nodes, arcs[nodes, first])
    rank, length = np.where(ends, 0, first + 1), 1
    while length <= longest:
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        pointer, length = pointer[pointer], 2 * length
    # the least arc: by letter, then by the rank of the audit that follows
    key = np.where(arcs >= 0, np.arange(4) * (len(arcs) + 1) + rank[arcs], 4 * (len(arcs) + 1))
    chosen = key.argmin(axis=1)
    pointers = [np.where(ends, nodes, arcs[nodes, chosen])]
    while 1 << len(pointers) <= longest:
        pointers.append(pointers[-1][pointers[-1]])
    path = roots[:, None]
    for jump in reversed(pointers):
        path = np.stack([path, jump[path]], axis=2).reshape(len(roots), -1)
    return np.where(ends[path], 0, chosen[path] + 1)


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    end = np.zeros(1, np.int64)
    return np.concatenate([x for r in rows for x in (r, end)]), np.array([len(r) for r in rows], np.int64)


def solve(rows: list[np.ndarray]) -> list[tuple[int, str]]:
    """Cost and audit of each conversation, given as row codes of at most ``BLOCK`` rows."""
    codes, sizes = _padded(rows)
    cost = costs_to_go(codes, sizes, np.tile(ACCEPT, (len(rows), 1)))
    arcs = optimal_arcs(codes, sizes, cost, inserts_at_end=True)
    starts = np.cumsum(sizes + 1) - sizes - 1
    longest = 3 * int(sizes.max()) + 2  # at most two inserts before a row and at the end
    letters = least_letters(arcs, 4 * starts, longest)
    text = np.array(["", *LETTERS])
    return [(int(cost[s, START]), "".join(text[x[: np.count_nonzero(x)]])) for s, x in zip(starts, letters)]


def solve_long(row: np.ndarray, block: int = BLOCK) -> tuple[int, str]:
    """The same for one conversation of any length: costs at block ends, back to front; audits front to back."""
    starts = range(0, len(row), block)
    ends = [ACCEPT]
    for s in reversed(starts):
        codes, sizes = _padded([row[s : s + block]])
        ends.append(costs_to_go(codes, sizes, ends[-1][None])[0])
    ends.reverse()
    state, audit = START, []
    for i, s in enumerate(starts):
        codes, sizes = _padded([row[s : s + block]])
        cost = costs_to_go(codes, sizes, ends[i + 1][None])
        arcs = optimal_arcs(codes, sizes, cost, inserts_at_end=i + 1 == len(starts))
        letters = least_letters(arcs, np.array([state]), 3 * len(codes))[0]
        letters = letters[: np.count_nonzero(letters)]
        audit.append("".join(np.array(["", *LETTERS])[letters]))
        state = _state_after(state, audit[-1], codes[:-1])
    return int(ends[0][START]), "".join(audit)


def _state_after(state: int, audit: str, codes: np.ndarray) -> int:
    """The state that the letters of whole rows lead to; only the last letter that gives a role counts."""
    at = len(codes)
    emitted = 0
    for letter in reversed(audit):
        if letter == "D":
            at -= 1
        elif letter == "K":
            role = int(codes[at - 1]) // 4 + 1
            break
        else:
            emitted += 1
            at -= letter == "R"
    else:
        role = state
    for _ in range(emitted):
        role = int(NEXT[role])
    return role


def _counts(row: np.ndarray) -> tuple[int, int, int, int]:
    fault, role = row % 4, row // 4
    pair = role[:-1] * 4 + role[1:]
    return int((fault == 1).sum()), int((fault == 2).sum()), int((fault == 3).sum()), int((~np.isin(pair, (1, 6, 9))).sum())


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, counts, cost, audit from conv_id, codes (letters from "a")."""
    for batch in batches:
        rows = [np.frombuffer(b, np.uint8).astype(np.int64) - 97 for b in batch["codes"].cast(pa.binary()).to_pylist()]
        found: dict[int, tuple[int, str]] = {i: solve_long(r) for i, r in enumerate(rows) if len(r) > BLOCK}
        rest = sorted((i for i in range(len(rows)) if i not in found), key=lambda i: len(rows[i]))
        group: list[int] = []
        for n, i in enumerate(rest):  # by length, so that one long conversation doesn't widen all paths
            group.append(i)
            if len(group) * 8 * (len(rows[i]) + 1) > CELLS or n + 1 == len(rest):
                found |= zip(group, solve([rows[j] for j in group]))
                group = []
        counts = list(zip(*map(_counts, rows))) or [()] * 4
        answers = [found[i] for i in range(len(rows))]
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], *(pa.array(c, pa.int64()) for c in counts), pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.string())],
            ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, seq, codes: runs of one conversation in sorted rows, cut where a batch ends."""
    seq = TaskContext.get().partitionId() << 33
    for batch in batches:
        if not len(batch):
            continue
        ids, code = batch["conv_id"], (batch["code"].to_numpy(zero_copy_only=False).astype(np.uint8) + 97).tobytes()
        null, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (null[1:] != null[:-1])]))
        runs = [code[a:b].decode() for a, b in zip(starts, [*starts[1:], len(batch)])]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(starts)), pa.array(seq + starts), pa.array(runs)], ["conv_id", "seq", "codes"])
        seq += len(batch)


def _in_order() -> list[Column]:
    """Order of the rows of a conversation; rows with the same mark are equal."""
    return [F.col("has_turn"), F.col("turn"), F.col("mark")]


def _marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, with has_turn and mark (one per conversation, role and text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whose = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    mark = F.md5(F.concat(whose, F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"))
    return rows.withColumn("has_turn", F.col("turn").isNotNull()).withColumn("mark", mark)


def row_codes(rows: DataFrame) -> DataFrame:
    """conv_id, turn, has_turn, mark, rid, code for every row of ``_marked`` rows."""
    body = F.rtrim("text", F.lit(SPACE))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    ended = F.right(body, F.lit(1)).isin(".", "!", "?")
    light = cut(
        numbered(
            rows.select("conv_id", "turn", "has_turn", "mark", role.alias("role"), F.when(body == "", 1).when(~ended, 3).otherwise(0).alias("fault"))
        )
    )
    place = F.struct("has_turn", F.coalesce("turn", F.lit(0)).alias("turn"), "rid")
    again = light.where("fault != 1").groupBy("mark").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    known = light.withColumn("place", place).join(cut(again.select("mark", "first")), "mark", "left")
    fault = F.when(F.col("fault") == 1, 1).when(F.col("place") > F.col("first"), 2).otherwise(F.col("fault"))
    return known.select("conv_id", "turn", "has_turn", "mark", "rid", (F.col("role") * 4 + fault).cast("int").alias("code"))


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit for every conversation that has rows.

    A null role or text is one space, a null id a conversation of its own, and rows without a turn come
    first. Rows of one turn are in the order of a hash of role and text, so that equal rows are adjacent. A
    row's first fault counts: blank, duplicate (its role and text came earlier), truncated. Other columns
    are ignored, and an empty table gives an empty result.
    """
    coded = row_codes(_marked(rows))
    order = [F.col("conv_id").asc_nulls_first(), *_in_order(), F.col("rid")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = cut(dealt.select("conv_id", "code").mapInArrow(_pieces, "conv_id long, seq long, codes string"))
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "codes"))).alias("runs"))
    codes = whole.select("conv_id", F.array_join(F.transform("runs", lambda r: r["codes"]), "").alias("codes"))
    return codes.mapInArrow(_audited, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def turn_gaps(rows: DataFrame) -> DataFrame:
    """conv_id, gaps: turns missing between a conversation's first and last, 0 without any turn."""
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")).distinct()
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str | None, str | None]]]:
    """Per batch the repaired (conv_id, role, text) rows; (conv_id, None, None) begins a conversation."""
    conv, audit, at, state = None, "", 0, START
    out: list[tuple] = []

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            out.append((conv, GIVES[state], ""))
            at, state = at + 1, int(NEXT[state])

    for batch in batches:
        for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if role is None:
                inserts()
                conv, audit, at, state = conv_id, text, 0, START
                out.append((conv, None, None))
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter == "K":
                state = "sua".index(role[0]) + 1
                out.append((conv, role, text))
            elif letter == "R":
                out.append((conv, GIVES[state], text))
                state = int(NEXT[state])
        yield out
        out = []
    inserts()
    yield out


def _rows_after_audit(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, role, text in tasks that hold whole conversations, each begun by its audit (role null)."""
    body = _marked(rows).withColumn("kind", F.lit(1))
    null = lambda kind: F.lit(None).cast(kind)
    head = audited.select("conv_id", null("long").alias("turn"), null("string").alias("role"), F.col("audit").alias("text"), F.lit(False).alias("has_turn"), F.lit("").alias("mark"), F.lit(0).alias("kind"))
    return body.unionByName(head).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_in_order()).select("conv_id", "role", "text")


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, at (from 0), role, text: the rows that the audits leave; null roles and texts are one space."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = -1
        for out in _edited(batches):
            kept = []
            for conv, role, text in out:
                at = -1 if role is None else at + 1
                if role is not None:
                    kept.append((conv, at, role, text))
            columns = list(zip(*kept)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv_id", "at", "role", "text"])

    return _rows_after_audit(rows, audited).mapInArrow(edit, "conv_id long, at long, role string, text string")


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired ``role:text``, newline-joined; a conversation's rows are streamed."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, any_row = [], None, False

        def done(conv) -> None:
            held.append((conv, sha.hexdigest()))

        last = None
        for out in _edited(batches):
            for conv, role, text in out:
                if role is None:
                    if sha is not None:
                        done(last)
                    last, sha, any_row = conv, hashlib.sha256(), False
                    continue
                sha.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                any_row = True
            if held:
                yield _pairs(held)
                held.clear()
        if sha is not None:
            done(last)
            yield _pairs(held)

    return _rows_after_audit(rows, audited).mapInArrow(digest, "conv_id long, repaired_sha256 string")


def _pairs(held: list[tuple]) -> pa.RecordBatch:
    ids, digests = zip(*held)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests)], ["conv_id", "repaired_sha256"])


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32("conv_id:turn") % 20 (a null is one space): 0 drops a
    row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats it, 4 makes it the user's."""
    named = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    how = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    hurt = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), how.alias("how"),
        F.when(how == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(how == 1, F.lit("")).when(how == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    ).where("how != 0")
    times = F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.select("conv_id", "turn", "role", "text", F.explode(times).alias("time")).drop("time")


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``, conv_id): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    A conversation without rows has zeros, an empty audit and the hash of the empty string. Nulls, ties and
    empty tables: see ``audits``. The hash is of a conversation's rows in turn, so one task streams
    them; sorted by Spark, they are not held together.
    """
    found = cut(audits(rows))
    parts = [found, turn_gaps(rows), repaired_digests(rows, found)]
    if ids is not None:
        parts.append(ids.select(F.col("conv_id").cast("long").alias("conv_id")))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    # each part has a row per conversation, so this brings at most one value of each column together
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return together.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), empty).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same repairs by a recursion over rows that keeps, for each last role, the least (cost, audit) and its rows."""
    never = "{'c': 1099511627776, 'a': '', 'o': []::VARCHAR[]}"

    def step(state: str, cost: str, letter: str, row: str | None) -> str:
        rows = f"list_append({state}.o, {row})" if row else f"{state}.o"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {rows}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def when(condition: str, option: str) -> str:
        return f"CASE WHEN {condition} THEN {option} ELSE {never} END"

    def keep(state: str, initial: str) -> str:
        return when(f"NOT gone AND initial = '{initial}'", step(state, "extra", "K", "role || ':' || text"))

    def rerole(state: str, role: str) -> str:
        return when("NOT gone", step(state, f"{REROLE} + extra", "R", f"'{role}:' || text"))

    def dropped(state: str) -> str:
        return step(state, str(DELETE), "D", None)

    user = least("s2", *[step(s, str(INSERT), "I", "'user:'") for s in ("s0", "s1", "s3")])
    assistant = least("s3", step("u", str(INSERT), "I", "'assistant:'"))
    return f"""
WITH RECURSIVE struck AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS rid,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
  FROM conversations
),
hurt AS (
  SELECT conv_id, turn, rid, time, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM struck, (SELECT unnest([0, 1]) AS time) WHERE how <> 0 AND (time = 0 OR how = 3)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST,
    md5(coalesce(conv_id::VARCHAR, ' ') || ':' || length(role) || ':' || role || text), rid, time) AS i FROM hurt
),
faulty AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed
),
rows AS MATERIALIZED (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INT AS extra,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faulty
),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id
),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i, {dropped('s0')} AS s0, {least(dropped('s1'), keep('s0', 's'))} AS s1,
    {least(dropped('u'), *[f(s, x) for s in ('s0', 's1', 'a') for f, x in ((keep, 'u'), (rerole, 'user'))])} AS s2,
    {least(dropped('a'), keep('u', 'a'), rerole('u', 'assistant'))} AS s3
  FROM (
    SELECT *, {assistant} AS a FROM (
      SELECT r.conv_id, r.i, role, text, initial, gone, extra, s0, s1, s3, {user} AS u
      FROM paths p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    )
  )
),
ended AS (
  SELECT *, {least('s0', assistant)} AS best FROM (
    SELECT counts.*, s0, s3, {user} AS u FROM paths JOIN counts ON counts.conv_id IS NOT DISTINCT FROM paths.conv_id AND n = paths.i
  )
)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM every.conv_id
"""


SQL = _sql()


def damaged_report(rows: DataFrame) -> DataFrame:
    """``repair_report`` of the damaged rows, with every conversation of ``rows``."""
    return repair_report(damaged(rows), rows)


def op12_prefix_doubling_repair(spark, sf_dir: str) -> DataFrame:
    return damaged_report(table(spark, sf_dir, "conversations"))
