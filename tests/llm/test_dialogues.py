from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest

from tidemark.llm import dialogues, repairgrammar
from tidemark.llm.queries.dialogues import damage, repaired

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, place string, audit string"


def exhaustive(symbols):
    """The least (cost, audit) by trying all edits, with up to two insertions in each gap."""
    rows = [symbols[i : i + 2] for i in range(0, len(symbols), 2)]
    gaps = [[("", "", 0)], [("I", r, 3) for r in "ua"], [("II", a + b, 6) for a in "ua" for b in "ua"]]
    gaps = [g for group in gaps for g in group]

    def ways(row):
        yield "D", "", 4
        if row[1] not in "bd":
            more = 3 if row[1] == "t" else 0
            yield "K", row[0], more
            for r in "ua":
                yield "R", r, 3 + more

    best = None
    for first, *rest in product(gaps, *(product(list(ways(r)), gaps) for r in rows)):
        parts = [first, *(x for pair in rest for x in pair)]
        if LEGAL.match("".join(p[1] for p in parts)):
            found = (sum(p[2] for p in parts), "".join(p[0] for p in parts))
            best = min(best or found, found)
    return best


def cheapest(rows):
    """(cost, audit, lines) by searching from the first row on, cheapest first."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and LEGAL.match(roles):
            return cost, audit, lines
        last = roles[-1:]
        if (at, last) in seen:
            continue
        seen.add((at, last))
        turns = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for t, name in (("u", "user"), ("a", "assistant")):
            if t in turns:
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + t, (*lines, f"{name}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, lines))
            if fault not in "bd":
                more = 3 if fault == "t" else 0
                if role[:1] and role[:1] in turns:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role[0], (*lines, f"{role}:{text}")))
                for t, name in (("u", "user"), ("a", "assistant")):
                    if t in turns:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, roles + t, (*lines, f"{name}:{text}")))
    raise AssertionError


def damaged(rows):
    for conv_id, turn, role, text in rows:
        c, t, role, text = (" " if x is None else x for x in (conv_id, turn, role, text))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range((kind != 0) + (kind == 3)):
            yield conv_id, turn, role, text


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = [r[1:] for r in damaged(rows) if r[0] == c]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faulty = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "." if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(faulty, faulty[1:], strict=False)]
        cost, audit, lines = cheapest(faulty)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        faults = [sum(f[2] == x for f in faulty) for x in "bdt"]
        out[c] = (gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)
    return out


def random_rows(rng, conv_id, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "useful"]
    texts = ["Yes.", "No!", "  \t", "", None, "cut off", "Why? \n", "a. b"]
    for k in range(n):
        turn = None if rng.random() < 0.05 else rng.choice([k, k, k, k + 2, k - 1])
        text = rng.choice(texts) if rng.random() < 0.4 else f"turn {rng.random()}" + rng.choice([".", "!", "", "?\n"])
        yield conv_id, turn, rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[k % 2], text


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_parser_finds_the_least_of_all_edits(n):
    rng = random.Random(n)
    symbols = ["".join(s) for s in product(repairgrammar.ROWS, repeat=n)]
    for s in rng.sample(symbols, min(len(symbols), 60)):
        assert repairgrammar.best(repairgrammar.span_cells(s)) == exhaustive(s)


def test_spans_combine_however_they_are_divided():
    rng = random.Random(9)
    rows = rng.choices(list(repairgrammar.ROWS), k=101)
    whole = repairgrammar.span_cells("".join(rows))
    for cuts in ([1, 50], [33], [10, 20, 30, 99]):
        edges = [0, *cuts, len(rows)]
        parts = ["".join(rows[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        assert repairgrammar.join_spans(map(repairgrammar.span_cells, parts)) == whole


def test_repairs_match_a_search_over_all_edits(spark):
    rng = random.Random(4)
    rows = [r for c in range(60) for r in random_rows(rng, c - 3, rng.randint(1, 9))]
    rows += [r for r in random_rows(rng, None, 30)]
    rows += [r for r in random_rows(rng, 1000, 400)]
    # All rows of these are dropped, or there is but one.
    dropped = next(c for c in range(2000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Gone."), (5000, 7, "user", "Hi."), (5001, None, None, None)]
    rows += [(6000, 1, "user", "Same.")] * 9
    rng.shuffle(rows)
    got = {r[0]: tuple(r)[1:] for r in repaired(frame(spark, rows).repartition(3)).collect()}
    want = brute(rows)
    assert got == want
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_conversation_over_many_partitions_is_repaired_as_one(spark):
    rng = random.Random(8)
    rows = [r for r in random_rows(rng, 1, 600)] + [r for c in range(2, 40) for r in random_rows(rng, c, 4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fixed = dialogues.repair_conversations(damage(frame(spark, rows)))
        spread = fixed.rows.where("conv_id = 1").selectExpr("count(DISTINCT shiftright(place, 33))").first()[0]
        got = {r.conv_id: r.audit for r in fixed.report.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread > 1
    assert got == {c: x[-2] for c, x in brute(rows).items() if c in got}
    kept = fixed.rows.where("conv_id = 1").orderBy("place", "part").collect()
    assert LEGAL.match("".join(r.role[0] for r in kept))
    assert "".join(r.edit for r in kept) == got[1].replace("D", "")


def test_empty_table(spark):
    assert repaired(frame(spark, [])).count() == 0
    assert dialogues.repair_conversations(frame(spark, [])).rows.count() == 0


def test_very_long_text(spark):
    rows = [(1, 0, "user", "long " * 200_000 + "end."), (1, 1, "assistant", "Short.")]
    (row,) = dialogues.repair_conversations(frame(spark, rows)).report.collect()
    assert (row.cost, row.audit, row.truncated) == (0, "KK", 0)
