"""Conversation repair: every edit by brute force, the contract by a plain loop, edge rows."""

import hashlib
import random
import re
import zlib
from heapq import heappop, heappush
from itertools import product

import pytest

from winnowry.llm import conversation_repair as cr
from winnowry.llm import queries

GOOD = re.compile(r"(s?(ua)+)?")
KIND = "conv_id bigint, turn bigint, role string, text string"


def brute(turns):
    """Least (cost, audit, rows) over all edits; ``turns`` are (role, text, must go, breaks off)."""
    best = None

    def walk(i, cost, audit, rows):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns):
            if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in rows)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, rows
        if audit[-2:] != "II":
            for role in ("user", "assistant"):
                walk(i, cost + 2, audit + "I", [*rows, (role, "")])
        if i < len(turns):
            role, text, gone, cut = turns[i]
            walk(i + 1, cost + 3, audit + "D", rows)
            if not gone:
                walk(i + 1, cost + cut, audit + "K", [*rows, (role, text)])
                for other in ("user", "assistant"):
                    walk(i + 1, cost + 2 + cut, audit + "R", [*rows, (other, text)])

    # an upper bound to start from: everything is deleted
    best = 3 * len(turns), "D" * len(turns), []
    walk(0, 0, "", [])
    return best


def searched(turns):
    """The same by a uniform-cost search over (turns done, last initial), for longer conversations."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, rows = heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if last == "end":
            return cost, audit, list(rows)
        if i == len(turns) and last in ("", "a"):
            heappush(heap, (cost, audit, i, "end", rows))
        edits = [("I", 2, i, role, "") for role in ("user", "assistant")]
        if i < len(turns):
            role, text, gone, cut = turns[i]
            heappush(heap, (cost + 3, audit + "D", i + 1, last, rows))
            if not gone:
                edits += [("K", cut, i + 1, role, text)] + [("R", 2 + cut, i + 1, r, text) for r in ("user", "assistant")]
        for letter, more, after, role, text in edits:
            if role and last + role[0] in ("s", "u", "su", "ua", "au"):
                heappush(heap, (cost + more, audit + letter, after, role[:1], (*rows, (role, text))))


def code(role, gone, cut):
    return cr.INITIALS.get(role[:1], 0) + (cr.BLANK if gone else 0) + (cr.TRUNCATED if cut and not gone else 0)


def test_repair_equals_brute_force():
    rnd, repairer = random.Random(5), cr.Repairer()
    kinds = [(r, f"{r}{g}{c}", g, c) for r in ("user", "assistant", "system", "tool", "") for g, c in ((0, 0), (0, 0), (1, 0), (0, 1))]
    samples = [list(p) for n in range(3) for p in product(kinds[:12:2] + kinds[3:12:4], repeat=n)]
    samples += [[rnd.choice(kinds) for _ in range(rnd.randint(3, 4))] for _ in range(40)]
    for turns in samples:
        cost, audit = repairer.repair(bytes(code(r, g, c) for r, _, g, c in turns))
        expected = brute(turns)
        assert searched(turns) == expected
        assert (cost, audit) == expected[:2], turns
        assert list(cr.edited(audit, iter([(r, t) for r, t, _, _ in turns]))) == expected[2]
    for n in (9, 40, 200):
        turns = [rnd.choice(kinds) for _ in range(n)]
        assert repairer.repair(bytes(code(r, g, c) for r, _, g, c in turns)) == searched(turns)[:2]
    assert len(repairer.solved) < 600


def test_prices_are_distances_and_paths_contract():
    """The prices of a place satisfy the auction's conditions and equal the shortest distances."""
    rnd = random.Random(1)
    for _ in range(500):
        behind = tuple(rnd.randint(0, 7) for _ in range(4))
        turn = rnd.choice([None, *range(4), 4, 17, 18, 19])
        price, tight = cr.auction(turn, behind)
        arcs = [cr._arcs(n, turn) for n in range(4)]
        distance = [min([a[1] + behind[a[3]] for a in arcs[n] if a[2]], default=99) for n in range(4)]
        for _ in range(4):
            distance = [min([distance[n]] + [a[1] + distance[a[3]] for a in arcs[n] if not a[2]]) for n in range(4)]
        assert list(price) == distance
        for n in range(4):
            reach = {a: a[1] + (behind[a[3]] if a[2] else price[a[3]]) for a in arcs[n]}
            assert min(reach.values()) == price[n] == reach[tight[n]]
            assert tight[n][0] == min(a[0] for a, r in reach.items() if r == price[n])


def test_a_long_conversation_is_linear():
    rnd = random.Random(2)
    cost, audit = cr.Repairer().repair(bytes(rnd.choice([1, 2, 3, 2 + 16, 3 + 4]) for _ in range(300_000)))
    assert sum(audit.count(x) for x in "DKR") == 300_000 and cost > 0


def plain(rows):
    """The contract, row by row."""
    spell = lambda v: " " if v is None else str(v)
    found = {}
    for conv, turn, role, text in rows:
        turns, n = found.setdefault(conv, []), zlib.crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        role, text = spell(role), spell(text)
        if n == 0:
            continue
        role, text = "user" if n == 4 else role, "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        turns += [(turn, role, text)] * (2 if n == 3 else 1)
    out = {}
    for conv, turns in found.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for turn, role, text in turns:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit, kept = searched(marked)
        known = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        out[conv] = counts | {
            "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, "cost": cost, "audit": audit,
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        }
    return out


def same(found, expected):
    assert len(found) == len(expected)
    for r in found:
        assert {k: r[k] for k in expected[r["conv_id"]]} == expected[r["conv_id"]], r


def test_query_equals_a_plain_loop(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(queries.op11_conversation_repair(spark, sf).collect(), plain(rows))


def test_edge_rows(spark):
    rows = [(i, t, role, text) for i in range(60) for t, role, text in (
        (i, "user", "Hi."), (i + 1, "assistant", "Yes! \t"), (i + 2, "user", "and\v"), (i + 2, "user", "and\v"), (i + 5, "assistant", None),
    )]
    rows += [(None, 1, "user", "A."), (None, None, None, "B."), (None, None, "user", None), (-1, None, "system", "S."), (-1, None, "tool", "x")]
    rows += [(-2, 1, "", "x."), (-3, 7, "user", "é" * 300_000 + "."), (-3, 8, "assistant", "… ."), (-4, 0, "System", " ")]
    rows += [(-5, 2**40, "user", "Q?"), (-5, -(2**40), "assistant", "Q?"), (-6, 3, "user", "a."), (-6, 3, "assistant", "b.")]
    turns = spark.createDataFrame([(*r, 0, "k", "h") for r in rows], KIND + ", place int, kind string, h1 string").repartition(5)
    expected = plain(rows)
    del expected[-6]  # tied turns of two roles come in the order of the roles
    found = cr.repair_report(turns).collect()
    same([r for r in found if r["conv_id"] != -6], expected)
    tied = [r for r in found if r["conv_id"] == -6][0]
    assert tied["gaps"] == 0 and tied["illegal"] <= 1
    empty = turns.limit(0)
    assert cr.repair_report(empty).count() == 0 and cr.audit_turns(empty).count() == 0
    assert cr.repaired_turns(empty, cr.audit_turns(empty)).count() == 0


def test_repaired_rows_are_conversations(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (2, 0, "system", "s."), (3, 4, "assistant", "c.")], KIND)
    rows = sorted(tuple(r) for r in cr.repaired_turns(turns, cr.audit_turns(turns)).collect())
    by_id = {i: [(r[2], r[3]) for r in rows if r[0] == i] for i in (1, 2, 3)}
    assert by_id == {1: [("user", "a."), ("assistant", "b.")], 2: [], 3: [("user", ""), ("assistant", "c.")]}


@pytest.mark.parametrize("n", [5000])
def test_one_conversation_holds_all_rows(spark, n):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(n)]
    turns = spark.createDataFrame(rows, KIND).repartition(8)
    audit = cr.audit_turns(turns).first()
    assert (audit["turns"], audit["cost"], audit["audit"]) == (n, 0, "K" * n)
    assert cr.repaired_turns(turns, cr.audit_turns(turns)).count() == n
