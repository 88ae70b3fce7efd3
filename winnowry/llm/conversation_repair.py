"""Conversation structure repair by the auction algorithm for shortest paths.

The turns of a conversation, in order, span a lattice: a node is a place between
two turns together with the role that came last, and arcs are edits of whole
cost: keep a turn (0), give it the other role (2), delete it (3), insert an empty
turn (2); keeping a turn that breaks off costs one more. Wanted is the cheapest
way to roles of the form ``(system? (user assistant)+)?``.

Every node has a price. A path grows from its origin over the arc of least cost
plus price (extension); where that is more than the node's own price, the price
rises to it and the path steps back (contraction). Prices never exceed what the
arcs allow, so a path that arrives has the length its origin's price says.
Places are taken from the last to the first: prices behind a place are final, a
path ends when it meets one of them, and the new place's prices start at the least
of them. Arcs whose cost is exactly the difference of prices are tight; every
cheapest repair runs along tight arcs, and following the least letter at each node
gives the least of them. A place depends on its turn and on the differences of the
prices behind it alone, of which there are few, so those are solved once and kept.

Turns are ordered by ``turn`` (nulls first), then role, then a hash of the text;
equal turns lie side by side. Null roles and texts are one space: such a text is
blank, such a role is neither system, user nor assistant. A null conversation
id is a conversation of its own. An empty table gives no rows.

Turns reach a task sorted and are passed through: what is held of a conversation
is a reference per turn and its audit, which is one cell of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.staging import stage

DELETE, INSERT, KEEP, REROLE = "DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
BREAKS_OFF = 1
SPACES = "\t\n\v\f\r "

#: What came last: nothing, system, user, assistant; which may follow; which role is put in next.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {SYSTEM: (NOTHING,), USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
ENDS = (NOTHING, ASSISTANT)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

# a turn in one number: its initial, and these
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16

Arc = tuple[str, int, bool, int]  # letter, cost, whether it uses the turn up, what came last then


def _arcs(last: int, code: int | None) -> list[Arc]:
    """Edits at a place where ``last`` came last, the letters in order; no turn is left where ``code`` is None."""
    arcs = [(INSERT, COSTS[INSERT], False, NEXT[last])]
    if code is None:
        return arcs + ([("", 0, True, NOTHING)] if last in ENDS else [])
    arcs.append((DELETE, COSTS[DELETE], True, last))
    if not code & (BLANK | DUPLICATE):
        more, initial = BREAKS_OFF if code & TRUNCATED else 0, code & 3
        arcs.append((REROLE, COSTS[REROLE] + more, True, NEXT[last]))
        if initial and last in AFTER[initial]:
            arcs.append((KEEP, COSTS[KEEP] + more, True, initial))
    return sorted(arcs)


def auction(code: int | None, behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[Arc, ...]]:
    """Prices of the four nodes of a place, and the tight arc of least letter of each.

    ``behind`` are the final prices past the turn: shortest distances to the end.
    """
    arcs = [_arcs(last, code) for last in range(4)]
    price = [min(behind)] * 4  # no node is nearer: every way leads past the turn
    final = [False] * 4

    def reach(arc: Arc) -> int:
        return arc[1] + (behind[arc[3]] if arc[2] else price[arc[3]])

    for origin in range(4):
        path = [origin]
        while not final[path[-1]]:
            end = path[-1]
            best = min(arcs[end], key=reach)
            if price[end] < reach(best):
                price[end] = reach(best)
                if len(path) > 1:
                    path.pop()
            elif best[2]:
                break
            else:
                path.append(best[3])
        for node in path:
            final[node] = True
    tight = tuple(next(arc for arc in arcs[n] if reach(arc) == price[n]) for n in range(4))
    return tuple(price), tight


@dataclass
class Repairer:
    """Places already solved, by their turn and the differences of the prices behind it."""

    solved: dict = field(default_factory=dict)

    def place(self, code: int | None, behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[Arc, ...]]:
        key = code, behind
        if key not in self.solved:
            self.solved[key] = auction(code, behind)
        return self.solved[key]

    def repair(self, codes: bytes) -> tuple[int, str]:
        """Cost and audit of the cheapest repair, the least audit of several."""
        least, (price, tight) = 0, self.place(None, (0, 0, 0, 0))
        places = [tight]
        for code in reversed(codes):
            low = min(price)
            least += low
            price, tight = self.place(code, tuple(p - low for p in price))
            places.append(tight)
        letters, last, at = [], NOTHING, len(places) - 1
        while True:
            letter, _, onwards, last = places[at][last]
            letters.append(letter)
            if onwards:
                at -= 1
                if at < 0:
                    return least + price[NOTHING], "".join(letters)


# --- columns of a turn ----------------------------------------------------------

def _told_apart() -> list[Column]:
    """Order of the turns of a conversation."""
    return [F.asc_nulls_first("turn"), F.col("role"), F.col("h1"), F.col("h2")]


def read_turns(turns: DataFrame) -> DataFrame:
    """The four columns with nulls replaced, and two hashes of the text."""
    given = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    return given.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(71), "text")})


def coded_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, code)`` sorted by conversation within tasks; no text is shuffled.

    A turn's first fault counts: blank, then equal to an earlier turn, then without a full stop.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    letter = F.substring("role", 1, 1)
    initial = F.coalesce(*[F.when(letter == k, F.lit(v)) for k, v in INITIALS.items()], F.lit(0))
    narrow = read_turns(turns).select(
        "conv_id", "turn", "role", "h1", "h2", initial.alias("initial"), (end == "").alias("blank"),
        F.substring(end, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    seen = F.row_number().over(
        Window.partitionBy("conv_id", "role", "h1", "h2").orderBy(F.asc_nulls_first("turn"))
    )
    fault = F.when(F.col("blank"), BLANK).when(F.col("seen") > 1, DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(0)
    return (
        narrow.repartition("conv_id").withColumn("seen", seen)
        .sortWithinPartitions("conv_id", *_told_apart(), "seen")
        .select("conv_id", "turn", (F.col("initial") + fault).cast("int").alias("code"))
    )


AUDIT = (
    "conv_id bigint, turns bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string"
)
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_START = object()


class _Tally:
    """What is known of a conversation after some of its turns."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.codes = conv_id, bytearray()
        self.first = self.last = None
        self.distinct = 0

    def add(self, turn: int | None, code: int) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1

    def row(self, repairer: Repairer) -> tuple:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        initials = (codes & 3).tolist()
        cost, audit = repairer.repair(bytes(self.codes))
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        illegal = sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))
        faults = [int(np.count_nonzero(codes & f)) for f in (BLANK, DUPLICATE, TRUNCATED)]
        return self.conv_id, len(codes), gaps, *faults, illegal, cost, audit


def audit_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: its turns and faults, and cost and audit of its repair.

    ``turns`` holds ``(conv_id, turn, role, text)``; the result is written down and read back.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, open_one, done = Repairer(), None, []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(schema)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            for conv_id, turn, code in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if open_one is None or conv_id != open_one.conv_id:
                    if open_one is not None:
                        done.append(open_one.row(repairer))
                    open_one = _Tally(conv_id)
                open_one.add(turn, code)
            yield rows()
        if open_one is not None:
            done.append(open_one.row(repairer))
            yield rows()

    schema = pa.schema([
        (name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split() for c in AUDIT.split(", "))
    ])
    return stage(coded_turns(turns).mapInArrow(per_task, AUDIT), "audits")


def edited(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Repaired ``(role, text)`` of a conversation: its turns after the edits of the audit."""
    last = NOTHING
    for letter in audit:
        if letter == INSERT:
            last = NEXT[last]
            yield ROLES[last], ""
            continue
        role, text = next(turns)
        if letter == REROLE:
            last = NEXT[last]
            yield ROLES[last], text
        elif letter == KEEP:
            last = INITIALS[role[0]]
            yield role, text


REPAIRED = "conv_id bigint, place bigint, role string, text string"
ROWS_AT_ONCE = 1_000


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the repaired conversations, places from 0.

    A conversation's audit comes before its turns, so turns are edited as they
    pass; the rows of a conversation come out of one task, in order.
    """
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
        F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"), F.col("audit").alias("text"),
    )
    bodies = read_turns(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h1", "h2", "text")
    ordered = (
        heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_told_apart())
        .select("conv_id", "kind", "role", "text")
    )

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        flow = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(4))))
        head = next(flow, None)
        while head is not None:
            conv_id, following = head[0], [None]

            def own() -> Iterator[tuple[str, str]]:
                for row in flow:
                    if row[1] == 0:
                        following[0] = row
                        return
                    yield row[2], row[3]

            own_turns = own()
            for place, (role, text) in enumerate(edited(head[3], own_turns)):
                yield conv_id, place, role, text
            for _ in own_turns:
                raise ValueError(f"conversation {conv_id} has more turns than its audit")
            head = following[0]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in conversations(batches):
            rows.append(row)
            if len(rows) == ROWS_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return ordered.mapInArrow(per_task, REPAIRED)


def digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of ``role:text`` lines, from rows as ``repaired_turns`` gives them."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = _START, None
        ids, found = [], []

        def close() -> None:
            if digest is not None:
                ids.append(current)
                found.append(digest.hexdigest())

        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if current is _START or conv_id != current:
                    close()
                    current, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["conv_id", "repaired_sha256"])
            ids, found = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(per_task, "conv_id bigint, repaired_sha256 string")


# --- the query ------------------------------------------------------------------

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by the hash of their id and turn: dropped, emptied, stripped of full stops, repeated, made the user's."""
    spelled = [F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    number = F.pmod(F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    hit = conversations.select(
        "conv_id", "turn", number.alias("number"), role.alias("role"), text.alias("text")
    ).where("number <> 0")
    number = F.col("number")
    return hit.select(
        "conv_id", "turn", F.when(number == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(number == 1, F.lit("")).when(number == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(number == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation's faults after damage, the audit of its repair, and a digest of what the repair gives."""
    turns = damaged(conversations)
    audits = audit_turns(turns)
    found = digests(repaired_turns(turns, audits))
    ids = conversations.select(F.col("conv_id").cast("bigint")).distinct().alias("i")
    same = lambda other: F.col("i.conv_id").eqNullSafe(F.col(f"{other}.conv_id"))
    return ids.join(audits.alias("a"), same("a"), "left").join(found.alias("d"), same("d"), "left").select(
        "i.conv_id", *[F.coalesce(F.col(f"a.{c}"), F.lit(0).cast("bigint")).alias(c) for c in COUNTS],
        F.coalesce("a.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same rows by a recursive query: least (cost, audit) per role that came last, turn by turn."""

    def edit(state: str, letter: str, cost: str, line: str = "") -> str:
        text = f"CASE WHEN {state}.t = '' THEN {line} ELSE {state}.t || chr(10) || {line} END" if line else f"{state}.t"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'p': {state}.p || '{letter}', 't': {text}}} END"

    def least(*choices: str) -> str:
        return f"list_min([{', '.join(choices)}])"

    def where(condition: str, choice: str) -> str:
        return f"CASE WHEN {condition} THEN {choice} END"

    kept, own = "NOT gone", "role || ':' || text"
    keep = lambda state, initial: where(f"{kept} AND initial = '{initial}'", edit(state, "K", "cut", own))
    rerole = lambda state, role: where(kept, edit(state, "R", "2 + cut", f"'{role}:' || text"))
    u_in = least("u", *[edit(s, "I", "2", "'user:'") for s in ("b", "s", "a")])
    a_in = least("a", edit("u2", "I", "2", "'assistant:'"))
    state = "STRUCT(c BIGINT, p VARCHAR, t VARCHAR)"
    return f"""
WITH RECURSIVE polynomial AS (
  SELECT list(list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) ORDER BY i) AS remainders
  FROM range(256) AS t(i)
), numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda s: CAST(ord(s) AS BIGINT)),
      lambda crc, byte: xor(crc >> 8, remainders[xor(crc & 255, byte) + 1]), 4294967295), 4294967295) % 20 AS number
  FROM conversations, polynomial
), damaged AS (
  SELECT conv_id, turn, CASE WHEN number = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN number = 1 THEN '' WHEN number = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN number = 3 THEN 2 ELSE 1 END)) FROM numbered WHERE number <> 0)
), seen AS (
  SELECT *, rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS ending, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged
), faulty AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(ending, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS place FROM seen
), turns AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM faulty
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id
), walked AS (
  SELECT conv_id, 0 AS place, CAST({{'c': 0, 'p': '', 't': ''}} AS {state}) AS b, CAST(NULL AS {state}) AS s, CAST(NULL AS {state}) AS u, CAST(NULL AS {state}) AS a
  FROM counted
  UNION ALL
  SELECT conv_id, place, CAST({edit('b', 'D', '3')} AS {state}), CAST({least(edit('s', 'D', '3'), keep('b', 's'))} AS {state}),
    CAST({least(edit('u2', 'D', '3'), *[f for x in ('b', 's', 'a2') for f in (keep(x, 'u'), rerole(x, 'user'))])} AS {state}),
    CAST({least(edit('a2', 'D', '3'), keep('u2', 'a'), rerole('u2', 'assistant'))} AS {state})
  FROM (SELECT *, {a_in} AS a2 FROM (
    SELECT w.conv_id, t.place, b, s, u, a, t.role, t.text, t.gone, t.cut, t.initial, {u_in} AS u2
    FROM walked w JOIN turns t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.place = w.place + 1))
), ended AS (
  SELECT conv_id, {least('b', 'a2')} AS best FROM (SELECT *, {a_in} AS a2 FROM (
    SELECT w.conv_id, b, s, u, a, {u_in} AS u2 FROM walked w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.place = c.n))
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.p, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted c ON i.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON i.conv_id IS NOT DISTINCT FROM e.conv_id
"""


SQL = _sql()
