"""Conversation repair against a plain search, and its results on odd rows."""

import hashlib
import random
import re
import zlib

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import queries, repair

FOLDER = "/root/testdata/sf0.01"
COLUMNS = "conv_id long, turn long, role string, text string"
ROLES = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    out = []
    shown = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def last_sign(text):
    return text.rstrip(" \t\n\r\x0b\x0c")[-1:]


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not last_sign(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if last_sign(text) in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cost, audit and repaired rows, by extending (cost, audit) per row of roles written so far."""
    faults = plain_faults(rows)
    best = {"": (0, "", [])}  # what has been written, up to its last two initials

    def fits(written, role):
        return role[:1] != "" and written + role[:1] in ("s", "u", "su", "ua", "au")

    def insert(states):
        for _ in range(3):
            for key, (cost, audit, done) in list(states.items()):
                for role in ("user", "assistant"):
                    if fits(key, role):
                        new = (cost + 2, audit + "I", done + [f"{role}:"])
                        if role[0] not in states or new[:2] < states[role[0]][:2]:
                            states[role[0]] = new
        return states

    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def offer(key, value):
            if key not in new or value[:2] < new[key][:2]:
                new[key] = value

        for key, (cost, audit, done) in insert(best).items():
            offer(key, (cost + 3, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            if fits(key, role):
                offer(role[0], (cost, audit + "K", done + [f"{role}:{text}"]))
            for other in ("user", "assistant"):
                if fits(key, other):
                    offer(other[0], (cost + 2, audit + "R", done + [f"{other}:{text}"]))
        best = new
    ends = insert(best)
    return min((ends[k] for k in ("", "a") if k in ends), key=lambda v: v[:2])


def plain_report(rows, originals):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = []
    for conv in {r[0] for r in originals}:
        mine = sorted(
            convs.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest())
        )
        turns = {t for t, _, _ in mine if t is not None}
        faults = plain_faults(mine)
        cost, audit, done = plain_repair(mine)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
            cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def exhaustive(kinds):
    """Least (cost, audit) by trying every edit of every row, up to two inserts in each gap."""
    best = []

    def go(k, roles, cost, audit):
        if k == len(kinds):
            for i in range(3):
                for extra in {0: [""], 1: ["a"], 2: ["ua"]}[i]:
                    if ROLES.fullmatch(roles + extra):
                        best.append((cost + 2 * i, audit + "I" * i))
            return
        initial, must, truncated = kinds[k]
        for extra in ("", "u", "a", "ua", "au"):
            c, a, r = cost + 2 * len(extra), audit + "I" * len(extra), roles + extra
            go(k + 1, r, c + 3, a + "D")
            if not must:
                go(k + 1, r + initial, c + truncated, a + "K")
                go(k + 1, r + "u", c + 2 + truncated, a + "R")
                go(k + 1, r + "a", c + 2 + truncated, a + "R")

    go(0, "", 0, "")
    return min(best)


KIND = st.tuples(st.sampled_from("sua?"), st.booleans(), st.booleans())


@settings(max_examples=25, deadline=None)
@given(kinds=st.lists(KIND, max_size=3))
def test_paths_against_all_edits(kinds):
    cost, slots = repair.least(repair.block(tuple(kinds)))
    assert (cost, slots.translate(repair.LETTERS)) == exhaustive(kinds)


@settings(max_examples=60, deadline=None)
@given(kinds=st.lists(KIND, min_size=2, max_size=40), cut=st.integers(1, 39), n=st.integers(1, 9))
def test_stretches_combine(kinds, cut, n):
    cut = min(cut, len(kinds) - 1)
    whole = repair.block(tuple(kinds))
    assert repair.combined(repair.block(tuple(kinds[:cut])), repair.block(tuple(kinds[cut:]))) == whole
    assert repair.power(repair.block(tuple(kinds[:2])), n) == repair.block(tuple(kinds[:2]) * n)
    path = repair.Stretch()
    for kind in kinds * n:
        path.add(kind)
    assert path.whole() == repair.block(tuple(kinds * n))


@pytest.mark.parametrize("parts", [1, 8])
def test_query_against_plain_version(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        have = cases.pairs(queries.QUERIES["op11_conversation_repair"](spark, FOLDER), "*")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert have == plain_report(plain_damage(rows), rows)


def table(spark, rows):
    clash = {c: F.lit(c) for c in (*cases.CLASHING, "conv", "at", "n", "first", "slots", "fault", "copy", "blank", "open", "a`b")}
    return spark.createDataFrame(rows, COLUMNS).withColumns(clash)


def odd_turns():
    rng = random.Random(3)
    rows = [
        (1, None, "user", "Hi."), (1, None, "assistant", "x"), (1, 0, None, None), (1, 3, "tool", "T!"), (1, 3, "user", "Hi."),
        (2, 1, "system", "Be."), (2, 2, "", "q?"), (2, 2, "", "q?"), (None, 1, "user", "a. \n"), (None, 2, "assistant", "b. "),
        (3, 0, "user", "　"), (4, 5, "assistant", "long " * 30_000 + "."), (5, None, None, None), (6, -(2**40), "user", "Yes."), (6, 2**40, "s", "no?"),
    ]
    # One long conversation with many copies of a few rows.
    rows += [(7, rng.randint(0, 40), rng.choice(["user", "assistant"]), rng.choice(["A.", "B", "C!"])) for _ in range(900)]
    rows += [(7, 9, "assistant", "A.")] * 300
    return rows + [(8, k, rng.choice(["user", "assistant", "system"]), f"text {rng.random()}.") for k in range(500)]


def test_odd_rows(spark):
    rows = odd_turns()
    found = repair.repair_report(table(spark, rows).repartition(7), table(spark, rows))
    shown = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert cases.pairs(found, "*") == plain_report(shown, rows)


def test_repaired_turns_follow_the_grammar(spark):
    reports, turns = repair.repair(table(spark, odd_turns()))
    written = {}
    for row in sorted(turns.collect(), key=lambda r: (repr(r.conv_id), r.place)):
        written.setdefault(row.conv_id, []).append(row)
    for row in reports.collect():
        mine = written.get(row.conv_id, [])
        assert ROLES.fullmatch("".join(r.role[0] for r in mine))
        assert [r.place for r in mine] == list(range(len(mine)))
        assert "".join(r.edit for r in mine) == row.audit.replace("D", "")


def test_empty_tables(spark):
    nothing = table(spark, [])
    reports, turns = repair.repair(nothing)
    assert reports.count() == 0 and turns.count() == 0
    assert repair.repair_report(nothing, nothing).count() == 0
    dropped = repair.repair_report(nothing, table(spark, [(4, 1, "user", "x"), (None, 1, "user", "x")]))
    assert {tuple(r) for r in dropped.collect()} == {(k, 0, 0, 0, 0, 0, 0, "", repair.EMPTY) for k in (4, None)}
