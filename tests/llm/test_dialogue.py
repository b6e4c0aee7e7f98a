"""Repaired conversations against a plain search over all edits, row by row."""

import hashlib
import random
import zlib
from collections import defaultdict

import cases
import oracle
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import dialogue as D
from ledgerloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def search(rows):
    """(cost, audit, repaired) of rows (initial, fault, role, text): all edits, the cheapest kept per state."""
    best = {"": (0, "", ())}

    def put(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                to = following[state]
                put(out, to, (cost + 3, audit + "I", (*lines, names[to] + ":")))
        return out

    for initial, fault, role, text in rows:
        new = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            put(new, state, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra, to = 3 * (fault == "truncated"), following[state]
                if initial == to or (initial == "s" and state == ""):
                    put(new, initial, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                put(new, to, (cost + 3 + extra, audit + "R", (*lines, f"{names[to]}:{text}")))
        best = new
    done = with_inserts(best)
    return min(done[state] for state in ("", "a") if state in done)


def brute(conversations, damage=False):
    convs = defaultdict(list)
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else -1
        rows = convs[conv]
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            ended = text.rstrip(" \t\n\x0b\x0c\r")
            repeated = (role, text) in seen
            seen.add((role, text))
            faults.append("blank" if not ended else "duplicate" if repeated else None if ended[-1] in ".!?" else "truncated")
        turns = {t for t, _, _ in rows if t is not None}
        starts = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:], strict=False))
        cost, audit, lines = search([(r[1][:1], f, r[1], r[2]) for r, f in zip(rows, faults, strict=True)])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repaired(df, **names):
    edits, summary = D.repair(df, **names)
    rows = summary.join(D.digests(edits), "conv").collect()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len({r.conv for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in numbers) for r in rows}


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_search(seed):
    """Costs by powers of runs, edits by unrolling; also in parts with each state at their start."""
    random.seed(seed)
    kinds = {"D": "blank", "s": None, "u": None, "a": None, "x": None}
    kinds |= {k.upper(): "truncated" for k in "suax"}
    for _ in range(150):
        symbols = "".join(random.choice("DsuaxSUAX") * random.choice([1, 1, 2, 9]) for _ in range(random.randint(0, 9)))
        rows = [(s.lower(), kinds[s], s.lower(), "t") for s in symbols]
        cost, audit, lines = search(rows)
        cut = random.randint(0, len(symbols))
        late = D._before(D.transition(symbols[cut:]), D.AT_END)
        assert D._before(D.transition(symbols), D.AT_END)[0] == cost == D._before(D.transition(symbols[:cut]), late)[0]
        first, middle = D.unroll(symbols[:cut], late, [0])[0]
        second, end = D.unroll(symbols[cut:], D.AT_END, [0, 1, 2, 3])[middle]
        edits = "".join([*first, *second, D.closing(end)])
        assert edits[::2] == audit
        assert "".join(edits[1::2]).replace("-", "") == "".join(line[0] for line in lines)


def test_powers_are_few():
    """A run of a million rows takes as many products as its length has bits."""
    D._power.cache_clear()
    assert D._before(D.transition("u" * 1_000_000), D.AT_END)[0] == 1_500_000
    assert D._power.cache_info().currsize <= 21


def random_conversations(n, longest, seed):
    random.seed(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Hi.", "Hi.", "Ho!", "cut", "", " \n", None, "Why?\t", "café 你.", "x.y"]
    rows = []
    for conv in range(n):
        for turn in range(random.randint(1, longest)):
            if random.random() < 0.9:
                text = random.choice([*texts, f"t{turn}.", f"t{turn}."])
                rows.append((conv, None if random.random() < 0.05 else turn, random.choice(roles), text))
    return rows + rows[:20] + [(None, 1, "user", "a."), (None, None, None, None), (None, 1, "assistant", "b.")]


def test_random_conversations(spark):
    rows = random_conversations(60, 14, 1)
    assert repaired(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_a_long_conversation_in_parts(spark, conf):
    """Sorted rows of one conversation over many partitions give the result of one."""
    conf({"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    random.seed(3)
    rows = [(7, t, random.choice(["user", "assistant", "system"]), random.choice(["a.", "b", f"{t}.", f"{t}", ""])) for t in range(900)]
    rows += [(c, t, "user", f"{t}.") for c in (6, 8) for t in range(40)] + rows[:30] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    edits, _ = D.repair(df)
    assert edits.where("conv_id = 7").select("part").distinct().count() >= 4
    assert repaired(df) == brute(rows)


def test_edits_hold_the_repaired_rows(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (1, 2, "user", "c"), (1, 3, "assistant", "d."), (1, 3, "assistant", "d.")]
    edits, _ = D.repair(spark.createDataFrame(rows, SCHEMA))
    got = [(r.inserted, r.action, r.role, r.text, r.copies) for r in edits.orderBy("part", "place").collect()]
    assert got == [
        ([], "rerole", "user", "a.", 1),
        ([], "keep", "assistant", "b.", 1),
        ([], "keep", "user", "c", 1),
        ([], "keep", "assistant", "d.", 2),
        ([], None, None, None, None),
    ]


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repaired(none) == {} and D.damaged(none).count() == 0
    rows = random_conversations(10, 6, 2)
    extra = "part int, place int, conv string, copies int, fault string, symbols string, first int"
    df = spark.createDataFrame([(*r, 1, 2, "c", 9, "f", "s", 3) for r in rows], f"{SCHEMA}, {extra}")
    assert repaired(df) == brute(rows)
    renamed = df.toDF("a", "b", "c", "d", *df.columns[4:])
    assert repaired(renamed, id_col="a", turn_col="b", role_col="c", text_col="d") == brute(rows)


def test_very_long_texts_and_turns(spark):
    rows = [(1, -(2**63), "user", " " * 300_000 + "a" + "\t" * 300_000), (1, 2**63 - 1, "assistant", "b." * 200_000)]
    got = repaired(spark.createDataFrame(rows, SCHEMA))
    assert got[1][1:] == brute(rows)[1][1:] and got[1][0] is None  # more turns missing than a long can say


def test_damage(spark):
    """The registered query's steps on tables with nulls, repeated rows and conversations of which nothing is left."""
    rows = random_conversations(80, 10, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    edits, summary = D.repair(D.damaged(df), copies=F.col("copies"))
    got = {r.conv_id: r for r in summary.join(D.digests(edits), "conv").collect()}
    expected = {c: v for c, v in brute(rows, damage=True).items()}
    for conv, values in expected.items():
        if conv in got:
            r = got[conv]
            assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == values
        else:
            assert values == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got) <= set(expected)


def test_query_against_search(spark):
    df = QUERIES["op11_dialogue"](spark, cases.SF)
    rows = oracle.connect(cases.SF).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == brute(rows, damage=True)
