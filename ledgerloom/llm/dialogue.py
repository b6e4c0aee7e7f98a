"""Repair of the role order in conversations by a run-length dynamic program."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import let, ship_package, stored
from ledgerloom.operators.joins import lookup

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
_NEVER = 1 << 60

# What has been read so far of an order of roles (s?(ua)+)?: nothing, s, ..u, ..a.
_STATES = range(4)
_START, _SYSTEM, _USER, _ASSISTANT = _STATES
_ENDS = (_START, _ASSISTANT)
_ROLE = {_SYSTEM: "system", _USER: "user", _ASSISTANT: "assistant"}
# The state after the user or assistant row that may follow.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)

# Symbols of rows: D has to go, else the initial of the role, or x; capital if truncated.
_GONE = "D"

# The six ASCII white-space characters.
_BLANKS = " \t\n\x0b\x0c\r"

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _kept(state: int, symbol: str) -> int | None:
    """The state after a row that keeps its role, if it may follow."""
    initial = symbol.lower()
    if initial == "s":
        return _SYSTEM if state == _START else None
    return _NEXT[state] if initial == {_USER: "u", _ASSISTANT: "a"}[_NEXT[state]] else None


def _inserted(state: int, other: int) -> int:
    """The cost of the inserts that lead from one state to another."""
    cost = 0
    for _ in range(3):
        if state == other:
            return cost
        state, cost = _NEXT[state], cost + INSERT
    return _NEVER


def _row(symbol: str, state: int) -> dict[int, int]:
    """The costs of a row by the state after it."""
    costs = {state: DELETE}
    if symbol != _GONE:
        extra = TRUNCATED if symbol.isupper() else 0
        costs[_NEXT[state]] = REROLE + extra
        kept = _kept(state, symbol)
        if kept is not None:
            costs[kept] = min(extra, costs.get(kept, _NEVER))
    return costs


def _times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(
        tuple(min(_NEVER, *(a[i][k] + b[k][j] for k in _STATES)) for j in _STATES) for i in _STATES
    )


def _before(a: Matrix, costs: Vector) -> Vector:
    """The costs to go before what ``a`` stands for, from those after it."""
    return tuple(min(_NEVER, *(a[i][k] + costs[k] for k in _STATES)) for i in _STATES)


@lru_cache(maxsize=None)
def _power(symbol: str, bit: int) -> Matrix:
    """The transition of 2 ** ``bit`` equal rows, each after the inserts before it."""
    if bit:
        half = _power(symbol, bit - 1)
        return _times(half, half)
    inserts = tuple(tuple(_inserted(i, j) for j in _STATES) for i in _STATES)
    rows = tuple(tuple(_row(symbol, i).get(j, _NEVER) for j in _STATES) for i in _STATES)
    return _times(inserts, rows)


IDENTITY: Matrix = tuple(tuple(0 if i == j else _NEVER for j in _STATES) for i in _STATES)

# The costs to go after the last row.
AT_END: Vector = tuple(min(_inserted(i, e) for e in _ENDS) for i in _STATES)


def _bits(n: int) -> Iterator[int]:
    return (b for b in range(n.bit_length()) if n >> b & 1)


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, sum(1 for _ in rows)) for symbol, rows in groupby(symbols)]


def transition(symbols: str) -> Matrix:
    """The min-plus transition of a stretch of rows, run by run."""
    whole = IDENTITY
    for symbol, n in runs_of(symbols):
        for bit in _bits(n):
            whole = _times(whole, _power(symbol, bit))
    return whole


@lru_cache(maxsize=1 << 14)
def _choices(symbol: str, after: Vector) -> tuple[str, ...]:
    """For each state before a row, its cheapest edits given the costs to go after it.

    Letters of edits with the initial of the role that results, inserts first; the first in ASCII
    order of equally cheap ones.
    """
    before = _before(_power(symbol, 0), after)
    found = []
    for state in _STATES:
        inserts = ""
        while True:
            rest = before[state]
            if rest == DELETE + after[state]:
                found.append(inserts + "D-")
                break
            following = _NEXT[state]
            if rest == INSERT + before[following]:
                inserts += "I" + _ROLE[following][0]
                state = following
                continue
            extra = TRUNCATED if symbol.isupper() else 0
            kept = _kept(state, symbol)
            if kept is not None and rest == extra + after[kept]:
                found.append(inserts + "K" + _ROLE[kept][0])
            else:
                found.append(inserts + "R" + _ROLE[following][0])
            break
    return tuple(found)


def _state_after(state: int, edits: str) -> int:
    for letter, initial in zip(edits[::2], edits[1::2], strict=True):
        if letter != "D":
            state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[initial]
    return state


def unroll(symbols: str, after: Vector, starts: list[int]) -> list[tuple[list[str], int]]:
    """The edits of every row, and the state at the end, for some states at the start.

    Costs at the ends of runs come from powers of their transitions; inside a run they are rolled
    out row by row. Only differences of costs matter, so runs meet few different ones.
    """
    runs = runs_of(symbols)
    at_ends = [after]
    for symbol, n in reversed(runs):
        costs = at_ends[-1]
        for bit in _bits(n):
            costs = _before(_power(symbol, bit), costs)
        at_ends.append(costs)
    at_ends.reverse()
    found: list[tuple[list[str], int]] = [([], s) for s in starts]
    for (symbol, n), costs in zip(runs, at_ends[1:], strict=True):
        rows = []
        for _ in range(n):
            least = min(costs)
            costs = tuple(c - least for c in costs)
            rows.append(_choices(symbol, costs))
            costs = _before(_power(symbol, 0), costs)
        for choices in reversed(rows):
            for i, (edits, state) in enumerate(found):
                edits.append(choices[state])
                found[i] = (edits, _state_after(state, choices[state]))
    return found


def closing(state: int) -> str:
    """The inserts after the last row."""
    edits = ""
    while AT_END[state]:
        state = _NEXT[state]
        edits += "I" + _ROLE[state][0]
    return edits


def _flat(matrix: Matrix) -> list[int]:
    return [x for line in matrix for x in line]


def _transitions(symbols: pd.Series) -> pd.Series:
    return pd.Series([_flat(transition(s)) for s in symbols], dtype=object)


def _costs_to_go(transitions: pd.Series) -> pd.DataFrame:
    """The cost of a conversation, and the costs to go after each of its parts."""
    rows = []
    for parts in transitions:
        costs, after = AT_END, []
        for flat in reversed(parts):
            after.append(list(costs))
            costs = _before(tuple(tuple(int(x) for x in flat[4 * i : 4 * i + 4]) for i in _STATES), costs)
        rows.append((costs[_START], after[::-1]))
    return pd.DataFrame(rows, columns=["cost", "after"])


def _ends(symbols: pd.Series, after: pd.Series) -> pd.Series:
    """Per state at the start of a part the state at its end."""
    both = zip(symbols, after, strict=True)
    return pd.Series([[e for _, e in unroll(s, tuple(map(int, a)), list(_STATES))] for s, a in both], dtype=object)


def _edits(symbols: pd.Series, after: pd.Series, start: pd.Series, last: pd.Series) -> pd.Series:
    rows = []
    for s, a, q, final in zip(symbols, after, start, last, strict=True):
        [(edits, end)] = unroll(s, tuple(map(int, a)), [int(q)])
        rows.append([*edits, closing(end)] if final else edits)
    return pd.Series(rows, dtype=object)


def _ended(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS))


def conversation_key(conv_id: Column) -> Column:
    """The id as a text that is never null, for joins."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _rows(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column) -> DataFrame:
    """Different rows of the conversations with the number of their copies; ``conv`` is never null."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return (
        df.select(
            conversation_key(F.col(id_col)).alias("conv"),
            F.col(id_col).alias("conv_id"),
            F.col(turn_col).alias("turn"),
            shown(role_col).alias("role"),
            shown(text_col).alias("text"),
            copies.cast("bigint").alias("copies"),
        )
        .groupBy("conv", "conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )


def repair(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The cheapest edits that give each conversation an order of roles ``(s?(ua)+)?``.

    Rows are ordered by turn (nulls first), then role and text; a null role or text is one space.
    The first fault of a row counts: blank (nothing but ASCII white space), duplicate (role and text
    seen earlier), truncated (the last character that is no white space is none of ``.!?``). Blank
    rows and duplicates are deleted. A deletion costs 4, a row that becomes user or assistant 3, an
    inserted empty user or assistant row 3, and a truncated row that stays 3. Of equally cheap edits
    the first in ASCII order of their initials D, I, K, R counts. ``copies`` says how often a row stands there.

    Equal consecutive symbols of rows (initial and fault) are a run; its min-plus transition over the
    four states of the role order is raised to the run's length by cached binary powers. A long
    conversation is cut into parts where the sorted rows are dealt to partitions: the transitions of the parts
    give the costs to go at their ends, so each is unrolled on its own.

    Returns two DataFrames. Edits: ``conv_id``, ``conv``, ``part`` and ``place`` (the order inside
    the conversation), ``inserted`` (roles inserted before the row, or at the end), ``action`` (keep,
    rerole, delete, null at the end), ``role`` (as repaired), ``text``, ``copies`` (of a kept row all but the
    first are deleted). Summary: per conversation with rows ``conv_id``, ``conv``, ``gaps`` (turns missing
    between the first and last, null turns aside), ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours
    in no legal order) and ``cost``. All rows without id are one conversation, and an empty table gives no rows. Runs jobs when it is called.
    """
    ship_package(conversations.sparkSession)
    rows = _rows(conversations, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    said = [F.xxhash64(F.lit(seed), F.col("role"), F.col("text")).alias(k) for seed, k in ((1, "k1"), (2, "k2"))]
    rows = rows.withColumns(dict(zip(("k1", "k2"), said, strict=True)))
    moment = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = rows.groupBy("conv", "k1", "k2").agg(F.min(moment).alias("first"))
    order = ["conv", "turn", "role", "text"]
    ranged = lookup(rows, firsts, ["conv", "k1", "k2"], "inner").repartitionByRange(*order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "dialogue-rows")

    blank = F.length(_ended(F.col("text"))) == 0
    seen = ~moment.eqNullSafe(F.col("first"))
    cut = ~F.substring(_ended(F.col("text")), -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    inside = Window.partitionBy("part", "conv").orderBy("turn", "role", "text")
    placed = ranged.select(
        "conv", "conv_id", "part", "turn", "role", "text", "copies",
        F.row_number().over(inside).alias("place"),
        initial.alias("initial"),
        F.when(blank, "blank").when(seen, "duplicate").when(cut, "truncated").alias("fault"),
    )
    fault = F.col("fault")
    symbol = F.when(fault.isin("blank", "duplicate"), _GONE).when(fault == "truncated", F.upper(known)).otherwise(known)
    count = lambda kind, n: F.sum(F.when(fault.eqNullSafe(F.lit(kind)), n).otherwise(0))
    again = F.when(fault.isin("blank", "duplicate"), 0).otherwise(F.col("copies") - 1)
    parts = placed.withColumn("symbol", symbol).groupBy("part", "conv").agg(
        F.max("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("place", "symbol", "initial"))).alias("listed"),
        count("blank", F.col("copies")).alias("blank"),
        (count("duplicate", F.col("copies")) + F.sum(again)).alias("duplicate"),
        count("truncated", F.lit(1)).alias("truncated"),
        F.sum(F.col("copies") - 1).alias("again"),
    )
    illegal = let(
        F.col("listed.initial"),
        lambda i: F.size(
            F.filter(
                F.zip_with(F.slice(i, 1, F.size(i) - 1), F.slice(i, 2, F.size(i)), lambda a, b: F.concat(a, b)),
                lambda pair: ~pair.isin("su", "ua", "au"),
            )
        ),
    )
    parts = stored(
        parts.select(
            "part", "conv", "conv_id", "blank", "duplicate", "truncated", "again",
            F.array_join("listed.symbol", "").alias("symbols"),
            illegal.alias("illegal"),
            F.element_at("listed.initial", 1).alias("first"),
            F.element_at("listed.initial", -1).alias("last"),
        ),
        "dialogue-parts",
    )

    def per_conversation(of: DataFrame, *columns: str) -> DataFrame:
        return of.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", *columns))).alias("p"))

    joints = F.size(
        F.filter(
            F.zip_with(
                F.slice("p.last", 1, F.size("p") - 1), F.slice("p.first", 2, F.size("p")), lambda a, b: F.concat(a, b)
            ),
            lambda pair: ~pair.isin("su", "ua", "au"),
        )
    )
    go = F.pandas_udf(_costs_to_go, "cost bigint, after array<array<bigint>>")
    # As many entries per conversation as there are partitions that hold its rows.
    moved = parts.withColumn("matrix", F.pandas_udf(_transitions, "array<bigint>")("symbols"))
    whole = per_conversation(moved, "matrix", "first", "last").select(
        "conv", "p.part", go("p.matrix").alias("c"), joints.alias("joints")
    )
    whole = stored(whole.select("conv", "part", "c.cost", "c.after", "joints"), "dialogue-costs")
    after = whole.select("conv", F.inline(F.arrays_zip("part", "after")))
    known_after = parts.select("conv", "part", "symbols").join(after, ["conv", "part"])
    ends = known_after.withColumn("ends", F.pandas_udf(_ends, "array<int>")("symbols", "after"))
    step = lambda acc, p: F.concat(acc, F.array(F.element_at(p.ends, F.element_at(acc, -1) + 1)))
    starts = per_conversation(ends, "ends").select(
        "conv",
        F.inline(
            F.zip_with(
                "p",
                F.aggregate("p", F.array(F.lit(_START)), step),
                lambda p, s: F.struct(
                    p.part.alias("part"), s.alias("start"), (p.part == F.element_at("p", -1).part).alias("last")
                ),
            )
        ),
    ).where(F.col("part").isNotNull())
    edited = F.pandas_udf(_edits, "array<string>")
    edits = known_after.join(starts, ["conv", "part"]).select(
        "conv", "part", F.posexplode(edited("symbols", "after", "start", "last")).alias("place", "edits")
    )
    edits = edits.withColumn("place", F.col("place") + 1)
    done = edits.join(placed.drop("fault", "initial", "turn"), ["conv", "part", "place"], "left")
    letters = F.regexp_replace("edits", r"I.", "")
    action = F.substring(letters, 1, 1)
    roles = {r[0]: r for r in _ROLE.values()}
    named = lambda c: F.when(c == "u", roles["u"]).otherwise(roles["a"])
    inserts = F.transform(F.regexp_extract_all("edits", F.lit(r"I(.)"), F.lit(1)), named)
    changed = done.select(
        "conv_id", "conv", "part", "place",
        inserts.alias("inserted"),
        F.when(action == "K", "keep").when(action == "R", "rerole").when(action == "D", "delete").alias("action"),
        F.when(action == "R", named(F.substring(letters, 2, 1))).otherwise(F.col("role")).alias("role"),
        "text", "copies",
    )

    totals = parts.groupBy("conv").agg(
        F.max("conv_id").alias("conv_id"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "again")],
    )
    # Copies of a row are neighbours with the same initial.
    turns = ranged.groupBy("conv").agg(
        F.max("turn").cast("decimal(38,0)").alias("most"),
        F.min("turn").cast("decimal(38,0)").alias("least"),
        F.count_distinct("turn").alias("n"),
    )
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n"), F.lit(0)).try_cast("bigint")
    summary = totals.join(whole.select("conv", "cost", "joints"), "conv").join(turns, "conv").select(
        "conv_id", "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("joints") + F.col("again")).alias("illegal"),
        (F.col("cost") + DELETE * F.col("again") + 0).alias("cost"),
    )
    return changed, summary


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash per conversation, in one pass over rows in order."""
    conv, audit, digest = None, [], hashlib.sha256()
    found: list[tuple] = []
    started = False

    def put(role: str, text: str) -> None:
        nonlocal started
        digest.update((f"\n{role}:{text}" if started else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        started = True

    def as_batch() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [(), (), ()]
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in columns], names=["conv", "audit", "repaired_sha256"]
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv"] != conv:
                if conv is not None:
                    found.append((conv, "".join(audit), digest.hexdigest()))
                conv, audit, digest, started = row["conv"], [], hashlib.sha256(), False
            for role in row["inserted"]:
                audit.append("I")
                put(role, "")
            if row["action"]:
                audit.append(row["action"][0].upper())
                if row["action"] != "delete":
                    put(row["role"], row["text"])
                audit.append("D" * (row["copies"] - 1))
        yield as_batch()
    if conv is not None:
        found.append((conv, "".join(audit), digest.hexdigest()))
        yield as_batch()


def digests(edits: DataFrame) -> DataFrame:
    """``audit``, the initials of all edits, and ``repaired_sha256``, of the repaired ``role:text``
    lines, per ``conv``.

    A hash over a whole conversation can only be made from its first row to its last, so the rows of
    a conversation pass through one task, in order, a batch at a time.
    """
    ship_package(edits.sparkSession)
    narrow = edits.select("conv", "part", "place", "inserted", "action", "role", "text", "copies")
    in_order = narrow.repartition("conv").sortWithinPartitions("conv", "part", "place")
    return in_order.mapInArrow(_digested, "conv string, audit string, repaired_sha256 string")


def damaged(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Conversations with faults dealt out by the checksum of ``id:turn``: rows lost, emptied, without
    ends of sentences, doubled (``copies`` 2) or turned to user. Nulls count as one space.

    Columns: ``conv_id``, ``turn``, ``role``, ``text``, ``copies``.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown(id_col), F.lit(":"), shown(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown(text_col), "[.!?]", ""))
    rows = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, "user").otherwise(shown(role_col)).alias("role"),
        text.otherwise(shown(text_col)).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("_kind"),
    )
    return rows.where(F.col("_kind") != 0).drop("_kind")


def _oracle() -> str:
    def add(value: str, cost: str | int, letters: str) -> str:
        """Nine digits of the cost before the letters, so that the least text is the cheapest."""
        return f"lpad((left({value}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || '{letters}'"

    user = f"least(u, {add('e', INSERT, 'Iu')}, {add('s', INSERT, 'Iu')}, {add('a', INSERT, 'Iu')})"
    assistant = f"least(a, {add('u', INSERT, 'Ia')}, {add('e', 2 * INSERT, 'IuIa')}, {add('s', 2 * INSERT, 'IuIa')})"
    gone = {q: add(q, DELETE, "D-") for q in "esua"}
    stays = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    kept = lambda q, to: f"CASE WHEN initial = '{to}' AND stays THEN {add(q, stays, 'K' + to)} END"
    turned = lambda q, to: f"CASE WHEN stays THEN {add(q, f'{REROLE} + {stays}', 'R' + to)} END"
    before_user = "least(e, s, a)"
    return rf"""
WITH RECURSIVE x AS (
    SELECT conv_id, coalesce(conv_id::VARCHAR, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
y AS (
    SELECT *, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
        lambda sum, b: list_reduce(
            list_prepend(xor(sum, b), range(8)),
            lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))) % 20 AS kind
    FROM x
),
d AS (
    SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM y WHERE kind <> 0
),
o AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS time,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended, left(role, 1) AS initial
    FROM d
),
f AS (
    SELECT *, fault IS NULL OR fault = 'truncated' AS stays FROM (
        SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
                       WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
               lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
        FROM o)
),
p AS (
    SELECT DISTINCT conv, 0::BIGINT AS i, '000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM d
    UNION ALL
    SELECT conv, i, {gone['e']}, least({gone['s']}, {kept('e', 's')}),
           least({gone['u']}, {kept(before_user, 'u')}, {turned(before_user, 'u')}),
           least({gone['a']}, {kept('u', 'a')}, {turned('u', 'a')})
    FROM (
        SELECT p.conv, f.i, initial, stays, fault, e, s, {user} AS u, {assistant} AS a
        FROM p JOIN f ON f.conv = p.conv AND f.i = p.i + 1)
),
b AS (
    SELECT conv, least(e, {assistant}) AS best FROM p QUALIFY i = max(i) OVER (PARTITION BY conv)
),
l AS (
    SELECT conv, k, substr(best, 8 + 2 * k, 1) AS letter, substr(best, 9 + 2 * k, 1) AS initial,
           sum(CASE WHEN substr(best, 8 + 2 * k, 1) <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY k) AS i
    FROM (SELECT *, unnest(range(1, (length(best) - 9) // 2 + 1)) AS k FROM b)
),
r AS (
    SELECT l.conv, string_agg(letter, '' ORDER BY k) AS audit,
           string_agg(CASE WHEN letter IN ('I', 'R') THEN CASE l.initial WHEN 'u' THEN 'user' ELSE 'assistant' END ELSE role END
                      || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k)
               FILTER (letter <> 'D') AS repaired
    FROM l LEFT JOIN f ON f.conv = l.conv AND f.i = l.i GROUP BY l.conv
),
g AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM f GROUP BY conv
)
SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM x) x
LEFT JOIN g ON g.conv = x.conv LEFT JOIN b ON b.conv = x.conv LEFT JOIN r ON r.conv = x.conv
"""


ORACLE = _oracle()
