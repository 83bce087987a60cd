"""Repair of a conversation's structure by the cheapest edits, found by A* on the edit lattice.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Its rows are taken in
order and each is kept, given the role that fits (user or assistant), or deleted; rows without
text may be inserted anywhere. A blank row and one whose role and text were seen earlier must be deleted;
a row that ends without a closing mark costs more unless it is deleted. A lattice node is (rows read, state),
where the state says what the last role written was. A* takes nodes by (cost so far + heuristic,
edits so far); the heuristic is the suffix sum of what the remaining rows cost in any case, the
deletions that are required and the charge that a truncated row can't avoid. No step costs less
than it lowers the heuristic, so the first time a node is taken is the best, and of equal
costs the least string of edits. (Two ways to a node read the same rows, so one string can be the beginning of
the other only by more insertions, that is at another cost. Hence order never changes when more edits follow.)

No task holds a whole conversation while edits are sought. Rows are sorted by range and numbered over
the whole table, and every ``BLOCK`` numbers are a block; each part of a conversation in one
block is solved for each state that it may begin in, and a conversation's parts are then
put together in order, best cost and string for each state. The edits and the digest of a conversation
are one value each, so what they are made of meets in one row.

Defined cases: in ``damage`` nulls are one space; in ``repair`` a null role or text is too. Rows are ordered by
turn, nulls first, then by role and text; repeated rows are rows of their own, so the second is
a duplicate. A role's initial is its first character, case counts, and one that is none of s, u
and a (an empty role has none) can't be kept. A null conversation id is a conversation like any other; other columns are
ignored; texts of any length are compared by their 128-bit digest; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, same, text_key
from .sharding import CRC_TABLE, crc_sql

BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS  # rows that are solved at once
KEY_CHARS = 64
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what was written last
FOLLOWS = (USER, USER, ASSISTANT, USER)  # by state: what an inserted or re-roled row becomes
CLOSING = ("", "II", "I", "")  # by state: the insertions that end a conversation
ROLES = ("", "system", "user", "assistant")
NOT_BLANK = r"[^\x20\x09-\x0D]"

Paths = dict[tuple[int, int], tuple[int, str]]


def damage(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` with the faults that a check sum of each row's id and turn picks."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(pick == 1, "").when(pick == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    times = F.when(pick == 0, 0).when(pick == 3, 2).otherwise(1)
    rows = turns.select("conv_id", "turn", F.when(pick == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), times.alias("times"))
    return rows.withColumn("time", F.explode(F.expr("slice(array(1, 2), 1, times)"))).drop("times", "time")


def number(turns: DataFrame) -> DataFrame:
    """The rows with ``place``, which rises with (conv_id, turn, role, text) over the whole table.

    Ranges are cut on the beginnings of roles and texts, so that the sample of keys that Spark takes is small however long texts are.
    """
    order = ["conv_id", "turn", "role", "text"]
    space = lambda name: F.coalesce(name, F.lit(" ")).alias(name)
    rows = turns.select("conv_id", "turn", space("role"), space("text"))
    rows = rows.repartitionByRange("conv_id", "turn", *(F.substring(c, 1, KEY_CHARS) for c in ("role", "text")))
    return materialize(rows.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))


def with_faults(numbered: DataFrame) -> DataFrame:
    """(conv_id, place, initial, fault): the first fault of each row, b, d or t, else a dash."""
    rows = numbered.select("conv_id", "place", "role", "text", text_key(F.col("text")).alias("key"))
    first = rows.groupBy("conv_id", "role", "key").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "key")), "first")
    last_mark = F.regexp_extract("text", rf"({NOT_BLANK})[\x20\x09-\x0D]*\z", 1)
    facts = rows.select(
        "conv_id",
        "place",
        "role",
        "key",
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("?").alias("initial"),
        F.when(~F.col("text").rlike(NOT_BLANK), "b").when(~last_mark.isin(".", "!", "?"), "t").otherwise("-").alias("mark"),
    )
    repeats = facts.join(first, same("conv_id") & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key")), "left")
    fault = F.when((F.col("mark") != "b") & (F.col("place") > F.col("first")), "d").otherwise(F.col("mark"))
    return repeats.select("conv_id", "place", "initial", fault.alias("fault"))


def search(initials: str, faults: str, entry: int) -> dict[int, tuple[int, str]]:
    """By state after the last row: least cost and, at that, least edits from state ``entry`` before the first."""
    n = len(initials)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if faults[i] in "bd" else min(TRUNCATED, DELETE) if faults[i] == "t" else 0)
    frontier = [(ahead[0], "", 0, entry)]
    taken: set[tuple[int, int]] = set()
    ends: dict[int, tuple[int, str]] = {}
    while frontier and len(ends) < len(FOLLOWS):
        bound, edits, i, state = heappop(frontier)
        if (i, state) in taken:
            continue
        taken.add((i, state))
        cost = bound - ahead[i]
        if i == n:
            ends[state] = cost, edits
            continue
        follows = FOLLOWS[state]
        steps = [(DELETE, "D", i + 1, state), (INSERT, "I", i, follows)]
        if faults[i] not in "bd":
            charge = TRUNCATED if faults[i] == "t" else 0
            steps.append((REROLE + charge, "R", i + 1, follows))
            if initials[i] == "s" and state == NOTHING:
                steps.append((charge, "K", i + 1, SYSTEM))
            elif initials[i] == ROLES[follows][0]:
                steps.append((charge, "K", i + 1, follows))
        for price, letter, j, after in steps:
            if (j, after) not in taken:
                heappush(frontier, (cost + price + ahead[j], edits + letter, j, after))
    return ends


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The ways through each part: a part that begins inside its block is the first of its conversation."""
    for batch in batches:
        ways = []
        for start, initials, faults in zip(batch["start"], batch["initials"], batch["faults"], strict=True):
            entries = range(4) if start % BLOCK == 0 else (NOTHING,)
            ways.append([(a, z, *found) for a in entries for z, found in search(initials, faults, a).items()])
        yield batch.assign(ways=ways)


def _join_parts(parts: list[Paths]) -> tuple[int, str, list[int]]:
    """Least cost, least edits and the states between the parts of a whole conversation."""
    best: dict[int, tuple[int, str, list[int]]] = {NOTHING: (0, "", [NOTHING])}
    for paths in parts:
        after: dict[int, tuple[int, str, list[int]]] = {}
        for (a, z), (cost, edits) in paths.items():
            if a in best:
                way = (best[a][0] + cost, best[a][1] + edits, [*best[a][2], z])
                if z not in after or way[:2] < after[z][:2]:
                    after[z] = way
        best = after
    return min((c + INSERT * len(CLOSING[q]), e + CLOSING[q], states) for q, (c, e, states) in best.items())


def _steps(start: int, initials: str, edits: str, state: int) -> Iterator[tuple[int, str, str | None]]:
    """(place, lines of the rows inserted before it, its role) of a part's rows; role is empty if kept, null if deleted."""
    row, before = 0, ""
    for letter in edits:
        if letter == "I":
            state = FOLLOWS[state]
            before += f"{ROLES[state]}:\n"
            continue
        if letter != "D":
            state = SYSTEM if letter == "K" and initials[row] == "s" else FOLLOWS[state]
        yield start + row, before, {"D": None, "K": "", "R": ROLES[state]}[letter]
        row, before = row + 1, ""


_FOLDED = """conv_id string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, closing string,
steps array<struct<place: long, before: string, role: string>>"""


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv, parts in zip(batch["conv_id"], batch["parts"], strict=True):
            paths = [{(w["entry"], w["exit"]): (w["cost"], w["edits"]) for w in p["ways"]} for p in parts]
            cost, audit, states = _join_parts(paths)
            initials, faults = ("".join(p[c] for p in parts) for c in ("initials", "faults"))
            steps = []
            for part, found, a, z in zip(parts, paths, states, states[1:], strict=False):
                steps += _steps(part["start"], part["initials"], found[a, z][1], a)
            closing = {"": "", "I": "assistant:\n", "II": "user:\nassistant:\n"}[CLOSING[states[-1]]]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
            rows.append((conv, *(faults.count(f) for f in "bdt"), illegal, cost, audit, closing, steps))
        names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "closing", "steps"]
        yield pd.DataFrame(rows, columns=names)


def cheapest_edits(numbered: DataFrame) -> DataFrame:
    """A row a conversation: counts of faults and illegal neighbours, cost, audit, steps (place, before, role), closing."""
    codes = F.sort_array(F.collect_list(F.struct("place", "initial", "fault")))
    parts = with_faults(numbered).groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(codes.alias("codes"))
    joined = lambda c: F.array_join(F.transform("codes", lambda x: x[c]), "")
    parts = parts.select(F.col("conv_id").cast("string"), F.col("codes")[0]["place"].alias("start"), joined("initial").alias("initials"), joined("fault").alias("faults"))
    kind = numbered.schema["conv_id"].dataType.simpleString()
    ways = "ways array<struct<entry: int, exit: int, cost: long, edits: string>>"
    solved = parts.mapInPandas(_solve, f"conv_id string, start long, initials string, faults string, {ways}")
    whole = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "initials", "faults", "ways"))).alias("parts"))
    return whole.mapInPandas(_fold, _FOLDED).withColumn("conv_id", F.col("conv_id").cast(kind))  # a string keeps all digits beside nulls


def rewrite(numbered: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, repaired): the lines ``role:text`` of each conversation after its edits, each with a line break."""
    steps = edits.select(F.explode("steps").alias("s")).select("s.place", "s.before", F.col("s.role").alias("new_role"))
    written = F.when(F.col("new_role").isNull(), "").otherwise(
        F.concat(F.coalesce(F.nullif("new_role", F.lit("")), "role"), F.lit(":"), "text", F.lit("\n"))
    )
    lines = numbered.join(steps, "place").select("conv_id", "place", F.concat("before", written).alias("lines"))
    return lines.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "lines"))), lambda x: x["lines"]), "").alias("repaired")
    )


def repair(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """A row for each ``conv_id`` of ``originals`` (or of ``turns``): what is wrong, the cheapest edits and the repaired conversation.

    Columns: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (lines joined by line breaks).
    """
    numbered = number(turns)
    edits = materialize(cheapest_edits(numbered))
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = numbered.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    own = {"conv_id": "_conv_id"}
    out = (originals if originals is not None else turns).select("conv_id").distinct()
    for part in (gaps, edits.drop("steps"), rewrite(numbered, edits)):
        out = out.join(part.withColumnsRenamed(own), same("conv_id"), "left").drop("_conv_id")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    repaired = F.coalesce(F.expr("substring(concat(repaired, closing), 1, length(concat(repaired, closing)) - 1)"), F.lit(""))
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), repaired.alias("repaired"))


def repair_digests(turns: DataFrame) -> DataFrame:
    """The conversations damaged, then repaired; the repaired lines as their SHA-256."""
    return repair(damage(turns), turns).select("*", F.sha2("repaired", 256).alias("repaired_sha256")).drop("repaired")


_CRC = crc_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")
_LAST = r"regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1, 's')"

# The lattice as a recursion over rows: at each row the best way to each state, insertions first.
ORACLE_SQL = f"""
with recursive crc_table as (select {CRC_TABLE} as crc_values), picked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC} % 20 as pick from conversations, crc_table
), damaged as (
  select conv_id, turn, if(pick = 4, 'user', role) as role,
    case pick when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from picked, (select unnest([1, 2]) as time) where pick <> 0 and time <= if(pick = 3, 2, 1)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, substr(role, 1, 1) as initial from damaged
), faulty as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
    when {_LAST} not in ('.', '!', '?') then 't' else '-' end as fault,
    lag(initial) over (partition by conv_id order by i) as before
  from placed
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'b') as blank,
    count(*) filter (where fault = 'd') as duplicate, count(*) filter (where fault = 't') as truncated,
    count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal, max(i) as n
  from faulty group by conv_id
), inserted(q, r, n, lines) as (values (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, 'user:\n'), (1, 2, 1, 'user:\n'),
  (3, 2, 1, 'user:\n'), (2, 3, 1, 'assistant:\n'), (0, 3, 2, 'user:\nassistant:\n'), (1, 3, 2, 'user:\nassistant:\n')
), edited(q, r, letter, initial, price) as (values (0, 0, 'D', null, 4), (1, 1, 'D', null, 4), (2, 2, 'D', null, 4), (3, 3, 'D', null, 4),
  (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
  (0, 2, 'R', null, 3), (1, 2, 'R', null, 3), (3, 2, 'R', null, 3), (2, 3, 'R', null, 3)
), walk(conv_id, i, q, best) as (
  select distinct conv_id, 0::bigint, 0, {{'cost': 0, 'audit': '', 'lines': ''}} from conversations
  union all
  select w.conv_id, f.i, e.r, min({{'cost': w.best.cost + 3 * s.n + e.price + if(e.letter <> 'D' and f.fault = 't', 3, 0),
    'audit': w.best.audit || repeat('I', s.n) || e.letter,
    'lines': w.best.lines || s.lines || case e.letter when 'D' then '' when 'K' then f.role || ':' || f.text || chr(10)
      else if(e.r = 2, 'user:', 'assistant:') || f.text || chr(10) end}})
  from walk w join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1 join inserted s on s.q = w.q join edited e on e.q = s.r
    and (e.initial is null or e.initial = f.initial) and (e.letter = 'D' or f.fault not in ('b', 'd'))
  group by w.conv_id, f.i, e.r
), ended as (
  select w.conv_id, min({{'cost': w.best.cost + 3 * s.n, 'audit': w.best.audit || repeat('I', s.n), 'lines': w.best.lines || s.lines}}) as best
  from walk w left join counted c on c.conv_id is not distinct from w.conv_id join inserted s on s.q = w.q
  where w.i = coalesce(c.n, 0) and s.r in (0, 3) group by w.conv_id
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, best.cost::bigint as cost, best.audit as audit, sha256(left(best.lines, greatest(length(best.lines) - 1, 0))) as repaired_sha256
from ended e left join counted c on c.conv_id is not distinct from e.conv_id
"""
