"""Conversation structure repair with a square-root checkpointed DP.

A repaired conversation's role initials are ``(s?(ua)+)?``: four states. Going backwards,
each row turns the vector of least costs from its four states to the end into the one
before it. Only checkpoint vectors are kept: of a conversation, those between blocks of
4,096 rows, which come from the blocks' 4 x 4 cost matrices without looking at a row
again; inside a block of n rows, one every sqrt(n) rows. The walk forward recomputes the
vectors between two checkpoints and takes, of the edits that keep the cost tight, the
ASCII-least letter: the letter fixes the next state, so this gives the least audit.

Blocks are worked on by themselves, so one conversation may hold any share of the rows;
only its matrices (16 numbers a block) and its walk's four outcomes a block come together.
A walk starts in a state that is known only after the block before, so a block walks from
each state, and the outcomes are chained afterwards. The digest of a conversation is one
hash over all its text: its rows are streamed through one task, and none is held.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLOCK_BITS = 12  # rows of a block: 4,096
SALTS = 16       # a text that a conversation repeats meets its first place in so many parts
SPACE = r"\x20\x09-\x0D"

START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: The state after a user or assistant message has been put where only one of them can stand.
TURN = (USER, USER, ASSISTANT, USER)
#: The state after a row of a given initial is kept; None where it cannot stand.
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None),
        "-": (None, None, None, None)}
ROLE = {USER: "user", ASSISTANT: "assistant"}
END = (0, 6, 3, 0)            # inserts that complete each state
TAIL = ("", "II", "I", "")


def step(after: tuple, initial: str, fault: str) -> tuple:
    """Least costs before a row of this role initial and fault, inserts before it included."""
    costs = [4 + c for c in after]
    if fault not in "bd":
        more, kept = 3 if fault == "t" else 0, KEPT[initial]
        for s in range(4):
            costs[s] = min(costs[s], 3 + more + after[TURN[s]])
            if kept[s] is not None:
                costs[s] = min(costs[s], more + after[kept[s]])
    user = min(costs[USER], 3 + costs[ASSISTANT])
    return tuple(user if s == USER else min(costs[s], 3 + user) for s in range(4))


def matrix(initials: str, faults: str) -> list[int]:
    """Least cost through a block from each state (rows) to each state (columns)."""
    columns = []
    for t in range(4):
        vector = tuple(0 if s == t else NEVER for s in range(4))
        for kind in zip(reversed(initials), reversed(faults)):
            vector = step(vector, *kind)
        columns.append(vector)
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def walk(initials: str, faults: str, after: tuple, states) -> list[tuple[str, int]]:
    """From each of ``states``: the ASCII-least tight edits through the block and the state behind it."""
    n = len(initials)
    size = isqrt(n) + 1
    marks, vector = {n: after}, after
    for i in range(n - 1, -1, -1):
        vector = step(vector, initials[i], faults[i])
        if i % size == 0:
            marks[i] = vector
    paths: list[list[str]] = [[] for _ in states]
    at = list(states)
    for low in range(0, n, size):
        high = min(low + size, n)
        costs = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            costs.append(step(costs[-1], initials[i], faults[i]))
        costs.reverse()
        for p, path in enumerate(paths):
            s = at[p]
            for i in range(low, high):
                here, then, kept = costs[i - low], costs[i - low + 1], KEPT[initials[i]]
                more = 3 if faults[i] == "t" else 0
                while 4 + then[s] != here[s] and 3 + here[TURN[s]] == here[s]:
                    path.append("I")
                    s = TURN[s]
                if 4 + then[s] == here[s]:
                    path.append("D")
                elif kept[s] is not None and more + then[kept[s]] == here[s]:
                    path.append("K")
                    s = kept[s]
                else:
                    path.append("R")
                    s = TURN[s]
            at[p] = s
    return [("".join(path), s) for path, s in zip(paths, at)]


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the CRC-32 of ``conv_id:turn``, modulo 20:
    0 drops the row, 1 empties the text, 2 takes its ``.!?`` away, 3 repeats the row, 4 sets the
    role to user. Nulls count as one space there, and null roles and texts become one space."""
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain(conv_id), F.lit(":"), plain(turn)).cast("binary")) % 20
    return (rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), plain(role).alias("role"),
                        plain(text).alias("text"), kind.alias("kind"))
            .filter("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def _key():
    """A conversation's name as text, apart from all others also when null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, a number that grows along each conversation, in a written table."""
    order = ["key", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "id"]
    # the last column tells rows alike in all others apart, so that a range may end among them
    dealt = rows.withColumn("key", _key()).withColumn("id", F.monotonically_increasing_id())
    return cut(dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("id")
               .withColumn("at", F.monotonically_increasing_id()), "ordered")


def _coded(ordered: DataFrame) -> DataFrame:
    """``key, at, initial, fault`` of every row; faults are b(lank), d(uplicate), t(runcated) or '.'."""
    same = F.md5(F.concat(F.col("key"), F.lit("\n"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    ends = F.col("text").rlike(f"[.!?][{SPACE}]*+\\z")
    initial = F.substring("role", 1, 1)
    rows = ordered.select("key", "at", F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
                          blank.alias("blank"), ends.alias("ends"), same.alias("same"),
                          F.pmod("at", F.lit(SALTS)).alias("salt"))
    first = (rows.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("same", "first", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt")))
    fault = (F.when(F.col("blank"), "b").when(F.col("first") < F.col("at"), "d").when(~F.col("ends"), "t").otherwise("."))
    return rows.join(first, ["same", "salt"], "left").select("key", "at", "initial", fault.alias("fault"))


def _runs(df: DataFrame, order: list[str], func, schema: str) -> DataFrame:
    """``func(rows) -> result rows`` for each run of one ``key``: ``rows`` is an iterator over
    tuples of ``df``'s columns in ``order``, streamed from the Arrow batches and never held."""
    names = [f.split()[0] for f in schema.split(", ")]
    at = df.columns.index("key")

    def run(batches):
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        out, row = [], next(rows, None)
        while row is not None:
            key, following = row[at], []

            def one(row=row, key=key, following=following):
                while row is not None and row[at] == key:
                    yield row
                    row = next(rows, None)
                following.append(row)

            stream = one()
            for result in func(stream):
                out.append(result)
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=names).astype(object)
                    out = []
            for _ in stream:
                pass
            row = following[0]
        if out:
            yield pd.DataFrame(out, columns=names).astype(object)

    return df.repartition("key").sortWithinPartitions("key", *order).mapInPandas(run, schema)


def _edits(coded: DataFrame) -> DataFrame:
    """``key, block, state, faults, letters, cost``: for each block the state it begins in, its
    rows' faults, its edits (with the inserts that complete the conversation in its last one)
    and the least cost from there to the end."""
    row = F.struct("at", "initial", "fault")
    blocks = (coded.groupBy("key", F.shiftright("at", BLOCK_BITS).alias("block"))
              .agg(F.sort_array(F.collect_list(row)).alias("rows"))  # 4,096 at most
              .select("key", "block", F.array_join("rows.initial", "").alias("initials"),
                      F.array_join("rows.fault", "").alias("faults")))

    def through(batches):
        for batch in batches:
            batch["through"] = [matrix(i, f) for i, f in zip(batch["initials"], batch["faults"])]
            yield batch

    blocks = cut(blocks.mapInPandas(through, "key string, block long, initials string, faults string, through array<long>"),
                 "blocks")

    def checkpoints(rows):
        """From the last block to the first: the costs behind each."""
        vector, last = END, True
        for key, _, block, through_ in rows:
            yield key, block, list(vector), last
            vector = tuple(min(through_[4 * s + t] + vector[t] for t in range(4)) for s in range(4))
            last = False

    back = blocks.select("key", (-F.col("block")).alias("back"), "block", "through")
    behind = _runs(back, ["back"], checkpoints, "key string, block long, after array<long>, last boolean")

    def walks(batches):
        for batch in batches:
            out = []
            for key, block, initials, faults, after, last in batch[
                    ["key", "block", "initials", "faults", "after", "last"]].itertuples(index=False, name=None):
                vector = tuple(after)
                paths = walk(initials, faults, vector, range(4))
                for kind in zip(reversed(initials), reversed(faults)):
                    vector = step(vector, *kind)
                out.append((key, block, faults, [p + (TAIL[s] if last else "") for p, s in paths],
                            [s for _, s in paths], list(vector)))
            yield pd.DataFrame(out, columns=["key", "block", "faults", "paths", "states", "costs"])

    walked = (blocks.select("key", "block", "initials", "faults").join(behind, ["key", "block"])
              .mapInPandas(walks, "key string, block long, faults string, paths array<string>, states array<int>, costs array<long>"))

    def chain(rows):
        state = START
        for key, block, faults, paths, states, costs in rows:
            yield key, block, state, faults, paths[state], int(costs[state])
            state = int(states[state])

    return _runs(walked, ["block"], chain, "key string, block long, state int, faults string, letters string, cost long")


def _applied(rows, state: int, letters: str):
    """The edits of a block done to its rows: ``(letter, role, text, row)``; no role where a row goes."""
    for letter in letters:
        if letter == "I":
            state = TURN[state]
            yield letter, ROLE[state], "", None
            continue
        row = next(rows)
        if letter == "D":
            yield letter, None, None, row
        elif letter == "R":
            state = TURN[state]
            yield letter, ROLE[state], row[1], row
        else:
            state = KEPT[row[0][:1]][state]
            yield letter, row[0], row[1], row


def _with_edits(rows: DataFrame) -> DataFrame:
    """The rows of each block behind a row with the block's edits (``at`` null)."""
    ordered = _ordered(rows)
    edits = cut(_edits(_coded(ordered)), "edits")
    ahead = edits.select("key", "block", F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                         "state", "faults", "letters", "cost")
    return ahead.unionByName(ordered.select(
        "key", F.shiftright("at", BLOCK_BITS).alias("block"), "at", F.col("turn").cast("string").alias("turn"),
        "role", "text"), allowMissingColumns=True)


_COLUMNS = ["key", "block", "at", "turn", "role", "text", "state", "faults", "letters", "cost"]


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations of ``conv_id, turn, role, text`` rows: ``conv_id`` (as text),
    ``place`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I)."""
    def turns(stream):
        place = 0
        for head in stream:
            block = ((r[4], r[5]) for r in stream)
            for letter, role, text, _ in _applied(block, int(head[6]), head[8]):
                if role is not None:
                    yield head[0], place, role, text, letter
                    place += 1

    found = _runs(_with_edits(rows).select(*_COLUMNS), ["block", "at"], turns,
                  "key string, place long, role string, text string, edit string")
    return found.select(F.expr("CASE WHEN key <> 'null' THEN substr(key, 2) END").alias("conv_id"),
                        "place", "role", "text", "edit")


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each ``conv_id`` of ``conversations`` about its ``rows`` (``conv_id, turn, role,
    text``, as :func:`damage` gives them): ``gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``.

    Rows count in order of turn, nulls first; rows of one turn in order of their role, then
    of their text's hash. Null roles and texts are one space. Roles other than by initial s,
    u or a, the empty one too, cannot be kept. A null conv_id is a conversation. Repeated
    rows are duplicates. Conversations without rows give zeros, an empty audit and the hash
    of no text; an empty table gives no row. Only the four columns are looked at.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))

    def summary(stream):
        distinct = illegal = cost = 0
        low = high = key = before = None
        faults = {"b": 0, "d": 0, "t": 0}
        letters, digest, lines = [], hashlib.sha256(), 0

        def told(rows):
            nonlocal distinct, illegal, low, high, before
            for r in rows:
                if r[3] is not None:
                    turn = int(r[3])
                    low = turn if low is None else low
                    distinct += turn != high
                    high = turn
                if before is not None and before + r[4][:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = r[4][:1]
                yield r[4], r[5]

        for head in stream:
            if key is None:
                key, cost = head[0], int(head[9])
            for f in faults:
                faults[f] += head[7].count(f)
            letters.append(head[8])
            for _, role, text, _ in _applied(told(stream), int(head[6]), head[8]):
                if role is not None:
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
        gaps = high - low + 1 - distinct if high is not None else 0
        yield (key, gaps, faults["b"], faults["d"], faults["t"], illegal, cost, "".join(letters), digest.hexdigest())

    schema = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    found = _runs(_with_edits(rows).select(*_COLUMNS), ["block", "at"], summary, schema)
    every = conversations.select("conv_id").distinct().withColumn("key", _key())
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, "key", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
