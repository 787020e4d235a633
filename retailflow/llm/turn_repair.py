"""Conversations repaired by alignment: turns are aligned to the strings of an alternating grammar, `(s?(ua)+)?` over the
initials of roles, at the least cost.

The turns of a block are aligned, as Wagner and Fischer do, to each feasible length of the grammar's string. Strings that
end alike share their suffixes, so that one table over (turns left, symbols left) serves all lengths. Ukkonen's band keeps
the cells that a path of at most the incumbent's cost can reach, the incumbent being what deletes and reroles alone cost.
Audits are backtraced for each length of the least cost and compared.

A conversation's turns are put in order by ranges, so that a long one is spread over tasks, and cut into blocks of at most
BLOCK turns. Where a conversation has more than one block, each block gives the costs from each state of the grammar to
each other, these are chained backward by a pass over sorted rows that holds four numbers, and the blocks' audits forward.
The repaired text is hashed as its rows go by, in order. No task holds more than a block of a conversation, beside the
conversation's audit, which is a value of the result.

Rows: a null counts as one space wherever a text, role, id or turn is read as text (in crc32, order and hash); turns sort
with nulls first, equal turns by role and text. A null conv_id is a conversation like others. A role of no letters ('') is
one that the grammar lacks: its turns are reroled or deleted. Repeats of one row in the input are turns like others, and
so duplicates of the first. Columns beyond those named are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

# Costs of the edits.
REROLE, DELETE, INSERT, UNENDED = 1, 2, 5, 5
BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS
_BIG = 1 << 60
#: States of the grammar: nothing yet, after s, after u, after a. What follows each, and the states it may end in.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_STATES = range(4)
_FINAL = (0, _BIG, _BIG, 0)
_NAMES = {"u": "user", "a": "assistant"}


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that are left, with the damage that crc32(`conv_id:turn`) % 20 names."""
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    role = F.when(kind == 4, "user").otherwise(_text("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", "")).otherwise(_text("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("n")).drop("n")


def in_order(turns: DataFrame) -> DataFrame:
    """turns with `pos`, which rises in the order of each conversation. A range of the order goes to each task, so that a
    conversation of any length is sorted by many; repeats of one row stay together. Ranges are told by short keys."""
    tie = F.concat(F.col("role"), F.lit("\0"), F.col("text"))
    keyed = turns.withColumn("tie", tie)
    ranged = keyed.repartitionByRange("conv_id", "turn", F.substring("tie", 1, 64)).sortWithinPartitions("conv_id", "turn", "tie")
    return cut(ranged.drop("tie").withColumn("pos", F.monotonically_increasing_id()), "turns")


def coded(turns: DataFrame) -> DataFrame:
    """conv_id, pos and one letter for each turn: b blank, d duplicate, or else the role's initial in the grammar (x: none),
    as a capital if the text is not ended. Digests alone are shuffled."""
    digest = F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    initial = F.left("role", F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    ended = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    code = F.when(trimmed == "", "b").when(ended, letter).otherwise(F.upper(letter))
    own = cut(turns.select("conv_id", "pos", code.alias("code"), digest.alias("digest")), "codes")
    first = own.groupBy("conv_id", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), "first")
    joined = own.join(first, own["conv_id"].eqNullSafe(first["c"]) & (own["digest"] == first["g"]), "left")
    later = (F.col("code") != "b") & (F.col("pos") > F.col("first"))
    return joined.select("conv_id", "pos", F.when(later, "d").otherwise(F.col("code")).alias("code"))


# ---- one block


class Alignment:
    """Turns of one block against all strings of the grammar that lead from a state to a state.

    codes: letters of coded(). left[q][i][r]: the least cost of turns i.. against the last r symbols of the alternating
    string that ends in state q (after u or after a); cells outside the band are unreachable.
    """

    def __init__(self, codes: str) -> None:
        self.n = len(codes)
        self.initial = codes.lower()
        self.gone = [c in "bd" for c in codes]
        self.extra = [UNENDED * (c in "SUAX") for c in codes]
        self.cost = self._incumbent()
        n, most = self.n, self.n + self.cost // INSERT
        r = np.arange(most + 1)
        self.left = {}
        for q in (AFTER_U, AFTER_A):
            ends_here = "u" if q == AFTER_U else "a"
            other = "a" if q == AFTER_U else "u"
            keeps = {c: np.where(r % 2 == 1, 0 if c == ends_here else REROLE, 0 if c == other else REROLE) for c in "suax"}
            table = np.full((n + 1, most + 1), _BIG, np.int64)
            table[n, : self.cost // INSERT + 1] = INSERT * r[: self.cost // INSERT + 1]
            for i in range(n - 1, -1, -1):
                lo, hi = max(0, n - i - self.cost // DELETE), min(most, n - i + self.cost // INSERT) + 1
                best = table[i + 1, lo:hi] + DELETE
                if not self.gone[i]:
                    at = max(lo, 1)
                    match = table[i + 1, at - 1 : hi - 1] + keeps[self.initial[i]][at:hi] + self.extra[i]
                    np.minimum(best[at - lo :], match, out=best[at - lo :])
                best = np.minimum.accumulate(best - INSERT * r[lo:hi]) + INSERT * r[lo:hi]
                table[i, lo:hi] = np.where(best > self.cost, _BIG, best)
            self.left[q] = table

    def _incumbent(self) -> int:
        """What it costs to delete each turn that must go or is not ended, to rerole the others in turn, and to mend the ends."""
        kept = [c for c, gone, extra in zip(self.initial, self.gone, self.extra, strict=True) if not gone and not extra]
        wrong = min(sum(c != "ua"[(k + s) % 2] for k, c in enumerate(kept)) for s in (0, 1))
        return DELETE * (self.n - len(kept)) + REROLE * wrong + 2 * INSERT

    def _symbol(self, q: int, r: int) -> str:
        return "au"[r % 2] if q == AFTER_U else "ua"[r % 2]

    def _lengths(self, entry: int, q: int, i: int) -> list[tuple[int, int]]:
        """(cost, r) of each length of string that may follow the entry state and end in q, for turns i.. ."""
        table = self.left[q][i]
        first = "a" if entry == AFTER_U else "u"
        return [(int(table[r]), r) for r in range(1, table.size) if table[r] < _BIG and self._symbol(q, r) == first]

    def _paths(self, entry: int) -> Iterator[tuple[int, int, int, int | None, int]]:
        """(cost, end state, r, turn kept as s or None, turn from which the table counts)."""
        yield DELETE * self.n, entry, 0, None, 0
        for q in (AFTER_U, AFTER_A):
            for cost, r in self._lengths(entry, q, 0):
                yield cost, q, r, None, 0
        if entry == START:
            for i, c in enumerate(self.initial):
                if c == "s" and not self.gone[i]:
                    before = DELETE * i + self.extra[i]
                    yield before + DELETE * (self.n - i - 1), AFTER_S, 0, i, i + 1
                    for q in (AFTER_U, AFTER_A):
                        for cost, r in self._lengths(AFTER_S, q, i + 1):
                            yield before + cost, q, r, i, i + 1

    def transfer(self) -> list[int]:
        """The least cost from each state (row) to each (column)."""
        out = [_BIG] * 16
        for p in _STATES:
            for cost, q, *_ in self._paths(p):
                out[4 * p + q] = min(out[4 * p + q], cost)
        return out

    def _trace(self, q: int, r: int, i: int) -> str:
        """The least audit of turns i.. against r symbols: at each step the least letter that the table allows."""
        table, out = self.left[q], []
        while i < self.n or r:
            now = table[i, r]
            if i < self.n and table[i + 1, r] + DELETE == now:
                out.append("D")
                i += 1
                continue
            if r and table[i, r - 1] + INSERT == now:
                out.append("I")
                r -= 1
                continue
            out.append("K" if self.initial[i] == self._symbol(q, r) else "R")
            i, r = i + 1, r - 1
        return "".join(out)

    def audit(self, entry: int, after: tuple[int, ...]) -> tuple[int, str, int]:
        """Cost, least audit and end state of the cheapest edits, `after` being the cost to go on from each state."""
        paths = [(cost + after[q], q, r, kept, i) for cost, q, r, kept, i in self._paths(entry) if after[q] < _BIG]
        if not paths:
            return _BIG, "", entry
        least = min(p[0] for p in paths)
        found = []
        for cost, q, r, kept, i in paths:
            if cost == least:
                head = "" if kept is None else "D" * kept + "K"
                found.append((head + (self._trace(q, r, i) if r else "D" * (self.n - i)), q))
        return least, *min(found)


class _Known:
    """Audits of short blocks, which repeat."""

    def __init__(self) -> None:
        self.audits: dict[str, tuple[int, str, int]] = {}

    def whole(self, codes: str) -> tuple[int, str, int]:
        if codes in self.audits:
            return self.audits[codes]
        found = Alignment(codes).audit(START, _FINAL)
        if len(codes) <= 16 and len(self.audits) < 100_000:
            self.audits[codes] = found
        return found


def repaired(codes: str, audit: str, entry: int) -> tuple[list[tuple[str, int, str]], int]:
    """What to put out: ('keep', turn, ''), ('role', turn, initial) or ('new', -1, initial), in order; and the end state."""
    out, i, state = [], 0, entry
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        follow = "a" if state == AFTER_U else "u"
        if letter == "I":
            out.append(("new", -1, follow))
        elif letter == "R":
            out.append(("role", i, follow))
        else:
            out.append(("keep", i, ""))
            follow = codes[i].lower()
        i += letter != "I"
        state = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[follow]
    return out, state


# ---- blocks of conversations


def blocks_of(codes: DataFrame) -> DataFrame:
    """conv_id, block and the codes of its turns, in order."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "code")))
    grouped = codes.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(ordered.alias("turns"))
    return grouped.select("conv_id", "block", F.array_join("turns.code", "").alias("codes"))


def _mapped(df: DataFrame, more: str, per_row) -> DataFrame:
    """df with more columns, per_row giving their values for a row (a dict)."""
    names = [part.split()[0] for part in more.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            rows = batch.to_pylist()
            out = [per_row(row, state) for row in rows]
            cols = [pa.array([o[k] for o in out], pa.list_(pa.int64()) if "array" in part else pa.string() if "string" in part else pa.int64()) for k, part in enumerate(more.split(","))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, {more}")


def _alone(row: dict, state: dict) -> tuple:
    known = state.setdefault("known", _Known())
    _, audit, _ = known.whole(row["codes"])
    return audit, START


def _transfer(row: dict, state: dict) -> tuple:
    return (Alignment(row["codes"]).transfer(),)


def _backward(row: dict, state: dict) -> tuple:
    """Costs to go on after a block. Rows come by conversation, the last block first; four numbers are kept."""
    if "conv" not in state or state["conv"] != row["conv_id"]:
        state |= {"conv": row["conv_id"], "after": [*_FINAL]}
    after, costs = state["after"], row["costs"]
    state["after"] = [min(min(costs[4 * p + q] + after[q], _BIG) for q in _STATES) for p in _STATES]
    return (after,)


def _by_entry(row: dict, state: dict) -> tuple:
    block = Alignment(row["codes"])
    found = [block.audit(p, tuple(row["after"])) for p in _STATES]
    return "|".join(f[1] for f in found), [f[2] for f in found]


def _forward(row: dict, state: dict) -> tuple:
    """The audit of each block for the state in which the one before it ends; rows come in order."""
    if "conv" not in state or state["conv"] != row["conv_id"]:
        state |= {"conv": row["conv_id"], "at": START}
    entry = state["at"]
    state["at"] = row["ends"][entry]
    return row["audits"].split("|")[entry], entry


def audited(blocks: DataFrame) -> DataFrame:
    """conv_id, block, codes, audit and the state that the block is entered in."""
    many = blocks.groupBy(F.col("conv_id").alias("c")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("c")
    same = blocks["conv_id"].eqNullSafe(many["c"])
    short = _mapped(blocks.join(many, same, "left_anti").select("conv_id", "block", "codes"), "audit string, entry bigint", _alone)
    own = blocks.join(many, same, "left_semi").select("conv_id", "block", "codes")
    costs = _mapped(own.repartition("conv_id", "block"), "costs array<bigint>", _transfer)
    after = _mapped(costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")), "after array<bigint>", _backward).drop("costs")
    ways = _mapped(after.repartition("conv_id", "block"), "audits string, ends array<bigint>", _by_entry).drop("after")
    chosen = _mapped(ways.repartition("conv_id").sortWithinPartitions("conv_id", "block"), "audit string, entry bigint", _forward)
    return short.unionByName(chosen.select(*short.columns))


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Report:
    """One conversation's row of the result, from its blocks and turns in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.lines = conv_id, 0
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.distinct = self.cost = 0
        self.low = self.high = self.before = None
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.todo: list[tuple[str, int, str]] = []
        self.at = self.turn = 0

    def block(self, codes: str, audit: str, entry: int) -> None:
        self.flush()
        self.todo, self.at, self.turn = repaired(codes, audit, entry)[0], 0, 0
        self.audit.append(audit)
        for c in codes:
            kind = c if c in "bd" else "t" if c in "SUAX" else ""
            if kind:
                self.counts[kind] += 1
        turns = iter(codes)
        for letter in audit:
            if letter == "I":
                self.cost += INSERT
            elif next(turns) in "SUAX" and letter != "D":
                self.cost += UNENDED
            self.cost += REROLE * (letter == "R") + DELETE * (letter == "D")

    def _line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _new(self) -> None:
        while self.at < len(self.todo) and self.todo[self.at][0] == "new":
            self._line(_NAMES[self.todo[self.at][2]], "")
            self.at += 1

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if self.high is None or turn != self.high:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self._new()
        if self.at < len(self.todo) and self.todo[self.at][1] == self.turn:
            kind, _, initial = self.todo[self.at]
            self._line(role if kind == "keep" else _NAMES[initial], text)
            self.at += 1
        self.turn += 1

    def flush(self) -> None:
        self._new()

    def result(self) -> tuple:
        self.flush()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, min(gaps, (1 << 63) - 1), self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *(part.split()[0] for part in RESULT.split(", "))]
    now: _Report | None = None
    for batch in batches:
        done = []
        for conv_id, block, pos, turn, role, text, codes, audit, entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Report(conv_id)
            if codes is not None:
                now.block(codes, audit, entry)
            elif pos is not None:
                now.row(turn, role, text)
        if done:
            yield _batch(done, names)
    if now is not None:
        yield _batch([now.result()], names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def repair(turns: DataFrame) -> DataFrame:
    """A row for each conversation of the input: faults by kind, gaps of turns, illegal neighbours, and the cheapest repair
    after damaged(): its cost, audit (K keep, R rerole, D delete, I insert) and the repaired text's digest."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    ordered = in_order(damaged(rows))
    blocks = cut(blocks_of(coded(ordered)), "blocks")
    heads = audited(blocks)
    none = {"pos": "bigint", "turn": "bigint", "role": "string", "text": "string", "codes": "string", "audit": "string", "entry": "bigint", "block": "bigint"}
    columns = ["conv_id", "block", "pos", "turn", "role", "text", "codes", "audit", "entry"]
    filled = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in columns])
    everything = filled(rows.select("conv_id").distinct()).unionAll(filled(heads)).unionAll(filled(ordered.withColumn("block", F.shiftright("pos", BLOCK_BITS))))
    lined = everything.repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos")
    return lined.mapInArrow(_reports, f"conv_id bigint, {RESULT}")
