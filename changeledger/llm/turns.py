"""Repair of conversation structure by iterative-deepening A*.

A conversation's rows become one letter each: their first fault and their role's initial. The cheapest edits that give
role initials `(s?(ua)+)?` are searched depth first, in ASCII order of the edits, under cost bounds that grow to the next
cost that failed; a transposition table holds, for every state (row, role state), the least cost below which it is known to
fail. The first path to accept is the answer. Long conversations are searched in blocks of BLOCK rows from the last to the
first: leaving a block costs what is left to do there, so a bound never has to grow by more than one block's surprise.

Rows are range-partitioned by conversation, turn, role and text once and stored with a number that has their order, so
no conversation has to sort in one task. What one task holds of a conversation is its letters, a byte a row, no
more than its audit in the result; its texts stream past one digest.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch
from changeledger.shipping import ship

SPACE = r"\x20\x09-\x0D"
ROLES = "sua"
BLOCK = 64
#: Rows whose letters are joined at a time before a conversation's are.
STRETCH = 4096
DELETE, INSERT, KEEP, REROLE = "DIKR"
#: Role states: nothing yet, after system, after user, after assistant.
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The role that an insertion or a new role gives in each state, and the state after it.
NEXT = (2, 2, 3, 2)
#: Cost left at the end of a conversation in each state: insertions of 5 each.
END = (0, 10, 5, 0)
SOLVED = "conv long, audit string, cost long, blank long, duplicate long, truncated long, illegal long"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, gone) of rows (conv_id, turn, role, text), damaged by crc32 of `conv_id:turn`: dropped (gone),
    emptied, without sentence ends, repeated or given to the user. A null is one space, but for conv and turn themselves."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    base = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1))
    return base.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("gone"))


def whole(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) undamaged, as damaged() gives them."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.lit(False).alias("gone"))


def ordered(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """rows, stored, with `id`: it rises with (conv, turn, role, text), nulls first."""
    order = ["conv", "turn", "role", "text"]
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    fault = F.when(last == "", 1).when(last.rlike(r"[.!?]"), 0).otherwise(3)
    same = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    out = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    return scratch.save(out.withColumns({"fault": fault, "same": F.unhex(same)}), "turns")


def lettered(rows: DataFrame) -> DataFrame:
    """(conv, id, letter) of ordered() rows that are not gone: `A` plus four times the fault plus the place of the role's
    initial among s, u, a (3: another)."""
    there = rows.where("not gone").select("conv", "id", "fault", "same", F.substring("role", 1, 1).alias("initial"))
    # A repeated text may be any share of all rows: its first rows come from partial minima, not from a window.
    first = there.where("fault != 1").groupBy("conv", "same").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    fault = F.when((F.col("fault") != 1) & F.col("first").isNull(), 2).otherwise(F.col("fault"))
    place = F.instr(F.lit(ROLES), F.col("initial")) - 1
    place = F.when((F.col("initial") == "") | (place < 0), 3).otherwise(place)
    return there.join(first, "id", "left").select("conv", "id", F.char(F.lit(65) + 4 * fault + place).alias("letter"))


def facts(letter: str) -> tuple[int, str]:
    """(fault number, role initial or `?`) of a letter."""
    fault, role = divmod(ord(letter) - 65, 4)
    return fault, (ROLES + "?")[role]


class Block:
    """The search in one block of letters, given the cost of leaving it in each role state."""

    def __init__(self, letters: str, leave: tuple[int, ...]):
        self.moves = [self._moves(*facts(c)) for c in letters]
        least = [min(min(c for _, _, c in m) for m in moves) for moves in self.moves]
        rest = [min(leave)] * (len(letters) + 1)
        for i in range(len(letters) - 1, -1, -1):
            rest[i] = rest[i + 1] + least[i]
        #: The least cost that is not known to fail, by row and role state: at first each row's cheapest edit.
        self.table = [[r] * 4 for r in rest[:-1]] + [list(leave)]
        self.path: list[str] = []

    @staticmethod
    def _moves(fault: int, role: str) -> list[list[tuple[str, int, int]]]:
        """For each state the edits that use up the row, (edit, next state, cost), insertion's place marked by state -1."""
        out = []
        for state in range(4):
            moves = [(DELETE, state, 2), (INSERT, -1, 5)]
            extra = 5 if fault == 3 else 0
            if fault not in (1, 2):
                if state in AFTER.get(role, {}):
                    moves.append((KEEP, AFTER[role][state], extra))
                moves.append((REROLE, NEXT[state], 1 + extra))
            out.append(moves)
        return out

    def _search(self, i: int, state: int, bound: int) -> int:
        """The state in which a path of at most bound leaves the block, its edits added to path from last to first; -1 if none."""
        table = self.table
        if table[i][state] > bound:
            return -1
        if i == len(self.moves):
            return state
        fails = 1 << 60
        for edit, to, cost in self.moves[i][state]:
            at, to = (i, NEXT[state]) if to < 0 else (i + 1, to)
            if cost + table[at][to] <= bound:
                left = self._search(at, to, bound - cost)
                if left >= 0:
                    self.path.append(edit)
                    return left
            fails = min(fails, cost + table[at][to])
        table[i][state] = fails
        return -1

    def solve(self, state: int) -> tuple[int, str, int]:
        """(cost, edits, state left in) from a role state."""
        while True:
            self.path = []
            bound = self.table[0][state]
            left = self._search(0, state, bound)
            if left >= 0:
                return bound, "".join(reversed(self.path)), left


def repair(letters: str) -> tuple[int, str]:
    """(cost, audit) of a conversation's letters."""
    leave, solved = END, []
    for at in range((len(letters) - 1) // BLOCK * BLOCK, -1, -BLOCK) if letters else ():
        block = Block(letters[at : at + BLOCK], leave)
        solved.append([block.solve(state) if at or not state else (0, "", 0) for state in range(4)])
        leave = tuple(cost for cost, _, _ in solved[-1])
    audit, state = [], 0
    for paths in reversed(solved):
        _, edits, state = paths[state]
        audit.append(edits)
    return leave[0], "".join(audit) + INSERT * (END[state] // 5)


def _solved(batches):
    """(conv, letters of stretches in order) rows to SOLVED."""
    names = [part.split()[0] for part in SOLVED.split(", ")]
    schema = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in names])
    for b in batches:
        out: list[list] = [[] for _ in names]
        for conv, stretches in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            letters = "".join(stretches)
            cost, audit = repair(letters)
            roles = "".join(facts(c)[1] for c in letters)
            legal = sum(roles.count(pair) for pair in ("su", "ua", "au"))
            faults = [sum(letters.count(chr(65 + 4 * f + r)) for r in range(4)) for f in (1, 2, 3)]
            for column, v in zip(out, (conv, audit, cost, *faults, max(0, len(roles) - 1) - legal)):
                column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)


def _digests(batches):
    """Rows (conv, id, role, text, audit) sorted by (conv, id), each conversation led by its audit, to (conv, repaired_sha256)."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])
    conv, audit, place, state, digest, some = None, None, 0, 0, None, False

    def line(role: str, text: str):
        nonlocal some
        if some:
            digest.update(b"\n")
        digest.update(role.encode() + b":" + text.encode())
        some = True

    def new_role() -> str:
        return "assistant" if state == 2 else "user"

    def inserted():
        nonlocal place, state
        while audit[place : place + 1] == INSERT:
            line(new_role(), "")
            place, state = place + 1, NEXT[state]

    for b in batches:
        done: list[tuple] = []
        for c, i, role, text, plan in zip(*(column.to_pylist() for column in b.columns)):
            if i < 0:
                if audit is not None:
                    inserted()
                    done.append((conv, digest.hexdigest()))
                conv, audit, place, state, digest, some = c, plan, 0, 0, hashlib.sha256(), False
                continue
            inserted()
            edit = audit[place]
            if edit == KEEP:
                line(role, text)
                state = AFTER[role[0]][state]
            elif edit == REROLE:
                line(new_role(), text)
                state = NEXT[state]
            place += 1
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(schema.types)], schema=schema)
    if audit is not None:
        inserted()
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], schema=schema)


def repair_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation of rows
    (conv, turn, role, text, gone), as damaged() or whole() give them.

    Rows go by turn, nulls first, then by role and text, so ties have one order. Rows without conversation id are one
    conversation. A role whose first letter is not s, u or a, or that is empty, cannot be kept, only given anew or
    deleted. A conversation whose rows are all gone has zeros, an empty audit and the digest of the empty string; an empty
    table gives no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    base = ordered(scratch, rows)
    stretch = F.shiftright("id", STRETCH.bit_length() - 1)
    some = lettered(base).groupBy("conv", stretch.alias("s")).agg(F.collect_list(F.struct("id", "letter")).alias("x"))
    some = some.select("conv", "s", F.array_join(F.transform(F.array_sort("x"), lambda v: v["letter"]), "").alias("letters"))
    put = some.groupBy("conv").agg(F.collect_list(F.struct("s", "letters")).alias("x"))
    put = put.select("conv", F.transform(F.array_sort("x"), lambda v: v["letters"]).alias("stretches"))
    solved = scratch.save(put.mapInArrow(_solved, SOLVED), "solved")
    # Each conversation's audit leads its rows, so that no row has to carry it.
    blank = lambda t: F.lit(None).cast(t)
    heads = solved.select("conv", F.lit(-1).cast("long").alias("id"), blank("string").alias("role"), blank("string").alias("text"), "audit")
    texts = base.where("not gone").select("conv", "id", "role", "text", blank("string").alias("audit"))
    stream = heads.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "id")
    digests = stream.mapInArrow(_digests, "conv long, repaired_sha256 string")
    spans = missing_turns(base)
    out = spans.join(solved, spans["conv"].eqNullSafe(solved["conv"]), "left").drop(solved["conv"])
    out = out.join(digests, out["conv"].eqNullSafe(digests["conv"]), "left").drop(digests["conv"])
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    return out.select(F.col("conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def missing_turns(base: DataFrame) -> DataFrame:
    """(conv, gaps) of every conversation, those without rows left included: a turn counts once, partial sums first."""
    turn = F.when(~F.col("gone"), F.col("turn")).alias("turn")
    each = base.select("conv", turn).groupBy("conv", "turn").agg(F.count("*").alias("n"))
    return each.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))


def repair_conversations(rows: DataFrame, damage: bool = False) -> DataFrame:
    """repair_rows() of a table (conv_id, turn, role, text; other columns are ignored), damaged first if so asked.

    Nulls in role and text are one space; texts of any length are read whole; repeated rows are turns of their own, all but
    the first of which are duplicates.
    """
    return repair_rows(damaged(rows) if damage else whole(rows))
