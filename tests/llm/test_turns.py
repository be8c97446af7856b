import hashlib
import random
import re
import zlib
from functools import cache

from changeledger.llm import turns
from changeledger.llm.queries import op12_turns
from tests.conftest import SF

GRAPH = re.compile("[^\x20\x09-\x0d]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Every edit string by cost, then by ASCII: memoized over (row, roles so far as a state)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        marks = GRAPH.findall(text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @cache
    def best(i, state, inserted=0):
        """(cost, audit, lines) of the cheapest way on; the state is the last role's initial."""
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        for role in ("user", "assistant") if inserted < 3 else ():
            if (state, role[0]) in step:
                cost, audit, lines = best(i, role[0], inserted + 1)
                ways.append((cost + 5, "I" + audit, (role + ":", *lines)))
        if i < len(rows):
            _, _, own, text = rows[i]
            cost, audit, lines = best(i + 1, state)
            ways.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                for edit, role in (("K", own), ("R", "user"), ("R", "assistant")):
                    if (state, role[:1]) in step:
                        cost, audit, lines = best(i + 1, role[0])
                        ways.append((cost + (edit == "R") + 5 * (faults[i] == "truncated"), edit + audit, (f"{role}:{text}", *lines)))
        return min(ways, key=lambda w: w[:2]) if ways else (10**9, "", ())

    cost, audit, lines = best(0, "")
    numbered = [r[1] for r in rows if r[1] is not None]
    missing = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (missing, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(rows, damage=True):
    after = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(((conv, *plain_repair([r for r in after if r[0] == conv])) for conv in {r[0] for r in rows}), key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_turns(spark, SF)) == plain(rows)


def test_random_structures(spark):
    rnd = random.Random(5)
    texts = ["a.", "b!", "c?", "open", "", " \t", "d. \n", "e", "é."]
    rows = []
    for conv in range(150):
        for turn in range(rnd.choice([1, 2, 3, 5, 9, 14])):
            rows.append((conv, rnd.choice([turn, turn, None, turn // 2]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice([*texts, f"t{turn}.", None])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(turns.repair_conversations(df, damage=True)) == plain(rows)
    assert got(turns.repair_conversations(df)) == plain(rows, damage=False)


def test_long_conversations_are_searched_in_blocks(spark, monkeypatch):
    rnd = random.Random(7)
    for n in (0, 1, 63, 64, 65, 128, 700):
        letters = "".join(rnd.choice("ABCDEFGHIJKLMNOP"[:12] + "ABC" * 5) for _ in range(n))
        blocks = turns.repair(letters)
        monkeypatch.setattr(turns, "BLOCK", 200)
        assert turns.repair(letters) == blocks
        monkeypatch.undo()
    texts = [f"line {i}{rnd.choice(['.', '.', '.', ''])}" for i in range(150)]
    rows = [(1, i, rnd.choice(["user", "assistant", "assistant", "system"]), texts[i % 130]) for i in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert got(turns.repair_conversations(df)) == plain(rows, damage=False)


def test_edges(spark):
    long = "x y. " * 100_000 + "."
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "dropped."), (None, None, None, None), (None, 1, "user", long), (7, None, "user", "a."), (7, None, "user", "a."), (7, None, "assistant", "b."), (7, 2, "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as id", "'x' as conv", "2 as letter", "'y' as audit")
    found = got(turns.repair_conversations(df, damage=True))
    assert found == plain(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in found
    assert turns.repair_conversations(df.limit(0), damage=True).count() == 0
