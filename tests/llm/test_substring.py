import hashlib
import random

from changeledger.llm.queries import op10_substring
from changeledger.llm.substring import compact, remove_repeats, repeated_spans
from tests.conftest import SF


def brute(rows, window=20):
    """Ids are unique here, but for equal rows."""
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            at = first.setdefault(tuple(words[s : s + window]), (i, s))
            if at != (i, s):
                gone[s : s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((rows[i][0] if rows[i][0] is not None else -1, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_small(spark):
    rnd = random.Random(3)
    word = lambda: rnd.choice("abcdefghijkl") * rnd.randint(1, 2)
    passage = [word() for _ in range(60)]
    rows = [(1, None), (2, ""), (3, "x " * 30), (4, " ".join(passage[:19])), (None, " ".join(passage))]
    for i in range(5, 60):
        a = rnd.randint(0, 40)
        rows.append((i, " ".join([word() for _ in range(rnd.randint(0, 30))] + passage[a : a + rnd.randint(15, 50)] + [word() for _ in range(rnd.randint(0, 30))] + passage[: rnd.randint(0, 30)])))
    rows += [(60, rows[7][1]), (0, rows[9][1]), (61, "a b c d e " * 30000), (62, "é x " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as th", "1 as n")
    assert got(remove_repeats(df)) == brute(rows)
    assert remove_repeats(df.limit(0)).count() == 0
    twice = df.where("doc_id = 5").union(df.where("doc_id = 5"))
    assert len(set(got(remove_repeats(twice)))) == 1


def test_null_id_is_no_number(spark):
    """The greatest id and a null id stay apart, and the greatest id comes before it."""
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(None, words + " z"), ((1 << 63) - 1, words + " y"), ((1 << 63) - 1, "short text"), (-(1 << 63), "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_words): r.n_removed for r in remove_repeats(df).collect()}
    assert found == {(None, 41): 40, ((1 << 63) - 1, 41): 0, ((1 << 63) - 1, 2): 0, (-(1 << 63), 2): 0}


def test_hot_id(spark):
    """Rows of one id are not gathered; they never count against each other."""
    words = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(words[:50] + [str(i % 40)])) for i in range(200)] + [(None, " ".join(words[:50] + [str(i)])) for i in range(100)] + [(9, " ".join(words))]
    got_rows = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got_rows) == len(rows)
    assert {(r.doc_id, r.n_removed) for r in got_rows} == {(7, 0), (None, 50), (None, 51), (9, 50)}


def test_paths_end_at_branches(spark):
    """Of two sources that share a passage, a node where they part ends the path."""
    edges = [(1, 2, 0), (2, 3, 1), (3, 4, 2), (4, 5, 3)]
    rows = [(f, t, 5, 100, p) for f, t, p in edges] + [(3, 9, 6, 200, 7), (9, 10, 6, 200, 8)]
    first = spark.createDataFrame(rows, "f long, t long, src_dk long, src long, src_p int")
    heads = {(r.f, r.t): (r.src, r["head"]) for r in compact(first).collect()}
    assert heads == {(1, 2): (100, 0), (2, 3): (100, 0), (3, 4): (100, 2), (4, 5): (100, 2), (3, 9): (200, 7), (9, 10): (200, 7)}


def test_spans_hold_their_source(spark):
    rnd = random.Random(4)
    passage = [rnd.choice("abcdef") * rnd.randint(1, 3) for _ in range(90)]
    rows = [(i, " ".join([str(i)] * 3 + passage[a : a + 60] + ["q"] * 5 + passage[: 20 + i])) for i, a in enumerate((0, 10, 25, 30, 5))]
    texts = {d: t.split() for d, t in rows}
    _, info, spans = repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = {r.rid: r.dk for r in info.collect()}
    found = spans.collect()
    assert found and all(r.n > 0 for r in found)
    for r in found:
        own, src = texts[ids[r.rid]], texts[ids[r.src if r.src is not None else r.rid]]
        size = r.n + 19
        assert own[r.start : r.start + size] == src[r.src_start : r.src_start + size]
        assert r.src is None or hashlib.sha256(" ".join(own[r.start : r.start + size]).encode()).digest() == bytes(r.digest)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op10_substring(spark, SF)) == brute(rows)
