import random
import re
import zlib
from collections import Counter

import pytest

from changeledger.llm import spelling
from changeledger.llm.queries import op11_spelling
from tests.conftest import SF


def plain_words(rows, damage=97):
    found = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if damage and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain_group(words):
    """Neighbours by deleting letters: words one edit apart agree after one deletion from one or from both."""
    by = {}
    for w in words:
        for k in range(len(w)):
            by.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            near[w] |= by[w[:k], w[k + 1 :]] | ({w[:k] + w[k + 1 :]} & words.keys())
    for w in words:
        near[w].discard(w)
        for v in list(near[w]):
            near[v].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_group(plain_words(rows))
    assert got(op11_spelling(spark, SF)) == want
    assert any(w[1] for w in want) and any(w[1] != w[2] for w in want if w[1])


@pytest.mark.parametrize("tile", [7, 1024])
def test_tiles_lose_no_pair(spark, monkeypatch, tile):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.choice([5, 5, 6, 7]))): rnd.choice([3, 4, 8, 20, 90]) for _ in range(400)}
    words |= {"a" * 5000: 3, "a" * 5001: 9, "a" * 4999 + "b": 30, "abcab" * 900: 4}
    monkeypatch.setattr(spelling, "TILE", tile)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.group(df)) == plain_group(words)


def test_one_edit():
    yes = [("abcde", "abcd"), ("abcde", "bcde"), ("abcde", "abXde"), ("abcde", "abccde"), ("aaaaa", "aaaa")]
    no = [("abcde", "abcde"), ("abcde", "abdce"), ("abcde", "abcdefg"), ("abcde", "bcdea"), ("abcd", "bcdaa")]
    assert all(spelling.one_edit(a, b) and spelling.one_edit(b, a) for a, b in yes)
    assert not any(spelling.one_edit(a, b) or spelling.one_edit(b, a) for a, b in no)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "wordy wordy wordy"), (3, "wordy wordie"), (3, "WORDY Wordys wordys wordys"), (4, "x" * 200_000 + " ÀÉÎÕÜ ÀÉÎÕÜ àéîõü ÀÉÎÕÜ"), (5, "wor_dy1wordy"), (6, "tie-aaaab aaaab aaaab aaaac aaaac aaaac aaaad aaaad aaaad " * 3 + "aaaax aaaax aaaax")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n", "2 as key", "3 as form")
    for damage in (None, 97, 2):
        assert got(spelling.variants(df, damage)) == plain_group(plain_words(rows, damage))
    assert spelling.variants(df.limit(0)).count() == 0
