import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from changeledger.llm import packing, repair
from changeledger.llm.queries import op6_repair, op7_packing
from changeledger.llm.tokens import Encoder, byte_level
from tests.conftest import SF

T = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", None, " ", "  two  spaces ", " lead", "trail ", "a\n b", "a \nb", "tab\t x", "it's he'll 'd ' s", "é x 　 y", "foo <|endoftext|> bar", "x" * 5000, "12 34  5", "a\r\n\r\n b ", "😀 🎉  ok"]


def plain(t):
    return [*T.encode(t or "", add_special_tokens=False).ids, 2]


def test_encoder():
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice([" ", " ", "a", "bc", "\n", "\t", "'s", "1", "é", ".", " ", "Z"]) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    e = Encoder()
    assert [x.tolist() + [2] for x in e.encode(texts)] == [plain(t) for t in texts]
    e.KEPT = 10
    assert [x.tolist() + [2] for x in e.encode(texts)] == [plain(t) for t in texts]


def test_words_go_to_the_model_once_a_group():
    """Repeated words, with marks and line feeds too, cost the library nothing, and groups of any size give its ids."""
    e, given = Encoder(), []
    library = e.model

    class Model:
        token_to_id = library.token_to_id

        def encode_batch_fast(self, joined, **kept):
            given.extend(w for text in joined for w in text.split(e.gap)[:-1])
            return library.encode_batch_fast(joined, **kept)

    e.model = Model()
    texts = [f"Some word, más {k % 7} words.\nSome word; a{k % 3}b más" for k in range(500)] + ODD
    for size, least, most in ((1 << 20, 1, 1), (1000, 15, 40)):
        given.clear()
        e.GROUP_BYTES = size
        assert [x.tolist() + [2] for x in e.each(pa.array(texts))] == [plain(t) for t in texts]
        assert least <= max(map(given.count, given)) <= most and least <= given.count("\u0120word")
        assert {"Some", "\u0120words", "\u0120word", "\u0120mÃ¡s"} < set(given)


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """A normalizer, an added token with a space or another pre-tokenizer: no chunks, and the library's ids."""
    described = json.loads(T.to_str())
    assert byte_level(described)
    spaced = {**described["added_tokens"][0], "id": 50257, "content": "two words", "special": False}
    others = [{"normalizer": {"type": "Lowercase"}}, {"added_tokens": [*described["added_tokens"], spaced]}, {"pre_tokenizer": {"type": "Whitespace"}}]
    texts = ["Some TWO words, two words  here", "", None, *ODD]
    for k, change in enumerate(others):
        path = f"{tmp_path}/{k}.json"
        with open(path, "w") as f:
            json.dump(described | change, f)
        own, e = Tokenizer.from_file(path), Encoder(path)
        assert not e.chunked
        assert [x.tolist() for x in e.encode(texts)] == [own.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_grammar():
    rnd = np.random.default_rng(1)
    docs = [(i, rnd.choice(50, rnd.integers(1, 400), p=np.r_[[0.5], [0.5 / 49] * 49])) for i in range(60)] + [(60, np.zeros(500, int))]
    row = repair._shard_row(0, 0, 0, docs, 50)
    s = repair.Shard(row)
    ids = np.concatenate([d for _, d in docs])
    assert repair.compress(ids, np.zeros(len(ids), bool), 50, rounds=5)[2].max() > 49
    # With the shipped parameters no pair is left that occurs 16 times.
    ended = np.zeros(len(s.symbols), bool)
    ended[s.first[1:] - 1] = True
    left = {}
    for i in np.flatnonzero(~ended):
        left.setdefault((int(s.symbols[i]), int(s.symbols[i + 1])), []).append(int(i))
    assert all(len(p) < 16 or (a == b and (len(p) + 1) // 2 < 16) for (a, b), p in left.items())
    assert len(s.rules) > 10 and len(s.symbols) < 0.7 * len(ids)
    assert (s.all() == ids).all() and all((s.document(k) == d).all() for k, (_, d) in enumerate(docs))
    for a, b in ((0, 1), (5, 1200), (len(ids) - 3, len(ids)), (77, 78)):
        assert (s.ids_between(a, b) == ids[a:b]).all()


def test_round_trip(spark, tmp_path):
    rows = [(i * 7 % 23 if i else None, t) for i, t in enumerate(ODD)] + [(3, "same"), (3, "same"), (4, "word " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as start")
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in repair.round_trip(df).collect()))
    at, seen = 0, []
    for start, d, n, crc in got:
        assert start == at
        at += n
        seen.append((d is not None, d or 0, crc))
    assert [x[:2] for x in seen] == sorted(x[:2] for x in seen)
    assert sorted(seen) == sorted((d is not None, d or 0, zlib.crc32(np.array(plain(t), "<u4").tobytes())) for d, t in rows)
    assert repair.round_trip(df.limit(0)).count() == 0
    repair.encode(df, f"{tmp_path}/ids", shard_ids=500)
    ids = {(r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in repair.decode(spark, f"{tmp_path}/ids").collect()}
    assert ids == {(d, zlib.crc32(np.array(plain(t), "<u4").tobytes())) for d, t in rows}


def check_packing(rows, got, capacity=1024):
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in by.values():
        ends = 0
        for o, n in sorted(x):
            assert o == ends
            ends += n
        assert ends <= capacity
    want = []
    for d, t in rows:
        ids = plain(t)
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        want += [(d or -1, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(want) == sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    return len(by), sum(x[3] for x in want)


def test_packing(spark):
    rows = [(i or None, t) for i, t in enumerate(ODD)] + [(3, "same")] * 3 + [(90, "word " * 3000), (91, "a " * 1023), (92, " a" * 1024)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "2 as g")
    check_packing(rows, packing.pack_documents(df).collect())
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("high", [60, 500, 1024])
def test_pack(high):
    n = np.random.default_rng(high).integers(1, high + 1, 5000)
    bins, at = packing.pack(n, 1024)
    assert bins.max() + 1 <= 1.06 * -(-n.sum() // 1024) or high > 500
    for b in range(0, int(bins.max()) + 1, 97):
        x = sorted(zip(at[bins == b], n[bins == b]))
        assert all(p[0] + p[1] == q[0] for p, q in zip(x, x[1:])) and x[0][0] == 0 and sum(x[-1]) <= 1024


def test_queries(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bins, total = check_packing(rows, op7_packing(spark, SF).collect())
    assert bins <= 1.03 * -(-total // 1024)
    at = 0
    for r, (d, t) in zip(sorted(op6_repair(spark, SF).collect(), key=lambda r: r.start), sorted(rows)):
        ids = plain(t)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
