"""Round trips on generated inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from changeledger.llm import flac, packing, repair
from changeledger.llm.tokens import Encoder

ENCODER = Encoder()
CHARS = st.lists(st.sampled_from([*" \n\t.,'!aZé9 ß  sı😀ĳⅷ", "'s", "ll"]), max_size=60).map("".join)


@settings(deadline=None, max_examples=300)
@given(st.lists(CHARS, max_size=5))
def test_chunks_encode_like_whole_texts(texts):
    want = [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in ENCODER.encode(texts)] == want


@settings(deadline=None, max_examples=40)
@given(st.lists(st.binary(max_size=900), min_size=1, max_size=4), st.integers(0, 191), st.integers(1, 300))
def test_flac(blobs, start, count):
    blocks = [flac.payload(b) for b in blobs]
    streams = flac.encode(blocks)
    assert flac.decode(streams) == blocks
    assert [flac.read_samples(m, start, count) for m in streams] == [b[start : start + count] for b in blocks]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=80), min_size=1, max_size=6), st.integers(1, 4))
def test_grammar(docs, rounds):
    ids = np.array(sum(docs, []))
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    symbols, ended, rules = repair.compress(ids, last, 4, rounds=rounds, top=3, least=2)
    flat, offsets = repair.expansions(rules, 4)
    grown = [x if x < 4 else flat[offsets[x - 4] : offsets[x - 3]].tolist() for x in symbols.tolist()]
    out, at = [[]], 0
    for x, e in zip(grown, ended.tolist()):
        out[-1] += x if isinstance(x, list) else [x]
        out += [[]] if e else []
    assert out[:-1] == docs


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_pack(lengths):
    n = np.array(lengths, np.int64)
    bins, at = packing.pack(n, 30)
    for b in set(bins.tolist()):
        x = sorted(zip(at[bins == b].tolist(), n[bins == b].tolist()))
        assert x[0][0] == 0 and all(p + q == r for (p, q), (r, _) in zip(x, x[1:])) and sum(x[-1]) <= 30
    assert all(b >= 0 for b in bins) and len(set(bins.tolist())) <= max(1, 2 * -(-int(n.sum()) // 30))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=80), min_size=1, max_size=6), st.integers(1, 4))
def test_grammar_leaves_no_frequent_pair(docs, top):
    ids = np.array(sum(docs, []))
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    symbols, ended, rules = repair.compress(ids, last, 4, top=top, least=2)
    places: dict = {}
    for i in np.flatnonzero(~ended):
        places.setdefault((symbols[i], symbols[i + 1]), []).append(int(i))
    # Of a run of one symbol every other place counts.
    assert all(len(p) == 1 or (a == b and len(p) < 3) for (a, b), p in places.items())
    flat, offsets = repair.expansions(rules, 4)
    grown = np.concatenate([[x] if x < 4 else flat[offsets[x - 4] : offsets[x - 3]] for x in symbols.tolist()])
    assert grown.tolist() == ids.tolist()


def test_grammar_of_copies():
    passage = np.arange(256)
    ids, last = np.tile(passage, 64), np.tile(passage == 255, 64)
    symbols, _, _ = repair.compress(ids, last, 256)
    assert len(symbols) == 64


def test_grammar_outgrows_narrow_symbols():
    passage = np.arange(600)
    ids, last = np.tile(passage + 64_900, 40), np.tile(passage == 599, 40)
    symbols, _, rules = repair.compress(ids, last, 65_500)
    flat, offsets = repair.expansions(rules, 65_500)
    assert len(symbols) == 40 and len(rules) > 500 and symbols.min() >= 65_536
    assert flat[offsets[symbols[0] - 65_500] : offsets[symbols[0] - 65_499]].tolist() == ids[:600].tolist()
