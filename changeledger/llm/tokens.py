"""Token ids of whole texts by a public tokenizer, each distinct chunk of a group of texts encoded once.

A single space between two non-space characters always starts a new pre-token of the byte-level pattern, and a line
feed between two such characters is a pre-token of its own. So the chunk from one such place to the next is encoded
alike wherever it stands. Arrow splits a group of texts and numbers its distinct chunks. Those of Latin letters, but for a
closing mark, go to the vocabulary's model of the tokenizers library in byte letters, many at a time with the letter of a
byte between them that no UTF-8 has; the library encodes the others with a tab between them (a pre-token of its own
there as well), and a bounded cache keeps these. The ids are those of encoding the whole text. This holds for byte-level
BPE without normalizer, by the tokenizer's own description; with any other tokenizer whole texts are encoded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
MARKS = ".,;:!?"


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


def byte_level(described: dict) -> bool:
    """Whether a tokenizer's description is one that chunks are encoded alike under: byte-level words and plain BPE."""
    before, model = described.get("pre_tokenizer") or {}, described.get("model") or {}
    words = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    parts = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")]
    plain = model.get("type") == "BPE" and not any(parts) and not model.get("ignore_merges")
    added = described.get("added_tokens") or []
    # An added token is found before words are; in chunks it is only if no space or line feed can be part of it.
    whole = all(not any(x.isspace() for x in t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
    return bool(words and plain and whole and described.get("normalizer") is None)


def _odd(chunk: str) -> bool:
    """Whether a chunk has space characters at its edges, so that it must not stand alone."""
    core = chunk[1:] if chunk[:1] == "\n" else chunk
    return not core or core[0].isspace() or core[-1].isspace()


def _gap(described: dict, letters: dict[int, int]) -> str | None:
    """The letter of a byte that no UTF-8 has, if it is in the vocabulary and no merge takes it: words on both sides keep their ids."""
    vocab = described["model"].get("vocab")
    if not isinstance(vocab, dict):
        return None
    merged = "".join(t for t in vocab if len(t) > 1)
    return next((g for g in (chr(letters[b]) for b in range(0xF8, 0x100)) if g in vocab and g not in merged), None)


def _buffers(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of an array without nulls."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)), at - at[0]


def _gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends) of the runs of a pool, one after the other."""
    whole = np.int32 if max(len(pool), int(size.sum())) < 1 << 31 else np.int64
    ends = np.cumsum(size)
    shift = (begin - ends + size).astype(whole)
    return pool[np.repeat(shift, size) + np.arange(ends[-1] if len(ends) else 0, dtype=whole)], ends


def _lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each string, or values of each list."""
    count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    return count(values).to_numpy().astype(np.int64)


class Encoder:
    """encode(texts) gives one array of ids (uint16 if the vocabulary allows it) per text; null is empty.

    `known` holds the ids of chunks that are not words of Latin letters: of the chunk itself if it begins with a line
    feed, else of a space and the chunk.
    """

    #: Entries kept, and the longest chunk kept, so that the cache takes some 120 MB at most.
    KEPT, LONGEST = 600_000, 48
    #: UTF-8 bytes of the texts in one group (one text, if it is longer), and words in one string for the model.
    GROUP_BYTES, JOINED = 8 << 20, 32

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.tab = self.tokenizer.encode("\t", add_special_tokens=False).ids
        described, letters = json.loads(self.tokenizer.to_str()), _byte_letters()
        self.letters, self.gap = np.array([letters[b] for b in range(256)], "<u4"), _gap(described, letters)
        self.model = Tokenizer(self.tokenizer.model)
        self.chunked = byte_level(described) and self.gap is not None
        # Nothing, each mark and a line feed: what may stand before or after a word.
        self.fixed = [np.zeros(0, self.dtype), *self._ids([*MARKS, "\n"])]
        self.line = len(self.fixed[-1])

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size) of words with or without a space before them, each one pre-token, by the vocabulary's model."""
        data, at = _buffers(words)
        at = at + np.arange(len(at))
        raw, own = np.full(at[-1], 0xF8, np.uint8), np.ones(at[-1], bool)
        own[at[1:] - 1] = False
        raw[own] = data
        codes = self.letters[raw]
        codes[~own] = ord(self.gap)
        text, cuts = codes.tobytes().decode("utf-32-le"), [*at[: -1 : self.JOINED].tolist(), int(at[-1])]
        joined, found = [text[a:z] for a, z in zip(cuts, cuts[1:])], []
        for k in range(0, len(joined), 256):
            batch = self.model.encode_batch_fast(joined[k : k + 256], add_special_tokens=False)
            found.append(np.fromiter(chain.from_iterable(e.ids for e in batch), self.dtype))
        ids = np.concatenate([np.zeros(0, self.dtype), *found])
        ends = np.flatnonzero(ids == self.model.token_to_id(self.gap))
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not keep the gap apart")
        begin = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
        return ids, begin, ends - begin

    def _learn(self, chunks: list[str], odd: bool = False) -> dict[str, bytes]:
        """The ids of each chunk; odd: some may be."""
        out: dict[str, bytes] = {}
        spaced = lambda c: c if c[:1] == "\n" else " " + c
        plain = [c for c in chunks if "\t" not in c and not (odd and _odd(c))] if len(self.tab) == 1 else []
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            ids = self._ids(["\t".join(map(spaced, part))])[0]
            cut = np.flatnonzero(ids == self.tab[0])
            if len(cut) != len(part) - 1:
                raise ValueError("the vocabulary does not keep a tab apart")
            data, width = ids.tobytes(), ids.itemsize
            for c, a, z in zip(part, [0, *((cut + 1) * width).tolist()], [*(cut * width).tolist(), len(data)]):
                out[c] = data[a:z]
        rest = [c for c in chunks if c not in out] if len(plain) < len(chunks) else []
        out.update(zip(rest, (ids.tobytes() for ids in self._ids(list(map(spaced, rest))))))
        return out

    def _others(self, chunks: list[str]) -> list[bytes | None]:
        """The ids of distinct chunks, None for odd ones; they are kept unless long."""
        values = list(map(self.known.get, chunks))
        odd = {i for i, v in enumerate(values) if v is None and _odd(chunks[i])}
        gaps = [i for i, v in enumerate(values) if v is None and i not in odd]
        learnt = self._learn([chunks[i] for i in gaps])
        for i in gaps:
            values[i] = learnt[chunks[i]]
        if len(self.known) + len(learnt) > self.KEPT:
            self.known.clear()
        kept = ((c, v) for c, v in learnt.items() if len(c) <= self.LONGEST)
        self.known.update(islice(kept, self.KEPT))
        return values

    def _one(self, text: str) -> np.ndarray:
        """A text with space characters side by side: chunks are joined again there."""
        chunks: list[list[str]] = []
        for p in text.split(" "):
            if not chunks or not p or not chunks[-1][-1] or p[0].isspace() or chunks[-1][-1][-1].isspace():
                chunks.append([p]) if not chunks else chunks[-1].append(p)
            else:
                chunks.append([p])
        first, *rest = [" ".join(c) for c in chunks]
        new = self._learn(list(dict.fromkeys(c for c in rest if c not in self.known)), True)
        ids = [self._ids([first])[0].tobytes() if first else b""] + [new[c] if c in new else self.known[c] for c in rest]
        return np.frombuffer(b"".join(ids), self.dtype)

    def _chunks(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size, odd) of distinct chunks.

        A chunk is a line feed or none, a word and a mark or none; a chunk that is not of this form is a word of its own kind.
        """
        core = pc.ascii_ltrim(chunks, characters="\n")
        word = pc.ascii_rtrim(core, characters=MARKS)
        line, marked = (_lengths(chunks) > _lengths(core)), _lengths(core) - _lengths(word)
        # Letters below U+0240, so that no two versions of the character tables disagree.
        plain = (marked <= 1) & pc.utf8_is_alpha(word).to_numpy(zero_copy_only=False)
        data, at = _buffers(word)
        plain[np.searchsorted(at, np.flatnonzero(data > 0xC8), "right") - 1] = False
        last = pc.index_in(pc.utf8_slice_codeunits(core, -1), value_set=pa.array(list(MARKS), pa.large_string()))
        after = np.where(plain & (marked == 1), pc.fill_null(last, 0).to_numpy() + 1, 0)
        before = np.where(plain & line, len(self.fixed) - 1, 0)
        space = pc.if_else(pa.array(line), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        numbered = pc.binary_join_element_wise(space, word, pa.scalar("", pa.large_string())).filter(pa.array(plain)).dictionary_encode()
        ids, begin, size = self._words(numbered.dictionary)
        values = self._others(chunks.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist())
        odd, other = np.zeros(len(chunks), bool), [np.frombuffer(v or b"", self.dtype) for v in values]
        odd[~plain] = [v is None for v in values]
        runs = [*self.fixed, *other]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        place = np.empty(len(chunks), np.int64)
        place[plain], place[~plain] = len(runs) + numbered.indices.to_numpy(), len(self.fixed) + np.arange(len(other))
        parts = np.stack((before, place, after), 1)
        pool = np.concatenate([*runs, ids])
        begin, size = np.concatenate((np.cumsum(sizes) - sizes, begin + sizes.sum())), np.concatenate((sizes, size))
        ids, _ = _gather(pool, begin[parts.ravel()], size[parts.ravel()])
        size = size[parts].sum(1)
        return ids, np.cumsum(size) - size, size, odd

    def _group(self, texts: pa.LargeStringArray) -> Iterator[np.ndarray]:
        """One array of ids per text, none null."""
        empty, feed = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
        split = pc.split_pattern(pc.binary_join_element_wise(feed, pc.replace_substring(texts, "\n", " \n"), empty), " ")
        numbered = split.flatten().dictionary_encode()
        place = numbered.indices.to_numpy()
        ids, begin, size, odd = self._chunks(numbered.dictionary)
        ids, ends = _gather(ids, begin[place], size[place])
        # Every text has a chunk, as a line feed stands before it, whose ids are left out again.
        counts = _lengths(split)
        after = np.cumsum(counts)
        slow = np.logical_or.reduceat(odd[place], after - counts).tolist()
        cuts = ends[after - 1].tolist()
        for k, (a, z) in enumerate(zip([0, *cuts], cuts)):
            yield self._one(texts[k].as_py()) if slow[k] else ids[a + self.line : z]

    def each(self, texts: list[str | None] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of one text after the other, of which those of one group are held at a time."""
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string())
        column = pc.fill_null(column, "")
        if not self.chunked:
            for at in range(0, len(column), 64):
                yield from self._ids(column.slice(at, 64).to_pylist())
            return
        group = np.cumsum(_lengths(column)) // self.GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)] if len(column) else []
        for a, z in zip(cuts, cuts[1:]):
            yield from self._group(column.slice(a, z - a))

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        return list(self.each(texts))


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """This process's encoder, whose cache later tasks of the same worker share."""
    return Encoder(path)
