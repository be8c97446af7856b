"""Spelling variants: words one edit apart, found by Gram matrices of letter-count blocks.

Letters are dealt into CLASSES classes of about equal weight. One inserted, deleted or replaced letter changes the counts of
at most two classes, so two words one edit apart agree on all letters of some CLASSES - 2 classes: a block is the words
that agree there. Inside blocks, NumPy products of letter-count rows give the squared distances of all words of equal or
adjacent lengths; pairs at distance two at most are verified letter by letter. A pair is taken in the first block that
holds both words, hence once. Large blocks are tiled, and tiles meet in pairs, so no task holds a large block.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch
from changeledger.shipping import ship

#: Maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 whose A-Z are lower-cased.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
CLASSES = 4
KEPT = list(itertools.combinations(range(CLASSES), CLASSES - 2))
#: Distinct words that a task counts before it hands them on; words of a tile; words multiplied at a time.
FLUSH, TILE, PACK = 300_000, 1024, 256
TALLY = "word string, n_near long, best_n long, best string"


def _counts(damage: int | None):
    """(doc_id as text, text as UTF-8) rows to (word, n): the runs of a task, counted by their words."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(found: Counter):
        words = [w.decode() for w in found]
        keep = [len(w) >= 5 for w in words]
        return pa.RecordBatch.from_arrays([pa.array(list(itertools.compress(xs, keep)), t) for xs, t in zip((words, found.values()), schema.types)], schema=schema)

    def run(batches):
        found: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                runs = Counter(RUN.findall((text.as_py() or b"").lower()))
                head = doc.encode() + b":"
                for w, n in runs.items() if damage else ():
                    h = zlib.crc32(head + w)
                    if h % damage == 0:
                        letters = w.decode()
                        at = h % len(letters)
                        found[(letters[:at] + letters[at + 1 :]).encode()] += n
                        runs[w] = 0
                found.update(runs)
                if len(found) > FLUSH:
                    yield out(found)
                    found = Counter()
        yield out(found)

    return run


def vocabulary(docs: DataFrame, damage: int | None = None, least: int = 3) -> DataFrame:
    """(word, n): the words of at least 5 letters that occur at least `least` times in docs (doc_id, text).

    With damage, a run loses one letter where damage divides the crc32 of `<doc_id>:<run>`; a null doc_id is empty there.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string").cast("binary"))
    found = rows.mapInArrow(_counts(damage), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least)


def letter_classes(words: DataFrame) -> list[str]:
    """LETTERS in CLASSES classes: by falling number of words that hold a letter, each to the lightest class so far."""
    holds = [F.count_if(F.col("word").contains(c)).alias(str(i)) for i, c in enumerate(LETTERS)]
    weight = words.agg(*holds).first()
    classes, load = [""] * CLASSES, [0] * CLASSES
    for i in sorted(range(len(LETTERS)), key=lambda i: (-weight[i], i)):
        k = load.index(min(load))
        classes[k] += LETTERS[i]
        load[k] += weight[i]
    return classes


def blocks(words: DataFrame, classes: list[str]) -> DataFrame:
    """(choice, key, word, n): for each choice of kept classes a hash of the word's letters in them, sorted."""
    def letters(kept):
        gone = "".join(classes[k] for k in range(CLASSES) if k not in kept)
        return F.xxhash64(F.array_join(F.array_sort(F.split(F.translate("word", gone, ""), "")), ""))

    keys = [F.struct(F.lit(i).alias("choice"), letters(kept).alias("key")) for i, kept in enumerate(KEPT)]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("b")).select("b.choice", "b.key", "word", "n")


def tiles(rows: DataFrame) -> DataFrame:
    """(choice, key, tile, tiles, words, ns) of blocks with two words or more, cut by a hash of the word into tiles of
    about TILE words: one for most blocks, more for large ones."""
    size = rows.groupBy("choice", "key").agg(F.count("*").alias("m")).where("m > 1")
    size = size.select("choice", "key", F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    dealt = rows.join(size, ["choice", "key"]).withColumn("tile", F.pmod(F.xxhash64("word", F.lit(7)), F.col("tiles")).cast("int"))
    packed = dealt.groupBy("choice", "key", "tile", "tiles").agg(F.collect_list(F.struct("word", "n")).alias("x"))
    return packed.select("choice", "key", "tile", "tiles", F.col("x.word").alias("words"), F.col("x.n").alias("ns"))


def meetings(table: DataFrame) -> DataFrame:
    """(choice, words, ns, words2, ns2): every tile with itself (words2 null) and with the later tiles of its block."""
    own = table.select("choice", "words", "ns", F.lit(None).cast("array<string>").alias("words2"), F.lit(None).cast("array<bigint>").alias("ns2"))
    large = table.where("tiles > 1")
    later = large.select("choice", "key", F.col("tile").alias("tile2"), F.col("words").alias("words2"), F.col("ns").alias("ns2"))
    return own.unionByName(large.join(later, ["choice", "key"]).where("tile < tile2").select(*own.columns))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def letter_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, lengths): a row of letter counts per word; float32 holds every product exactly up to 4,095 letters."""
    lengths = np.array(list(map(len, words)), np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    column = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26)
    at = np.repeat(np.arange(len(words)), lengths) * len(LETTERS) + column
    counts = np.bincount(at, minlength=len(words) * len(LETTERS)).reshape(len(words), -1)
    return counts.astype(np.float32 if lengths.max(initial=0) < 4096 else np.float64), lengths


def candidates(left: list[str], right: list[str] | None, group: np.ndarray, choice: np.ndarray, member: np.ndarray):
    """(i, j) of words whose letter counts are one insertion or replacement apart, each pair in the first of its blocks.

    right is another tile of the block of left; without it left meets itself, where group tells packed blocks apart.
    choice: the choice of kept classes of each left word; member: classes by letters.
    """
    a, a_len = letter_counts(left)
    b, b_len = (a, a_len) if right is None else letter_counts(right)
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    step = np.abs(a_len[:, None] - b_len[None, :])
    near = ((square == 2) & (step == 0)) | ((square == 1) & (step == 1))
    if right is None:
        near &= group[:, None] == group[None, :]
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    changed = (np.abs(a[i] - b[j]) @ member) > 0
    first = np.argmax(np.stack([~changed[:, kept].any(1) for kept in map(list, KEPT)], 1), 1) if len(i) else i
    mine = first == choice[i]
    return i[mine], j[mine]


def _near(classes: list[str]):
    """meetings() to TALLY: for each word of a batch its near words, the commonest of them and that one's count."""
    member = np.array([[c in letters for letters in classes] for c in LETTERS], np.float64)
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def packs(rows):
        """Small blocks together, up to PACK words; a larger one, or one that meets another tile, alone."""
        words, ns, group, choice = [], [], [], []
        for k, (c, ws, n, ws2, n2) in enumerate(rows):
            if ws2 is not None:
                yield ws, n, ws2, n2, None, np.full(len(ws), c)
                continue
            if words and len(words) + len(ws) > PACK:
                yield words, ns, None, ns, np.array(group), np.array(choice)
                words, ns, group, choice = [], [], [], []
            words, ns = words + ws, ns + n
            group += [k] * len(ws)
            choice += [c] * len(ws)
        if words:
            yield words, ns, None, ns, np.array(group), np.array(choice)

    def run(batches):
        for batch in batches:
            tally: dict[str, tuple[int, int, str]] = {}

            def meet(w, other, n):
                have = tally.get(w)
                if have is None:
                    tally[w] = (1, n, other)
                else:
                    count, best_n, best = have
                    better = n > best_n or n == best_n and other < best
                    tally[w] = (count + 1, n, other) if better else (count + 1, best_n, best)

            for words, ns, words2, ns2, group, choice in packs(zip(*(c.to_pylist() for c in batch.columns))):
                i, j = candidates(words, words2, group, choice, member)
                others = words if words2 is None else words2
                for x, y in zip(i.tolist(), j.tolist()):
                    if one_edit(words[x], others[y]):
                        meet(words[x], others[y], ns2[y])
                        meet(others[y], words[x], ns[x])
            columns = [list(tally), *(zip(*tally.values()) if tally else ([], [], []))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): the last word that forms lead to. Each step doubles the way; counts at least
    double from word to form, so ways are short."""
    now = scratch.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        there = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = scratch.save(now.join(there, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.free(now)
        if step.where("moved").isEmpty():
            return step.drop("moved")
        now = step


def group(words: DataFrame) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for every row of words (word, n), whose words are distinct, of LETTERS.

    form is the near word of greatest n (ties: the least by code points) if that n is at least twice the word's own, else
    null with form_n; root is where following forms ends, the word itself if it has none. An empty table gives no rows.
    """
    ship(words.sparkSession)
    scratch = Scratch(words.sparkSession)
    words = scratch.save(words.select("word", "n"), "words")
    classes = letter_classes(words)
    packed = scratch.save(tiles(blocks(words, classes)), "tiles")
    found = meetings(packed).mapInArrow(_near(classes), TALLY)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b"))
    near = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))
    follows = F.col("best_n") >= 2 * F.col("n")
    formed = scratch.save(near.select("word", "n", "n_near", F.when(follows, F.col("best")).alias("form"), F.when(follows, F.col("best_n")).alias("form_n")), "forms")
    scratch.free(packed)
    ends = roots(scratch, formed.where("form is not null"))
    return formed.join(ends, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def variants(docs: DataFrame, damage: int | None = None, least: int = 3) -> DataFrame:
    """group() of the vocabulary of docs (doc_id, text; other columns are ignored), read whole.

    Null and empty texts hold no words; rows that repeat count each time; texts and words may be of any length; ties go to
    the least word; an empty table gives no rows.
    """
    return group(vocabulary(docs, damage, least))
