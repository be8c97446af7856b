"""Secret scans: fixed rules and a character Markov log-likelihood ratio; DataFrame functions only.

Two first-order Markov models over a fixed alphabet, one of random strings and one of ordinary words, are trained
from samples that the fixed rules label: their matches are random, all other words ordinary. A further token is a
secret if the shrunk mean log-likelihood ratio of its transitions reaches a threshold, which held-out samples fix; short
tokens need a greater mean, because fewer transitions speak for them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import WORD, Scratch

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Documents (expected number) whose words train the models and their threshold; transitions added by score().
SAMPLE_DOCS, SHRINK = 2000, 6
#: Share of held-out ordinary tokens that may reach the threshold; the threshold where no sample fixes it.
FALSE_RATE, THRESHOLD = 0.0005, 0.7
BLOCK, MASK = 256, "[SECRET]"
#: Code points of a text that redact() cuts at a time.
PAGE = 4096
SPAN = "array<struct<start:bigint,end:bigint,kind:int>>"


def _with_starts(rows: DataFrame, name: str) -> DataFrame:
    """rows with the start of every match of __m in code points, __p being the pieces between the matches.

    Running sums over blocks, kept in columns of their own, make it near-linear in the number of matches. What a lambda
    reads is named a second time outside it, so that Spark does not move its computation into the lambda.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("__step", F.transform("__m", lambda m, i: F.length(m).cast("long") + F.length(F.get("__p", i))))
    block = lambda b: total(F.slice("__step", b * BLOCK + 1, F.lit(BLOCK)))
    rows = rows.withColumn("__sums", F.transform(F.sequence(F.lit(0), F.floor(F.size("__step") / BLOCK).cast("int")), block))
    heads = F.transform("__sums", lambda _, j: total(F.slice("__sums", F.lit(1), j)))
    rows = rows.withColumn("__heads", F.when(F.size("__sums") > 0, heads))

    def start(_: Column, i: Column) -> Column:
        b = F.floor(i / BLOCK).cast("int")
        return F.get("__heads", b) + total(F.slice("__step", b * BLOCK + 1, i % BLOCK)) + F.length(F.get("__p", i))

    many = (F.size("__heads") > 0) & (F.size("__step") > 0)
    return rows.withColumn(name, F.when(many, F.transform("__m", start))).drop("__step", "__sums", "__heads")


def _replaced(rows: DataFrame, column: str, pattern: str, new: Callable[[Column, Column], Column]) -> DataFrame:
    """rows with every match of the pattern in a column as new(match, value); the value is that of an assignment."""
    rows = rows.withColumn("__m", F.regexp_extract_all(column, F.lit(pattern), F.lit(0)))
    some = F.size("__m") > 0
    rows = rows.withColumn("__p", F.when(some, F.split(column, pattern, -1)))
    rows = rows.withColumn("__g", F.when(some, F.regexp_extract_all(column, F.lit(pattern), F.lit(2 if pattern == ASSIGN else 0))))
    rows = rows.withColumn("__f", F.when(some, F.zip_with("__m", "__g", new)))
    joined = F.array_join(F.transform("__p", lambda p, i: F.concat(p, F.coalesce(F.get("__f", i), F.lit("")))), "")
    return rows.withColumn(column, F.when(F.size("__f") > 0, joined).otherwise(F.col(column))).drop("__m", "__p", "__g", "__f")


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __assign, __access and __hex: arrays of (start, end, kind number) in code points, end exclusive."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn("__text", whole)
    for k, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        name = f"__{KINDS[k]}"
        out = out.withColumn("__m", F.regexp_extract_all("__text", F.lit(pattern), F.lit(0)))
        some = F.size("__m") > 0
        out = out.withColumn("__p", F.when(some, F.split("__text", pattern, -1)))
        out = out.withColumn("__g", F.when(some, F.regexp_extract_all("__text", F.lit(pattern), F.lit(2)))) if k == 0 else out.withColumn("__g", F.col("__m"))
        out = _with_starts(out, "__s")
        kind = F.lit(k).alias("kind")
        spans = F.transform("__s", lambda s, i: F.struct(s.alias("start"), (s + F.length(F.get("__m", i))).alias("end"), kind, F.length(F.get("__g", i)).alias("value")))
        spans = F.filter(spans, lambda x: x["value"] >= 12) if k == 0 else spans
        out = out.withColumn(name, F.coalesce(F.transform(spans, lambda x: F.struct(x["start"], x["end"], x["kind"])), F.array().cast(SPAN)))
    return out.drop("__m", "__p", "__g", "__s")


class Model(NamedTuple):
    """ratios: log-likelihood ratios of all transitions, row by row of the alphabet; threshold: of score()."""

    ratios: list[float]
    threshold: float


def _transitions(words: DataFrame) -> dict[str, int]:
    """Counts of two-character transitions inside the alphabet: at most its square of them."""
    at = F.sequence(F.lit(1), F.length("w") - 1)
    pairs = words.where("length(w) > 1").select(F.explode(F.transform(at, lambda i: F.substring(F.col("w"), i, F.lit(2)))).alias("p"))
    inside = pairs.where(F.col("p").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    return {r.p: r.n for r in inside.groupBy("p").agg(F.count("*").alias("n")).collect()}


def samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(w, random, held) of about sample_docs documents, at any input size: what the fixed rules match, and all other words.

    Documents are chosen by a hash of id and text, so reruns agree and equal rows count once; a quarter of them, by
    another hash, is held out of training. Stored, so that the corpus is read once for it.
    """
    n = docs.count()
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    share = int((1 << 30) * min(1.0, sample_docs / max(1, n)))
    picked = picked.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) < share).dropDuplicates(["doc_id", "text"])
    picked = picked.withColumn("held", F.pmod(F.xxhash64("doc_id", "text", F.lit(4)), F.lit(4)) == 0)
    value = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    whole = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (ACCESS, HEX)]
    secret = F.concat(F.filter(value, lambda v: F.length(v) >= 12), *whole)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))
    tag = lambda xs, random: F.transform(xs, lambda w: F.struct(w.alias("w"), F.lit(random).alias("random")))
    rows = picked.select("held", F.explode(F.concat(tag(secret, True), tag(words, False))).alias("x")).select("x.w", "x.random", "held")
    return Scratch(docs.sparkSession).save(rows, "samples")


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Both models from the samples that train, and the threshold from those held out.

    Add-one counts leave a model without samples uniform. The threshold lies four fifths of the way from the score that
    a share of FALSE_RATE of the held-out ordinary tokens reaches to the score that nine in ten held-out secrets reach,
    but never below the former; without held-out samples of a kind it is THRESHOLD or the former.
    """
    rows = samples(docs, sample_docs)
    random, ordinary = (_transitions(rows.where(f"not held and random = {kind}")) for kind in ("true", "false"))
    size, ratios = len(ALPHABET), []
    for a in ALPHABET:
        totals = [sum(model.get(a + b, 0) for b in ALPHABET) + size for model in (random, ordinary)]
        ratios += [math.log((random.get(a + b, 0) + 1) / totals[0]) - math.log((ordinary.get(a + b, 0) + 1) / totals[1]) for b in ALPHABET]
    tokens = rows.where("held").select("random", F.explode(F.regexp_extract_all("w", F.lit(TOKEN), F.lit(0))).alias("t"))
    scored = tokens.select("random", score(F.col("t"), ratios).alias("s"))
    quantile = lambda random, q: F.percentile(F.when(F.col("random") == random, F.col("s")), q)
    ends = scored.agg(quantile(False, 1 - FALSE_RATE).alias("low"), quantile(True, 0.1).alias("high")).first()
    if ends.low is None or ends.high is None:
        return Model(ratios, THRESHOLD if ends.low is None else max(THRESHOLD, ends.low))
    return Model(ratios, max(ends.low, 0.2 * ends.low + 0.8 * ends.high))


def score(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's transitions, shrunk as by SHRINK more that speak for neither model."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded into one constant
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))) - 1
    steps = F.sequence(F.lit(1), F.length(token) - 1)
    total = F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.get(table, code(i) * len(ALPHABET) + code(i + 1)))
    return total / (F.length(token) - 1 + SHRINK)


def _spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with __base and __markov: the spans of the fixed rules and those that the models add, in code points."""
    rows = base_spans(docs, text)
    rows = rows.withColumn("__base", F.sort_array(F.concat("__assign", "__access", "__hex")))
    # Base spans as so many spaces, so that places stay the same.
    spaces = lambda m: F.repeat(F.lit(" "), F.length(m))
    rows = _replaced(rows, "__text", ASSIGN, lambda m, v: F.when(F.length(v) >= 12, spaces(m)).otherwise(m))
    rows = _replaced(_replaced(rows, "__text", ACCESS, lambda m, _: spaces(m)), "__text", HEX, lambda m, _: spaces(m))
    rows = rows.withColumn("__m", F.regexp_extract_all("__text", F.lit(TOKEN), F.lit(0)))
    rows = rows.withColumn("__llr", F.transform("__m", lambda m: score(m, model.ratios)))
    some = F.exists("__llr", lambda x: x >= model.threshold)
    rows = rows.withColumn("__p", F.when(some, F.split("__text", TOKEN, -1)))
    rows = _with_starts(rows, "__s")
    place = lambda s, i: F.struct(s.alias("start"), (s + F.length(F.get("__m", i))).alias("end"), F.lit(3).alias("kind"), F.get("__llr", i).alias("llr"))
    found = F.filter(F.transform("__s", place), lambda x: x["llr"] >= model.threshold)
    clear = F.filter(found, lambda x: ~F.exists("__base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    spans = F.transform(clear, lambda x: F.struct(x["start"], x["end"], x["kind"]))
    return rows.withColumn("__markov", F.coalesce(spans, F.array().cast(SPAN))).drop("__m", "__llr", "__p", "__s")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) for every row of docs (doc_id, text).

    Markov spans are the tokens of 12 or more characters, outside all base spans, whose score reaches the model's
    threshold; of a token that a base span covers in part, the rest counts. A null text is empty; texts without a
    secret have empty spans and the hash of the empty string; a text of any length is read whole; spans that start
    together go by kind; repeated rows and null ids each get a row; other columns are ignored; an empty table gives no rows.
    """
    model = model or train(docs)
    rows = _spans(docs.select("doc_id", "text"), model)
    kind = F.array(*map(F.lit, KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kind, x["kind"]), x["start"], x["end"])), ",")
    # Sorted as (start, end, kind) above; by contract start, then kind.
    turned = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    by_kind = lambda spans: F.transform(F.sort_array(F.transform(spans, turned)), lambda x: F.struct(x["start"], x["end"], x["kind"]))
    counts = [F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(text(by_kind(F.col("__base"))), 256)
    return rows.select("doc_id", *counts, digest.alias("base_sha256"), text(by_kind(F.concat("__base", "__markov"))).alias("spans"))


def _gaps(rows: DataFrame) -> DataFrame:
    """rows with __gap: what no span of __all (sorted) covers, as (p, q) in code points; spans that touch or overlap are one.

    A span starts a new gap where it starts after all earlier ends, whose running maximum is taken by blocks.
    """
    rows = rows.withColumn("__ends", F.transform("__all", lambda x: x["end"]))
    block = lambda b: F.array_max(F.slice("__ends", b * BLOCK + 1, F.lit(BLOCK)))
    rows = rows.withColumn("__tops", F.transform(F.sequence(F.lit(0), F.floor(F.size("__ends") / BLOCK).cast("int")), block))
    rows = rows.withColumn("__heads", F.transform("__tops", lambda _, j: F.array_max(F.slice("__tops", F.lit(1), j))))

    def gap(x: Column, i: Column) -> Column:
        b = F.floor(i / BLOCK).cast("int")
        before = F.greatest(F.get("__heads", b), F.array_max(F.slice("__ends", b * BLOCK + 1, i % BLOCK)))
        return F.struct(before.alias("p"), x["start"].alias("q"))

    first = F.filter(F.transform("__all", gap), lambda g: g["p"].isNull() | (g["q"] > g["p"]))
    inner = F.transform(first, lambda g: F.struct(F.coalesce(g["p"], F.lit(0).cast("long")).alias("p"), g["q"].alias("q")))
    last = F.struct(F.array_max("__ends").alias("p"), F.length("__whole").cast("long").alias("q"))
    return rows.withColumn("__gap", F.concat(inner, F.array(last))).drop("__ends", "__tops", "__heads")


def _without() -> Column:
    """__whole with MASK between its gaps; pages of PAGE code points keep the cost linear in the text."""
    page = F.col("__pages")

    def piece(g: Column) -> Column:
        a, z = F.floor(g["p"] / PAGE).cast("int"), F.floor((g["q"] - 1) / PAGE).cast("int")
        head = F.substring(F.get(page, a), (g["p"] - a * PAGE + 1).cast("int"), (g["q"] - g["p"]).cast("int"))
        middle = F.array_join(F.slice(page, a + 2, F.greatest(z - a - 1, F.lit(0))), "")
        tail = F.substring(F.get(page, z), F.lit(1), (g["q"] - z * PAGE).cast("int"))
        return F.when(g["q"] <= g["p"], F.lit("")).when(a == z, head).otherwise(F.concat(head, middle, tail))

    return F.array_join(F.transform("__gap", piece), MASK)


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every secret in `text` replaced by MASK; null texts stay null and all rows and columns are kept.

    What is masked is the union of the spans that scan() reports, so that no character of one is left; spans that touch
    or overlap share one MASK. n_chars, where there is one, is the new length of a changed text. Columns may have any
    names; an empty table gives no rows, repeated rows and null ids stay.
    """
    model = model or train(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("__whole"))
    rows = _spans(rows, model, "__whole").withColumn("__all", F.sort_array(F.concat("__base", "__markov")))
    some = F.size("__all") > 0
    rows = rows.withColumn("__pages", F.when(some, F.regexp_extract_all("__whole", F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))))
    rows = _gaps(rows)
    rows = rows.withColumn("__new", F.when(some, _without()).otherwise(F.col("__whole")))
    out = {c: F.col("row").getField(c) for c in docs.columns}
    if "n_chars" in out:
        out["n_chars"] = F.when(some, F.length("__new").cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    out["text"] = F.col("__new")
    return rows.select(*[v.alias(c) for c, v in out.items()])
