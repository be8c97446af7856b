import hashlib
import random
import re

from pyspark.sql import functions as F

from changeledger.llm import secrets
from changeledger.llm.queries import op2_secrets
from tests.conftest import SF

BASE = (
    ("assign", re.compile(r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, g, n) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= n]
    return [sum(f[3] == k for f in found) for k, *_ in BASE], ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


def check(rows, got):
    assert len(got) == len(rows)
    by = {}
    for d, t in rows:
        by.setdefault(d, []).append(brute(t))
    for r in got:
        hits = [(n, s) for n, s in by[r.doc_id] if [r.n_assign, r.n_access, r.n_hex] == n and r.base_sha256 == hashlib.sha256(s.encode()).hexdigest()]
        assert hits, (r, by[r.doc_id])
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("markov")) == hits[0][1]


WORDS = "the quick brown fox jumps over the lazy dog internationalization characteristically and misunderstanding "


def test_small(spark):
    h = "0123456789abcdef0123"
    rows = [
        (1, None), (2, ""), (3, "PassWord = 'abcdefghijklmnop' x"), (4, "token=secret:abcdefghijklmnop token: short api-key=1 apikey:AAAABBBBCCCCDDDD"), (5, "é😀 AKIA" + "Z9" * 9 + f" {h}"), (6, h * 3 + "g" + h + "AKIAKIA"),
        (7, f"token={h} x " * 900), (8, "deadbeef " * 20000), (9, f"secret=\"{h}\""), (9, f"secret=\"{h}\""), (None, h), (10, WORDS * 40), (11, "key QmFzZTY0xK9zLw8Tq2VnRj4Yp7Ud here"), (12, "internationalizationcharacteristically misunderstandingthelazy"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as __m", "2 as n_hex")
    model = secrets.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = secrets.scan(df, model).collect()
    check(rows, got)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[11] == "markov:4:32" and spans[12] == "" and spans[10] == ""
    parts = secrets.scan(spark.createDataFrame([(1, f"id Zx81Kq92mT0p and {h}Qm9ZLw8Tq2VnRj4x")], "doc_id long, text string"), model).first().spans
    assert parts == "markov:3:15,hex:20:40,markov:40:56", parts
    assert secrets.scan(df.limit(0)).count() == 0
    check(rows, secrets.scan(df).collect())
    redacted = secrets.redact(df, model).collect()
    assert all(r["__m"] == "mine" and r.n_hex == 2 for r in redacted)
    clean = {r.doc_id: r.text for r in redacted}
    assert clean[11] == "key [SECRET] here" and clean[1] is None and clean[10] == WORDS * 40 and clean[5] == "é😀 [SECRET] [SECRET]"
    assert not any(brute(t)[1] for t in clean.values())


def masked(text, spans):
    """text with every maximal run of covered characters as one mask; spans that touch are one run."""
    covered = [False] * len(text)
    for span in filter(None, spans.split(",")):
        _, a, z = span.split(":")
        covered[int(a) : int(z)] = [True] * (int(z) - int(a))
    return "".join(("[SECRET]" if not i or not covered[i - 1] else "") if covered[i] else c for i, c in enumerate(text))


def test_redact_masks_the_union_of_all_spans(spark):
    """Spans of several kinds that overlap, touch or hold one another, many of them, and spans over the pages' edges."""
    h, a = "0123456789abcdef", "AKIA" + "B7" * 9
    texts = [
        "0123456789abcdeapi_key=abcdefghijklmnop x", f"token={h}{a}", f"{h}{a}{h}", f"{a}token={a}", f"é😀{h}secret: {a}", f"apikey={h}.{h}.{a} end", f"{h}", f" {h} ", f"x token={h} y {a}{h}",
        f"token={h}-{a} " * 700, "😀" * 4090 + h + "y" * 8190 + a + " é" * 4100 + f"secret={h}", "z" * 4096 + " " + h, "no secret", f"{h}Qm9ZLw8Tq2VnRj4x{a}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'m' as __all", "cast(length(text) as int) as n_chars", "1 as __gap")
    model = secrets.train(spark.read.parquet(f"{SF}/documents.parquet"))
    spans = {r.doc_id: r.spans for r in secrets.scan(df, model).collect()}
    out = secrets.redact(df, model)
    assert out.columns == df.columns
    for r in out.collect():
        assert r.text == masked(texts[r.doc_id], spans[r.doc_id]), r.doc_id
        assert r.n_chars == len(r.text) and not brute(r.text)[1]


def test_no_span_is_left_in_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = secrets.train(docs)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    spans = {r.doc_id: r.spans for r in secrets.scan(docs, model).collect()}
    new = {r.doc_id: r.text for r in secrets.redact(docs, model).select("doc_id", "text").collect()}
    assert sum(map(bool, spans.values())) > 30
    assert all(new[d] == masked(texts[d], spans[d]) and not brute(new[d])[1] for d in texts)


def test_scores(spark):
    model = secrets.train(spark.read.parquet(f"{SF}/documents.parquet"))
    words = ["QmFzZTY0xK9zLw8Tq2VnRj4Yp7Ud", "9f8e7d6c5b4a39281706f5e4", "internationalizationcharacteristically", "thereanderationtheding", "Zx81Kq92mmT0"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    s = [r.s for r in df.select(secrets.score(secrets.F.col("w"), model.ratios).alias("s")).collect()]
    assert min(s[0], s[1], s[4]) > model.threshold > max(s[2], s[3]), (s, model.threshold)


def test_held_out_secrets(spark):
    """Random strings that no base rule matches, among the corpus' ordinary long words: precision and recall."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rnd = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    planted = ["".join(rnd.choice(letters) for _ in range(rnd.randint(12, 40))) for _ in range(300)]
    held = docs.where("doc_id % 4 = 1").select("doc_id", "text")
    model = secrets.train(docs.where("doc_id % 4 != 1"))
    rows = spark.createDataFrame([(-1 - i, f"see {w} there") for i, w in enumerate(planted)], "doc_id long, text string")
    got = secrets.scan(rows.union(held), model).select("doc_id", "n_markov").collect()
    hits, false = sum(r.n_markov for r in got if r.doc_id < 0), sum(r.n_markov for r in got if r.doc_id >= 0)
    assert hits >= 0.95 * len(planted) and false <= 5, (hits, false)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op2_secrets(spark, SF).collect()
    check(rows, got)
