"""Mixing of sources to target weights by entropy balancing; DataFrame functions only.

Each source has a token target. Its documents' rates minimise a bounded relative entropy to rate 1 under the token
constraint, so a rate is cap / (1 + (cap - 1) exp(-lambda x)): an exponential tilt in x, the document's log length,
that stays below the cap. The multipliers lambda solve the convex dual by Newton steps, each one aggregation of the
(source, size) histogram. Rates become whole copies by a cut on a hash of the id: the cut is found in two levels of a
fixed-size histogram, so that the copies' words meet the target up to a document, with no sort of a source's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeledger.llm.common import WORD, Scratch
from changeledger.operators.prefix import sequence

LEVELS = 4096
WEIGHTS = (5.0, 2.0, 1.0)
#: Newton steps at most; not to converge by then is an error. Multiplier of a source whose documents all take the cap.
STEPS, FULL = 100, 1e6


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Null and every string apart, null last in code-point order."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def targets(sources: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """Adds `target` to (k, source_size): all sizes shared out by weight, none above cap times its own size.

    One row per source, any number of them. A level of words per weight is raised until the sources that it fills beyond
    their most stay the same; each step is one aggregation, and filled sources stay filled.
    """
    numbered = sequence(sources, ["k"], "n")
    turn = F.pmod(F.col("n") - 1, F.lit(len(weights))).cast("int")
    weighed = numbered.withColumn("w", F.get(F.array(*map(F.lit, weights)), turn)).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    level, filled = 0.0, -1
    while True:
        full = F.col("most") <= F.col("w") * level
        now = weighed.agg(
            F.sum("source_size").alias("total"), F.count_if(full).alias("filled"),
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("used"), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("open"),
        ).first()
        if not now.open or now.filled == filled:
            break
        filled, level = now.filled, (now.total - now.used) / now.open
    return weighed.select("k", "source_size", F.least("most", F.col("w") * level).alias("target"))


def _tilt(size: Column) -> Column:
    return F.log1p(size.cast("double")) / 6.0


def _rate(lam: Column, size: Column, cap: float) -> Column:
    return F.lit(cap) / (1.0 + (cap - 1.0) * F.exp(F.least(F.lit(600.0), -lam * _tilt(size))))


def _draw(docs_k: Column) -> Column:
    """A hash of id, source and text: rows that differ in any of them draw apart."""
    return F.xxhash64(F.col("doc_id").cast("long"), docs_k, F.col("text").cast("string"))


def _share(draw: Column) -> Column:
    """A number in [0, 1) from a draw."""
    return F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))


def plan(docs: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """One row per source: k, source_size, target, lam and cut; copies() turns them into a document's copies."""
    scratch = Scratch(docs.sparkSession)
    key = source_key(F.col("source"))
    sized = docs.select(key.alias("k"), _draw(key).alias("draw"), size_of(F.col("text")).alias("size"))
    sized = scratch.save(sized, "sized")
    hist = scratch.save(sized.groupBy("k", "size").agg(F.count("*").alias("n")), "hist")
    state = targets(hist.groupBy("k").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap)
    at_cap = F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))
    state = scratch.save(state.withColumn("lam", F.when(at_cap, F.lit(FULL)).otherwise(F.lit(0.0))), "state")
    for _ in range(STEPS):
        r = _rate(F.col("lam"), F.col("size"), cap)
        words = F.col("n") * F.col("size")
        moved = (
            hist.join(state, "k").groupBy("k", "source_size", "target", "lam")
            .agg(F.sum(words * r).alias("got"), F.sum(words * r * (1 - r / cap) * _tilt(F.col("size"))).alias("slope"))
            .withColumn("miss", F.col("target") - F.col("got"))
            .withColumn("step", F.when(F.col("slope") > 1e-9, F.greatest(F.lit(-3.0), F.least(F.lit(3.0), F.col("miss") / F.when(F.col("slope") > 1e-9, F.col("slope"))))).otherwise(F.lit(0.0)))
        )
        moved = scratch.save(moved.select("k", "source_size", "target", (F.col("lam") + F.col("step")).alias("lam"), (F.abs("miss") / F.greatest(F.col("target"), F.lit(1.0))).alias("off")), "state")
        worst = moved.agg(F.max("off")).first()[0]
        scratch.free(state)
        state = moved
        if worst is None or worst < 1e-4:
            break
    else:
        raise RuntimeError(f"the rates miss a target by {worst:.2g} of it after {STEPS} steps")
    r = _rate(F.col("lam"), F.col("size"), cap)
    drawn = sized.where("size > 0").join(state, "k").withColumn("r", r).withColumn("v", _share(F.col("draw")) - (F.col("r") - F.floor("r")))
    base = drawn.groupBy("k").agg(F.sum(F.col("size") * F.floor("r")).alias("whole"))
    need = scratch.save(state.join(base, "k", "left").select("k", "source_size", "target", "lam", (F.col("target") - F.coalesce("whole", F.lit(0))).alias("need")), "need")
    # v is in (-1, 1); the extra copy goes to the documents below the cut.
    drawn = drawn.where(F.col("r") < cap).select("k", "size", ((F.col("v") + 1) / 2 * LEVELS).alias("at"))
    one = _cross(drawn.withColumn("b", F.floor("at")), need.select("k", "need"))
    two = _cross(drawn.join(one.select("k", F.col("b").alias("b1"), "before"), "k").where("floor(at) = b1").select("k", "size", F.floor((F.col("at") - F.col("b1")) * LEVELS).alias("b"), "b1", "before"), need.join(one.select("k", "b", "before"), "k").select("k", (F.col("need") - F.col("before")).alias("need")))
    two = two.select("k", F.when(F.col("need") - F.col("before") > F.col("words") / 2, F.col("b") + 1).otherwise(F.col("b")).alias("b2"))
    cut = F.when(F.col("need") <= 0, F.lit(0.0)).otherwise(F.coalesce(F.col("b") + F.col("b2") / LEVELS, F.lit(float(LEVELS + 1))))
    done = need.join(one.select("k", "b"), "k", "left").join(two, "k", "left").select("k", "source_size", "target", "lam", cut.alias("cut"))
    return scratch.save(done, "plan")


def _cross(cells: DataFrame, need: DataFrame) -> DataFrame:
    """For each k the level b (at most LEVELS of them) in which the running words reach its need."""
    run = Window.partitionBy("k").orderBy("b")
    sums = cells.groupBy("k", "b").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(run) - F.col("words")).join(need, "k")
    return sums.where("need > before and need <= before + words").select("k", "b", "before", "words", "need")


def _copies(draw: Column, size: Column, lam: Column, cut: Column, cap: float) -> Column:
    r = _rate(lam, size, cap)
    level = (_share(draw) - (r - F.floor(r)) + 1) / 2 * LEVELS
    extra = (r < cap) & (F.floor(level * LEVELS) < F.round(cut * LEVELS))
    return F.when(size == 0, F.lit(0)).otherwise(F.least(F.floor(r) + extra.cast("int"), F.lit(int(cap)))).cast("long")


def _chosen(docs: DataFrame, weights, cap: float) -> DataFrame:
    """(row, k, size, source_size, target, copies): docs' rows as structs, so that their columns may have any names."""
    per_source = plan(docs, weights, cap)
    key = source_key(F.col("source"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("k"), size_of(F.col("text")).alias("size"), _draw(key).alias("draw"))
    return rows.join(per_source, "k").withColumn("copies", _copies(F.col("draw"), F.col("size"), F.col("lam"), F.col("cut"), cap))


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """docs with size, source_size, target, copies and taken; input columns of those names are replaced.

    Null texts have size 0 and, like empty ones, no copies. Null sources are one source, the last. Rows that share
    source, id (null is a value) and text share their draw, so reruns and repeated rows agree. An empty table gives no
    rows; where all sizes are 0 all targets are. Sources of any number are targeted; those filled to the cap take it whole.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    rows = _chosen(docs, weights, cap).withColumn("taken", F.col("copies") * F.col("size"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in new], *new)


def mixed(docs: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """docs in the mixed corpus: each row as often as its copies, with the columns of docs. Empty texts have no copies."""
    rows = _chosen(docs, weights, cap).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
