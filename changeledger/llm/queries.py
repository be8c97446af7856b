"""The registered queries of this subpackage: queries() and oracle_sql() entries by name."""

from __future__ import annotations

from changeledger.llm import ann, exact, flac, mixing, oracles, packing, repair, secrets, simhash, spelling, substring, toxicity, turns, urls
from changeledger.llm.common import table


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_substring(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op6_repair(spark, sf_dir):
    return repair.round_trip(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ann(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"))


def op3_flac(spark, sf_dir):
    return flac.round_trip(table(spark, sf_dir, "documents"))


def op11_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"), damage=97)


def op12_turns(spark, sf_dir):
    return turns.repair_conversations(table(spark, sf_dir, "conversations"), damage=True)


def op13_exact(spark, sf_dir):
    return exact.find_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    "op3_flac": op3_flac,
    "op4_toxicity": op4_toxicity,
    "op5_ann": op5_ann,
    "op2_secrets": op2_secrets,
    "op8_mixing": op8_mixing,
    "op9_urls": op9_urls,
    "op6_repair": op6_repair,
    "op7_packing": op7_packing,
    "op10_substring": op10_substring,
    "op1_simhash": op1_simhash,
    "op11_spelling": op11_spelling,
    "op12_turns": op12_turns,
    "op13_exact": op13_exact,
}
ORACLE_SQL = {"op9_urls": oracles.OP9, "op10_substring": oracles.OP10, "op13_exact": oracles.OP13}
