"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Words are the tokens. Sources in code point order (null last) weigh 5, 2, 1, repeating, and share as many words as there
are; no target exceeds CAP times its source's words, and the excess goes to the others by weight. The targets are then
turned into whole blocks of BLOCK words: highest quotients target / (2k + 1), first among the sources, then among each
source's shards of about SHARD words. A shard's documents lie in seeded order; its quota takes whole rounds of all its
blocks and, for the rest, a run of blocks that begins at a seeded one, so a document's share is the overlap of its words
with that run.

Everything is DataFrame work: a partial sum by source, windows over sources (few rows) and over shards (bounded words;
a hot source has many shards). Quotients are formed only near each quota, where the last block is decided.

Defined cases: null text has size 0; null source is a source of its own; empty input gives an empty result; rows repeat
as they come and count each; a null doc_id orders as an empty one; further columns are ignored by `mix`.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm import common as C

BLOCK, SHARD, CAP = 16, 65_536, 3
WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def _hash(*parts) -> F.Column:
    """An integer below 2**32 by md5, alike in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *parts)), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: source, source_size (a row a source). Adds rn, weight, target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("rn", F.row_number().over(order))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rn") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    s = s.withColumn("ratio", F.col("source_size") * CAP / F.col("weight"))
    up = W.orderBy("ratio", "rn").rowsBetween(W.unboundedPreceding, -1)
    down = W.orderBy("ratio", "rn").rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(1))
    s = s.withColumn("before", F.coalesce(F.sum("source_size").over(up), F.lit(0)) * CAP).withColumn("open", F.sum("weight").over(down))
    s = s.withColumn("level", (F.sum("source_size").over(whole) - F.col("before")) / F.col("open"))
    s = s.withColumn("full", F.col("ratio") <= F.col("level"))
    s = s.withColumn("share", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))  # of the first that is not full
    return s.withColumn("target", F.when(F.col("full"), (F.col("source_size") * CAP).cast("double")).otherwise(F.col("weight") * F.col("share"))).select("source", "source_size", "rn", "target")


def apportion(parties: DataFrame, key: str, weight: str, seats: str, among: list[str]) -> DataFrame:
    """Adds quota: Sainte-Lague seats of each party (key: its order on ties) among those with equal columns among.

    seats is the number to award, the same for all parties of a group. A party surely keeps its rounded fair share but
    for a margin of its share of the group's parties, so quotients are formed only within that margin.
    """
    group = W.partitionBy(*among) if among else W.partitionBy(F.lit(1))
    p = parties.withColumn("all_", F.sum(weight).over(group)).withColumn("parties", F.count("*").over(group))
    part = F.when(F.col("all_") > 0, F.col(weight) / F.col("all_")).otherwise(F.lit(0.0))
    p = p.withColumn("fair", F.floor(F.col(seats) * part + 0.5)).withColumn("margin", (F.ceil(F.col("parties") * part) + 2).cast("long"))
    p = p.withColumn("sure", F.greatest(F.lit(0), F.col("fair") - F.col("margin")).cast("long"))
    p = p.withColumn("left_", F.col(seats) - F.sum("sure").over(group))
    near = p.where(F.col(weight) > 0).withColumn("k", F.explode(F.sequence(F.col("sure"), F.col("fair") + F.col("margin"))))
    by = (W.partitionBy(*among) if among else W.partitionBy(F.lit(1))).orderBy((F.col(weight) / (2 * F.col("k") + 1)).desc(), key, "k")
    won = near.withColumn("place", F.row_number().over(by)).where("place <= left_")
    won = won.groupBy(*among, key).agg(F.count("*").alias("won"))
    names = [*among, key]
    joined = p.alias("p").join(won.alias("w"), [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in names], "left")
    return joined.select("p.*", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota")).drop("all_", "parties", "fair", "margin", "sure", "left_")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, and the document's words beyond whole copies as (lo1, hi1, lo2, hi2)."""
    spark = docs.sparkSession
    C.prepare(spark)
    size = F.size(F.filter(F.split(F.coalesce(docs[text_col], F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")).cast("long")
    rows = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), size.alias("size"), *(docs[c].alias(f"_{c}") for c in carry))
    if not carry:
        rows = C.cut(rows)
    sizes = C.cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    quotas = apportion(sizes.withColumn("seats", F.floor(F.sum("source_size").over(W.partitionBy(F.lit(1))) / BLOCK + 0.5)), "rn", "target", "seats", [])
    quotas = C.cut(quotas.select("source", "source_size", "rn", "target", "quota"))

    q = quotas.withColumnRenamed("source", "s_")
    placed = rows.join(q, rows["source"].eqNullSafe(q["s_"])).drop("s_")
    order = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD))
    placed = placed.withColumn("order_", order).withColumn("shard", F.pmod(F.conv(F.substring("order_", 1, 8), 16, 10).cast("long"), shards))
    held = placed.groupBy("rn", "quota", "shard").agg(F.sum("size").alias("shard_size"))
    held = apportion(held.withColumnRenamed("quota", "seats"), "shard", "shard_size", "seats", ["rn"])
    held = held.withColumn("blocks", F.ceil(F.col("shard_size") / BLOCK)).where("blocks > 0")
    held = held.withColumn("quota", F.least("quota", F.col("blocks") * CAP))
    held = held.select("rn", "shard", "blocks", F.expr("quota div blocks").alias("rounds"), F.expr("quota % blocks").alias("rest"), F.pmod(_hash(F.lit("block"), "rn", "shard"), F.col("blocks")).alias("first"))

    lane = W.partitionBy("rn", "shard").orderBy("order_", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = placed.drop("quota").withColumn("z", F.sum("size").over(lane)).withColumn("a", F.col("z") - F.col("size")).join(held, ["rn", "shard"], "left")
    lo, hi = F.col("first") * BLOCK, (F.col("first") + F.col("rest")) * BLOCK
    wrap = F.greatest(F.lit(0), (F.col("first") + F.col("rest") - F.col("blocks")) * BLOCK)
    piece = lambda x, y: (F.least(F.greatest(x, F.col("a")), F.col("z")) - F.col("a"), F.least(F.greatest(y, F.col("a")), F.col("z")) - F.col("a"))
    (lo1, hi1), (lo2, hi2) = piece(lo, F.least(hi, F.col("blocks") * BLOCK)), piece(F.lit(0), wrap)
    d = d.withColumns({"lo1": F.coalesce(lo1, F.lit(0)), "hi1": F.coalesce(hi1, F.lit(0)), "lo2": F.coalesce(lo2, F.lit(0)), "hi2": F.coalesce(hi2, F.lit(0)), "rounds": F.coalesce("rounds", F.lit(0))})
    taken = F.col("rounds") * F.col("size") + (F.col("hi1") - F.col("lo1")) + (F.col("hi2") - F.col("lo2"))
    return d.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "rounds", "lo1", "hi1", "lo2", "hi2", *(F.col(f"_{c}").alias(f"_{c}") for c in carry))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, text, source)."""
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def _copies(batch: pa.RecordBatch) -> dict:
    import re

    word = re.compile(C.WORD)
    cols = batch.to_pydict()
    out: dict[str, list] = {c: [] for c in ("doc_id", "text", "lang", "source", "n_chars")}
    for i, text in enumerate(cols["_text"]):
        texts = [text] * cols["rounds"][i]
        ranges = [(cols["lo1"][i], cols["hi1"][i]), (cols["lo2"][i], cols["hi2"][i])]
        if any(a < b for a, b in ranges):
            at = [m.span() for m in word.finditer(text)]
            texts.append("\n".join(text[at[a][0] : at[b - 1][1]] for a, b in sorted(ranges) if a < b))
        for t in texts:
            for c, v in (("doc_id", cols["doc_id"][i]), ("text", t), ("lang", cols["_lang"][i]), ("source", cols["source"][i]), ("n_chars", len(t) if t is not None else None)):
                out[c].append(v)
    return out


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of documents: a row for each whole copy, and one for the words beyond them."""
    taken = plan(docs, carry=("text", "lang")).where("taken > 0")
    return C.map_arrow(taken.select("doc_id", "source", "rounds", "lo1", "hi1", "lo2", "hi2", "_text", "_lang"), _copies, "doc_id long, text string, lang string, source string, n_chars long")
