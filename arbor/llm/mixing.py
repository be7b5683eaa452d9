"""Drawing documents from sources so that each supplies its share of all tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.prefix import exclusive_sum

#: Expected copies are whole multiples of 1 / UNIT, so that prefix sums are exact in any order of adding.
UNIT = 2**32
#: Sources that a table of targets may name.
MOST_SOURCES = 10_000


def rates(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> list[dict]:
    """Per source with a target: source, target_share, max_repeats, tokens there, goal_share, and copies, the expected
    number of copies of each of its documents.

    sizes: source, n_tokens of each document. targets: source, target_share, max_repeats, at most MOST_SOURCES rows,
    checked; rows with a null source, or a share or limit that is null or not positive, are left out, and of repeated
    sources the row with the largest share counts. Sources without tokens can supply nothing, so the shares of
    the others are scaled to sum to 1 (goal_share). `total` is the size of the mixture in tokens, by default the
    largest at which no source needs more than max_repeats copies of a document; a greater one leaves sources at
    their limit, short of their share.
    """
    want = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("w"))
    have = sizes.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    rows = [r.asDict() for r in want.select("source", "w.*").join(have, "source", "left").take(MOST_SOURCES + 1)]
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    able = sum(r["target_share"] for r in rows if r["tokens"])
    for r in rows:
        r["goal_share"] = r["target_share"] / able if r["tokens"] else 0.0
    most = min((r["max_repeats"] * r["tokens"] / r["goal_share"] for r in rows if r["tokens"]), default=0.0)
    for r in rows:
        r["copies"] = min(float(r["max_repeats"]), (most if total is None else total) * r["goal_share"] / r["tokens"]) if r["tokens"] else 0.0
    return rows


def draw(sizes: DataFrame, given: list[dict], seed: int = 1, stretch: int = 20_000) -> DataFrame:
    """source, doc_id, n_tokens, repeats of each drawn document, by systematic sampling.

    Documents of a source stand in order of size, then id; the prefix sum of their expected copies, moved by one random
    offset per source, crosses whole numbers, and each crossing is a copy. So a document's copies are its expected
    number rounded down or up, never more than max_repeats, and every range of sizes supplies its part. Documents
    without tokens, source or target are never drawn. Repeated rows are documents of their own.

    The prefix sum has three levels: stretches of a source, by size and hash with about `stretch` documents each, are
    summed with partial aggregation and added up in groups of 256, then each stretch adds up its own documents; so no task
    holds a source. Sums are of whole numbers, and so the same in every run.
    """
    if not any(r["copies"] for r in given):
        return sizes.select("source", "doc_id", "n_tokens", F.lit(0).cast("long").alias("repeats")).limit(0)
    # as many rows as there are sources with a target, of which rates takes MOST_SOURCES at most
    rate = sizes.sparkSession.createDataFrame([(r["source"], round(r["copies"] * UNIT)) for r in given], "source string, units long")
    docs = sizes.where("source is not null and n_tokens > 0").select("source", "doc_id", "n_tokens").join(F.broadcast(rate), "source").where("units > 0")
    scatter = max(1, sizes.count() // (stretch * 8))
    docs = docs.withColumns({"size": F.floor(F.log2("n_tokens") * 8).cast("int"), "part": F.pmod(F.xxhash64("doc_id"), F.lit(scatter)).cast("int")})
    sums = docs.groupBy("source", "size", "part").agg(F.sum("units").alias("all"))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.lit(UNIT))
    starts = exclusive_sum(sums, ["source"], [F.col("size"), F.shiftright("part", 8)], [F.col("part")], F.col("all"), "start").select("source", "size", "part", (F.col("start") + offset).alias("start"))
    upto = Window.partitionBy("source", "size", "part").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.withColumn("within", F.sum("units").over(upto)).join(starts, ["source", "size", "part"])
    end = F.col("start") + F.col("within")
    copies = F.shiftright(end, 32) - F.shiftright(end - F.col("units"), 32)
    return placed.select("source", "doc_id", "n_tokens", copies.alias("repeats")).where("repeats > 0")


def shares(drawn: DataFrame, given: list[dict]) -> DataFrame:
    """source, target_share, goal_share, share (reached), tokens (of the mixture), n_docs, max_repeats, most_repeats."""
    spark = drawn.sparkSession
    got = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("n_docs"), F.max("repeats").alias("most_repeats"))
    want = spark.createDataFrame([(r["source"], float(r["target_share"]), float(r["goal_share"]), int(r["max_repeats"])) for r in given], "source string, target_share double, goal_share double, max_repeats int")
    out = want.join(got, "source", "left").fillna(0, ["tokens", "n_docs", "most_repeats"])
    every = Window.partitionBy()  # one row per source with a target, at most MOST_SOURCES
    return out.withColumn("share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(every), F.lit(0)), F.lit(0.0)))
