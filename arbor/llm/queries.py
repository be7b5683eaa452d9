"""The queries of problems 2, 3, 6, 7, 8 and 9, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import keyed
from ..plans.cut import cut
from ..sources.tables import read_table
from . import bpe, mixing, mojibake, packing, quantiles, topn

PERCENTS = [1, 5, 25, 50, 75, 95, 99]


def _records(spark: SparkSession, folder: str, *values: str) -> DataFrame:
    return keyed(read_table(spark, folder, "forest"), ["tree_node_index"], list(values))


def p2_top(spark: SparkSession, folder: str) -> DataFrame:
    """The three most massive progenitors of each descendant."""
    rows = _records(spark, folder, "desc_node_index", "tree_node_mass").where("desc_node_index >= 0")
    return topn.top_n(rows, "desc_node_index", "tree_node_mass", "tree_node_index", 3)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The three most massive progenitors of each descendant with at least four."""
    rows = _records(spark, folder, "desc_node_index", "tree_node_mass").where("desc_node_index >= 0")
    return topn.top_n(rows, "desc_node_index", "tree_node_mass", "tree_node_index", 3, min_items=4).drop("tree_node_mass")


def _placed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    roots = _records(spark, folder, "desc_node_index", "branch_size").where("desc_node_index is null or desc_node_index < 0")
    layouts = read_table(spark, folder, "chunk_layouts")
    roots = cut(roots.select("tree_node_index", "branch_size"), "roots")
    return packing.pack(roots, "tree_node_index", "branch_size", layouts, "layout_name", "capacity_rows"), layouts


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Layouts and roots whose tree had to be split."""
    placed, _ = _placed(spark, folder)
    return placed.where("n_pieces > 1").select(F.col("layout").alias("layout_name"), F.col("item").alias("tree_node_index")).distinct()


def p3_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk of each piece of each tree."""
    placed, _ = _placed(spark, folder)
    return placed.select(F.col("layout").alias("layout_name"), F.col("item").alias("tree_node_index"), "piece", "n_pieces", F.col("size").alias("n_rows"), F.col("container").alias("chunk"))


def p3_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full each chunk is."""
    placed, layouts = _placed(spark, folder)
    out = packing.fills(placed, layouts, "layout_name", "capacity_rows")
    return out.select(F.col("layout").alias("layout_name"), F.col("container").alias("chunk"), F.col("n_pieces").alias("n_trees"), F.col("size").alias("n_rows"), "fill")


def p3_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of each layout: trees and rows laid out, chunks that hold too much (none), and whether there are at
    most two per cent, and two, more chunks than the rows need at least."""
    placed, layouts = _placed(spark, folder)
    placed = cut(placed, "placed")
    full = packing.fills(placed, layouts, "layout_name", "capacity_rows").groupBy("layout").agg(F.sum("size").alias("n_rows"), F.sum((F.col("fill") > 1).cast("long")).alias("n_over"), F.count("*").alias("n_chunks"))
    room = layouts.select(F.col("layout_name").alias("layout"), "capacity_rows").distinct()
    trees = placed.where("piece = 1").groupBy("layout").agg(F.count("*").alias("n_trees"))
    tight = F.col("n_chunks") <= F.ceil(F.col("n_rows") / F.col("capacity_rows")) * 1.02 + 2
    return full.join(room, "layout").join(trees, "layout").select(F.col("layout").alias("layout_name"), "n_trees", "n_rows", "n_over", tight.alias("tight"))


def p3_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces and rows of each tree as laid out, from the chunks."""
    placed, _ = _placed(spark, folder)
    return placed.groupBy(F.col("layout").alias("layout_name"), F.col("item").alias("tree_node_index")).agg(F.count("*").alias("n_pieces"), F.sum("size").alias("n_rows"))


def _summaries(spark: SparkSession, folder: str, k: int = quantiles.K) -> DataFrame:
    rows = read_table(spark, folder, "forest").select("snapnum", F.datediff(F.col("loaded_at").cast("date"), F.lit("1970-01-01").cast("date")).alias("day"), "tree_node_mass")
    return quantiles.summarize(rows, ["snapnum", "day"], "tree_node_mass", k)


#: The day of a summary as a date.
_DAY = "date_add(date '1970-01-01', cast(day as int)) as day"


def p6_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of the finite masses of each snapshot and day of loading, and with a null day of each snapshot over all
    days: the first from the daily summaries, which are kept, the others from these combined."""
    daily = cut(quantiles.merged(_summaries(spark, folder), ["snapnum", "day"]), "daily")
    parts = quantiles.percentiles(daily, ["snapnum", "day"], PERCENTS)
    whole = quantiles.percentiles(quantiles.merged(daily, ["snapnum"]), ["snapnum"], PERCENTS).withColumn("day", F.lit(None).cast("long"))
    return parts.unionByName(whole).select(F.col("snapnum").cast("int").alias("snapnum"), F.expr(_DAY), "percent", "value", "n_values", "max_rank_error")


def p6_within(spark: SparkSession, folder: str, k: int = 64) -> DataFrame:
    """Whether each percentile of each snapshot is within its stated error, with buffers so small that they collapse: the
    ranks that the value really has, counted over all rows, against the rank asked for."""
    made = cut(quantiles.percentiles(quantiles.merged(_summaries(spark, folder, k), ["snapnum"], k), ["snapnum"], PERCENTS), "percentiles")
    rows = read_table(spark, folder, "forest").select("snapnum", F.col("tree_node_mass").cast("double").alias("x")).where("x is not null and not isnan(x) and abs(x) < double('infinity')")
    # as many rows per snapshot as there are percents, joined to all its values and summed before the shuffle
    of = made.groupBy("snapnum").agg(F.collect_list(F.struct("percent", "value", "n_values", "max_rank_error")).alias("p"))
    each = rows.join(of, rows["snapnum"].eqNullSafe(of["snapnum"])).select(of["snapnum"], "x", F.explode("p").alias("p")).select("snapnum", "x", "p.*")
    ranks = each.groupBy("snapnum", "percent", "n_values", "max_rank_error").agg(F.sum((F.col("x") < F.col("value")).cast("long")).alias("below"), F.sum((F.col("x") <= F.col("value")).cast("long")).alias("upto"))
    asked = F.greatest(F.lit(1), F.ceil(F.col("percent") * F.col("n_values") / 100))
    near = (F.col("below") + 1 - F.col("max_rank_error") <= asked) & (asked <= F.col("upto") + F.col("max_rank_error"))
    return ranks.select(F.col("snapnum").cast("int").alias("snapnum"), "percent", near.alias("within"))


def p6_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of the finite masses of each snapshot and day of loading: what the daily summaries say by themselves."""
    out = quantiles.percentiles(quantiles.merged(_summaries(spark, folder), ["snapnum", "day"]), ["snapnum", "day"], PERCENTS)
    return out.select(F.col("snapnum").cast("int").alias("snapnum"), F.expr(_DAY), "percent", "value", "n_values", "max_rank_error")


def p6_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of the finite masses of each snapshot, over every delivered row, from daily summaries."""
    daily = quantiles.merged(_summaries(spark, folder), ["snapnum", "day"])
    out = quantiles.percentiles(quantiles.merged(daily, ["snapnum"]), ["snapnum"], PERCENTS)
    return out.withColumn("snapnum", F.col("snapnum").cast("int"))


def p6_days(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of the finite masses of each day of loading, from the same summaries."""
    out = quantiles.percentiles(quantiles.merged(_summaries(spark, folder), ["day"]), ["day"], PERCENTS)
    return out.select(F.expr(_DAY), "percent", "value", "n_values", "max_rank_error")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The byte_bpe_50k ids of each text."""
    return bpe.encode(read_table(spark, folder, "documents"), "text", ["doc_id"])


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the ids of each text decode to the text; a null one, like an empty one, to an empty text."""
    docs = bpe.encode(read_table(spark, folder, "documents"), "text", ["doc_id", "text"])
    back = bpe.decode(docs, "ids", ["doc_id", "text"])
    return back.select("doc_id", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"))


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, list[dict], DataFrame]:
    sizes = cut(bpe.encode(read_table(spark, folder, "documents"), "text", ["doc_id", "source"], count_only=True), "sizes")
    given = mixing.rates(sizes, read_table(spark, folder, "mix_targets"))
    return mixing.draw(sizes, given), given, sizes


def p8_drawn(spark: SparkSession, folder: str) -> DataFrame:
    """The drawn documents with their repeats."""
    return _mixture(spark, folder)[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of each source."""
    drawn, given, _ = _mixture(spark, folder)
    return mixing.shares(drawn, given)


def p8_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the drawing, per source that can supply something: that no document is drawn more often than the
    source's max_repeats, and that its copies are as many as expected, but for one."""
    drawn, given, sizes = _mixture(spark, folder)
    most = spark.createDataFrame([(r["source"], int(r["max_repeats"]), float(r["copies"])) for r in given if r["copies"]], "source string, max_repeats int, expected double")
    there = sizes.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n"))
    got = drawn.groupBy("source").agg(F.max("repeats").alias("most"), F.sum("repeats").alias("copies"))
    rows = most.join(there, "source").join(got, "source", "left").fillna(0, ["most", "copies"])
    return rows.select("source", (F.col("most") <= F.col("max_repeats")).alias("within_limit"), (F.abs(F.col("copies") - F.col("n") * F.col("expected")) < 1.01).alias("as_expected"))


def _second_model(docs: DataFrame) -> mojibake.Model:
    first = mojibake.train(docs, "text")
    return mojibake.without(first, mojibake.suspects(docs, "text", [], first), "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a passage that was decoded with a wrong character encoding."""
    docs = read_table(spark, folder, "documents")
    return mojibake.cases(docs, "text", ["doc_id"], _second_model(docs))


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Their texts as restored, the chains undone, what these gained, and whether characters stay lost."""
    docs = read_table(spark, folder, "documents")
    return mojibake.find(docs, "text", ["doc_id"], _second_model(docs))


QUERIES = {f.__name__: f for f in (p2_found, p2_top, p3_found, p3_chunks, p3_fill, p3_trees, p3_kept, p6_levels, p6_percentiles, p6_daily, p6_days, p6_within, p7_ids, p7_round_trip, p8_drawn, p8_shares, p8_kept, p9_found, p9_restored)}

_LATEST = "r AS (SELECT tree_node_index AS t, max(struct_pack(a := loaded_at, d := desc_node_index, m := tree_node_mass, b := branch_size)) AS x FROM forest WHERE tree_node_index IS NOT NULL GROUP BY 1)"
_RANKED = f"""WITH {_LATEST}, k AS (SELECT x.d AS desc_node_index, t AS tree_node_index, CAST(x.m AS DOUBLE) AS tree_node_mass,
  CAST(row_number() OVER (PARTITION BY x.d ORDER BY x.m DESC, t) AS INT) AS rnk, count(*) OVER (PARTITION BY x.d) AS n FROM r WHERE x.d >= 0 AND isfinite(x.m))"""
_ROOTS = f"WITH {_LATEST}, roots AS (SELECT t, CAST(x.b AS BIGINT) AS b FROM r WHERE (x.d IS NULL OR x.d < 0) AND x.b > 0)"
_PERCENTILES = f"""SELECT {{key}}, CAST(p AS INT) AS percent, CAST(v AS DOUBLE) AS value, n AS n_values, CAST(0 AS DOUBLE) AS max_rank_error
FROM (SELECT {{key}}, tree_node_mass AS v, row_number() OVER (PARTITION BY {{key}} ORDER BY tree_node_mass) AS k, count(*) OVER (PARTITION BY {{key}}) AS n
  FROM (SELECT {{expr}} AS {{key}}, tree_node_mass FROM forest WHERE isfinite(tree_node_mass)))
JOIN (SELECT unnest({PERCENTS}) AS p) ON k = greatest(1, (p * n + 99) // 100)"""

ORACLES = {
    "p2_found": f"{_RANKED} SELECT desc_node_index, rnk, tree_node_index FROM k WHERE rnk <= 3 AND n >= 4",
    "p2_top": f"{_RANKED} SELECT desc_node_index, rnk, tree_node_index, tree_node_mass FROM k WHERE rnk <= 3",
    "p3_found": f"{_ROOTS} SELECT layout_name, t AS tree_node_index FROM roots JOIN chunk_layouts ON b > capacity_rows",
    "p3_trees": f"{_ROOTS} SELECT layout_name, t AS tree_node_index, (b + capacity_rows - 1) // capacity_rows AS n_pieces, b AS n_rows FROM roots CROSS JOIN chunk_layouts",
    "p3_kept": f"{_ROOTS} SELECT layout_name, count(*) AS n_trees, CAST(sum(b) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_over, true AS tight FROM roots CROSS JOIN chunk_layouts GROUP BY 1",
    "p6_levels": _PERCENTILES.replace("{expr} AS {key}", "{expr}").format(key="snapnum, day", expr="CAST(snapnum AS INT) AS snapnum, CAST(loaded_at AS DATE) AS day") + " UNION ALL SELECT snapnum, NULL, percent, value, n_values, max_rank_error FROM (" + _PERCENTILES.format(key="snapnum", expr="CAST(snapnum AS INT)") + ")",
    "p6_within": f"SELECT DISTINCT CAST(snapnum AS INT) AS snapnum, CAST(p AS INT) AS percent, true AS within FROM forest CROSS JOIN (SELECT unnest({PERCENTS}) AS p) WHERE isfinite(tree_node_mass)",
    "p7_round_trip": "SELECT doc_id, true AS same FROM documents",
    "p8_kept": "SELECT DISTINCT source, true AS within_limit, true AS as_expected FROM mix_targets JOIN documents USING (source) WHERE text <> '' AND target_share > 0 AND max_repeats > 0",
    "p6_daily": _PERCENTILES.replace("{expr} AS {key}", "{expr}").format(key="snapnum, day", expr="CAST(snapnum AS INT) AS snapnum, CAST(loaded_at AS DATE) AS day"),
    "p6_percentiles": _PERCENTILES.format(key="snapnum", expr="CAST(snapnum AS INT)"),
    "p6_days": _PERCENTILES.format(key="day", expr="CAST(loaded_at AS DATE)"),
}
