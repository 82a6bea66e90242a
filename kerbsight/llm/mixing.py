"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over blocks. DataFrame operations only.

1. *Targets.* Sources, by code point with null last, weigh 5, 2, 1 in turn and share 150 % of all words; a target stops at
   twice its source's words and the excess is shared again by weight. That is the water level ``t = min(2 size, level *
   weight)``, found in one pass over the sources in the order of ``2 size / weight``.
2. *Blocks.* The documents of a source are dealt into ``BLOCKS`` blocks by the hash of their id. A target of ``k`` sizes and
   a rest takes every block ``k`` times and then whole blocks in permuted order until the rest is reached; the block in
   which it ends is taken in part, to the word.
3. *Splitting tree.* The blocks to take are quotas by source. The tree over the output shards halves them: the urn of a
   node holds its quotas, half of all its tickets are drawn without replacement for the left child, the others go right.
   So every shard's share of every source is exact and hypergeometric, and quotas add up at every node.
4. *Draw.* A shard takes, of each source, the next tickets of the permuted order that its quota says: blocks are disjoint.
   Inside a shard the order is a hash of shard, pass and document.

The tables of sources, blocks and tickets have at most ``BLOCKS`` rows for each source and pass; documents only move once, as
(id, source, size), by source and block, so the hot source is spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.llm.store import Scratch, is_small
from kerbsight.llm.words import WORD

c = F.col
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BLOCKS, SHARDS = 256, 16
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(*parts: Column | str) -> Column:
    """32 hex digits of the seed and the parts; the same in any SQL."""
    return F.md5(F.concat_ws("/", F.lit(SEED), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts]))


def _block(doc_id: str = "doc_id") -> Column:
    return F.conv(F.substring(_hash(F.lit("block"), doc_id), 1, 6), 16, 10).cast("int") % BLOCKS


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size); null is a source of its own."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(c("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    per = per.withColumn("weight", F.get(weights, (F.row_number().over(order) - 1) % len(WEIGHTS)))
    by_cap = Window.orderBy((c("source_size") / c("weight")), c("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = (
        per.withColumn("share", F.lit(SHARE) * F.sum("source_size").over(whole))
        .withColumn("capped", F.sum(c("source_size") * MOST).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (c("share") - F.coalesce("capped", F.lit(0))) / c("open"))
        .withColumn("fits", c("level") * c("weight") <= c("source_size") * MOST)
        .withColumn("level", F.max(F.when(c("fits"), c("level"))).over(whole))
    )
    target = F.least((c("source_size") * MOST).cast("double"), c("level") * c("weight"))
    return per.select("source", "source_size", F.coalesce(target, (c("source_size") * MOST).cast("double")).alias("target"))


def tickets(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """(source, block, pass, take, place): what the mix takes of each block, in the permuted order of its source.

    ``take`` is the number of words; less than the block's words only where the target ends."""
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("words")).where("words > 0")
    order = Window.partitionBy("source").orderBy(_hash(F.lit("order"), "source", "block"), "block")
    ranked = blocks.join(per, blocks["source"].eqNullSafe(per["source"])).drop(per["source"])
    goal = F.round("target").cast("long")
    ranked = (
        ranked.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("source")))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
        .withColumn("take", F.least(c("words"), goal - c("pass") * c("source_size") - c("before")))
        .where("take > 0")
    )
    return ranked.select("source", "block", "pass", "take", (c("pass") * c("blocks") + c("place")).alias("place"))


def _halved(quotas: Column) -> Column:
    """The left child's quotas: half of all tickets (rounded up), drawn from the urn without replacement.

    The urn is emptied source by source, ticket by ticket; ``rolls`` hashes give each draw."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q["n"])
    start = F.struct(F.array().cast("array<struct<source:string,n:long>>").alias("out"), ((total + 1) / 2).cast("long").alias("left"), total.alias("rest"))

    def of_source(state: Column, quota: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), state["left"].alias("left"), state["rest"].alias("rest"))

        def ticket(urn: Column, k: Column) -> Column:
            roll = F.pmod(F.xxhash64(F.lit(SEED), c("node"), urn["rest"], k), urn["rest"])
            won = (roll < urn["left"]).cast("long")
            return F.struct((urn["n"] + won).alias("n"), (urn["left"] - won).alias("left"), (urn["rest"] - 1).alias("rest"))

        each = F.when(quota["n"] > 0, F.sequence(F.lit(1).cast("long"), quota["n"])).otherwise(F.array().cast("array<long>"))
        urn = F.aggregate(each, zero, ticket)
        return F.struct(F.concat(state["out"], F.array(F.struct(quota["source"].alias("source"), urn["n"].alias("n")))).alias("out"), urn["left"].alias("left"), urn["rest"].alias("rest"))

    return F.aggregate(quotas, start, of_source, lambda s: s["out"])


def shard_quotas(drawn: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, source, quota, first): the tickets of each source that each shard takes, from place ``first`` on.

    ``shards`` is rounded up to a power of two. The tree has one row for each node of a level."""
    scratch = Scratch(drawn.sparkSession)
    level = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("quotas"))
    level = level.select(F.lit(1).alias("node"), "quotas")
    while shards > 1:
        shards = (shards + 1) // 2
        left = level.withColumn("left", _halved(c("quotas")))
        right = F.zip_with("quotas", "left", lambda a, b: F.struct(a["source"].alias("source"), (a["n"] - b["n"]).alias("n")))
        both = left.withColumn("child", F.explode(F.array(
            F.struct((c("node") * 2).alias("node"), c("left").alias("quotas")), F.struct((c("node") * 2 + 1).alias("node"), right.alias("quotas")))))
        level = scratch.keep(both.select("child.node", "child.quotas"), "mix-tree")
    quotas = level.select(c("node").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.source", c("q.n").alias("quota"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return quotas.withColumn("first", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def mix(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(draws, sizes). draws: (doc_id, source, size, twin, pass, shard, position, taken), a row for each time that a document is
    taken, with ``taken`` words of it from its start; twin numbers rows of equal doc_id, source and size. sizes: (doc_id, source,
    size, source_size, target) for every row of ``docs``.

    ``docs`` needs doc_id, source and text. Null texts have no words; null sources are one source; documents without words
    are never drawn. Repeated rows are documents of their own. ``position`` orders a shard. Reruns give the same mix. An
    empty table gives empty results."""
    scratch = Scratch(docs.sparkSession)
    sizes = docs.select(c("doc_id").cast("long").alias("doc_id"), c("source").cast("string").alias("source"), word_count(c("text").cast("string")).alias("size"))
    sizes = scratch.keep(sizes.withColumn("block", _block()), "mix-sizes")
    per, seen = scratch.keep(targets(sizes), "mix-targets", rows=F.count(F.lit(1)))
    drawn = scratch.keep(tickets(sizes, per), "mix-tickets")
    quotas = shard_quotas(drawn, shards)
    on = drawn["source"].eqNullSafe(quotas["source"]) & (drawn["place"] >= quotas["first"]) & (drawn["place"] < quotas["first"] + quotas["quota"])
    dealt = drawn.join(quotas, on).select(drawn["source"], "block", F.struct("pass", "take", "shard").alias("draw"))
    dealt = dealt.groupBy("source", "block").agg(F.sort_array(F.collect_list("draw")).alias("draws"))  # at most one for each pass

    in_block = Window.partitionBy("source", "block").orderBy(_hash(F.lit("doc"), "doc_id"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.where("size > 0").withColumn("before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    placed = placed.withColumn("twin", F.row_number().over(Window.partitionBy("source", "block", "doc_id", "size").orderBy("before")))
    on = placed["source"].eqNullSafe(dealt["source"]) & (placed["block"] == dealt["block"])
    draws = placed.join(dealt, on).select("doc_id", placed["source"], "size", "twin", "before", F.explode("draws").alias("draw"))
    draws = draws.withColumn("taken", F.least(c("size"), c("draw.take") - c("before"))).where("taken > 0")
    draws = draws.select(
        "doc_id", "source", "size", "twin", c("draw.pass").alias("pass"), c("draw.shard").alias("shard"),
        _hash(F.lit("place"), "draw.shard", "draw.pass", "doc_id").alias("position"), "taken")
    at = per.withColumnRenamed("source", "of")
    at = F.broadcast(at) if is_small(seen["rows"], 256) else at
    sizes = sizes.join(at, sizes["source"].eqNullSafe(at["of"])).drop("of", "block")
    return draws, sizes


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``; taken counts all the mix's passes."""
    draws, sizes = mix(docs)
    rows = sizes.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(1).alias("rows"))
    more = draws.select("doc_id", "source", "size", F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"), "taken", F.lit(0).alias("rows"))
    whole = rows.unionByName(more).groupBy("doc_id", "source", "size").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("taken").alias("taken"), F.sum("rows").alias("rows"))
    # repeated rows: the words taken of them together, spread over the rows in order
    each = whole.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), c("rows"))))
    share = F.floor(c("taken") * c("row") / c("rows")) - F.floor(c("taken") * (c("row") - 1) / c("rows"))
    return each.select("doc_id", "size", "source_size", "target", F.when(c("rows") > 1, share).otherwise(c("taken")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row of ``docs`` for each time that the mix takes it, with all its columns.

    Where the mix takes a document in part, its text is the words taken, joined by one space (and n_chars, where there is such a
    column, its length). Of rows that share doc_id, source and number of words the first by text are taken first."""
    draws, sizes = mix(docs, shards)
    key = ["doc_id", "source", "size"]
    takes = draws.groupBy(*key, "twin").agg(F.collect_list("taken").alias("takes"))  # at most one for each pass
    takes = takes.select(*[c(k).alias(f"mix_{k}") for k in key], c("twin").alias("mix_twin"), "takes")
    rows = docs.withColumns({"mix_id": c("doc_id").cast("long"), "mix_of": c("source").cast("string"), "mix_n": word_count(c("text").cast("string"))})
    twins = sizes.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").limit(1).count()
    order = Window.partitionBy("mix_id", "mix_of", "mix_n").orderBy("text")
    rows = rows.withColumn("mix_row", F.row_number().over(order) if twins else F.lit(1))
    on = rows["mix_id"].eqNullSafe(takes["mix_doc_id"]) & rows["mix_of"].eqNullSafe(takes["mix_source"]) & (rows["mix_n"] == takes["mix_size"]) & (rows["mix_row"] == takes["mix_twin"])
    rows = rows.join(takes.hint("shuffle_hash"), on).withColumn("mix_taken", F.explode("takes"))
    part = c("mix_taken") < c("mix_n")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), 1, c("mix_taken").cast("int")), " ")
    rows = rows.withColumn("text", F.when(part, cut).otherwise(c("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(part, F.length("text")).otherwise(c("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)
