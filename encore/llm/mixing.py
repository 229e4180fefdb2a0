"""Mixing sources to target weights, with DataFrame functions only.

Plan, from one row per source:
  targets   total x weight, stopped at ``max_repeats`` times the source's own words; the excess goes
            to the others by weight until none is above (closed form over the sorted caps).
  blocks    every source is cut into hashed blocks of documents. Whole passes take every block; the
            rest of the target takes blocks in permuted order, the last of them cut at the word.
  shards    the block draws of all sources are dealt to ``2 ** depth`` output shards by a splitting
            tree: at each node the exact quota of every source is split between both halves by a
            multivariate hypergeometric draw (so the halves have equal sizes and each is a random
            sub-mix). A shard's draws of a source are a range of the permuted block order, so
            shards are disjoint.
  order     inside a shard, rows are put in an order made by a hash: a local shuffle.
Every random choice is a hash of the seed and of ids, so reruns agree.

Defined results: the size of a text is its number of words, 0 for null and empty ones; a source
without words has target 0. A null source is a source of its own and comes last. Rows that repeat
an id and a text share their draws' place but each gives its own row. Texts without words have no
draws; ``mixed_documents`` gives each of them out once, in a shard by hash. An empty table gives an empty
result. Extra columns are ignored by ``draws`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_RE, materialize, quoted, unused

#: Blocks of a source: as many as its words fill, but at most BLOCKS (then the blocks grow).
BLOCK_WORDS, BLOCKS = 65_536, 2048


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, size); weights repeat over the sources in
    code point order, null last. One row per source goes through the windows below."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
    # Sources reach their cap in order of cap / weight. With those before one at their caps, the rest
    # share what is left by weight; that level rises until no further source is above its cap.
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    levels = (weighed.withColumns({"capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
                                   "open_weight": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
                                   "total": F.sum("source_size").over(all_rows)})
              .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight")))
    share = F.max("level").over(all_rows)
    return levels.select("source", "source_size", "weight",
                         F.least(F.col("cap"), F.coalesce(share, F.lit(0.0)) * F.col("weight")).alias("target"))


def _uniform(*parts) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52)


def hypergeometric(population: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """The number of marked items among ``drawn`` of ``population`` without replacement, by inversion
    of the exact distribution around its mode (beyond 14 standard deviations nothing is lost in
    doubles)."""
    low = F.greatest(F.lit(0), drawn - (population - marked))
    high = F.least(drawn, marked)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1.0) * (marked + 1.0) / (population + 2.0)).cast("long")))
    spread = F.sqrt(drawn * (marked / F.greatest(population, F.lit(1))) * (1 - marked / F.greatest(population, F.lit(1)))) * 14 + 40
    first = F.greatest(low, mode - spread.cast("long"))
    last = F.least(high, mode + spread.cast("long"))

    def ratio(k: Column) -> Column:  # p(k + 1) / p(k)
        return (marked - k) * 1.0 * (drawn - k) / ((k + 1.0) * (population - marked - drawn + k + 1.0))

    # Unscaled masses from ``first`` on; the largest stays far below the range of doubles.
    start = F.struct(F.lit(1e-150).alias("p"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k"))
    steps = F.sequence(first, last)
    total = F.aggregate(steps, start, lambda a, k: F.struct(
        (a["p"] * ratio(k)).alias("p"), (a["sum"] + a["p"]).alias("sum"), a["k"].alias("k")))["sum"]
    chosen = F.aggregate(steps, F.struct(F.lit(1e-150).alias("p"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k")),
                         lambda a, k: F.struct(
                             (a["p"] * ratio(k)).alias("p"), (a["sum"] + a["p"]).alias("sum"),
                             F.when((a["k"] < 0) & (a["sum"] + a["p"] >= u * total), k).otherwise(a["k"]).cast("long").alias("k")))["k"]
    return F.when(high <= low, low).otherwise(F.when(chosen < 0, last).otherwise(chosen)).cast("long")


def _left_half(quotas: Column, size: Column, seed: int, level: int, node: Column) -> Column:
    """Quotas of the left child: one conditional hypergeometric draw per source, in order."""
    state = F.struct(F.floor(size / 2).cast("long").alias("take"), size.alias("rest"), F.lit(0).cast("long").alias("i"),
                     F.array().cast("array<bigint>").alias("out"))

    def draw(acc: Column, k: Column) -> Column:
        # Held in a one-item array so that the draw is made once.
        return F.transform(
            F.array(hypergeometric(acc["rest"], k, acc["take"], _uniform(F.lit(seed), F.lit(level), node, acc["i"]))),
            lambda h: F.struct((acc["take"] - h).alias("take"), (acc["rest"] - k).alias("rest"), (acc["i"] + 1).alias("i"),
                               F.concat(acc["out"], F.array(h)).alias("out")))[0]

    return F.aggregate(quotas, state, draw)["out"]


def splitting_tree(quotas: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """(source, shard, first, last): the draws ``first <= i < last`` of each source go to the shard.

    ``quotas``: (source, draws). The plan is one row per source and shard, made from one row that
    holds the quotas of all nodes of a level."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "draws")))
    level_row = (quotas.groupBy().agg(ordered.alias("sources"))
                 .withColumn("nodes", F.array(F.transform("sources", lambda s: s["draws"].cast("long")))))

    def halves(level: int):
        return lambda q, node: F.struct(q.alias("all"), _left_half(
            q, F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x), seed, level, node).alias("left"))

    for level in range(depth):
        level_row = level_row.withColumn("halves", F.transform("nodes", halves(level)))
        level_row = level_row.withColumn("nodes", F.flatten(F.transform("halves", lambda h: F.array(
            h["left"], F.zip_with(h["all"], h["left"], lambda a, b: a - b)))))
    rows = (level_row.select("sources", F.posexplode("nodes").alias("shard", "quota"))
            .select("shard", F.posexplode(F.arrays_zip("sources", "quota")).alias("s", "z"))
            .select("shard", F.col("z.sources.source").alias("source"), F.col("z.quota").alias("n")))
    until = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("last", F.sum("n").over(until)).filter("n > 0")
            .select("source", "shard", (F.col("last") - F.col("n")).alias("first"), "last"))


def draws(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, depth: int = 4, seed: int = 0,
          whole_documents: bool = False, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs``: doc_id, source, size, source_size, target, and ``draws``: an array of
    (shard, place, words), one item for each time the mix takes the document.

    With ``whole_documents`` the last document of a source is taken whole when half of it or more is
    due, else not at all; without, its first ``words`` words are due.
    The texts are read once and not shuffled; what moves is one narrow row per document."""
    sizes = materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                                    n_words(F.col(text)).alias("size"), F.xxhash64(F.col(text).cast("string")).alias("text_hash")), "mix-sizes")
    targets = (source_targets(sizes, weights, max_repeats)
               .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long"))
               .withColumn("rest", (F.round("target") - F.col("passes") * F.col("source_size")).cast("long"))
               .withColumn("n_blocks", F.least(F.lit(BLOCKS), F.ceil(F.col("source_size") / BLOCK_WORDS) + 1).cast("long")))
    targets = materialize(targets, "mix-targets")
    placed = (sizes.join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
              .withColumn("hash", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
              .withColumn("block", F.pmod(F.col("hash"), F.col("n_blocks"))))
    placed = materialize(placed, "mix-placed")
    # Permuted block order of a source, and the words before each block in it: at most BLOCKS rows a source.
    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "block"), "block")
    blocks = (blocks.withColumns({"rank": (F.row_number().over(permuted) - 1).cast("long"), "of": F.count(F.lit(1)).over(Window.partitionBy("source")),
                                  "before": F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")})
              .withColumn("due", F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - F.col("before")))))
    # Draw numbers of a source: block rank + pass x blocks, the partial pass last.
    quotas = blocks.groupBy("source").agg((F.max("passes") * F.max("of") + F.sum((F.col("due") > 0).cast("long"))).alias("draws"))
    ranges = splitting_tree(quotas, depth, seed + 2)
    shards = ranges.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("first", "last", "shard"))).alias("shards"))
    plan = (blocks.join(shards.withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
            .select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), "rank", "of", "due", "words", "shards"))
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")))
    # The one block of a source that is partly due is cut in its own permuted order.
    partly = joined.filter("due > 0 and due < words")
    in_block = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed + 3), "hash"), "doc_id", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("due") - (F.sum("size").over(in_block) - F.col("size"))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left))
    if whole_documents:
        cut = F.when((F.col("size") > 0) & (2 * left >= F.col("size")), F.col("size")).otherwise(F.lit(0))
    done = joined.filter("not (due > 0 and due < words)").withColumn("part", F.when(F.col("due") > 0, F.col("size")).otherwise(0).cast("long"))
    done = done.unionByName(partly.withColumn("part", cut.cast("long")))
    shard_of = lambda i: F.filter("shards", lambda s: (s["first"] <= i) & (i < s["last"]))[0]["shard"]

    def one(copy: Column, words: Column) -> Column:
        number = F.col("rank") + copy * F.col("of")
        return F.struct(shard_of(number).cast("int").alias("shard"), F.xxhash64(F.lit(seed + 4), "hash", copy).alias("place"), words.alias("words"))

    whole = F.when((F.col("passes") > 0) & (F.col("size") > 0), F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), lambda c: one(c, F.col("size"))))
    partial = F.when(F.col("part") > 0, F.array(one(F.col("passes"), F.col("part"))))
    empty = F.array().cast("array<struct<shard: int, place: bigint, words: bigint>>")
    return done.select("doc_id", "source", "text_hash", "size", "source_size", "target",
                       F.concat(F.coalesce(whole, empty), F.coalesce(partial, empty)).alias("draws"))


def taken(mix: DataFrame) -> Column:
    return F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, whole, once for each draw, those without words once; all columns stay.

    Rows lie by shard and in its local order. Rows that repeat an id and a text are drawn alike, and
    each of them is given out."""
    seed, depth = options.get("seed", 0), options.get("depth", 4)
    wordless = F.array(F.struct(F.pmod(F.xxhash64(F.lit(seed + 5), "doc_id", "text_hash"), F.lit(1 << depth)).cast("int").alias("shard"),
                                F.xxhash64(F.lit(seed + 4), "doc_id", "text_hash").alias("place"), F.lit(0).cast("long").alias("words")))
    mix = (draws(docs, whole_documents=True, **options)
           .withColumn("draws", F.when(F.col("size") == 0, wordless).otherwise(F.col("draws"))).filter(F.size("draws") > 0)
           .groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_text"), F.col("source").alias("m_source"))
           # equal rows may be cut differently: the same one of their draws is taken every time
           .agg(F.max("draws").alias("m_draws")))
    draw = unused(docs, "__llm_draw")
    tagged = docs.alias("d").join(
        mix.alias("m"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("m.m_id"))
        & (F.xxhash64(F.col("d.text").cast("string")) == F.col("m.m_text")) & F.col("d.source").cast("string").eqNullSafe(F.col("m.m_source")))
    rows = tagged.select(*[F.col(f"d.{quoted(c)}") for c in docs.columns], F.explode("m.m_draws").alias(draw))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return (rows.repartitionByRange(parts, f"{draw}.shard", f"{draw}.place")
            .sortWithinPartitions(f"{draw}.shard", f"{draw}.place").select(*map(quoted, docs.columns)))
