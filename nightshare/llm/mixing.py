"""Mixing sources to target weights: exact block quotas, split among shards by a hypergeometric tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nightshare.llm.common import hash_share, saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, LIMIT, BLOCKS, LEVELS = (3, 1, 2), 1.5, 2, 4096, 4


def _code(part: Column) -> Column:
    """32 bits of an MD5, which other engines compute alike."""
    return F.conv(F.substring(F.md5(part), 1, 8), 16, 10).cast("long")


def _name(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, blocks: int) -> DataFrame:
    """Words, source and block of each row. A source's rows fall evenly into ``blocks`` blocks by the hash of the id."""
    block = F.pmod(_code(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), F.lit(blocks))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"_size": size, "_source": F.col(source_col), "_block": block})


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Target words per source (one row per source; its windows see that small table only).

    Weights go round over the sources by code point, null last. No target is over ``limit``
    times the source; what is over goes to the others by weight. Sources that reach the limit
    are those with the least words per weight, so one pass over running sums finds the level.
    """
    if not 0 <= share <= limit:
        raise ValueError("share must lie between 0 and limit")
    by_name = Window.orderBy(F.col("_source").isNull(), "_source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight)
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("_source").isNull(), "_source")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    found = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= limit * F.col("source_size"))
    # The first source by ratio that stays below its limit fixes the level of all after it.
    fixed = F.min_by("level", F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("_source").isNull(), F.col("_source")))).over(everything)
    target = F.when(F.col("full"), F.lit(float(limit)) * F.col("source_size")).otherwise(fixed * F.col("weight"))
    return found.select("_source", "source_size", target.cast("double").alias("target"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _draw(total: Column, own: Column, draws: Column, u: Column) -> Column:
    """Hypergeometric draw by inverse distribution from the mode outwards (12 standard deviations each way)."""
    total, own, draws = (x.cast("double") for x in (total, own, draws))
    lo, hi = F.greatest(F.lit(0.0), draws - (total - own)), F.least(draws, own)
    mode = F.least(hi, F.greatest(lo, F.floor((draws + 1) * (own + 1) / (total + 2)).cast("double")))
    spread = F.sqrt(F.greatest(F.lit(0.0), draws * own * (total - own) * (total - draws) / F.greatest(F.lit(1.0), total * total * (total - 1))))
    given = F.struct(total.alias("t"), own.alias("k"), draws.alias("n"), u.alias("u"), mode.alias("mode"), lo.alias("lo"), hi.alias("hi"), F.ceil(12 * spread + 12).cast("double").alias("reach"))
    return _let(given, _drawn)


def _drawn(g: Column) -> Column:
    top, low = F.least(g.hi, g.mode + g.reach).cast("long"), F.greatest(g.lo, g.mode - g.reach).cast("long")

    def ratio(x: Column) -> Column:  # weight of x + 1 over weight of x
        return (g.k - x) * (g.n - x) / ((x + 1) * (g.t - g.k - g.n + x + 1))

    def weigh(a: Column, x: Column) -> Column:
        w = F.when(x == g["mode"], 1.0).when(x > g["mode"], a.w * ratio(x - 1)).when(x == g["mode"] - 1, 1.0 / ratio(x)).otherwise(a.w / ratio(x))
        return _let(w, lambda v: F.struct(v.alias("w"), (a.s + v).alias("s")))

    def pick(a: Column, x: Column, bound: Column) -> Column:
        return _let(weigh(F.struct(a.w.alias("w"), a.s.alias("s")), x), lambda v: F.struct(v.w.alias("w"), v.s.alias("s"), F.coalesce(a.x, F.when(v.s >= bound, x)).alias("x")))

    def from_values(values: Column) -> Column:
        total = F.aggregate(values, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s")), weigh, lambda a: a.s)
        first = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(None).cast("long").alias("x"))
        return _let(total * g.u, lambda bound: F.aggregate(values, first, lambda a, x: pick(a, x, bound), lambda a: F.coalesce(a.x, g["mode"].cast("long"))))

    start = g["mode"].cast("long")
    down = F.when(low < start, F.sequence(start - 1, low, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return _let(F.concat(F.sequence(start, top), down), from_values)


def _node_step(level: int, seed: int):
    """One source of a node: its units for the left child, drawn from what the node still has to give."""

    def step(a: Column, x: Column) -> Column:
        drawn = _draw(a.left, x.n, a.draws, hash_share(F.lit(seed), F.lit(level), F.col("node"), x.source, x["last"]))
        return _let(drawn, lambda got: F.struct((a.left - x.n).alias("left"), (a.draws - got).alias("draws"), F.concat(a.taken, F.array(got)).alias("taken")))

    return step


def splitting_tree(quotas: DataFrame, levels: int = LEVELS, seed: int = 42) -> DataFrame:
    """Units of each source per shard: (_source, shard, from_unit, to_unit).

    One row holds a node's units per source. Each level draws the left child's units from the
    node by conditional hypergeometric draws, source after source; the right child gets the
    rest. The 2**levels leaves are the shards; their totals differ by at most one unit a level.
    """
    vector = F.array_sort(F.collect_list(F.struct(F.col("_source").isNull().alias("last"), F.col("_source").alias("source"), F.col("units").alias("n"))))
    nodes = quotas.groupBy().agg(vector.alias("v")).where(F.size("v") > 0).withColumn("node", F.lit(0).cast("long"))
    for level in range(levels):
        total = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.n)
        nodes = nodes.withColumn("total", total)
        start = F.struct(F.col("total").alias("left"), F.expr("total div 2").alias("draws"), F.array().cast("array<bigint>").alias("taken"))

        nodes = nodes.withColumn("taken", F.aggregate("v", start, _node_step(level, seed), lambda a: a.taken))
        left = F.zip_with("v", "taken", lambda x, n: F.struct(x["last"].alias("last"), x.source.alias("source"), n.alias("n")))
        right = F.zip_with("v", "taken", lambda x, n: F.struct(x["last"].alias("last"), x.source.alias("source"), (x.n - n).alias("n")))
        children = F.array(F.struct((F.col("node") * 2).alias("node"), left.alias("v")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("v")))
        nodes = nodes.select(F.inline(children))
        nodes = saved(nodes, "mix-tree") if level % 2 else nodes
    leaves = nodes.select(F.col("node").alias("shard"), F.inline("v"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("shard"))
    return leaves.select(F.col("source").alias("_source"), "shard", (upto - F.col("n")).alias("from_unit"), upto.alias("to_unit")).where("to_unit > from_unit")


def plan_units(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, levels: int = LEVELS, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The units drawn (_source, _block, pass, shard) and the sources with their targets; at most blocks x limit units a source."""
    blocks = saved(rows.groupBy("_source", "_block").agg(F.sum("_size").alias("words")), "mix-blocks")
    sources = targets(blocks.groupBy("_source").agg(F.sum("words").alias("source_size")), weights, share, limit)
    name = _name(F.col("_source"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    joined = blocks.join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("whole", whole)
    # A source has a fixed number of blocks at most, so these windows are bounded.
    permuted = Window.partitionBy("_source").orderBy(F.md5(F.concat_ws(":", name, F.col("_block").cast("string"))), "_block")
    upto = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    need = F.col("target") - F.col("whole") * F.col("source_size")
    extra = ((need > 0) & (F.col("upto") - F.col("words") / 2 <= need)).cast("long")
    quota = joined.withColumn("upto", upto).withColumn("times", F.col("whole") + extra)
    units = quota.where("times > 0").select("_source", "_block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("pass"))
    order = Window.partitionBy("_source").orderBy(F.md5(F.concat_ws(":", name, F.col("_block").cast("string"), F.col("pass").cast("string"))), "_block", "pass")
    units = saved(units.withColumn("unit", F.row_number().over(order) - 1), "mix-units")
    ranges = splitting_tree(units.groupBy("_source").agg(F.count(F.lit(1)).alias("units")), levels, seed).withColumnRenamed("_source", "_s")
    dealt = units.join(ranges, units._source.eqNullSafe(ranges._s) & (units.unit >= ranges.from_unit) & (units.unit < ranges.to_unit))
    return saved(dealt.select("_source", "_block", "pass", "shard"), "mix-plan"), saved(sources, "mix-sources")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, blocks: int = BLOCKS, levels: int = LEVELS, seed: int = 42) -> DataFrame:
    """The mix itself: each drawn row once per draw, with ``mix_shard`` and ``mix_place`` (order within the shard).

    Size is the number of words (null text: 0). A source is cut into at most ``blocks`` blocks by the
    hash of the id; it gives all blocks as often as its target holds it whole, then blocks in
    permuted order as near to the rest as block ends allow. The splitting tree deals the
    blocks to shards; a shard's rows are ordered by a hash. Hot sources spread over their blocks.
    Rows of a null source form the last source; null ids share a block; repeated rows are drawn
    together; empty texts have size 0 and go with their block. Empty input gives an empty mix.
    Input columns are kept whatever their names, but for ``mix_shard`` and ``mix_place``, which are replaced.
    Texts are only counted, whatever their length.
    """
    # Names that the steps below use for themselves stand aside meanwhile.
    aside = {c: f"mix_aside{c}" for c in ("_size", "_source", "_block", "_s", "_b", "_pass") if c in docs.columns}
    docs = docs.drop("mix_shard", "mix_place").withColumnsRenamed(aside)
    id_col, text_col, source_col = (aside.get(c, c) for c in (id_col, text_col, source_col))
    rows = sized(docs, id_col, text_col, source_col, blocks)
    units, _ = plan_units(rows.select("_source", "_block", "_size"), weights, share, limit, levels, seed)
    units = units.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), F.col("pass").alias("_pass"), F.col("shard").alias("mix_shard"))
    drawn = rows.join(units, rows._source.eqNullSafe(F.col("_s")) & (rows._block == F.col("_b")))
    return drawn.withColumn("mix_place", F.xxhash64(F.lit(seed), F.col(id_col), "_pass")).drop("_size", "_source", "_block", "_s", "_b", "_pass").withColumnsRenamed({v: k for k, v in aside.items()})


def mix_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, blocks: int = BLOCKS, levels: int = LEVELS, seed: int = 42) -> DataFrame:
    """What the mix takes of each row: doc_id, size, source_size, target, taken, shards; texts are read once and not moved."""
    rows = sized(docs, id_col, text_col, source_col, blocks).select(F.col(id_col).alias("doc_id"), F.col("_size").alias("size"), "_source", "_block")
    rows = saved(rows, "mix-sizes")
    units, sources = plan_units(rows.withColumnRenamed("size", "_size"), weights, share, limit, levels, seed)
    taken = units.groupBy(F.col("_source").alias("_s"), F.col("_block").alias("_b")).agg(F.count(F.lit(1)).alias("times"), F.sort_array(F.collect_list("shard")).alias("shards"))
    blocks_of = taken.join(sources, taken._s.eqNullSafe(sources._source)).select("_s", "_b", "times", "shards")
    sources = sources.select(F.col("_source").alias("_t"), "source_size", "target")
    return (
        rows.join(blocks_of, rows._source.eqNullSafe(F.col("_s")) & (rows._block == F.col("_b")), "left")
        .join(sources, F.col("_source").eqNullSafe(F.col("_t")))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"), F.array_join(F.transform(F.coalesce("shards", F.array().cast("array<bigint>")), lambda s: s.cast("string")), ",").alias("shards"))
    )
