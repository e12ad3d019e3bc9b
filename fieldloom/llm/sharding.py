"""Sharding by a k-d tree over metadata.

Space is split at weighted medians: each node is cut along its widest metadata dimension so that both sides hold their
share of the bytes, until a leaf holds the target. A median is found by a few rounds of histograms (65,536 bins a node,
combined on the map side), each round inside the bin that the cut falls into. All nodes of a level are split at once; nodes,
bins and cuts are tables, so the driver holds nothing that grows with rows or shards.

Metadata of a text are its size, and the language and source of its smallest doc_id, so equal texts have equal metadata
and stay together; ties are ordered by the text's checksum. A cut goes through one text's copies, by a hash of doc_id,
only where keeping them whole would put the smaller side off its share by more than ``SLACK`` of it: bytes could not be
near equal otherwise.

Defined results: null text weighs its one byte and has checksum 0; null language and source sort as empty; null doc_id
is hashed like any value; repeated rows get slots of their own; an empty table gives an empty result with the same columns;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.llm.common import discard, is_empty, materialise

DIMENSIONS = ("by_size", "by_lang", "by_source")
#: Composite order of a row in a dimension: 16 bits of the dimension, 32 of the checksum, 12 of a hash of doc_id.
KEY_BITS, TEXT_BITS, ROUND_BITS, COARSE_BITS = 60, 48, 16, 8
#: A side may be off its share by this much of it for the sake of equal texts.
SLACK = 0.02
SLOTS = 20_000


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and a 60-bit key for each dimension, per row of docs."""
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "lang", "source", crc.alias("text_crc32"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"))
    rows = materialise(rows, "rows")
    text = rows.groupBy("text_hash", "size").agg(F.min(F.struct("doc_id", "lang", "source")).alias("m"))
    # Written first: rows then meet it in a plain join, whose partitions Spark can split where one text fills many rows.
    text = materialise(text.select(F.col("text_hash").alias("_hash"), F.col("size").alias("_size"), F.col("m.lang").alias("_lang"), F.col("m.source").alias("_source")), "texts")
    joined = rows.join(text, (F.col("text_hash") == F.col("_hash")) & (F.col("size") == F.col("_size")))
    sixteen = (1 << 16) - 1
    name = lambda c: F.shiftright(F.crc32(F.coalesce(F.col(c), F.lit("")).cast("binary")), 16)
    log = F.least(F.floor(F.log2(F.col("size").cast("double")) * 1638), F.lit(sixteen)).cast("long")
    rest = F.shiftleft(F.col("text_crc32"), 12).bitwiseOR(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 12)))
    keys = {d: F.shiftleft(v.cast("long"), TEXT_BITS - 4).bitwiseOR(rest) for d, v in zip(DIMENSIONS, (log, name("_lang"), name("_source")), strict=True)}
    return materialise(joined.select("doc_id", "size", "text_crc32", *[v.alias(d) for d, v in keys.items()]), "metadata")


#: The key of a row in its node's dimension.
_KEY = f"element_at(array({', '.join(DIMENSIONS)}), dim + 1)"
#: Place of a dimension in a key.
_AT = KEY_BITS - 16


def _bounds(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """A row for each node that has to be split: its widest dimension, and how many bytes its left side needs."""
    stats = placed.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))])
    widths = [f"shiftright(high_{d}, {_AT}) - shiftright(low_{d}, {_AT})" for d in DIMENSIONS]
    widest = F.expr(f"coalesce(array_position(array({', '.join(widths)}), greatest({', '.join(widths)})) - 1, 0)")
    found = nodes.filter("leaves > 1").join(stats, "node", "left")
    need = F.expr("cast(coalesce(bytes, 0) as double) * (leaves div 2) / leaves")
    return found.select("node", "leaves", widest.cast("int").alias("dim"), need.alias("need"), F.lit(0).cast("long").alias("low"), F.lit(KEY_BITS).alias("bits"), F.lit(None).cast("long").alias("cut"))


def _upto(bins: DataFrame, place: str, before: Column) -> DataFrame:
    """bins with the bytes of a node up to and with each of them."""
    running = W.partitionBy("node").orderBy(place).rowsBetween(W.unboundedPreceding, 0)  # at most 256 a node
    return bins.withColumn("upto", F.sum("w").over(running) + before)


def _met(bins: DataFrame, place: str) -> DataFrame:
    """node and b: the first of its bins with which the need is met, the last one if none does."""
    b = F.struct(place, "w", "upto")
    return bins.groupBy("node").agg(F.coalesce(F.min_by(b, F.when(F.col("upto") >= F.col("need"), F.col(place))), F.max_by(b, F.col(place))).alias("b"))


def _narrowed(placed: DataFrame, cuts: DataFrame, leaf: float) -> DataFrame:
    """One round of all open cuts: bins of their ranges are summed, and each goes into the bin where its need is met."""
    open_ = cuts.filter("cut is null").withColumn("shift", F.expr(f"greatest(bits - {ROUND_BITS}, 0)"))
    inside = placed.join(open_.select("node", "dim", "need", "low", "bits", "shift"), "node").withColumn("key", F.expr(_KEY))
    inside = inside.filter("key >= low and key - low < shiftleft(cast(1 as bigint), bits)")
    bins = inside.groupBy("node", "need", F.expr("shiftright(key - low, shift)").alias("bin")).agg(F.sum("size").alias("w"))
    # First the run of COARSE bins in which the need is met, then the bin within it: no task gets more of a node than that.
    run = F.shiftright("bin", COARSE_BITS).alias("run")
    runs = _upto(bins.groupBy("node", "need", run).agg(F.sum("w").alias("w")), "run", F.lit(0))
    chosen = _met(runs, "run").select(F.col("node").alias("in"), F.col("b.run").alias("at"), (F.col("b.upto") - F.col("b.w")).alias("before"))
    inner = bins.join(chosen, (F.col("node") == F.col("in")) & (F.shiftright("bin", COARSE_BITS) == F.col("at")))
    met = _met(_upto(inner, "bin", F.col("before")), "bin")
    at = cuts.withColumn("shift", F.expr(f"greatest(bits - {ROUND_BITS}, 0)")).join(met, "node", "left")
    at = at.withColumns({"edge": F.expr("low + shiftleft(b.bin, shift)"), "over": F.expr("b.upto - need"), "under": F.expr("need - (b.upto - b.w)")})
    fits = F.expr(f"least(abs(over), abs(under)) <= {SLACK} * {leaf!r}D * least(leaves div 2, leaves - leaves div 2)")
    nearer = F.expr("if(abs(over) <= abs(under), edge + shiftleft(cast(1 as bigint), shift) - 1, edge - 1)")
    done = (F.col("shift") == 0) | ((F.col("shift") <= KEY_BITS - TEXT_BITS) & fits)
    was_open = F.col("cut").isNull()
    cut = F.when(~was_open, F.col("cut")).when(F.col("b").isNull(), F.col("low") - 1).when(done, nearer)
    step = was_open & F.col("b").isNotNull() & ~done
    return at.select(
        "node", "leaves", "dim", F.when(step, F.col("under")).otherwise(F.col("need")).alias("need"), F.when(step, F.col("edge")).otherwise(F.col("low")).alias("low"),
        F.when(step, F.col("shift")).otherwise(F.col("bits")).alias("bits"), cut.alias("cut"),
    )


def kd_shards(rows: DataFrame, shards: int, leaf: float) -> DataFrame:
    """rows (from metadata) with their leaf, 0 to shards - 1, in column shard; leaf is the bytes of one.

    A node goes by the first leaf below it. Nodes and cuts are tables that meet the rows in joins; the driver knows the
    number of levels and nothing else.
    """
    spark = rows.sparkSession
    nodes = spark.range(1).select(F.lit(0).alias("node"), F.lit(shards).alias("leaves"))
    placed, most = materialise(rows.withColumn("node", F.lit(0)), "nodes"), shards
    while most > 1:
        cuts = materialise(_bounds(placed, nodes), "cuts")
        for k in range(1, -(-KEY_BITS // ROUND_BITS) + 1):
            narrower = materialise(_narrowed(placed, cuts, leaf), "cuts")
            discard(cuts)
            cuts = narrower
            if k * ROUND_BITS >= TEXT_BITS and is_empty(cuts.filter("cut is null")):
                break
        sides = placed.join(cuts.select("node", "dim", "cut", F.expr("leaves div 2").cast("int").alias("half")), "node", "left")
        beyond = F.expr(f"if(cut is not null and {_KEY} > cut, half, 0)")
        after = materialise(sides.select(*[c for c in placed.columns if c != "node"], (F.col("node") + beyond).alias("node")), "nodes")
        discard(placed, cuts)
        half = F.expr("cast(leaves div 2 as int)")
        parts = F.array(F.struct("node", half.alias("leaves")), F.struct((F.col("node") + half).alias("node"), (F.col("leaves") - half).alias("leaves")))
        nodes = nodes.select(F.inline(F.when(F.col("leaves") > 1, parts).otherwise(F.array(F.struct("node", "leaves")))))
        placed, most = after, most - most // 2
    return placed.withColumnRenamed("node", "shard")


def with_slots(rows: DataFrame, n_rows: int) -> DataFrame:
    """Gapless slots from 0 in each shard: by hashed parts of bounded size, never a whole shard in one task."""
    parts = max(1, ceil(n_rows / SLOTS))
    rows = materialise(rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id()), F.lit(parts))), "parts")
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(F.col("shard").alias("_shard"), F.col("_part").alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    slot = F.row_number().over(W.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32"))
    numbered = rows.withColumn("_no", slot)
    return numbered.join(base, (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_p"))).withColumn("slot", F.col("base") + F.col("_no") - 1).drop("_shard", "_p", "_part", "_no", "base")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; as many shards as target_bytes asks for unless given."""
    rows = metadata(docs)
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    shards = shards or max(1, ceil((total or 0) / target_bytes))
    placed = with_slots(kd_shards(rows, shards, (total or 0) / shards), n_rows)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
