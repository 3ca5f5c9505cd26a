"""Operator 5 - sharding by balanced label propagation (law ``rows``).

Documents with equal texts are linked.  Every document starts in a shard by
the hash of its row; in each round the links pull: per link group the shards
are ranked by how many members they hold, members outside the group's leading
shards ask to move there, and moves are granted under quotas.  A shard may
take in what it gives away plus its free room, so no shard passes its
capacity (an even share and ``SLACK`` more).  A group larger than a shard is led by as many shards as it needs.
After the last round the shards are levelled: surplus rows, unlinked ones
first, go to shards with room, until counts differ by one at most.

Only counts reach the driver: SHARDS x SHARDS numbers a round.  Who may move is
decided by hash buckets (``BUCKETS`` per pair of shards): whole buckets are
granted while the quota lasts; the rest asks again in the next round.  No
window spans a whole shard or group: ranks are taken inside one bucket and
offset by the bucket totals, a table of at most SHARDS x BUCKETS rows.

Defined results: null text has size 1, CRC 0 and is linked with empty texts;
repeated rows and rows sharing a doc_id are separate rows (each gets a slot);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, read

SHARDS = 16
ROUNDS = 3
SLACK = 0.25             # room beyond an even share while links pull; levelled at the end
BUCKETS = 1 << 12


def _bucket(*cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(BUCKETS)).cast("int")


def nodes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, text_crc32, link): one row per document row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return materialise(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("link")), "nodes")


def _counts(df: DataFrame, *by: str) -> dict:
    return {tuple(r[c] for c in by): r["n"]
            for r in df.groupBy(*by).agg(F.count("*").alias("n")).collect()}


def _capacity(total: int) -> list[int]:
    return [total // SHARDS + (s < total % SHARDS) for s in range(SHARDS)]


def _quotas(asked: dict, load: list[int], capacity: list[int]) -> dict:
    """Rows that may move from shard to shard: swaps first, then free room."""
    quota = {}
    for s in range(SHARDS):
        for t in range(SHARDS):
            if s != t:
                quota[s, t] = min(asked.get((s, t), 0), asked.get((t, s), 0))
    room = [max(0, c - x) for c, x in zip(capacity, load)]
    for (s, t), n in sorted(asked.items()):
        more = min(room[t], n - quota[s, t])
        quota[s, t] += more
        room[t] -= more
        room[s] += more
    return {k: v for k, v in quota.items() if v}


def _grant(rows: DataFrame, by: list[str], bucket: Column, quota: DataFrame) -> DataFrame:
    """``rows`` with ``granted``: whole buckets while the quota of ``by`` lasts."""
    rows = rows.withColumn("_bucket", bucket)
    running = Window.partitionBy(*by).orderBy("_bucket")
    upto = (rows.groupBy(*by, "_bucket").agg(F.count("*").alias("n"))
            .withColumn("upto", F.sum("n").over(running)).join(F.broadcast(quota), by)
            .select(*by, "_bucket", (F.col("upto") <= F.col("quota")).alias("granted")))
    return rows.join(F.broadcast(upto.filter("granted")), by + ["_bucket"], "left").withColumn(
        "granted", F.coalesce("granted", F.lit(False))).drop("_bucket")


def _pull(state: DataFrame, capacity: int) -> DataFrame:
    """``state`` (row, link, shard) with ``wish``: the shard its links ask for. Ties go by
    a hash, so that requests run both ways and can be swapped."""
    held = state.groupBy("link", "shard").agg(F.count("*").alias("n"))
    lead = (held.groupBy("link").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(
                F.struct((-F.col("n")).alias("n"), F.xxhash64("link", "shard").alias("tie"), "shard"))).alias("held"))
            .filter("n > 1")
            .select("link", F.transform(F.slice("held", F.lit(1), F.greatest(
                F.ceil(F.col("n") / F.lit(capacity)).cast("int"), F.lit(1))), lambda h: h["shard"]).alias("lead")))
    # as a table of its own, so that the join's hot links can be split at run time
    pulled = state.join(materialise(lead, "lead"), "link", "left")
    pick = F.pmod(F.xxhash64("row"), F.size("lead")).cast("int")
    return pulled.withColumn("wish", F.when(
        F.col("lead").isNull() | F.array_contains("lead", F.col("shard")), F.col("shard"))
        .otherwise(F.col("lead")[pick])).withColumn("linked", F.col("lead").isNotNull()).drop("lead")


def propagate(spark, graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, link, shard, linked) after the rounds, within capacity where moves made it so."""
    state = graph.select("row", "link", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(SHARDS)).cast("int").alias("shard"))
    total = graph.count()
    capacity = [int(c * (1 + SLACK)) for c in _capacity(total)]
    for k in range(rounds):
        state = materialise(_pull(state.select("row", "link", "shard"), max(1, total // SHARDS)), f"pull{k}")
        load = _counts(state, "shard")
        asked = _counts(state.filter("wish <> shard"), "shard", "wish")
        quota = _quotas(asked, [load.get((s,), 0) for s in range(SHARDS)], capacity)
        if not quota:
            break
        table = spark.createDataFrame(
            [(s, t, n) for (s, t), n in quota.items()], "shard int, wish int, quota long")
        moved = _grant(state, ["shard", "wish"], _bucket("link"), table)
        # buckets are of links, so a group moves together; a group larger than
        # the quota moves by rows instead
        used = moved.filter("granted").groupBy("shard", "wish").agg(F.count("*").alias("used"))
        rest = (table.join(used, ["shard", "wish"], "left")
                .withColumn("quota", F.col("quota") - F.coalesce("used", F.lit(0))).drop("used"))
        second = _grant(moved.filter("not granted and wish <> shard").drop("granted"),
                        ["shard", "wish"], _bucket("row", F.lit(k)), rest)
        state = (moved.filter("granted or wish = shard").unionByName(second)
                 .withColumn("shard", F.when(F.col("granted"), F.col("wish")).otherwise(F.col("shard")))
                 .select("row", "link", "shard", "linked"))
    return materialise(state.select("row", "link", "shard", "linked"), "propagated")


def _ranked(df: DataFrame, bucket: Column, first: list) -> DataFrame:
    """``rank`` of each row in its shard from 0, by bucket, then ``first``."""
    df = df.withColumn("_bucket", bucket)
    running = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (df.groupBy("shard", "_bucket").agg(F.count("*").alias("n"))
              .select("shard", "_bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before")))
    inside = Window.partitionBy("shard", "_bucket").orderBy(*first)
    return (df.join(F.broadcast(before), ["shard", "_bucket"])
            .withColumn("rank", F.col("before") + F.row_number().over(inside) - 1).drop("_bucket", "before"))


def level(spark, state: DataFrame) -> DataFrame:
    """(row, shard) with counts at most one apart; unlinked rows move first."""
    load = _counts(state, "shard")
    load = [load.get((s,), 0) for s in range(SHARDS)]
    total = sum(load)
    # the larger shares go to the fullest shards
    share = [total // SHARDS] * SHARDS
    for s in sorted(range(SHARDS), key=lambda s: (-load[s], s))[:total % SHARDS]:
        share[s] += 1
    takers = [(s, share[s] - load[s]) for s in range(SHARDS) if load[s] < share[s]]
    base, targets = 0, []
    for s, n in takers:
        targets.append((s, base, base + n))
        base += n
    base, givers = 0, []
    for s in range(SHARDS):
        if load[s] > share[s]:
            givers.append((s, load[s] - share[s], base))
            base += load[s] - share[s]
    if not givers:
        return state.select("row", "shard")
    half = BUCKETS // 2   # unlinked rows have the lower buckets
    bucket = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(half)).cast("int") + F.when(F.col("linked"), half).otherwise(0)
    ranked = _ranked(state, bucket, ["row"])
    give = F.broadcast(spark.createDataFrame(givers, "shard int, give long, base long"))
    take = F.broadcast(spark.createDataFrame(targets, "target int, low long, high long"))
    out = ranked.join(give, "shard", "left").withColumn("place", F.when(
        F.col("rank") < F.col("give"), F.col("base") + F.col("rank")))
    return (out.join(take, (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")), "left")
            .select("row", F.coalesce("target", "shard").alias("shard")))


def shard_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, link) per row."""
    spark = docs.sparkSession
    graph = nodes(docs)
    placed = level(spark, propagate(spark, graph))
    slots = _ranked(placed, _bucket("row"), ["row"])
    return graph.join(slots, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "link")


def op5_shard(spark, sf_dir: str) -> DataFrame:
    """Every document in one of SHARDS shards, counts at most one apart."""
    return shard_documents(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("link")
