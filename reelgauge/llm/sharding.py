"""Shards of equal counts by balanced label propagation.

Documents that are linked (here: that share a group) pull each other into one shard. Every document
starts in the shard its place in the table gives. Large groups get their shards first, the largest
ones whole shards. Then the others propagate: in each round a group that is still open wants the
shard in which most of its documents are, among those that have room for all of it, else another
with room; each shard has a quota, the room it has left, and takes what wants it up to the quota,
larger groups first, of like size those that have more of their documents there. What is refused
wants again in the next round, knowing the room left, until all are placed or nothing fits any more.
Only groups that then fit nowhere whole are packed into what is left, and split. Documents without
links give way.

Everything is DataFrame code. Ranks within a shard never sort a whole shard in one task: rows get a
bucket, buckets are counted, and a running sum of the counts gives each bucket its first rank.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.llm.common import stored

SHARDS = 24
# Rounds at most; they end when all groups are placed, or none that is open fits anywhere.
ROUNDS = 24
# Rows of a bucket on average, and buckets at least: of all rows, and of the rows of a shard.
BUCKET = 20_000
LEAST_BUCKETS = 64
LEAST_SHARD_BUCKETS = 4


def ranked(
    rows: DataFrame, keys: list[str], order: list[str], name: str, buckets: int,
    weight: str | None = None,
) -> DataFrame:
    """``rows`` with their rank from 0 within ``keys``: by the first column of ``order``, which
    holds few values, then by bucket, then by the rest of ``order``. With ``weight`` it is the sum
    of the weights before a row.

    Two levels: a window over the few counts of the buckets, and one over each bucket.
    """
    level, rest = order[0], order[1:]
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*rest), F.lit(buckets)).cast("int"))
    at = [*keys, level, "_bucket"]
    each = F.col(weight) if weight else F.lit(1)
    counts = dealt.groupBy(*at).agg(F.sum(each).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(level, "_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    firsts = counts.select(*at, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*at).orderBy(*rest).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt.withColumn("_rank", F.sum(each).over(within) - each).join(firsts, at)
        .withColumn(name, F.col("_first") + F.col("_rank")).drop("_bucket", "_first", "_rank")
    )


def balanced_shards(
    items: DataFrame, group: str, shards: int = SHARDS, rounds: int = ROUNDS,
) -> DataFrame:
    """``items`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 without gaps in a shard).

    ``items`` has ``row_id``, unique, and a ``group`` column; rows with the same group are linked,
    null groups have no links. Counts of shards differ by at most one. A group larger than a shard
    is spread over as many shards as it fills; a smaller one is split only if no shard has room for
    it beside the groups placed before it. An empty table gives an empty table.
    """
    total = items.count()
    buckets = max(LEAST_SHARD_BUCKETS, total // (shards * BUCKET))
    all_buckets = max(LEAST_BUCKETS, total // BUCKET)
    # More than a fiftieth of a shard: there are fewer than 50 times the shards of these.
    large = max(2, total // (50 * shards))
    sizes = items.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("members"))
    linked = sizes.where("members > 1").select(group, "members")
    by_place = ranked(
        items.select("row_id", group).withColumn("_all", F.lit(0)), [], ["_all", "row_id"],
        "place", all_buckets,
    )
    low, more = total // shards, total % shards
    start = F.when(
        F.col("place") < more * (low + 1), F.floor(F.col("place") / (low + 1))
    ).otherwise(more + F.floor((F.col("place") - more * (low + 1)) / max(1, low)))
    placed = stored(by_place.select("row_id", group, start.cast("int").alias("shard")), "start")

    most = [low + (s < more) for s in range(shards)]
    hot = linked.where(F.col("members") > large)
    far, room = spread(placed.join(F.broadcast(hot), group), group, most, buckets, all_buckets)
    others = placed.join(F.broadcast(hot.select(group)), group, "left_anti")
    small = linked.where(F.col("members") <= large)
    movable = stored(others.join(small, group), "linked")
    whole, open_, room = propagated(movable, group, room, buckets, rounds)
    near, room = with_rest(movable, group, whole, open_, room, all_buckets)

    # Documents without links fill what the linked ones leave free, staying where they can.
    single = others.join(small.select(group), group, "left_anti").select("row_id", "shard")
    stay = ranked(
        single.withColumn("_level", F.lit(0)), ["shard"], ["_level", "row_id"], "place", buckets
    )
    stay = stored(
        stay.select("row_id", "shard", (F.col("place") < per_shard(room)).alias("stays")), "stay"
    )
    kept = {r["shard"]: r["n"] for r in stay.where("stays").groupBy("shard").agg(
        F.count("*").alias("n")).collect()}  # one row per shard
    over = ranked(
        stay.where("not stays").select("row_id").withColumn("_level", F.lit(0)), [],
        ["_level", "row_id"], "place", all_buckets,
    )
    gaps = [(s, n - kept.get(s, 0)) for s, n in enumerate(room)]
    final = (
        far.unionByName(near)
        .unionByName(stay.where("stays").select("row_id", "shard"))
        .unionByName(over.select("row_id", filling(gaps).alias("shard")))
        .withColumn("_level", F.lit(0))
    )
    slots = ranked(final, ["shard"], ["_level", "row_id"], "slot", buckets)
    return items.join(slots.select("row_id", "shard", F.col("slot").cast("long").alias("slot")), "row_id")


def per_shard(values: list[int]) -> Column:
    """The value of a row's shard."""
    return F.array(*map(F.lit, values))[F.col("shard")]


def filling(gaps: list[tuple[int, int]]) -> Column:
    """The shard for a ``place``, when the places fill the gaps one after the other."""
    target, upto = F.lit(None).cast("int"), sum(n for _, n in gaps)
    for shard, n in reversed(gaps):
        target = F.when(F.col("place") < upto, F.lit(shard)).otherwise(target)
        upto -= n
    return target


def steps(shares: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Shards with the first place beyond their share, when the shares follow each other."""
    upto = list(accumulate(n for _, n in shares))
    return [(u, shard) for u, (shard, _) in zip(upto, shares)]


STEPS = "steps array<struct<upto: bigint, shard: int>>"


def step_taken() -> Column:
    """The shard of the first of the ``steps`` beyond a ``place``; null: none."""
    return F.get(F.filter("steps", lambda s: s["upto"] > F.col("place")), F.lit(0))["shard"]


def spread(
    rows: DataFrame, group: str, most: list[int], buckets: int, all_buckets: int,
) -> tuple[DataFrame, list[int]]:
    """Shards of the large groups, of which there are few, and the room left per shard."""
    held = rows.groupBy(group, "members", "shard").agg(F.count("*").alias("here"))
    groups: dict = {}
    for r in held.collect():  # few groups, a row per shard at most
        groups.setdefault((-r["members"], r[group]), {})[r["shard"]] = r["here"]
    room, keeps, goes = list(most), [], []
    for (size, name), here in sorted(groups.items()):
        given = shares(-size, here, room)
        keeps += [(name, s, min(n, here.get(s, 0))) for s, n in given.items()]
        goes.append((name, steps([(s, n - min(n, here.get(s, 0))) for s, n in given.items()])))
        room = [n - given.get(s, 0) for s, n in enumerate(room)]
    spark, kind = rows.sparkSession, rows.schema[group].dataType.simpleString()
    keep = spark.createDataFrame(keeps, f"`{group}` {kind}, shard int, keep bigint")
    go = spark.createDataFrame(goes, f"`{group}` {kind}, {STEPS}")
    at = rows.select("row_id", group, "shard").withColumn("_level", F.lit(0))
    own = stored(
        ranked(at, [group, "shard"], ["_level", "row_id"], "place", buckets)
        .join(F.broadcast(keep), [group, "shard"], "left")
        .select("row_id", group, "shard", "_level",
                (F.col("place") < F.coalesce("keep", F.lit(0))).alias("stays")),
        "large",
    )
    moves = ranked(own.where("not stays"), [group], ["_level", "row_id"], "place", all_buckets)
    moved = moves.join(F.broadcast(go), group).select("row_id", step_taken().alias("shard"))
    return stored(own.where("stays").select("row_id", "shard").unionByName(moved), "large"), room


def shares(size: int, here: dict[int, int], room: list[int]) -> dict[int, int]:
    """How many of a group go to which shard: all to one with room, where most of them are, the
    fullest of these; else the emptiest shard is filled and the rest looked at again."""
    out: dict[int, int] = {}
    while size:
        fits = [s for s, n in enumerate(room) if s not in out and n >= size]
        if fits:
            out[max(fits, key=lambda s: (here.get(s, 0), -room[s], -s))] = size
            break
        s = max((s for s in range(len(room)) if s not in out),
                key=lambda s: (room[s], here.get(s, 0), -s))
        out[s] = room[s]
        size -= room[s]
    return out


def whole_room(room: list[int]) -> Column:
    """The shards that have room for all members of a group, in order."""
    free = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(n).alias("free")) for s, n in enumerate(room)])
    return F.transform(F.filter(free, lambda f: f["free"] >= F.col("members")), lambda f: f["shard"])


def wanted(group: str, room: list[int], number: int) -> tuple[Column, Column]:
    """The shard a group wants, and how many of its documents are there: of the shards with room for
    all of it the one with most of them, ties by hash so that no shard is wanted by all; if it has
    documents in none of these, one of them by hash, another one each round. Null: none has room."""
    fits = whole_room(room)
    near = F.filter("held", lambda h: F.array_contains(fits, h["shard"]))
    best = F.array_max(F.transform(near, lambda h: F.struct(
        h["here"], F.xxhash64(F.col(group), h["shard"]).alias("by"), h["shard"]
    )))
    many = F.greatest(F.size(fits), F.lit(1))
    other = F.get(fits, F.pmod(F.xxhash64(F.col(group), F.lit(number)), many).cast("int"))
    return F.coalesce(best["shard"], other), F.coalesce(best["here"], F.lit(0))


def propagated(
    movable: DataFrame, group: str, room: list[int], buckets: int, rounds: int,
) -> tuple[DataFrame, DataFrame, list[int]]:
    """The groups that were placed, with their shard; those still open; the room left per shard.

    All documents of a group have the same neighbours and so want the same shard: a round joins and
    ranks one row per open group. What comes to the driver is a row per shard and round.
    """
    held = movable.groupBy(group, "members", "shard").agg(F.count("*").alias("here"))
    open_ = stored(
        held.groupBy(group, "members").agg(
            F.collect_list(F.struct("shard", "here")).alias("held")  # a row per shard at most
        ), "groups",
    )
    placed, room = open_.select(group, F.lit(None).cast("int").alias("shard")).where("false"), list(room)
    for number in range(rounds):
        goal, here = wanted(group, room, number)
        wishes = open_.withColumns({"shard": goal, "here": here})
        level = -2 * F.floor(F.log2(F.col("members").cast("double"))) - F.when(
            2 * F.col("here") > F.col("members"), 1
        ).otherwise(0)
        asked = ranked(
            wishes.where("shard is not null").withColumn("_level", level), ["shard"],
            ["_level", group], "before", buckets, "members",
        )
        judged = stored(
            asked.select(group, "members", "held", "shard", (
                F.col("before") + F.col("members") <= per_shard(room)).alias("taken"))
            .unionByName(wishes.where("shard is null").select(
                group, "members", "held", "shard", F.lit(False).alias("taken"))), "wishes",
        )
        taken = {r["shard"]: r["n"] for r in judged.where("taken").groupBy("shard").agg(
            F.sum("members").alias("n")).collect()}  # one row per shard
        if not taken:
            break
        room = [n - taken.get(s, 0) for s, n in enumerate(room)]
        placed = placed.unionByName(judged.where("taken").select(group, "shard"))
        open_ = judged.where("not taken").select(group, "members", "held")
        if not open_.limit(1).count():
            break
    return placed, open_, room


def with_rest(
    movable: DataFrame, group: str, placed: DataFrame, open_: DataFrame, room: list[int],
    all_buckets: int,
) -> tuple[DataFrame, list[int]]:
    """Shards of all documents of small groups, and the room left per shard.

    Open groups are counted by size, and each size, from the largest, is dealt to the shards that hold
    it whole. What fits nowhere fills the rest in the order of groups.
    """
    spark, room = movable.sparkSession, list(room)
    # One row per size: at most the square root of twice the rows.
    sizes = open_.groupBy("members").agg(F.count("*").alias("n")).collect()
    dealt = []
    for r in sorted(sizes, key=lambda r: -r["members"]):
        size, left, given = r["members"], r["n"], []
        for s, n in enumerate(room):
            take = min(left, n // size)
            given.append((s, take))
            room[s] -= take * size
            left -= take
        dealt.append((size, steps([g for g in given if g[1]])))
    members = movable.select("row_id", group)
    if not dealt:
        return stored(members.join(placed, group).select("row_id", "shard"), "settled"), room
    deal = spark.createDataFrame(dealt, f"members bigint, {STEPS}")
    rest = open_.select(group, "members").withColumn("_level", F.lit(0))
    rest = stored(
        ranked(rest, ["members"], ["_level", group], "place", all_buckets)
        .join(F.broadcast(deal), "members").select(group, "members", step_taken().alias("shard")),
        "groups",
    )
    whole = placed.unionByName(rest.where("shard is not null").select(group, "shard"))
    apart = ranked(
        rest.where("shard is null").select(group, "members").withColumn("_level", F.lit(0)), [],
        ["_level", group], "_before", all_buckets, "members",
    )
    split = ranked(
        members.join(apart.select(group, "_before"), group).withColumn("_level", F.lit(0)), [group],
        ["_level", "row_id"], "_within", LEAST_SHARD_BUCKETS,
    ).withColumn("place", F.col("_before") + F.col("_within"))
    gaps = sorted(enumerate(room), key=lambda g: -g[1])
    found = stored(
        members.join(whole, group).select("row_id", "shard").unionByName(
            split.select("row_id", filling(gaps).alias("shard"))
        ),
        "settled",
    )
    # What is split fills the gaps from the widest on.
    left = rest.where("shard is null").agg(F.coalesce(F.sum("members"), F.lit(0)).alias("n")).first()["n"]
    for s, n in gaps:
        room[s], left = n - min(n, left), left - min(n, left)
    return found, room


def sharded_documents(
    documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: counts of shards differ by at most one. Linked are documents with equal
    texts; null and very long texts are like others, null texts have size 8 and no links. Rows are
    told apart by a number of their own, so that repeated rows and null ids each get a slot. An empty
    table gives an empty table; other columns, also those named like a result, are not looked at.
    """
    text = F.col("text")
    slim = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(text.isNotNull(), F.sha2(text.cast("binary"), 256)).alias("links"),
    )
    # Written once, so that the number that tells equal rows apart stays theirs.
    items = stored(
        slim.withColumn("row_id", F.concat_ws(
            ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
            F.monotonically_increasing_id().cast("string"),
        )),
        "items",
    )
    found = balanced_shards(items, "links", shards, rounds)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
