"""Sharding by balanced label propagation, with DataFrame operations only.

Equal texts are linked. Each round, the documents of a group move towards the
shard that holds most of their neighbours, under quotas that never let a shard
outgrow its share of the rows. Groups whose first choice is full try their other
shards. Documents without links fill up the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.joins import attach
from gleanwork.functions.numbering import numbered, running_total
from gleanwork.session import settle


def _targets(n: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [n // shards + (1 if s < n % shards else 0) for s in range(shards)]


def _path(start: int, edges: list[list[int]], ends: list[bool]) -> list[tuple[int, int]]:
    """Fewest edges ``(a, b)`` with something on them, walked backwards from
    ``start`` to a shard in ``ends``; empty if there is none."""
    came: dict[int, int] = {start: start}
    queue = [start]
    for b in queue:
        if ends[b] and b != start:
            path = []
            while b != start:
                path.append((b, came[b]))
                b = came[b]
            return path
        for a in range(len(edges)):
            if edges[a][b] > 0 and a not in came:
                came[a] = b
                queue.append(a)
    return []


def plan_moves(
    wishes: dict[tuple[int, int], int], either: dict[tuple[int, int], int], room: list[int]
) -> tuple[list[list[int]], list[list[int]]]:
    """Rows accepted from each shard to each other one.

    ``wishes`` are rows by direction. ``either`` are groups of two rows in
    two shards, which are united by a move one way or the other. ``room``
    is what a shard may grow by. All wishes start as accepted and the groups of
    two half and half. A shard that would outgrow its room first turns
    groups of two around, along a chain of shards that ends where there is room
    for two rows, and only then refuses wishes, along a shortest chain.
    The numbers are shards x shards, whatever the size of the table.
    """
    shards = range(len(room))
    fixed = [[wishes.get((a, b), 0) for b in shards] for a in shards]
    turned = [[0] * len(room) for _ in shards]
    for (a, b), n in either.items():
        turned[a][b], turned[b][a] = n - n // 2, n // 2
    over = [sum(fixed[a][s] + turned[a][s] - fixed[s][a] - turned[s][a] for a in shards) - room[s] for s in shards]
    while max(over) > 0:
        full = over.index(max(over))
        path = _path(full, turned, [o <= -2 for o in over])
        if path:
            last = path[0][0]
            n = min(*(turned[a][b] for a, b in path), (over[full] + 1) // 2, -over[last] // 2)
            for a, b in path:
                turned[a][b] -= n
                turned[b][a] += n
            over[full] -= 2 * n
            over[last] += 2 * n
            continue
        both = [[fixed[a][b] + turned[a][b] for b in shards] for a in shards]
        # Without any move all shards have room, so a chain exists.
        path = _path(full, both, [o < 0 for o in over])
        last = path[0][0]
        n = min(*(both[a][b] for a, b in path), over[full], -over[last])
        for a, b in path:
            first = min(n, fixed[a][b])
            fixed[a][b] -= first
            turned[a][b] -= n - first
        over[full] -= n
        over[last] += n
    return fixed, turned


def _wishes(cells: DataFrame, ranks: Column, salt: int) -> DataFrame:
    """``<key, rank, kind, shard, to, n, top>``: every cell of a split group
    that wants to join the group's cell of the given rank by size.

    Ties are ordered by a hash of key, shard and round, so wishes between two
    shards run both ways. ``either``: two single rows. ``part``: the cell is
    not larger than the one it joins, so every row that moves cuts fewer links.
    ``whole``: it is larger, and only a move of the whole cell does.
    """
    cell = F.struct((-F.col("n")).alias("less"), F.xxhash64("key", "shard", F.lit(salt)).alias("coin"), "shard", "n")
    split = (
        cells.groupBy("key")
        .agg(F.array_sort(F.collect_list(cell)).alias("held"))  # at most `shards`
        .filter(F.size("held") > 1)
    )
    asked = split.select("key", "held", F.explode(ranks).alias("rank")).filter(F.col("rank") <= F.size("held"))
    asked = asked.withColumn("into", F.element_at("held", F.col("rank")))
    asked = asked.select(
        "key",
        "rank",
        F.col("into.shard").alias("to"),
        F.col("into.n").alias("top"),
        ((F.size("held") == 2) & (F.col("held")[0]["n"] == 1) & (F.col("rank") == 1)).alias("pair"),
        F.explode("held").alias("from"),
    ).filter(F.col("from.shard") != F.col("to"))
    single = F.col("pair") & (F.col("from.n") == 1)
    kind = F.when(single, "either").when(F.col("from.n") <= F.col("top"), "part").otherwise("whole")
    shard = F.col("from.shard")
    return asked.select(
        "key",
        "rank",
        kind.alias("kind"),
        F.when(single, F.least(shard, "to")).otherwise(shard).alias("shard"),
        F.when(single, F.greatest(shard, "to")).otherwise(F.col("to")).alias("to"),
        F.col("from.n").alias("n"),
        "top",
    )


def _by_route(quotas: list[list[int]], back: bool = False) -> Column:
    """The quota of a row's route from ``shard`` to ``to``, or of the way back."""
    routes = [
        F.when((F.col("shard") == a) & (F.col("to") == b), F.lit(quotas[b][a] if back else quotas[a][b]).cast("long"))
        for a in range(len(quotas))
        for b in range(len(quotas))
        if (quotas[b][a] if back else quotas[a][b])
    ]
    return F.coalesce(*routes, F.lit(0).cast("long"))


def _accepted(cells: DataFrame, targets: list[int], salt: int) -> DataFrame | None:
    """``<key, shard, to, taken>`` of one round, or nothing if no move is left.

    The largest cell of a group is its first choice; when no group gets its
    first choice any more, the others are tried in order of size.
    """
    shards = range(len(targets))
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = [targets[s] - held.get(s, 0) for s in shards]
    for ranks in ([1], list(shards)[2:] + [len(targets)]):
        wishes = _wishes(cells, F.array(*map(F.lit, ranks)), salt)
        # At most shards x shards numbers per rank and kind.
        asked = wishes.groupBy("rank", "kind", "shard", "to").agg(F.sum("n").alias("n"), F.min("n").alias("least")).collect()
        for rank in ranks:
            mine = [r for r in asked if r["rank"] == rank]
            rows = {k: {(r["shard"], r["to"]): r["n"] for r in mine if r["kind"] == k} for k in ("part", "either")}
            fixed, turned = plan_moves(rows["part"], rows["either"], room)
            if any(map(any, fixed)) or any(map(any, turned)):
                chosen = wishes.filter((F.col("rank") == rank) & (F.col("kind") != "whole"))
                order = [F.desc(F.col("top") - F.col("n")), F.asc("key")]
                summed = running_total(chosen, order, F.col("n"), "upto", ["kind", "shard", "to"])
                one_way = F.when(F.col("kind") == "either", _by_route(turned)).otherwise(_by_route(fixed))
                ahead = F.greatest(F.lit(0), F.least("n", one_way - (F.col("upto") - F.col("n"))))
                # Groups of two after those that move one way move the other way.
                back = (F.col("kind") == "either") & (F.col("upto") > one_way) & (
                    F.col("upto") <= one_way + _by_route(turned, back=True)
                )
                return summed.select(
                    "key",
                    F.when(back, F.col("to")).otherwise(F.col("shard")).alias("shard"),
                    F.when(back, F.col("shard")).otherwise(F.col("to")).alias("to"),
                    F.when(back, F.col("n")).otherwise(ahead).alias("taken"),
                ).filter("taken > 0")
            # Whole cells only fill room that is there without other moves.
            quotas, left = [[0] * len(room) for _ in shards], list(room)
            for r in sorted((r for r in mine if r["kind"] == "whole"), key=lambda r: (r["shard"], r["to"])):
                if r["least"] <= left[r["to"]]:
                    quotas[r["shard"]][r["to"]] = min(r["n"], left[r["to"]])
                    left[r["to"]] -= quotas[r["shard"]][r["to"]]
            if any(map(any, quotas)):
                chosen = wishes.filter((F.col("rank") == rank) & (F.col("kind") == "whole"))
                summed = running_total(chosen, [F.asc("n"), F.asc("key")], F.col("n"), "upto", ["shard", "to"])
                return summed.filter(F.col("upto") <= _by_route(quotas)).select("key", "shard", "to", F.col("n").alias("taken"))
    return None


def propagated(cells: DataFrame, targets: list[int]) -> DataFrame:
    """``<key, shard, n>`` when no move is left that cuts fewer links.

    Every accepted row joins a cell of its group at least as large as its own,
    or its whole cell moves, so the sum of squared cells grows in every round
    and the rounds end by themselves.
    """
    salt = 0
    while (accepted := _accepted(cells, targets, salt)) is not None:
        accepted = settle(accepted)
        change = accepted.select("key", F.col("to").alias("shard"), F.col("taken").alias("n")).union(
            accepted.select("key", "shard", -F.col("taken"))
        )
        after = cells.select("key", "shard", "n").union(change).groupBy("key", "shard").agg(F.sum("n").alias("n"))
        cells = settle(after.filter("n > 0"))
        salt += 1
    return cells


def balanced_shards(
    docs: DataFrame,
    key: Column,
    shards: int = 8,
) -> DataFrame:
    """``<row, shard, slot>``: every input row as the struct ``row``, its shard
    from 0 and its place there, gapless from 0.

    Rows with an equal ``key`` are linked; a null key links nothing. Shards
    differ by at most one row. A group too large for a shard, such as a third
    of all rows, stays split over the shards it fills. Rounds end when no
    move is left. A table of groups of two whose shards hold even numbers ends
    without a split group; in other tables a few groups can stay split where
    only an exchange of whole groups between shards would help. Repeated rows are rows of their own, an empty
    table gives no rows, other columns stay inside the struct ``row``.
    """
    base = settle(
        docs.select(F.struct("*").alias("row"), key.alias("key")).withColumn(
            "row_id", F.monotonically_increasing_id()
        )
    )
    # The start is dealt out by position, so all shards have their share.
    rows = settle(numbered(base.drop("row"), [F.col("row_id")], "position"))
    total = rows.count()
    targets = _targets(total, shards)
    rows = rows.withColumn("shard", F.pmod(F.col("position") - 1, F.lit(shards)).cast("int"))
    groups = settle(rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    linked = settle(attach(rows.filter(F.col("key").isNotNull()), groups, ["key"], "members", hot_rows=1_000))
    cells = settle(linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n")))
    cells = propagated(cells, targets)
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    # Members of a group, in order, fill its cells, shard by shard.
    layout = cells.groupBy("key").agg(
        F.sum("n").alias("members"),
        F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("cells"),  # at most `shards`
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.size("cells")),
        lambda i: F.aggregate(
            F.slice("cells", 1, i), F.lit(0).cast("long"), lambda acc, c: acc + c["n"]
        ),
    )
    layout = settle(layout.select("key", "members", F.col("cells.shard").alias("in_shard"), ends.alias("ends")))
    ordered = numbered(linked.select("row_id", "key"), [F.col("row_id")], "member", ["key"])
    placed = attach(ordered, layout, ["key"], "members", hot_rows=1_000).select(
        "row_id",
        F.element_at(
            "in_shard",
            F.size(F.filter("ends", lambda e: e < F.col("member"))) + 1,
        ).alias("shard"),
    )
    single = rows.select("row_id").join(linked.select("row_id"), "row_id", "left_anti")
    single = numbered(single, [F.col("row_id")], "member")
    filled, edges = 0, []
    for s in range(shards):
        filled += targets[s] - held.get(s, 0)
        edges.append(F.when(F.col("member") <= filled, F.lit(s)))
    alone = single.select("row_id", F.coalesce(*edges).alias("shard"))
    every = settle(placed.unionByName(alone))
    slots = numbered(every, [F.col("row_id")], "slot", ["shard"])
    return (
        base.select("row", "row_id")
        .join(slots, "row_id")
        .select("row", "shard", (F.col("slot") - 1).alias("slot"))
    )
