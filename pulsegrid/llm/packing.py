"""Filling fixed-capacity containers with documents.

Method: cost-balanced packing. A document costs ``linear * n + quadratic * n ** 2`` (attention); documents go in
descending order to the sequence of the lowest cost that still has room. The number of sequences is the least that could
hold all tokens, so some documents, small ones, find no room while a few tokens are free in each sequence. Exchanges of
documents of nearly equal size gather that room (``gather_room``); what is left over then is packed by best fit.

Scale: documents are dealt by hash to shards of about ``shard_docs``; a shard and capacity is one task's work on sizes
alone, and wastes at most its last container.
"""

from __future__ import annotations

import bisect
import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .tokens import encode_corpus

OUT = "pack_id int, container_id string, doc_id {id}, part int, token_from int, n_tokens int, moved boolean"


def lowest_cost(sizes: list[int], capacity: int, sequences: int, linear: float, quadratic: float) -> tuple[list[list[int]], list[int]]:
    """Descending ``sizes`` to the cheapest sequence with room: the item numbers per sequence, and those left over."""
    free, cost, items = [capacity] * sequences, [0.0] * sequences, [[] for _ in range(sequences)]
    cheapest = [(0.0, i) for i in range(sequences)]
    parked: list[tuple[int, int]] = []  # no room for the present size, the roomiest first; sizes only fall
    left = []
    for item, size in enumerate(sizes):
        while parked and -parked[0][0] >= size:
            _, i = heapq.heappop(parked)
            heapq.heappush(cheapest, (cost[i], i))
        while cheapest and free[cheapest[0][1]] < size:
            _, i = heapq.heappop(cheapest)
            heapq.heappush(parked, (-free[i], i))
        if not cheapest:
            left.append(item)
            continue
        _, i = heapq.heappop(cheapest)
        free[i] -= size
        cost[i] += linear * size + quadratic * size * size
        items[i].append(item)
        if free[i]:
            heapq.heappush(cheapest, (cost[i], i))
    return items, left


def gather_room(items: list[list[int]], left: list[int], sizes: list[int], capacity: int, rounds: int = 4) -> tuple[list[int], set[int]]:
    """Make room for the items left over by exchanges; changes ``items``, returns who is still left and who moved.

    A sequence with ``f`` tokens free gives an item to another open sequence and takes one of ``f`` tokens more: it is
    full then, and its room has moved to the other, where it adds up until an item that was left over fits. Costs hardly
    change, as the two items differ by the few tokens that were free.
    """
    free = [capacity - sum(sizes[i] for i in c) for c in items]
    moved: set[int] = set()
    for _ in range(rounds):
        if not left:
            break
        open_with: dict[int, set[int]] = {}  # size to the sequences with room that hold an item of it
        for c, own in enumerate(items):
            if free[c]:
                for i in own:
                    open_with.setdefault(sizes[i], set()).add(c)
        for c in sorted(range(len(items)), key=lambda c: (free[c], c)):
            f = free[c]
            if not f:
                continue
            best = max(((free[b], -b, -i) for i in items[c] for b in open_with.get(sizes[i] + f, ()) if b != c), default=None)
            if best is None:
                continue
            b, i = -best[1], -best[2]
            j = next(x for x in items[b] if sizes[x] == sizes[i] + f)
            items[c][items[c].index(i)], items[b][items[b].index(j)] = j, i
            free[c], free[b] = 0, free[b] + f
            moved |= {i, j}
            for x in (i, *items[c]):
                open_with.get(sizes[x], set()).discard(c)
            if all(sizes[x] != sizes[j] for x in items[b]):
                open_with[sizes[j]].discard(b)
            open_with.setdefault(sizes[i], set()).add(b)
        room = sorted((free[c], c) for c in range(len(items)) if free[c])
        rest = []
        for item in left:  # by descending size, each to the least room that takes it
            at = bisect.bisect_left(room, (sizes[item], -1))
            if at == len(room):
                rest.append(item)
                continue
            space, c = room.pop(at)
            items[c].append(item)
            moved.add(item)
            free[c] = space - sizes[item]
            if free[c]:
                bisect.insort(room, (free[c], c))
        if len(rest) == len(left):
            break
        left = rest
    return left, moved


def best_fit(items: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Items (by descending size) into the fullest new container with room, else into another one."""
    out: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for item in items:
        at = bisect.bisect_left(room, (sizes[item], -1))
        if at < len(room):
            free, c = room.pop(at)
        else:
            free, c = capacity, len(out)
            out.append([])
        out[c].append(item)
        if free > sizes[item]:
            bisect.insort(room, (free - sizes[item], c))
    return out


def pack_sizes(sizes: list[int], capacity: int, *, linear: float = 1.0, quadratic: float = 1 / 4096, excess: float = 0.004) -> tuple[list[list[int]], set[int]]:
    """Containers of item numbers for descending sizes within the capacity, and the items that the repair moved.

    What no exchange makes room for is packed by best fit; while that takes more than ``excess`` (and one container)
    over the least number of containers, a growing share of the sequences is packed anew with it. It happens where most documents are larger than
    half a container, so that the cheapest sequence is rarely one that a document fills.
    """
    if not sizes:
        return [], set()
    least = max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))
    dealt, left = lowest_cost(sizes, capacity, least, linear, quadratic)
    left, moved = gather_room(dealt, left, sizes, capacity)
    # open sequences first, then those of many items, whose room can be shared out anew
    order = sorted((c for c in dealt if c), key=lambda c: (sum(sizes[i] for i in c) == capacity, -len(c), c))
    for share in (0.0, 0.25, 0.5, 1.0):
        n = round(share * len(order))
        again = sorted(left + [i for c in order[:n] for i in c])
        packed = order[n:] + best_fit(again, sizes, capacity)
        if len(packed) <= least * (1 + excess) + 1:
            break
    return packed, moved | set(again)


def pack_documents(sizes: DataFrame, capacities: DataFrame, *, doc_id: str = "doc_id", n_tokens: str = "n_tokens", shard_docs: int = 50_000, linear: float = 1.0, quadratic: float = 1 / 4096) -> DataFrame:
    """Columns ``pack_id``, ``container_id``, ``doc_id``, ``part``, ``token_from``, ``n_tokens``, ``moved``: one row per placed piece.

    ``capacities`` has ``pack_id`` and ``capacity_tokens``; for each of them all documents are packed. A document larger
    than the capacity is split into full containers of its own and a remainder that is packed like any other; no other
    is split. Documents without tokens (null, empty) need no room and aren't listed. Capacities that are null or under
    1 are left out. Repeated ids are packed as often as they occur. ``moved`` marks pieces that lie elsewhere than where
    the lowest cost first put them. The number of shards follows from the number of documents; with equal input and
    ``shard_docs`` the containers and their names are equal.
    """
    id_type = dict(sizes.dtypes)[doc_id]
    held = cut(sizes.select(F.col(doc_id).alias("doc_id"), F.col(n_tokens).cast("int").alias("n_tokens")).filter(F.col(n_tokens) > 0))
    shards = max(1, round(held.count() / shard_docs))
    dealt = held.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(shards)).cast("int"))
    # a handful of capacities, as an array: each document meets each of them once
    wanted = [(r.pack_id, r.capacity_tokens) for r in capacities.filter("capacity_tokens >= 1").select("pack_id", "capacity_tokens").distinct().collect()]
    if not wanted:
        return held.sparkSession.createDataFrame([], OUT.format(id=id_type))
    packs = F.array(*[F.struct(F.lit(int(p)).cast("int").alias("pack_id"), F.lit(int(c)).cast("int").alias("capacity")) for p, c in wanted])
    goals = dealt.select("doc_id", "n_tokens", "shard", F.explode(packs).alias("g")).select("doc_id", "n_tokens", "shard", "g.pack_id", "g.capacity")
    # full containers of split documents are settled without any packing; a number tells repeated ids apart
    again = Window.partitionBy("pack_id", "doc_id").orderBy("n_tokens")
    whole = goals.filter("n_tokens >= capacity").withColumn("nth", F.row_number().over(again)).select("*", F.explode(F.sequence(F.lit(0), F.floor(F.col("n_tokens") / F.col("capacity")).cast("int") - 1)).alias("part"))
    split = whole.select(
        "pack_id", F.concat_ws("-", "pack_id", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "nth", "part").alias("container_id"), "doc_id", "part", (F.col("part") * F.col("capacity")).alias("token_from"), F.col("capacity").alias("n_tokens"), F.lit(False).alias("moved")
    )
    rest = goals.select("doc_id", "shard", "pack_id", "capacity", F.floor(F.col("n_tokens") / F.col("capacity")).cast("int").alias("part"), (F.col("n_tokens") % F.col("capacity")).alias("n_tokens")).filter("n_tokens > 0")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        capacity, pack, shard = int(pdf.capacity[0]), int(pdf.pack_id[0]), int(pdf.shard[0])
        container = [""] * len(pdf)
        packed, moved = pack_sizes(pdf.n_tokens.tolist(), capacity, linear=linear, quadratic=quadratic)
        for c, items in enumerate(packed):
            for i in items:
                container[i] = f"{pack}-{shard}-{c}"
        return pd.DataFrame({"pack_id": pdf.pack_id, "container_id": container, "doc_id": pdf.doc_id, "part": pdf.part, "token_from": pdf.part * capacity, "n_tokens": pdf.n_tokens, "moved": [i in moved for i in range(len(pdf))]})

    return split.unionByName(rest.groupBy("pack_id", "shard").applyInPandas(fill, OUT.format(id=id_type)))


def document_sizes(docs: DataFrame, **encoding) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of each document."""
    return encode_corpus(docs, **encoding).select("doc_id", F.size("ids").alias("n_tokens"))


def unused_space(packed: DataFrame, capacities: DataFrame, linear: float = 1.0, quadratic: float = 1 / 4096) -> DataFrame:
    """Per pack: containers, documents, tokens, the share of unused space, of moved pieces, and the containers' spread of cost.

    The spread is the standard deviation of the containers' costs over their mean.
    """
    cost = F.sum(linear * F.col("n_tokens") + quadratic * F.col("n_tokens") * F.col("n_tokens"))
    each = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("n_tokens"), cost.alias("cost"), F.count("*").alias("n_pieces"), F.count_if("moved").alias("n_moved"))
    per = each.groupBy("pack_id").agg(F.count("*").alias("n_containers"), F.sum("n_pieces").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"), (F.sum("n_moved") / F.sum("n_pieces")).alias("moved_share"), (F.stddev_pop("cost") / F.avg("cost")).alias("cost_spread"))
    return per.join(capacities.select("pack_id", "capacity_tokens").distinct(), "pack_id").withColumn("unused_share", 1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))


def packing_faults(packed: DataFrame, sizes: DataFrame, capacities: DataFrame, *, doc_id: str = "doc_id", n_tokens: str = "n_tokens") -> DataFrame:
    """Per pack (also of capacities that nothing was packed for): overfull containers, lost or doubled tokens, documents split though they fit.

    All three are 0 in a valid packing.
    """
    wanted = capacities.filter("capacity_tokens >= 1").select("pack_id", "capacity_tokens").distinct()
    full = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(wanted, "pack_id").groupBy("pack_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_overfull"))
    parts = packed.groupBy("pack_id", doc_id).agg(F.sum("n_tokens").alias("placed"), F.count("*").alias("parts"), F.count_if(F.col("token_from") == 0).alias("copies"))
    whole = sizes.filter(F.col(n_tokens) > 0).groupBy(F.col(doc_id).alias("d")).agg(F.sum(n_tokens).alias("due"), F.max(n_tokens).alias("most"))
    due = whole.join(F.broadcast(wanted), F.lit(True))  # a handful of capacities
    met = due.alias("w").join(parts.alias("p"), on=[F.col("w.pack_id") == F.col("p.pack_id"), F.col("w.d").eqNullSafe(F.col(f"p.{doc_id}"))], how="left")
    lost = F.abs(F.col("due") - F.coalesce("placed", F.lit(0)))
    split = (F.col("most") <= F.col("capacity_tokens")) & (F.col("parts") > F.col("copies"))
    per = met.groupBy("w.pack_id").agg(F.sum(lost).alias("n_lost"), F.count_if(split).alias("n_split"))
    return wanted.select("pack_id").join(full, "pack_id", "left").join(per, "pack_id", "left").select("pack_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_overfull", "n_lost", "n_split")])
