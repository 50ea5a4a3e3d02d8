"""Filling blocks of fixed capacity with items of varying length.

Method: hierarchical residual packing. Evenly cut partitions pack their items best-fit, full and nearly full blocks
leave, and the underfull ones travel up a tree, where they are merged as items by further best-fit rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.session import materialize, ratio_bucket

#: Items that one partition packs at a time, and children of a node of the tree.
ITEMS_PER_PARTITION = 100_000
FAN_IN = 16


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin number of each length (0 to capacity), by best fit in order of falling length.

    All items of one length go in together, to the fullest bins that still take them, so the work is
    capacity x capacity array steps however many items there are. Any two bins together hold more than one capacity.
    Items of length 0 go to the first bin.
    """
    out = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes, begins = np.unique(-lengths[order], return_index=True)
    free: list[np.ndarray] = [np.empty(0, np.int64) for _ in range(capacity + 1)]
    n_bins = 0
    for size, a, e in zip(-sizes, begins, [*begins[1:], len(order)]):
        if size == 0:
            break
        items = order[a:e]
        room = size
        while len(items):
            while room <= capacity and not len(free[room]):
                room += 1
            if room > capacity:
                # new bins, as many as the rest of this length fills
                per = capacity // size
                new = -(-len(items) // per)
                bins = np.arange(n_bins, n_bins + new)
                n_bins += new
                which = np.arange(len(items)) // per
                out[items] = bins[which]
                fill = np.bincount(which, minlength=new) * size
                for f in np.unique(fill):
                    free[capacity - f] = np.concatenate([free[capacity - f], bins[fill == f]])
                break
            # every bin with this room takes as many as go in, the last one perhaps fewer
            per = room // size
            use = min(len(free[room]), -(-len(items) // per))
            bins, free[room] = free[room][:use], free[room][use:]
            take, items = items[: use * per], items[use * per :]
            which = np.arange(len(take)) // per
            out[take] = bins[which]
            left = room - np.bincount(which, minlength=use) * size
            for f in np.unique(left):
                free[f] = np.concatenate([free[f], bins[left == f]])
    return out


def fullest_first(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin number of each length, by best fit of whole bins: the longest item left gets the items that fill its bin best.

    Among equally full fillings the one with the longest items is taken, so short ones stay for later. A filling is
    used for as many bins as the counts of its lengths allow, so the work depends on the capacity and not on the number
    of items. Again any two bins together hold more than one capacity, as no item left over fits any earlier bin.
    """
    out = np.zeros(len(lengths), np.int64)
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    ends = np.cumsum(left)
    n_bins = 0
    sizes = [x for x in range(1, capacity + 1) if left[x]]
    while sizes:
        top = sizes[-1]
        room = capacity - top
        left[top] -= 1
        reach, upto = [1], (1 << (room + 1)) - 1
        usable = [x for x in sizes if x <= room and left[x]]
        for x in usable:
            r = now = reach[-1]
            for _ in range(min(left[x], room // x)):
                now = (now << x) & upto
                r |= now
            reach.append(r)
        left[top] += 1
        rest = reach[-1].bit_length() - 1
        pattern = {top: 1}
        for k in range(len(usable) - 1, -1, -1):
            x, most = usable[k], min(left[usable[k]] - (usable[k] == top), rest // usable[k])
            for n in range(most, -1, -1):
                if reach[k] >> (rest - n * x) & 1:
                    break
            if n:
                pattern[x] = pattern.get(x, 0) + n
                rest -= n * x
        times = min(left[x] // n for x, n in pattern.items())
        for x, n in pattern.items():
            items = order[ends[x] - left[x] : ends[x] - left[x] + times * n]
            out[items] = n_bins + np.arange(times * n) // n
            left[x] -= times * n
        n_bins += times
        sizes = [x for x in sizes if left[x]]
    return out


def pack_bins(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The better of the two best-fit packings."""
    a, b = best_fit(lengths, capacity), fullest_first(lengths, capacity)
    return b if len(lengths) and b.max() < a.max() else a


def pieces_of(items: DataFrame, id_col: str, length: Column, capacity: int) -> DataFrame:
    """(id, piece_no, piece_len): each distinct id once; lengths above the capacity cut into full pieces and a rest."""
    one = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), length.cast("long").alias("n"))
    one = one.groupBy("id").agg(F.max("n").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)).cast("int")
    cut = one.select("id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece_no"))
    return cut.select("id", "piece_no", F.least(F.lit(capacity), F.col("n") - F.col("piece_no").cast("long") * capacity).cast("int").alias("piece_len"))


def _pack_items(capacity: int):
    def run(key, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["id", "piece_no"], kind="stable")
        bins = pack_bins(b["piece_len"].to_numpy(np.int64), capacity)
        return b[["id", "piece_no", "piece_len"]].assign(bin=(np.int64(key[0]) << 32) + bins)

    return run


def _pack_bins(capacity: int):
    def run(key, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("bin", kind="stable")
        to = pack_bins(b["fill"].to_numpy(np.int64), capacity)
        first = b.groupby(to)["bin"].transform("min")
        fill = b.groupby(to)["fill"].transform("sum")
        return pd.DataFrame({"old": b["bin"], "bin": first.astype("int64"), "fill": fill.astype("int64")})

    return run


def _candidates(bins: DataFrame, capacity: int) -> DataFrame:
    """Of the bins of each node those that a merge can still use.

    After best fit, any two bins of a node hold more than the capacity, so at most one is half empty; each merge
    further up needs one such bin. Of the others a node therefore passes on at most FAN_IN of every fill: the rest
    stay as they are, valid blocks. This bounds what a node receives by FAN_IN x FAN_IN x capacity rows.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("node", "fill").orderBy("bin")
    return bins.where(F.col("fill") < capacity).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= FAN_IN).drop("_r")


def pack(
    items: DataFrame, id_col: str, length: Column, capacity: int, items_per_partition: int = ITEMS_PER_PARTITION, fan_in: int = FAN_IN
) -> DataFrame:
    """Rows (id_col, piece_no, piece_len, block): the block of every piece of every item.

    No block holds more than ``capacity``. An item is never cut unless it is longer than that; then it gives full
    pieces and a rest, numbered from 0. Ids that repeat count once, with their greatest length; null ids are left out.
    A null length counts as 0; items of length 0 share a block with others. Ties are taken in order of id, so the
    result is the same on every run. An empty table gives no rows.
    """
    pieces = materialize(pieces_of(items, id_col, F.coalesce(length, F.lit(0)), capacity), "pieces")
    n = pieces.count()
    parts = max(1, -(-n // items_per_partition))
    spread = pieces.withColumn("node", ratio_bucket("id", "piece_no", n=parts))
    packed = spread.groupBy("node").applyInPandas(_pack_items(capacity), pieces.schema.simpleString()[7:-1].replace(":", " ") + ", bin long")
    packed = materialize(packed, "packed")
    bins = packed.groupBy("bin").agg(F.sum("piece_len").cast("long").alias("fill")).withColumn("node", F.shiftright("bin", 32))
    moves: list[DataFrame] = []
    while parts > 1:
        parts = -(-parts // fan_in)
        up = _candidates(bins, capacity).withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        merged = materialize(up.groupBy("node").applyInPandas(_pack_bins(capacity), "old long, bin long, fill long").join(up.select(F.col("bin").alias("old"), "node"), "old"), "merged")
        moves.append(merged.where("old <> bin").select("old", F.col("bin").alias("new")))
        bins = merged.groupBy("bin").agg(F.max("fill").alias("fill"), F.max("node").alias("node"))
    out = packed
    for m in moves:  # merged bins are at most a few for each node; the planner broadcasts the list only while it is small
        out = out.join(m.withColumnRenamed("old", "bin"), "bin", "left").withColumn("bin", F.coalesce("new", "bin")).drop("new")
    return out.select(F.col("id").alias(id_col), "piece_no", "piece_len", F.col("bin").alias("block"))


def pair_length(q: str = "q", a: str = "a") -> Column:
    """Characters of q plus characters of a (null as 0), divided by 4 and rounded up."""
    return F.ceil((F.coalesce(F.length(q), F.lit(0)) + F.coalesce(F.length(a), F.lit(0))) / 4)
