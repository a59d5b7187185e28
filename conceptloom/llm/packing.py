"""Problem 8: best-two-fit packing of documents into containers of fixed capacity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


class _Stock:
    """Unpacked items by size: how many of each, and the largest size at hand up to any bound."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.left = np.bincount(sizes, minlength=capacity + 1)
        self.top = np.maximum.accumulate(np.where(self.left > 0, np.arange(capacity + 1), 0))

    def take(self, size: int) -> None:
        self.left[size] -= 1
        if self.left[size] == 0:
            end = size
            while end < len(self.top) and self.top[end] == size:
                end += 1
            self.top[size:end] = self.top[size - 1]

    def best_pair(self, room: int, more_than: int) -> tuple[int, int] | None:
        """Two items that fill ``room`` most tightly, with a sum above ``more_than``."""
        first = np.flatnonzero(self.left[: room + 1])
        if not len(first):
            return None
        second = self.top[room - first]
        alone = (second == first) & (self.left[first] < 2)
        second = np.where(alone, self.top[np.maximum(first - 1, 0)], second)
        total = np.where(second > 0, first + second, 0)
        k = int(np.argmax(total))
        return (int(first[k]), int(second[k])) if total[k] > more_than else None


def best_two_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number and place within it of every item; sizes are 1 to capacity.

    Each container is filled greedily with the largest item that fits. While room is left, its smallest item
    gives way to two unpacked items when they fill the widened room more tightly; the item goes back to stock.
    """
    stock = _Stock(sizes, capacity)
    bins: list[list[int]] = []
    while stock.top[capacity]:
        items, room = [], capacity
        while room and (size := int(stock.top[room])):
            stock.take(size)
            items.append(size)
            room -= size
        while room:
            smallest = min(items)
            pair = stock.best_pair(room + smallest, smallest) if len(items) > 0 else None
            if pair is None:
                break
            items.remove(smallest)
            for size in pair:
                stock.take(size)
                items.append(size)
            room += smallest - sum(pair)
            stock.left[smallest] += 1
            stock.top[smallest:] = np.maximum(stock.top[smallest:], smallest)
        bins.append(items)
    flat = np.array([s for b in bins for s in b], np.int64)
    number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    place = np.concatenate([np.arange(len(b)) for b in bins]) if bins else np.zeros(0, np.int64)
    by_size, items = np.argsort(flat, kind="stable"), np.argsort(sizes, kind="stable")
    out_bin, out_place = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    out_bin[items], out_place[items] = number[by_size], place[by_size]
    return out_bin, out_place


def pack(sizes: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = 2048, group_rows: int = 20_000) -> DataFrame:
    """Containers for items: ``id_col``, piece, piece_tokens, container_id, place.

    Items up to ``capacity`` stay whole (piece 0). A larger one is cut into full containers and one rest that
    is packed like an item. Sizes that are null or below 1 take no room and have no row. Items are spread by
    the hash of their id over groups of about ``group_rows`` and each group is packed alone, so no task grows
    with the data; a group leaves at most its last container loose. Rows with equal or null ids are packed one by one.
    """
    items = sizes.where(F.col(size_col) >= 1).select(F.col(id_col), F.col(size_col).cast("long").alias("_size"))
    spark = sizes.sparkSession
    groups = max(1, -(-items.count() // group_rows))
    pieces = items.select(
        id_col,
        F.pmod(F.xxhash64(id_col), F.lit(groups)).alias("_group"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.expr(f"(_size - 1) div {capacity}")), lambda k: F.least(F.col("_size") - k * capacity, F.lit(capacity)))).alias("piece", "piece_tokens"),
    )
    id_type = spark.createDataFrame([], sizes.select(id_col).schema).schema[0].dataType.simpleString()

    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(id_col, "ascending"), ("piece", "ascending")]))
        number, place = best_two_fit(rows["piece_tokens"].to_numpy(), capacity)
        return rows.select([id_col, "piece", "piece_tokens"]).append_column("container_id", pa.array(key[0].as_py() * (1 << 32) + number)).append_column("place", pa.array(place.astype("int32")))

    return pieces.groupBy("_group").applyInArrow(one, f"`{id_col}` {id_type}, piece int, piece_tokens long, container_id long, place int")


def pack_corpus(docs: DataFrame, capacity: int = 2048, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sizes of all documents in tokens, counted once and kept in the shared folder, then their containers."""
    from .bytebpe import DEFAULT_VOCABULARY
    from .encoding import count_tokens

    return pack(cut(count_tokens(docs, id_col, text_col, path or DEFAULT_VOCABULARY)), id_col, "n_tokens", capacity)
