"""Problem 2: most similar vectors, by multi-index hashing.

Vectors become several binary codes by learned rotations. Each code is split into substrings and every substring is
an index of its own. By the pigeonhole principle two codes of ``m`` substrings that differ in at most
``m * (probe + 1) - 1`` bits agree in some substring up to ``probe`` bits; probing each index that deep retrieves every
code within this Hamming radius. How many codes are needed is measured on planted pairs, after the vectors are centred
as they will be. The float vectors of what was retrieved decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Rows of a kind in the sample from which the mean, rotations and misses are taken, at most; every row is indexed.
FIT_ROWS = 5_000
#: Planted pairs on which misses are measured.
PLANTED = 4_000
#: Index rows of a vector that are on disk at once, at most, unless a single code has more: codes are indexed in rounds.
ROUND_ROWS = 24


def _kept(df: DataFrame) -> DataFrame:
    """``cut`` whose shuffle files are removed as soon as the checkpoint stands, not when the driver collects its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return cut(df.select("*"))  # what is planned under this setting keeps it
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def usable_vectors(df: DataFrame, id_col: str, kind: str, dim: int = 64) -> DataFrame:
    """``kind``, ``id``, ``v``, ``h`` of rows with ``dim`` finite values that are not all zero; ``h`` stands for the vector."""
    # A NaN counts as the greatest value, and nulls are passed over, so the two ends tell of all but nulls.
    v, endless = F.col("embedding"), F.lit(float("inf"))
    low, high = F.array_min(v), F.array_max(v)
    fine = (high < endless) & (low > -endless) & ((high != 0) | (low != 0)) & ~F.exists(v, lambda x: x.isNull())
    return (
        df.where(F.col(id_col).isNotNull() & (F.size(v) == dim) & fine)
        .select(F.lit(kind).alias("kind"), F.col(id_col).alias("id"), v.cast("array<float>").alias("v"))
        .withColumn("h", F.xxhash64("v"))
    )


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (``kind``, ``h``, ``v``) and their members (``kind``, ``h``, ``id``): exact copies are searched once."""
    return vectors.groupBy("kind", "h").agg(F.first("v").alias("v")), vectors.select("kind", "h", "id").distinct()


def _ball(bits: int, radius: int) -> int:
    return sum(math.comb(bits, k) for k in range(radius + 1))


@dataclass(frozen=True)
class Plan:
    """Shape of an index: codes of ``substrings`` substrings of ``width`` bits, probed ``probe`` bits deep; bits that
    split a substring's index over tasks; and the rows of a task.

    A split index is kept once for each of ``probe`` + 1 pieces of the substring, of ``split`` bits if there is room:
    substrings that differ in ``probe`` bits at most have one of these pieces in common, so no task needs rows of another part.
    """

    width: int
    substrings: int
    probe: int
    codes: int = 1
    split: int = 0
    group_rows: int = 200_000

    @property
    def bits(self) -> int:
        return self.width * self.substrings

    @property
    def radius(self) -> int:
        """Codes within this Hamming radius are all retrieved: with more differences each substring could have ``probe`` + 1."""
        return self.substrings * (self.probe + 1) - 1

    @property
    def pieces(self) -> int:
        return self.probe + 1 if self.split else 1

    @property
    def shared(self) -> int:
        """Bits of a piece, which all rows of a part share."""
        return min(self.split, self.width // self.pieces)

    def sent(self, rows: int) -> int:
        """Index rows of a vector for one code: one for each substring, piece, and tile of a part that is too large for a task."""
        part = rows / 2**self.shared
        return self.substrings * self.pieces * (math.ceil(part / self.group_rows) if part > 2 * self.group_rows else 1)

    def cost(self, rows: int) -> float:
        """Cost of a row: to be sent to each index, to probe it, to be compared with what the probes hit, and to be verified."""
        ball, ball_of_code = _ball(self.width, self.probe), _ball(self.bits, self.radius)
        return self.codes * (500 * self.sent(rows) + self.substrings * (ball + 0.3 * rows * ball / 2**self.width) + 10000 * rows * ball_of_code / 2**self.bits)

    @staticmethod
    def of(rows: int, flips: float, miss: float = 2.5e-4, group_rows: int = 200_000) -> Plan:
        """The cheapest shape for a number of rows when the bits of near codes differ with chance ``flips``."""
        best = None
        for width in range(8, 31):
            for substrings in range(2, 62 // width + 1):
                for probe in range(4):
                    split = min(width // (probe + 1), max(0, math.ceil(math.log2(max(1, rows / group_rows)))))
                    plan = Plan(width, substrings, probe, 1, split, group_rows)
                    hit = sum(math.comb(plan.bits, k) * flips**k * (1 - flips) ** (plan.bits - k) for k in range(plan.radius + 1))
                    codes = max(1, math.ceil(math.log(miss) / math.log(1 - hit))) if hit < 1 - miss else 1
                    cost = plan.cost(rows) * codes
                    if best is None or cost < best[0]:
                        best = cost, Plan(width, substrings, probe, codes, split, group_rows)
        return best[1]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def planted_pairs(sample: np.ndarray, similarity: float, pairs: int = PLANTED, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at exactly ``similarity``: rows of the sample moved in any direction, and moved as rows differ."""
    rng = np.random.default_rng(seed)
    unit = _unit(sample)
    x = unit[rng.integers(0, len(unit), pairs)]
    out = []
    for away in (rng.standard_normal(x.shape), unit[rng.integers(0, len(unit), pairs)] - unit[rng.integers(0, len(unit), pairs)] + 1e-9 * rng.standard_normal(x.shape)):
        away = _unit(away - (away * x).sum(axis=1, keepdims=True) * x)
        out.append((x, similarity * x + math.sqrt(1 - similarity**2) * away))
    return out


def learn_rotation(centred: np.ndarray, seed: int, rounds: int = 8) -> np.ndarray:
    """One rotation by iterative quantisation; each seed begins from another start."""
    dim = centred.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]
    for _ in range(rounds if len(centred) > dim else 0):
        u, _, vt = np.linalg.svd(np.sign(centred @ rotation).T @ centred)
        rotation = (u @ vt).T
    return rotation


@dataclass(frozen=True)
class Coder:
    """What turns vectors into codes: a mean and rotations for each code; ``found`` is the share of planted pairs retrieved."""

    mean: np.ndarray
    rotations: np.ndarray
    found: float

    def codes(self, x: np.ndarray, plan: Plan) -> np.ndarray:
        """Codes of vectors as 64-bit words, one column for each code."""
        on = (_unit(x.astype(np.float64)) - self.mean) @ self.rotations > 0
        weights = np.uint64(1) << np.arange(plan.bits, dtype=np.uint64)
        return on.reshape(len(x), plan.codes, plan.bits) @ weights


def _flips(mean: np.ndarray, rotation: np.ndarray, planted) -> float:
    return max(float((((x - mean) @ rotation > 0) != ((y - mean) @ rotation > 0)).mean()) for x, y in planted)


def fit(samples: dict[str, np.ndarray], rows: dict[str, int], similarity: float, miss: float = 2.5e-4, plan: Plan | None = None) -> tuple[Plan, dict[str, Coder]]:
    """The plan for the largest kind and a coder for each kind.

    Chances come from planted pairs as the codes see them: after centring. Codes are added until both sorts of
    planted pairs of every kind miss ``miss`` of their number or less.
    """
    state = {}
    for kind, sample in samples.items():
        unit = _unit(sample.astype(np.float64))
        mean = unit.mean(axis=0)
        state[kind] = mean, unit - mean, planted_pairs(sample.astype(np.float64), similarity)
    first = {kind: learn_rotation(centred, 0) for kind, (_, centred, _) in state.items()}
    plan = plan or Plan.of(max(rows.values()), max(_flips(state[k][0], first[k], state[k][2]) for k in state), miss)
    per = max(1, len(next(iter(first.values()))) // plan.bits)  # codes that one rotation has bits for
    whole = -(-plan.bits // len(next(iter(first.values()))))
    columns: dict[str, list[np.ndarray]] = {k: [] for k in state}
    missed = {k: [np.ones(len(x), bool) for x, _ in planted] for k, (_, _, planted) in state.items()}
    codes = 0
    while codes == 0 or any(m.mean() > miss for many in missed.values() for m in many):
        for kind, (mean, centred, planted) in state.items():
            rotation = np.hstack([learn_rotation(centred, 1 + codes * 64 + i) for i in range(whole)])
            for c in range(per):
                part = rotation[:, c * plan.bits : (c + 1) * plan.bits]
                columns[kind].append(part)
                for lost, (x, y) in zip(missed[kind], planted):
                    lost &= (((x - mean) @ part > 0) != ((y - mean) @ part > 0)).sum(axis=1) > plan.radius
        codes += per
    plan = Plan(plan.width, plan.substrings, plan.probe, codes, plan.split, plan.group_rows)
    return plan, {k: Coder(state[k][0], np.hstack(columns[k]), 1 - max(m.mean() for m in missed[k])) for k in state}


def masks_of(bits: int, most: int) -> list[int]:
    """All words of some bits with ``most`` bits set or fewer."""
    return [sum(1 << b for b in some) for k in range(most + 1) for some in combinations(range(bits), k)]


def pairs_in_index(code_a, h_a, code_b, h_b, own: bool, j: int, free: int, probe: int, plan: Plan, block: int = 2_000_000, piece: int = 0):
    """Pairs of rows whose substring ``j`` differs in ``probe`` of ``free`` bits at most and whose codes lie within the radius.

    These bits are all but the ``piece``-th ``width`` - ``free`` ones, which all rows share. own: both sides are the same rows,
    and each pair comes once. A pair that an earlier substring of its code, or an earlier piece of this one, already
    finds is left to that one. Yields arrays of ``h``; no more than ``block`` candidates are held at a time.
    """
    shift, shared = np.uint64(j * plan.width), plan.width - free
    every, below = np.uint64((1 << plan.width) - 1), np.uint64((1 << piece * shared) - 1)
    earlier_pieces = [((1 << shared) - 1) << earlier * shared for earlier in range(piece)]

    def unshared(code: np.ndarray) -> np.ndarray:
        value = (code >> shift) & every
        return (value & below) | ((value >> np.uint64(shared)) & ~below)

    value_b = unshared(code_b)
    order = np.argsort(value_b, kind="stable")
    value_b, code_b, h_b = value_b[order], code_b[order], h_b[order]
    if own:
        value_a, code_a, h_a = value_b, code_b, h_b
    else:
        value_a = unshared(code_a)
    # Few values: a table of where each begins; many: binary search.
    starts = np.searchsorted(value_b, np.arange((1 << free) + 1, dtype=np.uint64)) if free <= 22 else None
    for mask in masks_of(free, probe):
        if not all(mask & bits for bits in earlier_pieces):
            continue
        target = value_a ^ np.uint64(mask)
        at = np.flatnonzero(value_a < target) if own and mask else np.arange(len(value_a))
        target = target[at]
        if starts is not None:
            begin, end = starts[target], starts[target + np.uint64(1)]
        else:
            begin, end = np.searchsorted(value_b, target, "left"), np.searchsorted(value_b, target, "right")
        if own and not mask:
            begin = at + 1
        count = np.maximum(end - begin, 0)
        some = count > 0
        at, begin, count = at[some], begin[some], count[some]
        ends = np.cumsum(count)
        k = 0
        while k < len(at):
            base = ends[k - 1] if k else 0
            to = max(k + 1, int(np.searchsorted(ends, base + block, "right")))
            c = count[k:to]
            for x, y in _expanded(at[k:to], begin[k:to], c, block):
                differ = code_a[x] ^ code_b[y]
                near = np.bitwise_count(differ) <= plan.radius
                x, y, differ = x[near], y[near], differ[near]
                first = np.ones(len(x), bool)
                for earlier in range(j):
                    first &= np.bitwise_count((differ >> np.uint64(earlier * plan.width)) & every) > plan.probe
                if first.any():
                    yield h_a[x[first]], h_b[y[first]]
            k = to


def _expanded(source, begin, count, block):
    """Row numbers of both sides of runs of candidates, in blocks; a run longer than a block is cut."""
    if len(source) == 1:
        for at in range(0, int(count[0]), block):
            n = min(block, int(count[0]) - at)
            yield np.full(n, source[0]), begin[0] + at + np.arange(n)
        return
    ends = np.cumsum(count)
    yield np.repeat(source, count), np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]))


def _codes(vectors: DataFrame, plan: Plan, coders: dict[str, Coder]) -> DataFrame:
    """``kind``, ``h``, ``codes`` of distinct vectors; the floats stay where they are read."""
    sent = vectors.sparkSession.sparkContext.broadcast(coders)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = np.array(batch.column("kind").to_pylist(), object)
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            out = np.zeros((len(x), plan.codes), np.uint64)
            for kind in set(kinds):
                out[kinds == kind] = sent.value[kind].codes(x[kinds == kind], plan)
            words = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel().view(np.int64)), plan.codes).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("h"), words], names=["kind", "h", "codes"])

    coded = vectors.select("kind", "h", "v").mapInArrow(encode, "kind string, h long, codes array<long>")
    return coded.groupBy("kind", "h").agg(F.first("codes").alias("codes"))


def fitted(vectors: DataFrame, similarity: float, miss: float = 2.5e-4, plan: Plan | None = None) -> tuple[Plan, dict[str, Coder], dict[str, int]] | None:
    """Plan, coders and numbers of distinct vectors; None if there are no vectors. ``h`` is a hash, so its remainder gives a sample."""
    rows = {r["kind"]: r["n"] for r in vectors.groupBy("kind").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not rows:
        return None
    part = F.lit(1)
    for kind, n in rows.items():
        part = F.when(F.col("kind") == kind, F.lit(max(1, n // FIT_ROWS))).otherwise(part)
    samples = {}
    for kind in rows:
        taken = vectors.where((F.col("kind") == kind) & (F.pmod("h", part) == 0)).select("h", "v").limit(2 * FIT_ROWS).toPandas().drop_duplicates("h").head(FIT_ROWS)
        if len(taken):
            samples[kind] = np.stack(taken["v"].to_numpy())
    missing = rows.keys() - samples.keys()
    for kind in missing:  # no row falls on the remainder: any rows serve
        samples[kind] = np.stack(vectors.where(F.col("kind") == kind).select("v").limit(FIT_ROWS).toPandas()["v"].to_numpy())
    return *fit(samples, rows, similarity, miss, plan), rows


def _tiled(rows: DataFrame, plan: Plan) -> DataFrame:
    """Rows with the tile they are compared in: a part of more than ``group_rows`` rows becomes a triangle of tiles.

    Rows of a large part get a salt by their hash; each pair of salts is a task of its own, so no task holds more than
    two salts' rows, however many rows share a value. There are fewer large parts than rows / group_rows.
    """
    sizes = rows.groupBy("kind", "slot", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * plan.group_rows)
    large = _kept(sizes.select("kind", "slot", "part", F.ceil(F.col("n") / plan.group_rows).cast("int").alias("salts")))
    if large.isEmpty():
        return rows.withColumn("tile", F.lit(0)).withColumn("other_tile", F.lit(0)).withColumn("salt", F.lit(0))
    salted = rows.join(F.broadcast(large), ["kind", "slot", "part"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("h"), F.col("salts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return salted.select("kind", "slot", "part", "h", "code", F.least("salt", "with").alias("tile"), F.greatest("salt", "with").alias("other_tile"), "salt")


def _found(codes: DataFrame, plan: Plan) -> DataFrame:
    """``kind``, ``h_a``, ``h_b``: the pairs of rows one of whose codes lie within the radius."""
    m, pieces, shared = plan.substrings, plan.pieces, plan.shared
    one = codes.select("kind", "h", F.posexplode("codes").alias("t", "code"))
    # A slot is a piece of a substring of a code; where indexes are split, its bits are the part.
    each = one.select("kind", "h", "code", F.explode(F.sequence(F.col("t") * (m * pieces), F.col("t") * (m * pieces) + m * pieces - 1)).alias("slot"))
    at = F.expr(f"shiftrightunsigned(code, cast(slot div {pieces} % {m} * {plan.width} + slot % {pieces} * {shared} as int))")
    rows = each.select("kind", "slot", at.bitwiseAND(F.lit((1 << shared) - 1)).alias("part"), "h", "code")
    tiled = _tiled(rows, plan) if plan.split else rows.withColumn("tile", F.lit(0)).withColumn("other_tile", F.lit(0)).withColumn("salt", F.lit(0))

    def find(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, slot, _, tile, other = (k.as_py() for k in key)
        table = pa.Table.from_batches([b.select(["h", "code", "salt"]) for b in batches])
        code = table["code"].to_numpy().view(np.uint64)
        h, salt = (table[c].to_numpy() for c in ("h", "salt"))
        left, right = salt == tile, salt == other
        for a, b in pairs_in_index(code[left], h[left], code[right], h[right], tile == other, slot // pieces % m, plan.width - shared, plan.probe, plan, piece=slot % pieces):
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.string()), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["kind", "h_a", "h_b"])

    return tiled.groupBy("kind", "slot", "part", "tile", "other_tile").applyInArrow(find, "kind string, h_a long, h_b long").distinct()


def similar_classes(vectors: DataFrame, similarity: float, plan: Plan | None = None, miss: float = 2.5e-4) -> DataFrame:
    """``kind``, ``h_a`` < ``h_b``, ``similarity`` of distinct vectors at least that similar, by multi-index hashing.

    vectors: as ``usable_vectors`` gives them. Only codes are shuffled; floats are read again for what was retrieved.
    """
    fits = fitted(vectors, similarity, miss, plan)
    if fits is None:
        return vectors.select("kind", F.col("h").alias("h_a"), F.col("h").alias("h_b"), F.lit(0.0).alias("similarity")).limit(0)
    plan, coders, rows = fits
    codes = _codes(vectors, plan, coders)
    at_once = max(1, ROUND_ROWS // plan.sent(max(rows.values())))
    codes = _kept(codes) if plan.split or at_once < plan.codes else codes
    # Each round holds the index rows of some codes only; what they find is kept, and their shuffle files go.
    rounds = [_kept(_found(codes.select("kind", "h", F.slice("codes", t + 1, at_once).alias("codes")), plan)) for t in range(0, plan.codes, at_once)]
    candidates = rounds[0] if len(rounds) == 1 else _kept(reduce(DataFrame.union, rounds).distinct())
    # Float vectors of candidates only: most vectors have none, so these tables are small.
    wanted = candidates.select("kind", F.explode(F.array("h_a", "h_b")).alias("h")).distinct()
    chosen = _kept(vectors.select("kind", "h", "v").join(wanted, ["kind", "h"], "left_semi").groupBy("kind", "h").agg(F.first("v").alias("v")))
    left, right = (chosen.select("kind", F.col("h").alias(f"h_{x}"), F.col("v").alias(f"v_{x}")) for x in "ab")
    return candidates.join(left, ["kind", "h_a"]).join(right, ["kind", "h_b"]).select("kind", "h_a", "h_b", cosine("v_a", "v_b").alias("similarity")).where(F.col("similarity") >= similarity - 1e-9)


def cosine(a: str, b: str):
    """Cosine of two arrays in double precision."""

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def similar_pairs(vectors: DataFrame, similarity: float = 0.9) -> DataFrame:
    """``kind``, ``id_a`` < ``id_b`` of different ids at least that similar.

    Null, short, non-finite and zero vectors have no pairs; repeated rows count once; exact copies under several
    ids are searched once, and expanded only here at the end, which the result's columns require.
    """
    found = similar_classes(vectors, similarity).select("kind", "h_a", "h_b")
    members = _kept(vectors.select("kind", "h", "id").distinct())
    a = members.select("kind", F.col("h").alias("h_a"), F.col("id").alias("a"))
    b = members.select("kind", F.col("h").alias("h_b"), F.col("id").alias("b"))
    across = found.join(a, ["kind", "h_a"]).join(b, ["kind", "h_b"]).select("kind", "a", "b")
    several = _kept(members.groupBy("kind", "h").count().where("count > 1").select("kind", "h"))
    copies = members.join(several, ["kind", "h"], "left_semi")
    within = copies.select("kind", "h", F.col("id").alias("a")).join(copies.select("kind", "h", F.col("id").alias("b")), ["kind", "h"]).where("a < b").select("kind", "a", "b")
    both = across.union(within)
    return both.select("kind", F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).where("id_a < id_b").distinct()


def _scan(queries: DataFrame, classes: DataFrame, k: int, most_rows: int = 400_000, least_rows: int = 10_000) -> DataFrame:
    """Exact ``k`` nearest classes of a stated set of queries: each block of queries meets all rows in turn.

    Rows stream past a block of queries in Arrow batches; only the best ``k`` of each query are kept. Blocks are
    as many as there are cores while they hold ``least_rows`` queries or more, and hold ``most_rows`` at most: every
    row is sent once for each block.
    """
    asked_rows = queries.count()
    block_rows = max(least_rows, min(most_rows, -(-asked_rows // queries.sparkSession.sparkContext.defaultParallelism)))
    blocks = max(1, -(-asked_rows // block_rows))
    asked = queries.select("kind", F.pmod("h", F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("role"), "h", "v")
    all_rows = classes.select("kind", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("role"), "h", "v")

    def search(batches):
        key, names, matrix, best, best_h, by_name = None, [], [], None, None, None

        def result():
            if best is None:
                return
            rows = np.repeat(np.arange(len(best)), k)
            keep = best_h.ravel() != 0
            yield pd.DataFrame({"kind": key[0], "h": names[rows[keep]], "neighbour": best_h.ravel()[keep], "similarity": best.ravel()[keep].astype(float)})

        for batch in batches:
            for (kind, block, role), part in batch.groupby(["kind", "block", "role"], sort=True):
                x = np.stack(part["v"].to_numpy()).astype(np.float32)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if (kind, block) != key:
                    yield from result()
                    key, names, matrix, best = (kind, block), [], [], None
                if role == 0:
                    names.append(part["h"].to_numpy())
                    matrix.append(x)
                    continue
                if not len(matrix):
                    continue
                if best is None:
                    names, matrix = np.concatenate(names), np.concatenate(matrix)
                    by_name = np.argsort(names, kind="stable")
                    best = np.full((len(names), k), -2, np.float32)
                    best_h = np.zeros((len(names), k), np.int64)
                h = part["h"].to_numpy()
                place = np.minimum(np.searchsorted(names, h, sorter=by_name), len(names) - 1)
                own_query, own_column = by_name[place], np.flatnonzero(names[by_name[place]] == h)
                own_query = own_query[own_column]
                for at in range(0, len(names), 1000):
                    score = matrix[at : at + 1000] @ x.T
                    mine = (own_query >= at) & (own_query < at + len(score))
                    score[own_query[mine] - at, own_column[mine]] = -3
                    now, now_h = best[at : at + 1000], best_h[at : at + 1000]
                    if score.shape[1] > k and now[0, 0] == -2:
                        c = np.argpartition(score, -k, axis=1)[:, -k:]
                        q = np.repeat(np.arange(len(score)), k)
                        c = c.ravel()
                    else:
                        q, c = np.nonzero(score > now.min(axis=1, keepdims=True))
                    if not len(q):
                        continue
                    # Best so far and what beats it, sorted by query, score and name; the first k of each query stay.
                    row = np.concatenate([np.repeat(np.arange(len(now)), k), q])
                    value, other = np.concatenate([now.ravel(), score[q, c]]), np.concatenate([now_h.ravel(), h[c]])
                    order = np.lexsort((other, -value, row))
                    start = np.searchsorted(row[order], np.arange(len(now)))
                    keep = order[(start[:, None] + np.arange(k)).ravel()]
                    best[at : at + 1000] = value[keep].reshape(-1, k)
                    best_h[at : at + 1000] = np.where(value[keep] > -2, other[keep], 0).reshape(-1, k)
        yield from result()

    rows = asked.union(all_rows).repartition(4 * blocks, "kind", "block").sortWithinPartitions("kind", "block", "role")
    return rows.mapInPandas(search, "kind string, h long, neighbour long, similarity double")


#: Similarities at which ``nearest`` looks for neighbours, one after the other.
LEVELS = (0.9, 0.8, 0.7, 0.6, 0.5)


def _pays(plan: Plan, rows: int, open_rows: int) -> bool:
    """Whether an index costs less than a quarter of comparing the open queries with all rows; both in costs of one comparison of codes."""
    return 4 * plan.cost(rows) <= 0.1 * open_rows


def nearest(vectors: DataFrame, k: int = 10, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """``kind``, ``id``, ``rank`` (from 1), ``neighbour``, ``similarity``: the ``k`` most similar other ids of every id.

    The radius grows from level to level: the indexes answer every query that has ``k`` neighbours at least as similar
    as the level, for no other row can be nearer; queries still open go to the next. A level is searched while its
    index costs less than comparing what is open. All other queries are stated in full against all rows, in
    blocks. Ties fall to the smaller id.
    """
    classes, members = classes_of(vectors)
    classes, members = cut(classes), cut(members)
    sizes = cut(members.groupBy("kind", "h").count())
    rows = classes.groupBy("kind").count().agg(F.max("count")).first()[0] or 0
    open_queries, parts = classes, []
    for n, level in enumerate(levels if rows else ()):
        if n:
            flips = math.acos(level) / math.pi
            if not _pays(Plan.of(rows, flips), rows, open_queries.count()):
                break
        hashed = cut(similar_classes(vectors, level))
        both = hashed.select("kind", F.col("h_a").alias("h"), F.col("h_b").alias("neighbour"), "similarity").union(hashed.select("kind", F.col("h_b"), F.col("h_a"), "similarity"))
        held = both.join(sizes.withColumnRenamed("h", "neighbour"), ["kind", "neighbour"]).groupBy("kind", "h").agg(F.sum("count").alias("near"))
        near = open_queries.select("kind", "h").join(sizes, ["kind", "h"]).join(held, ["kind", "h"], "left")
        answered = cut(near.where(F.coalesce("near", F.lit(0)) + F.col("count") - 1 >= k).select("kind", "h"))
        if not answered.isEmpty():
            parts.append(both.join(answered, ["kind", "h"], "left_semi"))
            open_queries = cut(open_queries.join(answered, ["kind", "h"], "left_anti"))
    all_near = classes.select("kind", "h", F.col("h").alias("neighbour"), F.lit(1.0).alias("similarity")).union(_scan(open_queries, classes, k))
    for part in parts:
        all_near = all_near.union(part)
    # The k + 1 smallest ids of a class are enough for any list of k; larger classes of copies lose nothing.
    first = members.withColumn("n", F.row_number().over(Window.partitionBy("kind", "h").orderBy("id"))).where(F.col("n") <= k + 1).drop("n")
    found = all_near.join(first.select("kind", F.col("h").alias("neighbour"), F.col("id").alias("other")), ["kind", "neighbour"])
    per_class = found.withColumn("n", F.row_number().over(Window.partitionBy("kind", "h").orderBy(F.desc("similarity"), "other"))).where(F.col("n") <= k + 1).drop("n")
    pairs = members.join(per_class, ["kind", "h"]).where("id <> other")
    rank = F.row_number().over(Window.partitionBy("kind", "id").orderBy(F.desc("similarity"), "other"))
    return pairs.select("kind", "id", rank.alias("rank"), F.col("other").alias("neighbour"), "similarity").where(F.col("rank") <= k)


def index_report(vectors: DataFrame, similarity: float = 0.9) -> DataFrame:
    """``kind``, ``vectors`` (estimated), ``codes``, ``substrings``, ``width``, ``probe``, ``radius``, ``found`` (share of planted pairs at ``similarity`` that are retrieved)."""
    schema = "kind string, vectors long, codes int, substrings int, width int, probe int, radius int, found double"
    fits = fitted(vectors, similarity)
    plan, coders, rows = fits or (None, {}, {})
    return vectors.sparkSession.createDataFrame([(k, rows[k], plan.codes, plan.substrings, plan.width, plan.probe, plan.radius, float(c.found)) for k, c in sorted(coders.items())], schema)
