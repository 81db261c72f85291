"""Near duplicates of embeddings by an inverted multi-index.

Unit vectors are cut into halves, each with a codebook of its own; a pair of codewords is a cell of the product grid,
and every vector is filed in the cell of its nearest codewords. The value of a cell is the squared distance of the
query from the planes halfway between its own nearest codewords and those of the cell,

    ((d1(i)^2 - d1min^2) / (2 |c1(i) - c1min|))^2 + ((d2(j)^2 - d2min^2) / (2 |c2(j) - c2min|))^2

Multi-sequence traversal takes a query's cells in rising order of value, up to the value at which the target recall is
reached, and every vector of these cells is verified by its cosine in doubles. The value is fitted on ``TRIAL`` sampled
vectors: on planted copies of them, turned in random directions until their cosine is the least that links, and on the
links that the sample has in all rows; the larger of the two values counts, so it needs no links in the sample. Links
above the least cosine are nearer and found more often. A vector within squared distance ``e`` lies in a cell with a
value of at most ``e``, so a target of 1 takes the bound ``2 - 2 * cosine`` and loses no link. There is no list of
candidates with a fixed length.

Fitted on bounded samples, chosen by a hash of the id: codebooks on ``SAMPLE`` vectors, the last value on ``TRIAL``
vectors. Everything else covers all rows. Equal vectors are filed once and counted with their number.

Codewords are numbered along a tree that halves them by their main direction, and the occupied part of the grid is cut
into boxes of about ``BLOCK`` filed vectors. A query goes once to each box with a visited cell, so the copies of a query
follow the geometry around it. A crowded cell is spread over many tasks, ``PART`` filed vectors by ``PART`` queries. A
task reports a number of links for each query and a spanning forest of its links, never its pairs.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components link with nothing.
Rows with a null id link with nothing and get a null component. Rows that repeat an id share its links.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored
from shelfspark.llm.graph import connected_components

COSINE = 0.95
SAMPLE, TRIAL = 20_000, 2048
#: Share of the links at exactly the least cosine that the traversal is to find; of nearer ones it finds more.
TARGET_RECALL = 0.99
#: Planted copies of each vector of the trial.
COPIES = 16
#: Filed vectors of a block; filed vectors and queries of a task; queries of it that are compared at a time.
BLOCK, PART, CHUNK = 1024, 4096, 1024
MAX_CODEWORDS = 1024
_STEPS = 64
#: Added to the bound for rounding; codewords closer than ``_CLOSE`` take the bound of the triangle inequality.
_SLACK, _CLOSE = 1e-6, 1e-4


def unit_rows(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def distances(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] - 2 * x @ codebook.T + (codebook * codebook).sum(1)
    return np.sqrt(np.maximum(square, 0))


def fit_codebook(x: np.ndarray, size: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """k-means; a codeword without vectors moves to the vector farthest from its own."""
    rng = np.random.default_rng(seed)
    words = x[rng.permutation(len(x))[:size]].copy()
    for _ in range(rounds):
        d = distances(x, words)
        near = d.argmin(1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(words))
        words[n > 0] = sums[n > 0] / n[n > 0, None]
        far = np.argsort(-d[np.arange(len(x)), near])
        words[n == 0] = x[far[: int((n == 0).sum())]]
    return words


def along_tree(words: np.ndarray) -> np.ndarray:
    """An order of codewords in which neighbours are near: halved by their main direction, again and again."""
    out, stack = [], [np.arange(len(words))]
    while stack:
        some = stack.pop()
        if len(some) < 2:
            out.extend(some)
            continue
        x = words[some] - words[some].mean(0)
        some = some[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
        stack += [some[len(some) // 2 :], some[: len(some) // 2]]
    return words[np.array(out, int)]


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.half = first.shape[1]

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector, the share of every codeword of the two halves in a cell's value."""
        out = []
        for part, book in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True):
            d = distances(part, book)
            least, gap = d.min(1, keepdims=True), distances(book, book)[d.argmin(1)]
            # (d - least) (d + least) / 2 gap; d + least is at least the gap.
            wide = np.where(gap > _CLOSE, (d + least) / np.maximum(gap, _CLOSE), 1)
            out.append(((d - least) / 2 * np.maximum(wide, 1)) ** 2)
        return out[0], out[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = distances(x[:, : self.half], self.books[0]), distances(x[:, self.half :], self.books[1])
        return first.argmin(1) * len(self.books[1]) + second.argmin(1)

    def traverse(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int]]:
        """Multi-sequence traversal: all cells in rising order of value, for the costs of one query."""
        one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = first[one].tolist(), second[two].tolist()
        n = len(self.books[1])
        heap, done = [(a[0] + b[0], 0, 0)], [0] * len(a)  # done[i]: cells of row i that were visited
        while heap:
            value, i, j = heapq.heappop(heap)
            done[i] = j + 1
            yield value, int(one[i]) * n + int(two[j])
            # A cell is ripe when its neighbours before it in both orders were visited.
            if i + 1 < len(a) and done[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))

    def visited(self, first: np.ndarray, second: np.ndarray, limit: float) -> list[int]:
        """The cells of a traversal that ends at ``limit``, nearest first."""
        out = []
        for value, cell in self.traverse(first, second):
            if value > limit:
                break
            out.append(cell)
        return out


def _sample(vectors: DataFrame, n: int) -> pd.DataFrame:
    return vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).toPandas()


def fit_index(vectors: DataFrame, n_rows: int, dims: int, sample: int = SAMPLE) -> MultiIndex:
    """About 16 vectors a cell, as far as ``MAX_CODEWORDS`` allow."""
    x = unit_rows(_sample(vectors, sample)["embedding"])
    size = int(np.clip(round((n_rows / 16) ** 0.5), 1, min(MAX_CODEWORDS, len(x))))
    half = max(1, dims // 2)
    first, second = fit_codebook(x[:, :half], size), fit_codebook(x[:, half:], size, seed=2)
    return MultiIndex(along_tree(first), along_tree(second))


def planted_values(index: MultiIndex, x: np.ndarray, cosine: float, copies: int = COPIES, seed: int = 3) -> np.ndarray:
    """Of copies of ``x`` at exactly ``cosine``, in random directions: the values of their cells, rising."""
    rng, out = np.random.default_rng(seed), []
    first, second = index.costs(x)
    for _ in range(copies):
        turn = rng.normal(size=x.shape)
        turn -= (turn * x).sum(1, keepdims=True) * x
        length = np.linalg.norm(turn, axis=1, keepdims=True)
        y = cosine * x + (1 - cosine**2) ** 0.5 * turn / np.where(length > 0, length, 1)
        i, j = np.divmod(index.cells(y), len(index.books[1]))
        out.append(first[np.arange(len(x)), i] + second[np.arange(len(x)), j])
    return np.sort(np.concatenate(out))


def fit_limit(vectors: DataFrame, index: MultiIndex, cosine: float, target: float, trial: int = TRIAL) -> float:
    """The value up to which cells are visited: the bound, or below a target of 1 the value within which the recall of
    planted copies, and the mean recall of sampled queries that have links against all other rows, reach ``target``."""
    full = 2 - 2 * cosine + _SLACK
    if target >= 1:
        return full
    spark = vectors.sparkSession
    sample = _sample(vectors, trial)
    queries, ids = unit_rows(sample["embedding"]), sample["vec_id"].to_numpy(np.int64)
    first, second = index.costs(queries)
    shared = spark.sparkContext.broadcast((index, queries, ids, first, second))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, queries, ids, first, second = shared.value
        n = np.zeros((len(queries), _STEPS + 1), np.int64)
        for batch in batches:
            x = unit_rows(batch["embedding"].to_pylist())
            if not len(x):
                continue
            cells = index.cells(x)
            i, j = np.divmod(cells, len(index.books[1]))
            others = ids[:, None] != batch["vec_id"].to_numpy()[None, :]
            q, y = np.nonzero((queries @ x.T >= cosine) & others)
            value = first[q, i[y]] + second[q, j[y]]
            np.add.at(n, (q, np.minimum(np.ceil(value / full * _STEPS), _STEPS).astype(int)), 1)
        q, step = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(step), pa.array(n[q, step])], ["q", "step", "n"])

    rows = (
        vectors.select("vec_id", "embedding")
        .mapInArrow(count, "q long, step long, n long")
        .groupBy("q", "step")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most TRIAL * (_STEPS + 1) rows
    )
    n = np.zeros((len(queries), _STEPS + 1))
    n[rows["q"].to_numpy(int), rows["step"].to_numpy(int)] = rows["n"]
    n = n[n.any(1)]
    values = planted_values(index, queries, cosine)
    limit = values[min(len(values) - 1, int(np.ceil(target * len(values))))]
    if len(n):
        recall = (n.cumsum(1) / n.sum(1, keepdims=True)).mean(0)
        limit = max(limit, np.flatnonzero(recall >= target)[0] / _STEPS * full)
    return float(min(limit, full))


def filed(vectors: DataFrame, index: MultiIndex) -> DataFrame:
    """Adds ``cell int`` to ``vec_id, copies, embedding``."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("int")
    def cell(embedding: pd.Series) -> pd.Series:
        return pd.Series(shared.value.cells(unit_rows(embedding)) if len(embedding) else [], dtype="int32")

    return vectors.withColumn("cell", cell("embedding"))


def blocks_of(cells: np.ndarray, counts: np.ndarray, size: int, shape: tuple[int, int]) -> np.ndarray:
    """For each cell of the grid its block, -1 if it is empty. The occupied cells are halved by number of vectors along
    the side of the grid on which they spread further, until a box holds at most ``size`` vectors or one cell."""
    out, block, stack = np.full(shape[0] * shape[1], -1, np.int32), 0, [np.arange(len(cells))]
    sides = np.divmod(cells, shape[1])
    while stack:
        box = stack.pop()
        if counts[box].sum() <= size or len(box) == 1:
            out[cells[box]] = block
            block += len(box) > 0
            continue
        side = sides[int(np.argmax([np.ptp(sides[k][box]) / shape[k] for k in (0, 1)]))][box]
        rising = np.argsort(side, kind="stable")
        ends = np.flatnonzero(np.diff(side[rising]))
        held = counts[box[rising]].cumsum()
        at = ends[np.abs(held[ends] - held[-1] / 2).argmin()] + 1
        stack += [box[rising[at:]], box[rising[:at]]]
    return out


def visits(vectors: DataFrame, index: MultiIndex, limit: float, block_of: np.ndarray) -> DataFrame:
    """``vec_id, embedding, block``: a row for each block with a cell that a query visits."""
    shared = vectors.sparkSession.sparkContext.broadcast((index, block_of))

    @F.pandas_udf("array<int>")
    def blocks(embedding: pd.Series) -> pd.Series:
        index, block_of = shared.value
        out, seen = [], np.zeros(block_of.max() + 2, bool)  # the last one stands for empty cells
        for at in range(0, len(embedding), CHUNK):
            first, second = index.costs(unit_rows(embedding[at : at + CHUNK]))
            for a, b in zip(first, second, strict=True):
                seen[:] = False
                seen[block_of[index.visited(a, b, limit)]] = True
                out.append(np.flatnonzero(seen[:-1]).astype(np.int32))
        return pd.Series(out, dtype=object)

    return vectors.select("vec_id", "embedding", F.explode(blocks("embedding")).alias("block"))


def _forest(link: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id that each row and column of a link matrix reaches."""
    top = np.iinfo(np.int64).max
    rows, columns = rows.copy(), columns.copy()
    some_r, some_c = np.flatnonzero(link.any(1)), np.flatnonzero(link.any(0))
    link = link[np.ix_(some_r, some_c)]
    while link.size:
        r = np.minimum(rows[some_r], np.where(link, columns[some_c][None, :], top).min(1))
        c = np.minimum(columns[some_c], np.where(link, r[:, None], top).min(0))
        same = (r == rows[some_r]).all() and (c == columns[some_c]).all()
        rows[some_r], columns[some_c] = r, c
        if same:
            break
    return rows, columns


def block_links(members: DataFrame, queries: DataFrame, cosine: float) -> DataFrame:
    """``vec_id, n_links, least``: for each block and vector in it, links to others and the least id reached."""
    m_parts = members.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("ms"))
    q_parts = queries.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("qs"))
    parts = m_parts.join(q_parts, "block")
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    seats = (
        members.join(parts, "block")
        .select("block", mine("ms").alias("m"), every("qs").alias("q"), "vec_id", "copies", "embedding")
        .withColumn("query", F.lit(False))
        .unionByName(
            queries.join(parts, "block")
            .select("block", every("ms").alias("m"), mine("qs").alias("q"), "vec_id", "embedding")
            .withColumn("copies", F.lit(0).cast("long"))
            .withColumn("query", F.lit(True))
        )
    )

    def compare(key, block: pd.DataFrame) -> pd.DataFrame:
        asks = block["query"].to_numpy(bool)
        ids, copies = block["vec_id"].to_numpy(np.int64), block["copies"].to_numpy(np.int64)[~asks]
        empty = pd.DataFrame({"vec_id": [], "n_links": [], "least": []}, dtype="int64")
        if asks.all() or not asks.any():
            return empty
        x = unit_rows(block["embedding"])
        out, queries = [empty], np.flatnonzero(asks)
        for at in range(0, len(queries), CHUNK):
            some = queries[at : at + CHUNK]
            link = (x[some] @ x[~asks].T >= cosine) & (ids[some][:, None] != ids[~asks][None, :])
            linked = link.any(1)
            if not linked.any():
                continue
            rows, columns = _forest(link, ids[some], ids[~asks])
            moved = columns != ids[~asks]
            out.append(
                pd.DataFrame(
                    {
                        "vec_id": np.concatenate((ids[some][linked], ids[~asks][moved])),
                        "n_links": np.concatenate((link[linked] @ copies, np.zeros(int(moved.sum()), np.int64))),
                        "least": np.concatenate((rows[linked], columns[moved])),
                    }
                )
            )
        return pd.concat(out)

    return seats.groupBy("block", "m", "q").applyInPandas(compare, "vec_id long, n_links long, least long")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    cosine: float = COSINE,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links long, component_id long, kept boolean``."""
    spark = vectors.sparkSession
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    sound = (
        F.col("vec_id").isNotNull()
        & ~F.exists("embedding", odd)
        & F.exists("embedding", lambda v: v != 0)
    )
    lengths = named.where(sound).groupBy(F.size("embedding").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), "dims").first()
    alone = named.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if most is None:
        return alone.withColumn("kept", F.lit(True))
    sound = sound & (F.size("embedding") == most["dims"])
    rows = named.where(sound)
    distinct = stored(
        spark, rows.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "vectors"
    )
    index = fit_index(distinct, most["count"], most["dims"])
    limit = fit_limit(distinct, index, cosine, target_recall)
    members = stored(spark, filed(distinct, index), "filed")
    counts = members.groupBy("cell").count().toPandas()  # at most MAX_CODEWORDS**2 rows
    shape = len(index.books[0]), len(index.books[1])
    block_of = blocks_of(counts["cell"].to_numpy(int), counts["count"].to_numpy(int), BLOCK, shape)
    shared = spark.sparkContext.broadcast(block_of)

    @F.pandas_udf("int")
    def block(cell: pd.Series) -> pd.Series:
        return pd.Series(shared.value[cell.to_numpy(int)])

    members = members.withColumn("block", block("cell")).drop("cell")
    queries = visits(distinct.drop("copies"), index, limit, block_of)
    found = stored(spark, block_links(members, stored(spark, queries, "visits"), cosine), "block-links")
    reach = connected_components(found.where("vec_id <> least"), "vec_id", "least")
    links = found.groupBy("vec_id").agg(F.sum("n_links").alias("n"))
    summary = (
        distinct.select("embedding", "copies", "vec_id")
        .join(links, "vec_id", "left")
        .join(reach.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
    )
    linked = rows.join(summary, "embedding").select("vec_id", "n_links", "component_id")
    rest = named.where(~F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.unionByName(rest)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
