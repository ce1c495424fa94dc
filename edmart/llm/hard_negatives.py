"""Hard negatives from embeddings by an inverted multi-index.

Two codebooks of ``CODES`` centroids, one for each half of the vector, are fitted on a bounded sample; a row's
two nearest centroids are its cell, and every row is indexed. Rows are dealt into blocks of neighbouring cells; a cell
of many rows is spread over several blocks. Each block meets the anchors, a bounded number at a time.

Inside a block, the score of any row of a cell is at most the sum of two half scores: the anchor's half times the
centroid, plus its length times the cell half's radius. A multi-sequence heap gives the cells in falling
order of this sum. Cells of one visit are scored exactly, and the search of an anchor stops when no cell left can
change its result: for the positives, when the bound is below the last of the best; for the negatives, when in every
window of scores the bound is below the last of the best or below the window. Cells that lie above all windows are
passed over. The best of all blocks are merged, so the result is exact whatever the codebooks are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edmart.llm.shared import stored

CODES = 16
SAMPLE = 4096  # rows that the codebooks are fitted on, those of the lowest id hash
ROUNDS = 8
BLOCK_ROWS = 8192
ANCHOR_ROWS = 4096
FIRST_VISIT = 256  # rows scored together at first; each further visit takes twice as many
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
LARGEST = 2.0**53


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers (in doubles): the floor of ``SCALE`` times the value."""
    return np.floor(vectors.astype(np.float64) * SCALE)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """List column as rows of ``width`` whole numbers; shorter vectors end in zeros."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = whole(column.flatten().to_numpy(zero_copy_only=False))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def halves(width: int) -> tuple[slice, slice]:
    return slice(0, (width + 1) // 2), slice((width + 1) // 2, width)


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centroids.T - (centroids**2).sum(axis=1) / 2, axis=1)


def codebook(points: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """Centroids by Lloyd's steps from evenly spaced points in the order of their first sums."""
    codes = max(1, min(codes, len(points)))
    order = np.lexsort((*points.T[::-1],)) if points.shape[1] else np.arange(len(points))
    centroids = points[order[np.linspace(0, len(points) - 1, codes).astype(int)]].astype(np.float64)
    for _ in range(rounds):
        own = nearest(points, centroids)
        for c in range(codes):
            if (own == c).any():
                centroids[c] = points[own == c].mean(axis=0)
    return centroids


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part; every seventh id has its label moved on."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", moved.cast("long").alias("label"), "embedding")


def indexed(rows: DataFrame, width: int, codes: int, sample: int) -> DataFrame:
    """(vec_id, label, embedding, uid, cell): every row with its cell, stored; ``uid`` tells repeated rows apart."""
    kept = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    points = matrix(kept.column("embedding"), width)
    books = [codebook(points[:, h], codes, ROUNDS) for h in halves(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(pa.chunked_array([batch.column("embedding")]), width)
            if len(points) and np.abs(points).max(initial=0) ** 2 * max(width, 1) >= LARGEST:
                raise ValueError("components are too large for exact scores")
            first, second = (nearest(points[:, h], b) for h, b in zip(halves(width), books))
            cells = pa.array((first * codes + second).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    cells = rows.mapInArrow(run, f"{fields}, cell int")
    return stored(cells.withColumn("uid", F.monotonically_increasing_id()), "vector-cells")


def block_of(rows: DataFrame, block_rows: int) -> tuple[Column, int]:
    """The block of a row: cells one after the other, each spread evenly over its stretch of blocks; their number."""
    # one count per cell: at most CODES * CODES
    counts = sorted((r["cell"], r["count"]) for r in rows.groupBy("cell").count().collect())
    spread = F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) / float(1 << 20)
    starts, at = [], 0
    for cell, n in counts:
        starts += [F.lit(cell), F.struct(F.lit(float(at)).alias("start"), F.lit(float(n)).alias("n"))]
        at += n
    place = F.element_at(F.create_map(*starts), F.col("cell"))
    blocks = max(1, -(-at // block_rows))
    return F.floor((place["start"] + spread * place["n"]) * blocks / at).cast("int"), blocks


class Block:
    """Rows of one block, sorted by cell, with centroids' stand-ins and radii of the halves that occur."""

    def __init__(self, table: pa.Table, width: int, codes: int):
        cells = table.column("cell").to_numpy()
        order = np.argsort(cells, kind="stable")
        self.points = matrix(table.column("embedding"), width)[order]
        self.ids, self.uids, self.labels = (table.column(c).to_numpy()[order] for c in ("vec_id", "uid", "label"))
        cells = cells[order]
        self.parts = halves(width)
        self.middles, self.radii, at = [], [], []
        for half, code in zip(self.parts, (cells // codes, cells % codes)):
            present, own = np.unique(code, return_inverse=True)
            points = self.points[:, half]
            # the mean of a block's own rows is the nearest stand-in for the codebook's centroid
            sums = np.zeros((len(present), points.shape[1]))
            np.add.at(sums, own, points)
            middle = sums / np.bincount(own)[:, None]
            far = np.zeros(len(present))
            np.maximum.at(far, own, np.sqrt(((points - middle[own]) ** 2).sum(axis=1)))
            self.middles.append(middle)
            self.radii.append(far)
            at.append(own)
        # start and end of every cell (first code, second code), empty ones included
        n1, n2 = len(self.radii[0]), len(self.radii[1])
        flat = at[0] * n2 + at[1]
        bounds = np.searchsorted(flat, np.arange(n1 * n2 + 1))
        self.starts, self.ends = bounds[:-1].reshape(n1, n2).tolist(), bounds[1:].reshape(n1, n2).tolist()

    def half_scores(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the largest and the smallest score of each code, a row per anchor."""
        out = []
        for half, middle, radius in zip(self.parts, self.middles, self.radii):
            own = anchors[:, half]
            mid, slack = own @ middle.T, np.sqrt((own**2).sum(axis=1))[:, None] * radius
            rounding = 1e-9 * (np.abs(mid) + slack) + 1e-6
            out.append((mid + slack + rounding, mid - slack - rounding))
        return out

    def cells(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, first code, second code) in falling order of the summed half scores: the multi-sequence heap."""
        a, b = np.argsort(-first), np.argsort(-second)
        x, y = first[a].tolist(), second[b].tolist()
        a, b = a.tolist(), b.tolist()
        heap = [(-(x[0] + y[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, a[i], b[j]
            # each pair is pushed by one neighbour only: along the row, and down from the row's first
            if j + 1 < len(y):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(x):
                heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))

    def visits(self, upper, lower, ceiling: float) -> Iterator[tuple[float, np.ndarray]]:
        """(bound, row numbers) of cells visited together; ``bound`` is that of all cells still to come.

        Cells all of whose scores lie above ``ceiling`` are passed over.
        """
        rows: list[range] = []
        n, wanted = 0, FIRST_VISIT
        for bound, i, j in self.cells(*upper):
            if n >= wanted:
                yield bound, np.concatenate([np.arange(r.start, r.stop) for r in rows])
                rows, n, wanted = [], 0, 2 * wanted
            start, end = self.starts[i][j], self.ends[i][j]
            if start < end and lower[0][i] + lower[1][j] <= ceiling:
                rows.append(range(start, end))
                n += end - start
        if rows:
            yield -np.inf, np.concatenate([np.arange(r.start, r.stop) for r in rows])

    def best(self, at: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` rows of the highest scores, ties by id and then row."""
        if len(at) > n:
            edge = np.partition(scores, len(scores) - n)[len(scores) - n]
            at, scores = at[scores >= edge], scores[scores >= edge]
        order = np.lexsort((self.uids[at], self.ids[at], -scores))[:n]
        return at[order], scores[order]

    def positives(self, anchor, label: int, uid: int, upper, lower, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``n`` best other rows of the anchor's label."""
        at, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        for bound, rows in self.visits(upper, lower, np.inf):
            rows = rows[(self.labels[rows] == label) & (self.uids[rows] != uid)]
            at, scores = self.best(np.append(at, rows), np.append(scores, self.points[rows] @ anchor), n)
            if len(at) == n and bound < scores[-1]:
                break
        return at, scores

    def negatives(self, anchor, label: int, windows: list[tuple[float, float]], upper, lower, n: int):
        """Per window (low, high) the rows and scores of the ``n`` best rows of other labels with such a score."""
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in windows]
        ceiling = max(high for _, high in windows)
        floor = min(low for low, _ in windows)
        for bound, rows in self.visits(upper, lower, ceiling):
            rows = rows[self.labels[rows] != label]
            scores = self.points[rows] @ anchor
            inside = (scores >= floor) & (scores <= ceiling)
            rows, scores = rows[inside], scores[inside]
            certified = True
            for k, (low, high) in enumerate(windows):
                fits = (scores >= low) & (scores <= high)
                if fits.any():
                    at, own = np.append(found[k][0], rows[fits]), np.append(found[k][1], scores[fits])
                    found[k] = self.best(at, own, n)
                own = found[k][1]
                certified &= bound < low or (len(own) == n and bound < own[-1])
            if certified:
                break
        return found


def window_of(score: int) -> tuple[int, int]:
    """The lowest and the highest negative score that a positive of this score allows (empty if low > high)."""
    return -(-LOW_PERCENT * score // 100), HIGH_PERCENT * score // 100


def met(rows: DataFrame, anchors: DataFrame, blocks: int, n_anchors: int):
    """Rows and anchors cogrouped: every block of rows with every lot of at most about ``ANCHOR_ROWS`` anchors."""
    lots = max(1, -(-n_anchors // ANCHOR_ROWS))
    lot = F.pmod(F.xxhash64("uid"), F.lit(lots)).cast("int")
    many = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    each = anchors.select(
        *[F.col(c).alias(c) for c in anchors.columns],  # columns of its own, as both sides come from one table
        lot.alias("lot"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    return each.groupBy("block", "lot").cogroup(many.groupBy("block", "lot"))


def ranked(found: DataFrame, by: list[str], score: str, row: str, n: int) -> DataFrame:
    """The best ``n`` of each anchor over all blocks, with their ``place``."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), f"{row}_id", f"{row}_uid")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def mine(
    vectors: DataFrame,
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    codes: int = CODES,
    block_rows: int = BLOCK_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, embedding).

    Rows with a NULL id, label or vector, or a NULL or non-finite component, take no part. Anchors are the ids
    divisible by ``every``; a shorter vector counts as ending in zeros. Repeated rows are rows of their own: a copy of
    an anchor is an anchor too and one of the other's positives. Ties go by id, then by the order read.
    Anchors without positives, and positives without negatives, have no rows; an empty table has none. Components so large that
    scores would not be exact fail the job. Other columns are not read.
    """
    rows = usable(vectors)
    width = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    spec = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if width is None:
        return vectors.sparkSession.createDataFrame([], spec)
    rows = indexed(rows, width, codes, sample)
    place, blocks = block_of(rows, block_rows)
    dealt = rows.withColumn("block", place)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    n_anchors = anchors.count()

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            block, points = Block(right, width, codes), matrix(left.column("embedding"), width)
            (u1, l1), (u2, l2) = block.half_scores(points)
            ids, uids, labels = (left.column(c).to_pylist() for c in ("vec_id", "uid", "label"))
            for k, anchor in enumerate(points):
                at, scores = block.positives(anchor, labels[k], uids[k], (u1[k], u2[k]), (l1[k], l2[k]), positives)
                own = zip(block.ids[at].tolist(), block.uids[at].tolist(), scores.astype(np.int64).tolist())
                out += [(ids[k], uids[k], *row) for row in own]
        names = ["anchor_id", "anchor_uid", "positive_id", "positive_uid", "positive_score"]
        return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(names)})

    found = met(dealt, anchors, blocks, n_anchors).applyInArrow(
        near, "anchor_id long, anchor_uid long, positive_id long, positive_uid long, positive_score long"
    )
    best = ranked(found, ["anchor_uid"], "positive_score", "positive", positives).drop("place")
    best = stored(best, "vector-positives")
    wanted = best.groupBy(F.col("anchor_uid").alias("uid")).agg(
        F.collect_list(F.struct("positive_id", "positive_uid", "positive_score")).alias("own")  # at most ``positives``
    )
    asked = anchors.join(wanted, "uid")

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            block, points = Block(right, width, codes), matrix(left.column("embedding"), width)
            (u1, l1), (u2, l2) = block.half_scores(points)
            ids, uids, labels, owns = (left.column(c).to_pylist() for c in ("vec_id", "uid", "label", "own"))
            for k, anchor in enumerate(points):
                own = [p for p in owns[k] if window_of(p["positive_score"])[0] <= window_of(p["positive_score"])[1]]
                if not own:
                    continue
                windows = [window_of(p["positive_score"]) for p in own]
                got = block.negatives(anchor, labels[k], windows, (u1[k], u2[k]), (l1[k], l2[k]), negatives)
                for p, (at, scores) in zip(own, got):
                    rows = zip(block.ids[at].tolist(), block.uids[at].tolist(), scores.astype(np.int64).tolist())
                    out += [(ids[k], uids[k], *p.values(), *row) for row in rows]
        names = [
            "anchor_id", "anchor_uid", "positive_id", "positive_uid", "positive_score",
            "negative_id", "negative_uid", "negative_score",
        ]
        return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(names)})

    found = met(dealt, asked, blocks, n_anchors).applyInArrow(
        hard,
        "anchor_id long, anchor_uid long, positive_id long, positive_uid long, positive_score long, "
        "negative_id long, negative_uid long, negative_score long",
    )
    best = ranked(found, ["anchor_uid", "positive_uid"], "negative_score", "negative", negatives)
    return best.select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
