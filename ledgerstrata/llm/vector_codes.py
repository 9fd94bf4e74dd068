"""Product codes of vectors, fitted exactly through metric trees (anchors hierarchy).

Every component x becomes the whole number floor(256 x); a vector is cut into ``PARTS``
equal parts, each with a codebook of ``ENTRIES`` entries. A round assigns every part to
its nearest entry (squared distance, ties to the lower index) and replaces each entry by
the floor of its parts' mean.

1. Tasks cut their rows into blocks of ``BLOCK_ROWS`` and build one tree per block and
   part, middle-out: about sqrt(n) anchors are spread over the points, each new one
   taking the points that are nearer to it; anchors are merged pair by pair into the
   balls above them, and split again by the same rule into the balls below. Every ball
   caches the sum and the number of its points. The blocks are stored once.
2. A round walks the trees from the top with the list of entries that may own a point
   of the ball. An entry leaves the list when the ball lies wholly on the other side of
   the plane between it and the entry nearest to the ball's pivot; children inherit what
   is left. A ball with one entry left is owned: its cached sum and number are added and
   its points are never looked at. Only points of small undecided balls are compared
   one by one.
3. Each task adds up one table of ``PARTS x ENTRIES`` sums; Spark sums those, and the new
   codebooks, of fixed size, go to every task. All arithmetic is in whole numbers, so
   any partitioning gives the same entries.

* Rows whose vector is NULL or empty or holds a NULL, NaN or infinite component are
  dropped, as are those whose length differs from that of the row with the least id.
* The first entries come from the rows with the least ids, NULL ids last; rows of one
  id are taken in the order of their vectors. With fewer rows there are fewer entries.
* Repeated rows and ids are rows of their own. Equal labels are summed, NULLs together.
* A length that ``PARTS`` does not divide, or a component of 2^24 or more after scaling,
  whose distances whole numbers of 64 bits might not hold, is an error.
* Other columns are not looked at. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ledgerstrata.llm.common import give_back, stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK_ROWS = 2048
LEAF = 24
LARGEST = 1 << 24


# --- one tree ------------------------------------------------------------------------


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every other, in whole numbers."""
    return (points**2).sum(1)[:, None] - 2 * points @ others.T + (others**2).sum(1)[None, :]


def _anchors(points: np.ndarray) -> np.ndarray:
    """Spread about sqrt(n) anchors over the points; which anchor owns each point."""
    n = len(points)
    owner = np.zeros(n, np.int64)
    pivots = [0]
    far = ((points - points[0]) ** 2).sum(1)
    for _ in range(1, int(np.ceil(np.sqrt(n)))):
        new = int(far.argmax())
        if far[new] == 0:
            break
        # A point less than half as far from its anchor as the new one is stays where it is.
        between = ((points[pivots] - points[new]) ** 2).sum(1)
        tried = np.flatnonzero(4 * far >= between[owner])
        distance = ((points[tried] - points[new]) ** 2).sum(1)
        nearer = distance < far[tried]
        owner[tried[nearer]] = len(pivots)
        far[tried[nearer]] = distance[nearer]
        pivots.append(new)
    return owner


class Tree:
    """Balls over the points of one part of a block.

    ``order`` lists the points so that every ball is a range ``low[i]:high[i]`` of it;
    ``left[i]`` and ``right[i]`` are its children, -1 at a leaf. ``pivot`` is the floor of
    the mean, ``reach`` the largest squared distance from it.
    """

    FIELDS = ("order", "low", "high", "left", "right", "pivot", "reach", "total")

    def __init__(self, points: np.ndarray):
        self.points = points
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.low, self.high, self.left, self.right = [], [], [], []
        self._grow(np.arange(len(points)))
        self.order = np.concatenate(self.parts)
        self.points = points[self.order]
        self.low, self.high, self.left, self.right = (
            np.array(x, np.int64) for x in (self.low, self.high, self.left, self.right)
        )
        running = np.r_[np.zeros((1, points.shape[1]), np.int64), np.cumsum(self.points, axis=0)]
        self.total = running[self.high] - running[self.low]
        self.pivot = self.total // (self.high - self.low)[:, None]
        self.reach = np.array(
            [((self.points[a:b] - p) ** 2).sum(1).max() for a, b, p in zip(self.low, self.high, self.pivot)]
        )

    def _node(self, low: int, high: int, left: int = -1, right: int = -1) -> int:
        for column, value in zip((self.low, self.high, self.left, self.right), (low, high, left, right)):
            column.append(value)
        return len(self.low) - 1

    def _leaf(self, rows: np.ndarray) -> int:
        self.parts.append(rows)
        self.size += len(rows)
        return self._node(self.size - len(rows), self.size)

    def _grow(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF:
            return self._leaf(rows)
        owner = _anchors(self.points[rows])
        groups = [rows[owner == i] for i in range(int(owner.max()) + 1)]
        groups = [group for group in groups if len(group)]
        if len(groups) == 1:
            return self._leaf(rows)
        return self._plant(self._merge(groups))

    def _merge(self, groups: list[np.ndarray]):
        """Join the two balls with the smallest ball around both until one is left."""
        n = len(groups)
        center = np.array([self.points[g].mean(0) for g in groups])
        reach = np.array([np.sqrt(((self.points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, center)])
        count = np.array([len(g) for g in groups], float)
        cost = np.sqrt(np.maximum(_distances(center, center), 0)) + reach[:, None] + reach[None, :]
        np.fill_diagonal(cost, np.inf)
        plants: list = list(groups)
        for _ in range(n - 1):
            a, b = divmod(int(cost.argmin()), n)
            a, b = min(a, b), max(a, b)
            weight = count[a] + count[b]
            middle = (center[a] * count[a] + center[b] * count[b]) / weight
            reach[a] = max(
                np.sqrt(((middle - center[i]) ** 2).sum()) + reach[i] for i in (a, b)
            )
            center[a], count[a] = middle, weight
            plants[a], plants[b] = (plants[a], plants[b]), None
            cost[b, :] = cost[:, b] = np.inf
            row = np.sqrt(((center - middle) ** 2).sum(1)) + reach + reach[a]
            live = np.isfinite(cost[a])
            cost[a, live] = cost[live, a] = row[live]
        return plants[0]

    def _plant(self, plan) -> int:
        """The nodes of a merged plan, whose leaves are groups to be split again."""
        if isinstance(plan, np.ndarray):
            return self._grow(plan)
        low = self.size
        left, right = self._plant(plan[0]), self._plant(plan[1])
        return self._node(low, self.size, left, right)

    # A tree as bytes: points and fields one after the other.

    def pack(self) -> bytes:
        arrays = [self.points, *(getattr(self, name) for name in self.FIELDS)]
        out = []
        for array in arrays:
            kind = next(k for k in ("<i2", "<i4", "<i8") if k == "<i8" or not array.size
                        or (np.iinfo(k).min <= array.min() and array.max() <= np.iinfo(k).max))
            head = np.array([array.shape[0], array.shape[1] if array.ndim > 1 else 0, int(kind[2])], "<i4")
            out += [head.tobytes(), np.ascontiguousarray(array).astype(kind).tobytes()]
        return b"".join(out)

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        tree = object.__new__(cls)
        at = 0
        for name in ("points", *cls.FIELDS):
            n, width, size = (int(x) for x in np.frombuffer(data, "<i4", 3, at))
            shape = (n, width) if width else (n,)
            values = np.frombuffer(data, f"<i{size}", n * (width or 1), at + 12)
            setattr(tree, name, values.astype(np.int64).reshape(shape))
            at += 12 + n * (width or 1) * size
        return tree

    # --- the walk ---

    def assign(self, entries: np.ndarray, owned=None) -> np.ndarray:
        """The nearest entry of every point, in the order of ``order``.

        ``owned(entry, total, count)`` is told the cached sums of balls with one owner,
        and of the points that were compared one by one.
        """
        owner = np.empty(len(self.points), np.int64)
        apart = _distances(entries, entries)
        # Of equal entries the first owns all.
        live = ~np.triu(apart == 0, 1).any(0)
        root = len(self.low) - 1
        nodes, lists = np.array([root]), live[None, :]
        never = np.iinfo(np.int64).max
        while len(nodes):
            distance = np.where(lists, _distances(self.pivot[nodes], entries), never)
            best = distance.argmin(1)
            gap = (distance - distance[np.arange(len(nodes)), best][:, None]).astype(float)
            bound = 2 * np.sqrt(self.reach[nodes][:, None].astype(float) * apart[best])
            # The margin covers the rounding of the root; the best entry has a gap of 0.
            lists = lists & ~(gap > bound * (1 + 1e-9))
            single = lists.sum(1) == 1
            for node, entry in zip(nodes[single].tolist(), best[single].tolist()):
                owner[self.low[node] : self.high[node]] = entry
            if owned is not None and single.any():
                done = nodes[single]
                owned(best[single], self.total[done], self.high[done] - self.low[done])
            leaf = ~single & (self.left[nodes] < 0)
            if leaf.any():
                sizes = (self.high - self.low)[nodes[leaf]]
                shift = np.repeat(self.low[nodes[leaf]] - (np.cumsum(sizes) - sizes), sizes)
                rows = shift + np.arange(len(shift))
                choice = np.where(np.repeat(lists[leaf], sizes, axis=0), _distances(self.points[rows], entries), never)
                owner[rows] = choice.argmin(1)
                if owned is not None:
                    owned(owner[rows], self.points[rows], np.ones(len(rows), np.int64))
            open_ = ~single & ~leaf
            nodes = np.concatenate([self.left[nodes[open_]], self.right[nodes[open_]]])
            lists = np.concatenate([lists[open_], lists[open_]])
        return owner


# --- on Spark ------------------------------------------------------------------------


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    out = np.floor(vectors.astype(np.float64) * scale)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError("a component is too large for exact distances")
    return out.astype(np.int64)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, vector, label)`` of the rows whose components are all finite numbers."""
    finite = F.forall(
        F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(label_col).alias("label"),
    ).where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)


def first_entries(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks ``[part, entry, position]`` from the rows with the least ids; None without rows."""
    least = F.col("vec_id").asc_nulls_last()
    seeds = rows.orderBy(least, "vector").limit(1).select("vector").collect()
    if not seeds:
        return None
    width = len(seeds[0][0])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    chosen = rows.where(F.size("vector") == width).orderBy(least, "vector").limit(entries)
    matrix = whole_numbers(np.array([row["vector"] for row in chosen.select("vector").collect()]))
    return matrix.reshape(len(matrix), parts, -1).swapaxes(0, 1).copy()


def tree_blocks(rows: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """One row per block: ids, labels, and a tree per part."""
    labels = rows.schema["label"].dataType
    schema = StructType(
        [
            StructField("ids", ArrayType(LongType())),
            StructField("labels", ArrayType(labels)),
            StructField("trees", ArrayType(BinaryType())),
        ]
    )

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [pa.list_(pa.int64()), pa.list_(to_arrow_type(labels)), pa.list_(pa.binary())]

        def block(held):
            table = pa.Table.from_batches(held)
            numbers = whole_numbers(table.column(1).combine_chunks().flatten().to_numpy().reshape(-1, width))
            cut = numbers.reshape(len(numbers), parts, -1)
            trees = [Tree(np.ascontiguousarray(cut[:, i])).pack() for i in range(parts)]
            row = [table.column(0).to_pylist(), table.column(2).to_pylist(), trees]
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds)], names=["ids", "labels", "trees"]
            )

        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK_ROWS - size)
                held.append(part)
                size += part.num_rows
                at += part.num_rows
                if size == BLOCK_ROWS:
                    yield block(held)
                    held, size = [], 0
        if size:
            yield block(held)
        give_back()

    return rows.where(F.size("vector") == width).mapInArrow(run, schema)


def entry_sums(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``(part, entry, n, total)`` of the parts that each entry owns."""
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches):
        import pyarrow as pa

        books = shared.value
        parts, entries, width = books.shape
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for i, tree in enumerate(trees.values):

                    def owned(entry, total, count, i=i):
                        np.add.at(sums[i], entry, total)
                        np.add.at(counts[i], entry, count)

                    Tree.unpack(tree.as_py()).assign(books[i], owned)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )
        give_back()

    partial = blocks.select("trees").mapInArrow(run, "part int, entry int, n long, total array<long>")
    width = codebooks.shape[2]
    totals = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
    return (
        partial.groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *totals)
        .select("part", "entry", "n", F.array(*[f"t{i}" for i in range(width)]).alias("total"))
    )


def fit_codebooks(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds``; entries that own nothing stay as they are.

    One row per part and entry reaches the driver.
    """
    books = first.copy()
    for _ in range(rounds):
        for row in entry_sums(blocks, books).collect():
            books[row["part"], row["entry"]] = np.array(row["total"], np.int64) // row["n"]
    return books


def encode(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``(vec_id, label, code, error)`` per row of the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)
    labels = blocks.schema["labels"].dataType.elementType
    schema = StructType(
        [
            StructField("vec_id", LongType()),
            StructField("label", labels),
            StructField("code", StringType()),
            StructField("error", LongType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        books = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids, label = (batch.column(i)[row].values for i in (0, 1))
                codes = np.empty((len(ids), len(books)), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for i, packed in enumerate(batch.column(2)[row].values):
                    tree = Tree.unpack(packed.as_py())
                    owner = tree.assign(books[i])
                    codes[tree.order, i] = owner
                    error[tree.order] += ((tree.points - books[i][owner]) ** 2).sum(1)
                text = codes.tobytes().hex()
                step = 2 * len(books)
                words = [text[at : at + step] for at in range(0, len(text), step)]
                yield pa.RecordBatch.from_arrays([ids, label, pa.array(words), pa.array(error)], names=schema.names)
        give_back()

    return blocks.mapInArrow(run, schema)


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    ``entries`` is at most 256, so that an index is one byte of the code.
    """
    rows = usable(vectors, id_col, vector_col, label_col)
    first = first_entries(rows, parts, entries)
    if first is None:
        books, coded = np.zeros((parts, 0, 0), np.int64), rows.select("vec_id", "label").limit(0)
        coded = coded.withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")})
    else:
        blocks = stored(tree_blocks(rows, parts * first.shape[2], parts), "vector-trees")
        books = fit_codebooks(blocks, first, rounds)
        coded = stored(encode(blocks, books), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["same"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The codes as SQL over ``embeddings``: every part against every entry of its codebook."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS (SELECT rid, part, arg_min(entry, struct_pack(d := d, e := entry)) AS entry, min(d) AS d FROM (
            SELECT rid, q.part, entry,
                list_dot_product(q.v, q.v) - 2 * list_dot_product(q.v, b.v) + list_dot_product(b.v, b.v) AS d
            FROM q JOIN b{i} b ON q.part = b.part) GROUP BY rid, part)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (SELECT part, entry, list(x ORDER BY j) AS v FROM (
            SELECT part, entry, j, floor(sum(x) / count(*)) AS x FROM (
                SELECT q.part, a{i}.entry, unnest(q.v) AS x, unnest(range(len(q.v))) AS j
                FROM q JOIN a{i} ON q.rid = a{i}.rid AND q.part = a{i}.part) GROUP BY part, entry, j)
            GROUP BY part, entry),
        b{i + 1} AS (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
            FROM b{i} b LEFT JOIN m{i} m ON b.part = m.part AND b.entry = m.entry)""")
    chain = ",".join(steps)
    return f"""
        WITH kept AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rid FROM (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x:
                x IS NOT NULL AND isfinite(x))) = len(embedding))),
        q AS (SELECT rid, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v
            FROM kept, (SELECT unnest(range({parts})) AS part)),
        b0 AS (SELECT part, rid - 1 AS entry, v FROM q WHERE rid <= {entries}),{chain},
        r AS (SELECT rid, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
            CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
        h AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, j)) AS books
            FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS j FROM b{rounds}))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            books AS codebooks_sha256
        FROM kept JOIN r USING (rid), h"""
