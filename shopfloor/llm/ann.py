"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs after learned rotations (iterative
quantisation on a bounded sample). A code is cut into substrings; each is an
index of its own, a directory from substring values to rows. By the pigeonhole
principle a code within Hamming radius r of a query lies within r_j of it on
some substring j if the r_j + 1 add up to r + 1; probing the directories
therefore finds every code within r. Those are ranked by the exact inner
product of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

NEIGHBOURS = 20

#: Vectors that rotations are fitted on, and queries whose true neighbours set
#: the radius; both are bounds of fitting only, every vector is indexed.
FIT_ROWS = 8192
TUNE_QUERIES = 64

#: Rotations; each gives as many bits as the vectors have dimensions.
ROTATIONS = 2
ITERATIONS = 30

#: Share of the tuning queries' neighbours that the radius must reach.
REACH = 0.97

SUBSTRING_BITS = 16

#: Queries that one broadcast block holds, and rows that one index holds.
QUERY_ROWS = 8192
INDEX_ROWS = 8192

#: Cells of the query-by-bucket tables that one step works on.
CELLS = 1 << 21


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): rows that take part. Null ids, null, empty or zero
    vectors and those with null, NaN or infinite components do not."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id is not null and vector is not null").where(fine & F.exists("vector", lambda x: x != 0.0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _lifted(x: np.ndarray, radius: float) -> np.ndarray:
    """One more dimension makes all rows equally long, so that the largest
    inner product with a query is the smallest angle."""
    rest = np.sqrt(np.maximum(radius**2 - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def learn(sample: np.ndarray, seed: int = 1) -> np.ndarray:
    """Rotations by iterative quantisation: alternate between the nearest sign
    matrix and the rotation that best maps the sample onto it."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    turns = []
    for _ in range(ROTATIONS):
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(ITERATIONS if len(sample) >= width else 0):
            signs = np.where(sample @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(sample.T @ signs)
            turn = left @ right
        turns.append(turn)
    return np.concatenate(turns, axis=1)


def encode(lifted: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Codes as 16-bit substrings, (rows, substrings)."""
    bits = lifted @ turns >= 0
    pad = -bits.shape[1] % SUBSTRING_BITS
    bits = np.concatenate([bits, np.zeros((len(bits), pad), dtype=bool)], axis=1)
    return np.packbits(bits, axis=1).view(np.uint16)


def radii(radius: int, substrings: int) -> list[int]:
    """Substring radii r_j with the sum of r_j + 1 equal to radius + 1; -1 asks nothing."""
    share, more = divmod(radius + 1, substrings)
    return [share - (j >= more) for j in range(substrings)]


class Index:
    """One shard: a directory per substring over its rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.codes = ids[order], vectors[order], codes[order]
        self.tables = []
        for j in range(codes.shape[1]):
            values, slot = np.unique(self.codes[:, j], return_inverse=True)
            self.tables.append((values, slot))

    def candidates(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows within ``radius`` of each query code, as a (queries, rows) mask."""
        found = np.zeros((len(code), len(self.ids)), dtype=bool)
        for (values, slot), reach, j in zip(self.tables, radii(radius, len(self.tables)), range(len(self.tables))):
            if reach >= 0:
                probed = np.bitwise_count(code[:, j, None] ^ values[None, :]) <= reach
                found |= probed[:, slot]
        at, row = np.nonzero(found)
        far = np.zeros(len(at), dtype=np.int64)
        for j in range(len(self.tables)):
            far += np.bitwise_count(code[at, j] ^ self.codes[row, j])
        found[at[far > radius], row[far > radius]] = False
        return found

    def search(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, radius: int, k: int):
        """(query id, row id, inner product) of each query's best k here."""
        step = max(1, CELLS // max(len(self.ids), 1))
        for lo in range(0, len(ids), step):
            part = slice(lo, lo + step)
            found = self.candidates(codes[part], radius)
            found &= ids[part][:, None] != self.ids[None, :]
            at, row = np.nonzero(found)
            products = np.zeros(len(at))
            for d in range(vectors.shape[1]):  # one order of summation everywhere: equal vectors tie exactly
                products += vectors[part][at, d] * self.vectors[row, d]
            order = np.lexsort((self.ids[row], -products, at))
            at, row, products = at[order], row[order], products[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            best = place < k
            yield ids[part][at[best]], self.ids[row[best]], products[best]


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = rows.toArrow()
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return ids, np.asarray(flat.flatten(), dtype=np.float64).reshape(len(ids), -1)


def _exact(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int) -> DataFrame:
    """True neighbours of a few queries: (query_id, vector) by brute force."""
    held = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = _matrix(batch.column(1), q.shape[1]), batch.column(0).to_numpy()
            near = np.where(q_ids[:, None] == own[None, :], -np.inf, q @ x.T)
            top = np.argsort(-near, axis=1, kind="stable")[:, :k]
            at = np.repeat(np.arange(len(q_ids)), top.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(near[at, top.ravel()]), batch.column(1).take(pa.array(top.ravel()))], ["query", "score", "vector"])

    near = rows.mapInArrow(run, "query long, score double, vector array<double>")
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).where("score > double('-infinity')")


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a
    function of the id column) holds, the k rows of largest inner product that
    were found, ties to the smaller id; the row itself is left out.

    Rows that can't take part are dropped (see :func:`usable`). An inner
    product needs vectors of one length: rows are searched among those of their
    length, each length by itself. Of rows with one id and length the first by
    vector counts. Every usable row is indexed. If a query finds fewer than k
    rows within the radius, its block is searched again with twice the radius,
    until all rows are in reach. Other columns are not read.
    """
    spark = vectors.sparkSession
    width = F.size("vector")
    rows = usable(vectors, id_col, vector_col).groupBy("vec_id", width.alias("width")).agg(F.min("vector").alias("vector"))
    rows = materialize(rows, "vectors")
    asked = rows.where(is_query(F.col("vec_id"))).select("width").distinct()
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for length in sorted(r["width"] for r in asked.collect()):
        found = found.unionAll(_search_length(rows.where(F.col("width") == length).select("vec_id", "vector"), is_query, k))
    return found


def _search_length(rows: DataFrame, is_query, k: int) -> DataFrame:
    """The search among vectors of one length."""
    spark = rows.sparkSession
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    facts = rows.agg(F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm"), F.count("*").alias("n")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    width, longest, n = facts["width"], facts["norm"], facts["n"]
    queries = rows.where(is_query(F.col("vec_id")))

    def share(of: DataFrame, total: int, want: int) -> DataFrame:
        part = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 20))
        return of.where(part < int((1 << 20) * min(1.0, want / max(total, 1))))

    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], schema)
    turns = learn(_lifted(_collected(share(rows, n, FIT_ROWS))[1].reshape(-1, width), longest))
    tune_ids, tune = _collected(share(queries, n_queries, TUNE_QUERIES))
    if not len(tune_ids):
        tune_ids, tune = _collected(queries.limit(TUNE_QUERIES))
    bits = turns.shape[1] + -turns.shape[1] % SUBSTRING_BITS

    def codes_of(x: np.ndarray, lift: bool) -> np.ndarray:
        lifted = _lifted(x, longest) if lift else np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        return encode(lifted, turns)

    true = _exact(rows, tune_ids, tune, k).select("query", "vector").toArrow()
    radius = bits
    if true.num_rows:
        near = np.asarray(pa.concat_arrays(true.column("vector").chunks).flatten(), dtype=np.float64).reshape(-1, width)
        far = np.bitwise_count(codes_of(tune, False)[true.column("query").to_numpy()] ^ codes_of(near, True)).sum(axis=1)
        radius = int(np.quantile(far, REACH, method="higher"))

    found = None
    blocks = -(-n_queries // QUERY_ROWS)
    block_of = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks))
    # Shards are what one index holds at a time; there are as many as it takes.
    shards = -(-n // INDEX_ROWS)
    index = rows if shards == 1 else rows.repartition(shards, "vec_id")
    for block in range(blocks):
        left_ids, left = _collected(queries.where(block_of == block))
        reach = radius
        while len(left_ids):
            part = materialize(_probe(index, left_ids, left, codes_of(left, False), turns, longest, reach, k), "near")
            best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            part = part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            full = np.zeros(0, dtype=np.int64)
            if reach < bits:
                enough = part.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1)).select("query_id")
                full = enough.toArrow().column(0).to_numpy()
                part = part.join(F.broadcast(enough), "query_id", "left_semi") if len(full) < len(left_ids) else part
            found = part if found is None else found.unionAll(part)
            more = ~np.isin(left_ids, full) if reach < bits else np.zeros(len(left_ids), dtype=bool)
            left_ids, left, reach = left_ids[more], left[more], min(2 * reach + 1, bits)
    return found.select("query_id", "rank", "vec_id", "score")


def _probe(index: DataFrame, ids, queries, codes, turns, longest: float, radius: int, k: int) -> DataFrame:
    held = index.sparkSession.sparkContext.broadcast((ids, queries, codes, turns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, q_codes, turn = held.value
        for part in _shards(batches):
            x, own = _matrix(part.column(1), q.shape[1]), part.column(0).to_numpy()
            shard = Index(own, x, encode(_lifted(x, longest), turn))
            for a, b, s in shard.search(q_ids, q, q_codes, radius, k):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s)], ["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, INDEX_ROWS):
            held.append(batch.slice(lo, INDEX_ROWS))
            if sum(b.num_rows for b in held) >= INDEX_ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=1 << 30)[0]
                held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=1 << 30)[0]


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0)
