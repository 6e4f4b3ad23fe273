"""Vector code compression: one codebook per part position, by member-resident Lloyd rounds.

The parts of all vectors live in blocks owned by ``(position, entry, salt)``. In
every round an owner compares its members with its position's codebook. Members
that stay remain in the owner's block, which is read and written without a shuffle;
those that change entry go to blocks of their own, and the next round's shuffle
takes only these to their new owners. Every block carries the count and the sums of
its members, so that the next codebook is a small aggregate over blocks. Of the
rounds, the driver sees codebooks alone: positions x entries x components numbers.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, materialise, release, slices

BLOCK = "pos int, entry int, salt int, n long, sums array<long>, members binary, moved boolean"
LIMIT = 1 << 27         # of a component's integer: squared distances of whole vectors stay below 2^62


@dataclass(frozen=True)
class Codebooks:
    """``books[position][entry]``: integer components; ``dims``: of a whole vector."""
    books: tuple[tuple[tuple[int, ...], ...], ...]
    dims: int
    scale: int

    def sha256(self) -> str:
        """Of all components in decimal by position, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for e in b for x in e).encode()).hexdigest()


def _integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Vectors as rows of integers ``floor(scale * x)``."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(flat) and np.abs(flat).max() > LIMIT:
        raise ValueError(f"a component beyond {LIMIT // scale} has no exact squared distance in 64 bits")
    return flat.astype(np.int64).reshape(len(column), dims)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (ties: the lower index) and its squared distance."""
    best, least = np.zeros(len(parts), np.int32), None
    for j, entry in enumerate(book):
        d = np.square(parts - entry).sum(axis=1)
        if least is None:
            least = d
        else:
            closer = d < least
            best[closer] = j
            least = np.where(closer, d, least)
    return best, least


def _blocks(rows: list[tuple[int, int, int, np.ndarray, bool]]) -> pa.RecordBatch:
    """One record for each (position, entry, salt, members, moved)."""
    pos, entry, salt, members, moved = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(pos, pa.int32()), pa.array(entry, pa.int32()), pa.array(salt, pa.int32()), pa.array([len(m) for m in members], pa.int64()),
         pa.array([m.sum(axis=0, dtype=np.int64).tolist() for m in members], pa.list_(pa.int64())),
         pa.array([m.astype("<i4").tobytes() for m in members], pa.binary()), pa.array(moved, pa.bool_())],
        names=["pos", "entry", "salt", "n", "sums", "members", "moved"])


def _split(parts: np.ndarray, entries: np.ndarray):
    """``(entry, its parts)`` for each entry that has any."""
    order = np.argsort(entries, kind="stable")
    cuts = np.flatnonzero(np.diff(entries[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(entries[own[0]]), parts[own]


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, vector`` of the rows whose vector is not NULL and has finite, non-NULL components only."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
            .filter(F.coalesce(finite, F.lit(False))))


def fit_codebooks(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
                  id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  block_rows: int = 1 << 16, owner_rows: int = 1 << 20) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds of assigning all parts and moving each entry to
    the floor of its members' mean; None if no row is kept.

    Entries start as the parts of the kept rows with the ``entries`` smallest ids, in order
    (fewer rows: fewer entries; NULL ids last; of repeated ids, the smaller vector first).
    An entry without members stays. Vectors have the commonest length divisible by
    ``parts`` (ties: the longer); rows of any other length, empty vectors too, are
    dropped. Equal vectors all count. Components beyond 2^27 / ``scale`` raise.

    A block holds ``block_rows`` members at most. The salt spreads an entry over one owner
    for each ``owner_rows`` vectors of the table, so that one that has most of them is no
    larger a task than the others.
    """
    if not (parts >= 1 and 1 <= entries <= 256 and rounds >= 0):
        raise ValueError("at least one part, 1 to 256 entries")
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    lengths = kept.groupBy(F.size("vector").alias("dims")).count().filter(f"dims > 0 and dims % {parts} = 0")
    common = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return None
    dims, total, width = common["dims"], common["count"], common["dims"] // parts
    kept = kept.filter(F.size("vector") == dims)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    start = _integers(pa.array([r[0] for r in first], pa.list_(pa.float64())), dims, scale)
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2)
    salts = max(1, -(-total // owner_rows))

    def deal(books):
        """From vectors to blocks of parts by entry, all of them on the move."""
        def run(batches):
            from pyspark import TaskContext
            task, made = TaskContext.get().partitionId(), 0
            held, n = [], 0
            for b in slices(batches, 4096):
                held.append(_integers(b.column(0), dims, scale).reshape(b.num_rows, parts, width))
                n += b.num_rows
                if n >= block_rows:
                    yield flush(np.concatenate(held), task + made)
                    held, n, made = [], 0, made + 1
            if n:
                yield flush(np.concatenate(held), task + made)

        def flush(rows, at):
            return _blocks([(p, e, at % salts, own, True) for p in range(parts)
                            for e, own in _split(rows[:, p], nearest(rows[:, p], books[p])[0])])
        return run

    def merge(batches):
        """Arrivals of one owner in a row to blocks."""
        key, held, n = None, [], 0
        for b in slices(batches, 16):
            for pos, entry, salt, rows, _, data, _ in zip(*[c.to_pylist() for c in b.columns]):
                if held and (key != (pos, entry, salt) or n + rows > block_rows):
                    yield _blocks([(*key, np.concatenate(held), False)])
                    held, n = [], 0
                key = (pos, entry, salt)
                held.append(np.frombuffer(data, "<i4").astype(np.int64).reshape(-1, width))
                n += rows
        if held:
            yield _blocks([(*key, np.concatenate(held), False)])

    def assign(books):
        """Each block's members that stay, and those that go to another entry."""
        def run(batches):
            for b in slices(batches, 4):
                out = []
                for pos, entry, salt, data in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 5)]):
                    own = np.frombuffer(data, "<i4").astype(np.int64).reshape(-1, width)
                    out += [(pos, e, salt, some, e != entry) for e, some in _split(own, nearest(own, books[pos])[0])]
                if out:
                    yield _blocks(out)
        return run

    def written(df: DataFrame) -> DataFrame:
        return materialise(df, "vector-blocks", "moved")

    def updated(table: DataFrame) -> np.ndarray:
        """The next codebook: of each entry that has members, the floor of their mean."""
        out = np.array(books)
        wide = T.DecimalType(38, 0)
        for r in (table.groupBy("pos", "entry").agg(F.sum("n").cast(wide).alias("n"), F.array(
                *[F.sum(F.get("sums", F.lit(i)).cast(wide)) for i in range(width)]).alias("sums")).collect()):
            out[r["pos"], r["entry"]] = [int(s) // int(r["n"]) for s in r["sums"]]
        return out

    table = None
    for _ in range(rounds):
        if table is None:
            new = written(map_arrow(kept.select("vector"), deal(books), BLOCK))
        else:
            arrived = (table.filter("moved").repartition("pos", "entry", "salt").sortWithinPartitions("pos", "entry", "salt")
                       .transform(map_arrow, merge, BLOCK))
            new = written(map_arrow(table.filter("not moved").unionByName(arrived), assign(books), BLOCK))
            release(table)
        table, books = new, updated(new)
    if table is not None:
        release(table)
    return Codebooks(tuple(tuple(tuple(map(int, e)) for e in b) for b in books), dims, scale)


def encode_vectors(vectors: DataFrame, codebooks: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``vec_id, label, code, error`` of every kept row: two hexadecimal digits for each part's
    entry, and the squared distances summed over the parts. Map-only; the codebooks go with the task."""
    kept = kept_vectors(vectors, id_col, vector_col, label_col).filter(F.size("vector") == codebooks.dims)
    books = [np.array(b, np.int64) for b in codebooks.books]
    parts, dims, scale = len(books), codebooks.dims, codebooks.scale

    def run(batches):
        for b in slices(batches, 4096):
            rows = _integers(b.column(2), dims, scale).reshape(b.num_rows, parts, dims // parts)
            codes, error = np.empty((b.num_rows, parts), np.uint8), np.zeros(b.num_rows, np.int64)
            for p, book in enumerate(books):
                codes[:, p], d = nearest(rows[:, p], book)
                error += d
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([bytes(c).hex() for c in codes]), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    return map_arrow(kept, run, schema)


def decode_vectors(codes: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``codes`` with ``vector``: the components that each code stands for."""
    books = F.array(*[F.array(*[F.array(*[F.lit(x / codebooks.scale) for x in e]) for e in b]) for b in codebooks.books])
    entry = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("vector", F.flatten(F.array(*[F.get(F.get(books, F.lit(p)), entry(p)) for p in range(len(codebooks.books))])))


def vector_codes(vectors: DataFrame, **params) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row.

    ``label_error`` sums the errors of all rows of a label, NULL labels together.
    Repeated rows are all returned; no kept row gives an empty result.
    """
    names = {k: v for k, v in params.items() if k.endswith("_col")}
    made = fit_codebooks(vectors, **params)
    if made is None:
        none = kept_vectors(vectors, **names).filter(F.lit(False))
        return none.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    coded = materialise(encode_vectors(vectors, made, **names), "vector-codes")
    by_label = materialise(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(made.sha256()).alias("codebooks_sha256"))
