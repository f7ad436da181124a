"""Centroid clustering of vectors of 64 components, by bit planes.

Components become integers in two's complement. Bit i of all 64 components of a vector is
one 64-bit number, its plane i. The dot product of a vector and a centroid is the sum over
pairs of planes of the bits that both have, weighted by the places of the planes; the
plane of the sign weighs negative. This is exact, and so are distances and centroids.
Vectors are stored as planes once; a round is one pass that returns sums for each cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import INT, LONG, STRING, stored, struct, table

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Components are counted in 1 / SCALE.
SCALE = 256

#: With so many planes on both sides, every distance fits 64 bits; more are added up in parts.
_NARROW = 28
#: Components of so many planes are added up in 64 bits, a chunk at a time.
_SUMMABLE = 48
#: Vectors compared with all centroids at once.
_CHUNK = 4096
_LONGEST = (1 << 63) - 1
_LIMB = 32


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles, exactly; Python integers where 64 bits may not do."""
    if not values.size or np.abs(values).max() < 2.0**40:
        return np.floor(values * SCALE).astype(np.int64)
    whole = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def planes(vectors: np.ndarray) -> list[bytes]:
    """The planes of each row of integers, lowest bit first, as eight bytes each; no more than it needs."""
    lengths = np.frompyfunc(int.bit_length, 1, 1)
    widths = lengths(np.where(vectors < 0, -1 - vectors, vectors).max(axis=1).astype(object)).astype(np.int64) + 1
    out = np.empty(len(vectors), object)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        bits = np.stack([(vectors[rows] >> i & 1).astype(np.uint8) for i in range(width)], axis=1)
        out[rows] = [p.tobytes() for p in np.packbits(bits, axis=2, bitorder="little")]
    return out.tolist()


def as_planes(packed: Sequence[bytes]) -> np.ndarray:
    """Planes of several vectors as rows of numbers, sign planes repeated up to the widest."""
    width = max(map(len, packed))
    return np.frombuffer(b"".join(p + p[-8:] * ((width - len(p)) // 8) for p in packed), "<u8").reshape(len(packed), -1)


def components(rows: np.ndarray) -> np.ndarray:
    """The integers whose planes these are; Python integers where 64 bits may not do."""
    n, width = rows.shape
    bits = np.unpackbits(rows.astype("<u8").view(np.uint8).reshape(n, width, 8), axis=2, bitorder="little")
    total = np.zeros((n, DIM), np.int64 if width <= _SUMMABLE else object)
    for i in range(width):
        weight = -(1 << i) if i == width - 1 else 1 << i
        total += bits[:, i].astype(total.dtype) * weight
    return total


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all rows of a with all rows of b, from their planes."""
    p, q = a.shape[1], b.shape[1]
    narrow = p <= _NARROW and q <= _NARROW
    parts = np.zeros((1 if narrow else (p + q) // _LIMB + 1, len(a), len(b)), np.int64)
    for i in range(p):
        for j in range(q):
            limb, place = (0, i + j) if narrow else divmod(i + j, _LIMB)
            sign = -1 if (i == p - 1) != (j == q - 1) else 1
            parts[limb] += np.bitwise_count(a[:, i, None] & b[None, :, j]) * np.int64(sign << place)
    if narrow:
        return parts[0]
    return sum(part.astype(object) * (1 << _LIMB * k) for k, part in enumerate(parts))


def nearest(vectors: np.ndarray, centroids: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For planes of vectors: the nearest centroid, the smaller number on a tie, and the squared distance.

    norms holds the squared lengths of the centroids, as Python integers.
    """
    if vectors.shape[1] <= _NARROW and centroids.shape[1] <= _NARROW:
        norms = norms.astype(np.int64)
    far = norms[None, :] - 2 * dots(vectors, centroids)
    at = np.argmin(far, axis=1)
    own = components(vectors)
    if vectors.shape[1] > _NARROW:
        own = own.astype(object)
    return at, far[np.arange(len(at)), at] + (own * own).sum(axis=1)


@F.arrow_udf(T.BinaryType())
def _planes(vector: pa.Array) -> pa.Array:
    values = vector.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
    rows: list[bytes] = []
    for k in range(0, len(values), _CHUNK):
        rows += planes(quantised(values[k : k + _CHUNK]))
    return pa.array(rows, pa.binary())


def packed(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ids and planes of all vectors with exactly 64 components, all of them finite numbers.

    Other rows, null vectors among them, are left out. Rows may repeat; ids may be null.
    """
    wide = F.col(vector).cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter((F.size(vector) == DIM) & finite).select(F.col(id).alias("id"), _planes(wide).alias("planes"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """Components of the vectors whose seeded ids have the smallest hashes, in their order.

    Equal ids are ordered by their planes; vectors without id come last.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "planes").limit(clusters).collect()
    return [components(as_planes([bytes(r["planes"])]))[0].tolist() for r in rows]


class _Assigner:
    """Finds the nearest of a few centroids for batches of packed vectors."""

    def __init__(self, centroids: list[list[int]]):
        self.planes = as_planes(planes(np.array(centroids, object)))
        self.norms = np.array([sum(x * x for x in c) for c in centroids], object)

    def __call__(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Places in the column, planes, centroids and distances, by chunks of equal width."""
        values = np.array([v.as_py() for v in column], object)
        widths = np.array([len(v) for v in values])
        for width in np.unique(widths):
            places = np.flatnonzero(widths == width)
            for k in range(0, len(places), _CHUNK):
                part = places[k : k + _CHUNK]
                rows = as_planes(list(values[part]))
                yield part, rows, *nearest(rows, self.planes, self.norms)


def _limbs(total: int) -> list[int]:
    """A number as parts of 32 bits, lowest first; the last one has the sign."""
    parts = []
    while not -(1 << _LIMB - 1) <= total < 1 << _LIMB - 1:
        parts.append(total & (1 << _LIMB) - 1)
        total >>= _LIMB
    return [*parts, total]


def _summer(centroids: list[list[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _Assigner(centroids)
        total: dict[int, np.ndarray] = {}  # by cluster: Python integers, behind the components the count
        for batch in batches:
            for _, rows, at, _ in assign(batch.column(0)):
                own = components(rows)
                for c in np.unique(at):
                    mine = own[at == c]
                    added = np.array([*mine.sum(axis=0).tolist(), len(mine)], object)
                    total[int(c)] = total.get(int(c), 0) + added
        out = [(c, j, k, part) for c, row in total.items() for j, x in enumerate(row) for k, part in enumerate(_limbs(x))]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = pa.int32(), pa.int32(), pa.int32(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["cluster", "at", "limb", "part"])

    return sums


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the floor of the mean of each centroid's vectors; one without vectors stays.

    Each task returns its sums, and so does the whole; the driver gets a few numbers for
    every component of every centroid.
    """
    found = vectors.select("planes").mapInArrow(_summer(centroids), struct(cluster=INT, at=INT, limb=INT, part=LONG))
    total: dict[tuple[int, int], int] = {}
    for r in found.groupBy("cluster", "at", "limb").agg(F.sum("part").alias("part")).collect():
        key = r["cluster"], r["at"]
        total[key] = total.get(key, 0) + (r["part"] << _LIMB * r["limb"])
    return [
        [total[c, j] // total[c, DIM] for j in range(DIM)] if (c, DIM) in total else old for c, old in enumerate(centroids)
    ]


def fitted(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids after some rounds over packed vectors; fewer than asked for if there are fewer vectors."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """id, cluster and squared distance of all packed vectors.

    The nearest centroid is exact for components of any size; a squared distance that does
    not fit 64 bits is given as the largest number that does.
    """

    def assign_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _Assigner(centroids)
        for batch in batches:
            cluster, distance = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64)
            for part, _, at, far in assign(batch.column(1)):
                cluster[part] = at
                distance[part] = np.minimum(far, _LONGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType
    return vectors.select("id", "planes").mapInArrow(assign_all, struct(id=kind, cluster=INT, distance=LONG))


def clustered(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Null vectors, other lengths and components that are null, NaN or infinite leave a row
    out. Repeated rows count as often as they occur. Columns other than the two named are not
    read, whatever their names. Inertias are sums of distances; sums and distances beyond 64
    bits are given as the largest 64-bit number. An empty table gives an empty result.
    """
    found = stored(packed(vectors, id, vector), "planes")
    centroids = fitted(found, clusters, rounds, seed)
    found = stored(assigned(found, centroids), "assigned") if centroids else found.selectExpr("id", "0 as cluster", "0L as distance")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row for each centroid
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    total = min(sum(inertia.values()), _LONGEST)
    known = [
        (c, min(inertia.get(c, 0), _LONGEST), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
        for c, x in enumerate(centroids)
    ]
    named = vectors.sparkSession.createDataFrame(known, struct(cluster=INT, cluster_inertia=LONG, centroid_sha256=STRING))
    columns: list[Column | str] = [F.col("id").alias(id), "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"]
    return found.join(F.broadcast(named), "cluster").select(*columns)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _round_sql(r: int) -> str:
    return f"""
far{r} as materialized (
    select row_id, c, sum((v.x - k.x) * (v.x - k.x)) as distance
    from v join c{r} k on v.j = k.j group by row_id, c
),
at{r} as materialized (
    select row_id, c, distance
    from (select *, row_number() over (partition by row_id order by distance, c) as place from far{r}) where place = 1
),
sum{r} as (
    select c, j, sum(x) as s, count(*) as n from at{r} join v on at{r}.row_id = v.row_id group by c, j
),
c{r + 1} as materialized (
    select k.c, k.j, case when n is null then k.x else (s - ((s % n) + n) % n) // n end as x
    from c{r} k left join sum{r} t on k.c = t.c and k.j = t.j
),"""


ORACLE = (
    f"""
with kept as (
    select row_number() over () as row_id, vec_id, sha256('{SEED}:' || vec_id) as hash,
           [cast(floor({SCALE} * cast(x as double)) as bigint) for x in embedding] as vector
    from embeddings
    where len(embedding) = {DIM}
      and len([x for x in embedding if x is not null and isfinite(x)]) = {DIM}
),
v as materialized (
    select row_id, unnest(range({DIM})) as j, unnest(vector) as x from kept
),
start as (
    select row_id, row_number() over (order by hash nulls last, vector) - 1 as c from kept
),
c0 as materialized (
    select c, j, cast(x as hugeint) as x from start join v on start.row_id = v.row_id where c < {CLUSTERS}
),"""
    + "".join(map(_round_sql, range(ROUNDS + 1)))
    + f"""
digests as (
    select c, sha256(string_agg(cast(x as varchar), ',' order by j)) as centroid_sha256 from c{ROUNDS} group by c
)
select vec_id, cast(a.c as integer) as cluster, cast(distance as bigint) as distance,
       cast(sum(distance) over (partition by a.c) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, centroid_sha256
from at{ROUNDS} a join kept on a.row_id = kept.row_id join digests on a.c = digests.c
"""
)
