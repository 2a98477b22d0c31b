"""Embedding near-duplicates with product quantisation.

A coarse quantiser cuts the unit vectors into inverted lists; what is left of a vector
after its list's centroid (the residual) is coded by a few bytes, one per subspace.  A
vector visits every list that can hold a link: the angles of a list's members to its
centroid span a ring, and all of them lie on the list's side of the plane between two
centroids; a list is passed over only where the angle to the ring or to that side exceeds
the angle of the limit, so that no link is lost.  In a list an approximate dot product is
the sum of one table entry per subspace (asymmetric: the query is exact, the member is
coded), and as the coding error of each member is stored, members whose approximate value
plus that error stays below the limit are certainly no links.  The survivors are compared
by exact cosine in double precision.

Centroids and codebooks are fitted on a sample of bounded size; every vector is indexed
and every vector is a query.  Equal vectors are one row with a count.  Neighbouring lists
stand on one shelf, and a vector is sent once to each shelf that has a list to visit, up
to its own: a pair on two shelves is compared once and counts at both ends.  A shelf with
many members or many visitors is cut into tiles, each pair of tiles a group of bounded
size that hands on one count and at most one link per row, never all pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.materialize import written
from .common import forest, group_batches, small_batches
from .components import components

MIN_COSINE = 0.9
MAX_LISTS = 4096
SAMPLE_PER_LIST = 32  # at most MAX_LISTS * SAMPLE_PER_LIST vectors are fitted on
SUBSPACES = 8
CODES = 256
MEMBER_TILE, VISITOR_TILE = 4096, 8192  # rows of a cell
LEAST_SHELVES = 12  # of a small table, by smaller tiles
VISITORS_AT_ONCE = 512
PAIRS_AT_ONCE = 1 << 15
_ROUNDING = 1e-9
_SHORT = 1e-3  # lengths below it have no direction
_ANGLE_ROUNDING = 1e-4  # the arc cosine of a number near one, divided by such a length
_CELL_BITS = 20


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of Euclidean k-means; an empty cluster keeps its centroid."""
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_nearest(part, centre, 1)[:, 0] for part in np.array_split(x, max(1, len(x) // 4096))])
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centre))[:, None]
        centre = np.where(n > 0, sums / np.maximum(n, 1), centre)
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    far = (centre * centre).sum(axis=1) - 2 * (x @ centre.T)
    n = min(n, len(centre))
    some = np.argpartition(far, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.take_along_axis(far, some, axis=1).argsort(axis=1, kind="stable"), axis=1)


def unit_rows(packed: list[bytes], width: int, kind: str) -> np.ndarray:
    """Packed vectors as doubles, filled up with zeros to ``width`` and scaled to length one."""
    out = np.zeros((len(packed), width))
    for i, raw in enumerate(packed):
        v = np.frombuffer(raw, kind)
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares stay in range
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


@dataclass
class Index:
    """Coarse centroids and the codebook of each subspace of the residuals."""

    width: int
    centroids: np.ndarray
    codebooks: np.ndarray  # subspace, code, dimension

    @classmethod
    def fit(cls, x: np.ndarray, n_lists: int, seed: int = 0) -> Index:
        rng = np.random.default_rng(seed)
        centroids = _kmeans(x, n_lists, 6, rng)
        residual = x - centroids[_nearest(x, centroids, 1)[:, 0]]
        parts = np.split(residual, SUBSPACES, axis=1)
        books = [_kmeans(p, CODES, 5, rng) for p in parts]
        return cls(x.shape[1], centroids, np.stack(books))

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes and the length of what they miss."""
        residual = x - self.centroids[lists]
        codes, coded = [], []
        for part, book in zip(np.split(residual, SUBSPACES, axis=1), self.codebooks):
            code = _nearest(part, book, 1)[:, 0]
            codes.append(code)
            coded.append(book[code])
        missed = residual - np.concatenate(coded, axis=1)
        return np.stack(codes, axis=1).astype(np.uint8), np.sqrt((missed * missed).sum(axis=1))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Dot products of each query's subvectors with all codes: subspace, query, code."""
        return np.stack([q @ book.T for q, book in zip(np.split(queries, SUBSPACES, axis=1), self.codebooks)])

    def angles(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Angle of each row to its list's centroid; 0 for a centroid too short to have a direction."""
        centre = self.centroids[lists]
        size = np.sqrt((centre * centre).sum(axis=1))
        return _arc((x * centre).sum(axis=1), size)


@dataclass
class Shelves:
    """Which lists stand on which shelf, and the ring of angles that each list's members span."""

    least: np.ndarray  # of each list; no ring where the list is empty
    most: np.ndarray
    members: np.ndarray
    shelf: np.ndarray

    @classmethod
    def of(cls, index: Index, rings: list[tuple[int, int, float, float]], member_tile: int) -> Shelves:
        """From (list, members, least angle, greatest angle) of the lists that have members."""
        n = len(index.centroids)
        least, most, members = np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n, np.int64)
        for at, count, low, high in rings:
            members[at], least[at], most[at] = count, low, high
        shelf, number, held = np.zeros(n, np.int64), 0, 0
        for at in _chain(index.centroids):
            if held and held + members[at] > member_tile:
                number, held = number + 1, 0
            shelf[at] = number
            held += members[at]
        return cls(least, most, members, shelf)

    def allowed(self, index: Index, x: np.ndarray, own: np.ndarray, lists: np.ndarray, min_cosine: float) -> np.ndarray:
        """Row, list: whether a member of the list can reach ``min_cosine``; ``own`` are the rows' nearest lists."""
        reach = np.arccos(np.clip(min_cosine, -1, 1)) + _ANGLE_ROUNDING
        centre, near = index.centroids[lists], index.centroids[own]
        square, near_square = (centre * centre).sum(axis=1), (near * near).sum(axis=1)
        dots = x @ centre.T
        size = np.sqrt(square)
        angle = _arc(dots, size)
        ring = (angle >= self.least[lists] - reach) & (angle <= self.most[lists] + reach)
        # members have m . (centre - near) >= (|centre|^2 - |near|^2) / 2
        gap = np.sqrt(np.maximum(square[None, :] + near_square[:, None] - 2 * (near @ centre.T), 0))
        side = _arc(dots - (x * near).sum(axis=1)[:, None], gap) - _arc((square[None, :] - near_square[:, None]) / 2, gap)
        return (self.members[lists] > 0) & ring & (side <= reach)


def _arc(dots: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Angle between unit vectors and vectors of length ``size``; 0 where these are too short."""
    return np.arccos(np.where(size < _SHORT, 1, np.clip(dots / np.maximum(size, _SHORT), -1, 1)))


def _chain(centre: np.ndarray) -> list[int]:
    """All centroids, each followed by the nearest one that is left."""
    square, left = (centre * centre).sum(axis=1), np.ones(len(centre), bool)
    order = [0]
    for _ in range(len(centre) - 1):
        left[order[-1]] = False
        order.append(int(np.where(left, square - 2 * (centre @ centre[order[-1]]), np.inf).argmin()))
    return order


def stated_cosine(a: bytes, b: bytes, kind: str) -> float:
    """a.b / sqrt(a.a b.b) in double precision on the vectors as they are.

    Sums are rounded once, and vectors are only scaled by powers of two, which is exact, so
    that squares stay in range; the value does not depend on where the pair is compared.
    """
    x, y = (np.frombuffer(raw, kind).astype(float) for raw in (a, b))
    x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))
    dot, xx, yy = (math.fsum(p) for p in (x * y, x * x, y * y))
    return dot / math.sqrt(xx * yy)


def links_in_cell(
    index: Index, list_no: int, q: np.ndarray, m: np.ndarray, codes: np.ndarray, missed: np.ndarray, min_cosine: float,
    stated=None,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) positions with exact cosine of at least ``min_cosine``.

    Scaled rows round twice, so pairs within a rounding margin of the limit are decided by
    ``stated``, a function of their positions.
    """
    tables = index.tables(q)
    near = np.repeat((q @ index.centroids[list_no])[:, None], len(m), axis=1)
    for s in range(SUBSPACES):
        near += tables[s][:, codes[:, s]]
    x, y = np.nonzero(near + missed[None, :] >= min_cosine - _ROUNDING)
    if len(x) > near.size // 8:
        exact = (q @ m.T)[x, y]
    else:
        exact = np.empty(len(x))
        for at in range(0, len(x), PAIRS_AT_ONCE):
            part = slice(at, at + PAIRS_AT_ONCE)
            exact[part] = np.einsum("ij,ij->i", q[x[part]], m[y[part]])
    found = exact >= min_cosine
    if stated is not None:
        for i in np.flatnonzero(np.abs(exact - min_cosine) <= _ROUNDING):
            found[i] = stated(x[i], y[i]) >= min_cosine
    return x[found], y[found]


def _assign(shared, kind: str):
    """(cid, n, packed) -> the same with list, angle to its centroid, codes and coding error."""

    def assign(batches):
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit_rows(batch.column("packed").to_pylist(), index.width, kind)
            lists = _nearest(x, index.centroids, 1)[:, 0]
            codes, missed = index.encode(x, lists)
            arrays = [
                *(batch.column(c) for c in ("cid", "n", "packed")),
                pa.array(lists, pa.int32()),
                pa.array(index.angles(x, lists)),
                pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(missed),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["cid", "n", "packed", "list", "angle", "codes", "missed"])

    return assign


def _visit(shared, shelved, min_cosine: float, kind: str):
    """Rows of ``_assign`` -> the same with their shelf and the shelves up to it that they visit."""

    def visit(batches):
        index, shelves = shared.value, shelved.value
        order = np.argsort(shelves.shelf, kind="stable")
        starts = np.flatnonzero(np.diff(shelves.shelf[order], prepend=-1))
        for batch in batches:
            for at in range(0, batch.num_rows, VISITORS_AT_ONCE):
                part = batch.slice(at, VISITORS_AT_ONCE)
                x = unit_rows(part.column("packed").to_pylist(), index.width, kind)
                own = part.column("list").to_numpy()
                home = shelves.shelf[own]
                allowed = shelves.allowed(index, x, own, order, min_cosine)
                goes = np.logical_or.reduceat(allowed, starts, axis=1)
                goes &= np.arange(len(starts))[None, :] <= home[:, None]
                visits = pa.array([np.flatnonzero(g) for g in goes], pa.list_(pa.int32()))
                arrays = [*(part.column(c) for c in ("cid", "n", "packed", "list", "codes", "missed")), pa.array(home, pa.int32()), visits]
                yield pa.RecordBatch.from_arrays(arrays, ["cid", "n", "packed", "list", "codes", "missed", "shelf", "visits"])

    return visit


def _compare(shared, shelved, min_cosine: float, kind: str):
    """Sorted rows of cells -> (a, null, links of a) and (a, b, null) rows."""

    def in_cell(cell: pa.Table):
        """Positions of linked (visitor, member) rows of one cell, a block of visitors and a list at a time."""
        index, shelves = shared.value, shelved.value
        is_member = cell.column("codes").is_valid().to_numpy()
        members, visitors = np.flatnonzero(is_member), np.flatnonzero(~is_member)
        if not len(members):
            return
        list_of = cell.column("list").to_numpy()
        members = members[np.argsort(list_of[members], kind="stable")]
        coded = cell.take(members)
        codes = np.frombuffer(b"".join(coded.column("codes").to_pylist()), np.uint8).reshape(len(members), SUBSPACES)
        missed = coded.column("missed").to_numpy()
        m_raw = coded.column("packed").to_pylist()
        m = unit_rows(m_raw, index.width, kind)
        lists, starts = np.unique(list_of[members], return_index=True)
        ends = np.append(starts[1:], len(members))
        for at in range(0, len(visitors), VISITORS_AT_ONCE):
            block = visitors[at : at + VISITORS_AT_ONCE]
            q_raw = cell.column("packed").take(block).to_pylist()
            q = unit_rows(q_raw, index.width, kind)
            allowed = shelves.allowed(index, q, list_of[block], lists, min_cosine)
            found = []
            for j, (start, end) in enumerate(zip(starts, ends)):
                rows = np.flatnonzero(allowed[:, j])
                if len(rows):
                    stated = lambda x, y, rows=rows, start=start: stated_cosine(q_raw[rows[x]], m_raw[start + y], kind)
                    a, b = links_in_cell(index, lists[j], q[rows], m[start:end], codes[start:end], missed[start:end], min_cosine, stated)
                    found.append((block[rows[a]], members[start + b]))
            if found:
                yield tuple(np.concatenate(side) for side in zip(*found))

    def compare(batches):
        for table in group_batches(batches, "cell"):
            cells = table.column("cell").to_numpy()
            edges = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1, append=cells[-1] + 1))
            for start, end in zip(edges, edges[1:]):
                cell = table.slice(start, end - start).combine_chunks()
                cid, n = cell.column("cid").to_numpy(), cell.column("n").to_numpy()
                width = pc.binary_length(cell.column("packed")).to_numpy()
                # on its own shelf every row is a visitor and a member, so that each end counts as visitor
                abroad = cell.column("shelf").to_numpy() != cells[start] >> (2 * _CELL_BITS)
                links = np.zeros(len(cid))
                for a, b in in_cell(cell):
                    other = (cid[a] != cid[b]) & (width[a] == width[b])
                    a, b = a[other], b[other]
                    if len(a):
                        links += np.bincount(a, n[b], len(cid))
                        back = abroad[a]
                        links += np.bincount(b[back], n[a[back]], len(cid))
                        yield _rows(*forest(cid[a], cid[b]), None)
                linked = np.flatnonzero(links)
                if len(linked):
                    yield _rows(cid[linked], None, links[linked].astype(np.int64))

    return compare


def _rows(a: np.ndarray, b: np.ndarray | None, links: np.ndarray | None) -> pa.RecordBatch:
    columns = [pa.nulls(len(a), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (a, b, links)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])


def _packed(vec: str, kind: str) -> Column:
    """A vector as the bytes of its numbers."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        ends = vectors.offsets.to_numpy()
        values = vectors.values.to_numpy(zero_copy_only=False).astype(kind)
        return pa.array([values[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())

    return pack(F.col(vec))


def usable(vec: Column) -> Column:
    """Not null or empty, all components finite numbers, one of them not zero."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(F.exists(vec, lambda x: x != 0) & ~F.exists(vec, lambda x: F.coalesce(odd(x), F.lit(True))), F.lit(False))


def fit_index(classes: DataFrame, kind: str, sample_per_list: int = SAMPLE_PER_LIST, max_lists: int = MAX_LISTS) -> Index:
    """Fit on a bounded sample of the distinct vectors, chosen by a hash of the vector."""
    n, width = classes.agg(F.count("*"), F.max(F.octet_length("packed"))).first()
    n_lists = max(1, min(max_lists, int(n**0.5)))
    sample = classes.select("packed").orderBy(F.xxhash64("packed"), "packed").limit(n_lists * sample_per_list)
    width = -(-width // np.dtype(kind).itemsize // SUBSPACES) * SUBSPACES
    return Index.fit(unit_rows(sample.toArrow().column("packed").to_pylist(), width, kind), n_lists)


def cell_rows(visiting: DataFrame, member_tile: int = MEMBER_TILE, visitor_tile: int = VISITOR_TILE) -> DataFrame:
    """Members and visitors of every shelf, dealt to cells of bounded numbers of both."""
    members = visiting.groupBy("shelf").agg(F.count("*").alias("members"))
    visitors = visiting.select(F.explode("visits").alias("shelf")).groupBy("shelf").agg(F.count("*").alias("visitors"))
    tiles = members.join(visitors, "shelf").select(
        F.col("shelf").alias("at"), F.ceil(F.col("members") / member_tile).cast("long").alias("mt"), F.ceil(F.col("visitors") / visitor_tile).cast("long").alias("vt")
    )
    tiles = F.broadcast(tiles)  # one row per shelf, so at most MAX_LISTS rows

    def cell(m: Column, v: Column) -> Column:
        base = F.shiftleft(F.col("at").cast("long"), 2 * _CELL_BITS)
        return base.bitwiseOR(F.shiftleft(m, _CELL_BITS)).bitwiseOR(v)

    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own_m, own_v = (F.pmod(F.xxhash64("cid"), F.col(n)) for n in ("mt", "vt"))
    as_member = visiting.join(tiles, F.col("shelf") == F.col("at")).select(
        F.explode(F.transform(upto("vt"), lambda v: cell(own_m, v))).alias("cell"), "cid", "n", "packed", "list", "shelf", "codes", "missed"
    )
    none = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("missed")]
    visits = visiting.select("cid", "n", "packed", "list", "shelf", F.explode("visits").alias("to"))
    as_visitor = visits.join(tiles, F.col("to") == F.col("at")).select(
        F.explode(F.transform(upto("mt"), lambda m: cell(m, own_v))).alias("cell"), "cid", "n", "packed", "list", "shelf", *none
    )
    return as_member.unionByName(as_visitor)


def cosine_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    min_cosine: float = MIN_COSINE,
    tiles: tuple[int, int] = (MEMBER_TILE, VISITOR_TILE),
    sample_per_list: int = SAMPLE_PER_LIST,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors link at a cosine of ``min_cosine`` or more.  A vector that is null, empty, zero or
    has null or non-finite components links with nothing; vectors of different length do
    not link.  Repeated rows are vectors of their own and link with each other.  A null id is
    no smallest id unless a whole component has none, and is not kept.  Further columns,
    whatever their names, are not looked at; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    kind = "<f4" if vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType()) else "<f8"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    good = written(rows.filter(usable(F.col("vec"))).select("id", _packed("vec", kind).alias("packed")), "vectors")
    grouped = good.groupBy("packed").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector_classes")
    alone = rows.filter(~usable(F.col("vec"))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    result = alone
    if classes.head(1):
        shared = spark.sparkContext.broadcast(fit_index(classes, kind, sample_per_list))
        schema = "cid bigint, n bigint, packed binary, list int, angle double, codes binary, missed double"
        assigned = written(classes.select("cid", "n", "packed").mapInArrow(_assign(shared, kind), schema), "inverted_lists")
        rings = assigned.groupBy("list").agg(F.count("*"), F.min("angle"), F.max("angle")).collect()  # at most MAX_LISTS rows
        share = min(1, sum(r[1] for r in rings) / (LEAST_SHELVES * tiles[0]))
        member_tile, visitor_tile = (max(1, round(t * share)) for t in tiles)
        shelved = spark.sparkContext.broadcast(Shelves.of(shared.value, rings, member_tile))
        schema = "cid bigint, n bigint, packed binary, list int, codes binary, missed double, shelf int, visits array<int>"
        visiting = written(assigned.mapInArrow(_visit(shared, shelved, min_cosine, kind), schema), "visits")
        cells = cell_rows(visiting, member_tile, visitor_tile).repartition("cell").sortWithinPartitions("cell")
        found = written(cells.mapInArrow(_compare(shared, shelved, min_cosine, kind), "a bigint, b bigint, links bigint"), "vector_links")
        counts = found.filter("links is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
        labels = components(found.filter("b is not null").select("a", "b")).toDF("cid", "label")
        labelled = classes.join(labels, "cid", "left").join(counts, "cid", "left").select(
            "packed", "first_id", F.coalesce("label", "cid").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
        )
        least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
        facts = labelled.join(least, "label").select("packed", "n_links", "component_id")
        result = alone.unionByName(good.join(facts, "packed").select("id", "n_links", "component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return result.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
