"""Near-duplicate vectors by E8 lattice hashing with exact cosines.

Each of several tables projects the unit vectors at random to eight dimensions (once or more, see `design`)
and decodes the projection to the nearest point of the E8 lattice, which is the vector's cell. A vector
is also a guest in the neighbouring cells it lies closest to, so two vectors meet where one is at home and
the other at home or a guest. Vectors that meet are compared by a 192-bit sketch of signs first, whose
bound lets a linked pair fail with a probability below 1e-8, and then by their cosine in double precision.

Groups of near copies never become pairs. Equal vectors are one entry with a count. Vectors that lie
within half the threshold's angle of their cell's mean direction form a ball: all of them are linked with
each other, whatever their number, since the angles to the centre add up. Cells list balls, not members,
and the links between two balls follow from the angle of their centres and their radii where these
decide; only otherwise members are compared, first with the other ball and then one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.components import connected_components
from habispark.llm.tables import stored
from habispark.llm.words import mix

THRESHOLD = 0.9
# Lattice steps in units of the length a unit vector is expected to have in eight projected dimensions.
STEP, BALL_STEP = 0.6, 0.8
# Cells a vector is entered in per table: its own and the neighbours nearest to it.
PROBES = 8
# What a table finds of the pairs at the threshold (measured in the tests): with one lattice point, and for each more.
FOUND, FOUND_BY_MORE = 0.79, 0.29
MISSED = 1e-3
# Distinct vectors that share a cell by chance when the number of lattice points is raised by one.
CROWD = 100
CELLS = 1000
SKETCH_BITS = 192
# Angles are computed with an error far below this; what is nearer to a bound is compared exactly.
_SLACK = 1e-6
_SEED = 8
# Numbers of the random projections that are no tables of the search.
_BALL_TABLE, _SKETCH = 900, 950_000
_SKETCHES = [f"sketch_{i}" for i in range(SKETCH_BITS // 64)]
# Vectors that are entered in their cells at a time.
_SLICE = 512


def design(count: int) -> tuple[int, int]:
    """Lattice points per cell and number of tables for `count` vectors: cells stay small, and the share of
    missed pairs at the threshold stays below MISSED."""
    points = 1
    while count > CROWD * CELLS**points:
        points += 1
    return points, math.ceil(math.log(MISSED) / math.log(1 - FOUND * FOUND_BY_MORE ** (points - 1)))


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of an even sum."""
    near = np.rint(x)
    error = x - near
    worst = np.abs(error).argmax(1)
    rows = np.arange(len(x))
    wrong = near.sum(1) % 2 != 0
    near[rows, worst] += np.where(wrong, np.where(error[rows, worst] >= 0, 1.0, -1.0), 0.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: even integer points and the same shifted by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


@cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            row = [0.0] * 8
            row[i], row[j] = a, b
            pairs.append(row)
    halves = [s for s in product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array(pairs + [list(s) for s in halves])


def _random(dims: int, columns: int, seed: int) -> np.ndarray:
    return np.random.RandomState((_SEED, seed)).normal(size=(dims, columns))


def _cell_keys(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit keys of lattice points given by doubled coordinates, one row each."""
    key = np.zeros(len(points), np.uint64) + salt
    for column in points.T:
        key = mix(key * np.uint64(31) + column.astype(np.int64).view(np.uint64))
    return key


def cells(units: np.ndarray, sizes: np.ndarray, table: int, points: int, step: float, probes: int) -> np.ndarray:
    """Keys of the cells of one table: the own one first, then the nearest neighbours, one row per vector.

    `sizes` are the lengths of the vectors before they were padded: different ones never share a cell.
    """
    count, dims = units.shape
    near = min(24, 8 * probes)
    homes, choices, costs = [], [], []
    for part in range(points):
        x = units @ _random(dims, 8, 1000 * table + part) / math.sqrt(8) / step
        home = nearest_e8(x)
        off = x - home
        # How much farther each neighbour is than the own point.
        cost = 2.0 - 2.0 * off @ neighbours().T
        best = np.argsort(cost, 1, kind="stable")[:, : near - 1]
        homes.append(home)
        choices.append(np.concatenate([np.full((count, 1), -1), best], 1))
        costs.append(np.concatenate([np.zeros((count, 1)), np.take_along_axis(cost, best, 1)], 1))
    # The cheapest combinations of one choice per lattice point.
    total, picked = costs[0], [np.broadcast_to(np.arange(near), (count, near))]
    for cost in costs[1:]:
        summed = (total[:, :, None] + cost[:, None, :]).reshape(count, -1)
        best = np.argsort(summed, 1, kind="stable")[:, :near]
        total = np.take_along_axis(summed, best, 1)
        picked = [np.take_along_axis(p, best // cost.shape[1], 1) for p in picked] + [best % cost.shape[1]]
    shifts = np.concatenate([neighbours(), np.zeros((1, 8))])
    salt = mix(np.full(count, table, np.uint64) + (sizes.astype(np.uint64) << np.uint64(20)))
    keys = np.empty((count, probes), np.uint64)
    for i in range(probes):
        at = [h + shifts[np.take_along_axis(c, p[:, i : i + 1], 1)[:, 0]] for h, c, p in zip(homes, choices, picked, strict=True)]
        keys[:, i] = _cell_keys(np.rint(2 * np.concatenate(at, 1)), salt)
    return keys.view(np.int64)


def sketch_limit(threshold: float) -> int:
    """Differing sketch bits that a pair at the threshold exceeds with a probability below 1e-8."""
    p = math.acos(threshold) / math.pi
    chance, within = 0.0, 0
    for bits in range(SKETCH_BITS + 1):
        chance += math.comb(SKETCH_BITS, bits) * p**bits * (1 - p) ** (SKETCH_BITS - bits)
        within = bits
        if 1 - chance < 1e-8:
            break
    return within


def _rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, padded with zeros to `dims`, and their lengths before; from a column of lists of numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths(), np.int64)
    if len(sizes) and (sizes == dims).all():
        rows = flat.reshape(-1, dims).copy()
    else:
        rows = np.zeros((len(sizes), dims))
        rows[np.arange(dims)[None] < sizes[:, None]] = flat
    # Scaled first, so that squares neither overflow nor vanish.
    rows /= np.abs(rows).max(1, initial=5e-324)[:, None]
    rows /= np.sqrt((rows * rows).sum(1))[:, None]
    return rows, sizes


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip((a * b).sum(1), -1.0, 1.0))


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


# --- distinct vectors and balls ----------------------------------------------------------------------


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, text key of the vector (NULL where it links with nothing), embedding as it is."""
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    number = np.float32 if kind == "array<float>" else np.float64

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            embedding = batch.column(1)
            flat = embedding.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(number) + number(0)
            ends = np.cumsum(np.asarray(embedding.value_lengths().fill_null(0), np.int64))
            keys = []
            for start, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                row = values[start:end]
                fine = np.isfinite(row).all() and row.any()
                keys.append(hashlib.sha256(row.tobytes()).digest()[:16] if fine else None)
            yield _table(vec_id=batch.column(0), vector_key=pa.array(keys, pa.binary()), embedding=embedding)

    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    return read.mapInArrow(key, f"vec_id long, vector_key binary, embedding {kind}")


def _balls(distinct: DataFrame, dims: int, points: int, radius: float) -> DataFrame:
    """`distinct` with `cls`, `centre` and `angle`: a negative class and the centre for members of a ball; else the
    node itself, NULL and 0."""
    kind = dict(distinct.dtypes)["embedding"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = _rows(batch.column("embedding"), dims)
            cell = cells(rows, sizes, _BALL_TABLE, points, BALL_STEP, 1)[:, 0] | np.int64(-(2**63))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    def grouped(rows: np.ndarray, counts: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(cell[order]) != 0]))
        return np.add.reduceat(rows[order], first, 0), np.add.reduceat(counts[order], first), cell[order][first]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, _ = _rows(batch.column("embedding"), dims)
                sums, counts, cell = grouped(rows, np.ones(len(rows), np.int64), batch.column("cell").to_numpy())
                yield _sums(cell, counts, sums)

    def _sums(cell: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        flat = pa.array(sums.astype(np.float32).ravel())
        return _table(cell=cell, members=counts, sums=pa.FixedSizeListArray.from_arrays(flat, dims).cast(pa.list_(pa.float32())))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = batch.column("sums").flatten().to_numpy().reshape(-1, dims).astype(np.float64)
            counts, cell = batch.column("members").to_numpy(), batch.column("cell").to_numpy()
            if open_ is not None:
                sums, counts, cell = (np.concatenate([a, b]) for a, b in zip(open_, (sums, counts, cell), strict=True))
            sums, counts, cell = grouped(sums, counts, cell)
            open_ = sums[-1:], counts[-1:], cell[-1:]
            # The last cell may go on in the next batch.
            yield from closed(sums[:-1], counts[:-1], cell[:-1])
        if open_ is not None:
            yield from closed(*open_)

    def closed(sums: np.ndarray, counts: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
        use = (counts > 1) & (np.abs(sums).max(1, initial=0.0) > 1e-3)
        if use.any():
            yield _sums(cell[use], counts[use], sums[use] / np.abs(sums[use]).max(1)[:, None])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = _rows(batch.column("embedding"), dims)
            centre, has = batch.column("sums"), np.asarray(batch.column("sums").is_valid())
            angle = np.full(len(rows), np.inf)
            if has.any():
                angle[has] = _angles(rows[has], _rows(centre.filter(pa.array(has)), dims)[0])
            inside = angle <= radius
            node = batch.column("node").to_numpy()
            yield _table(
                node=node, vector_key=batch.column("vector_key"), rep_id=batch.column("rep_id"), n=batch.column("n"),
                embedding=batch.column("embedding"), cls=np.where(inside, batch.column("cell").to_numpy(), node),
                centre=pc.if_else(pa.array(inside), centre, pa.scalar(None, centre.type)), angle=np.where(inside, angle, 0.0),
            )

    columns = f"node long, vector_key binary, rep_id long, n long, embedding {kind}"
    placed = stored(distinct.mapInArrow(place, f"{columns}, cell long"), "vector-cells")
    sums = "cell long, members long, sums array<float>"
    centres = (
        placed.select("cell", "embedding").mapInArrow(partial, sums)
        .repartition("cell").sortWithinPartitions("cell").mapInArrow(total, sums).select("cell", "sums")
    )
    return placed.join(centres, "cell", "left").mapInArrow(assign, f"{columns}, cls long, centre array<float>, angle double")


# --- links -------------------------------------------------------------------------------------------


def _entries(dims: int, points: int, tables: int, probes: int):
    """Function for `mapInArrow`: cell, cls, ball and the sketch for every table and cell of a vector."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = _random(dims, SKETCH_BITS, _SKETCH)
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows, sizes = _rows(batch.column("embedding"), dims)
                centre, ball = batch.column("centre"), np.asarray(batch.column("centre").is_valid())
                shown = rows.copy()
                if ball.any():
                    shown[ball] = _rows(centre.filter(pa.array(ball)), dims)[0]
                sketch = np.packbits(shown @ signs > 0, axis=1).view(np.int64)
                cls = batch.column("cls").to_numpy()
                for table in range(tables):
                    keys = cells(rows, sizes, table, points, STEP, probes)
                    # The members of a ball are one entry of a cell.
                    found = np.stack([keys.T.ravel(), np.tile(cls, probes), np.tile(np.arange(len(cls)), probes)], 1)
                    order = np.lexsort((found[:, 1], found[:, 0]))
                    same = (np.diff(found[order, 0]) == 0) & (np.diff(found[order, 1]) == 0)
                    found = found[order[np.concatenate([[True], ~same])]]
                    yield _table(
                        cell=found[:, 0], cls=found[:, 1], ball=ball[found[:, 2]],
                        **{name: np.ascontiguousarray(sketch[found[:, 2], i]) for i, name in enumerate(_SKETCHES)},
                    )

    return enter


def _meetings(nodes: DataFrame, dims: int, points: int, tables: int, threshold: float) -> DataFrame:
    """a, b (a < b): classes with vectors that meet in a cell and whose sketches allow a link."""
    schema = "cell long, cls long, ball boolean, " + ", ".join(f"{name} long" for name in _SKETCHES)
    single, member = F.col("centre").isNull(), F.col("centre").isNotNull()
    columns = nodes.select("embedding", "cls", "centre")

    def entered(probes: int) -> DataFrame:
        enter = _entries(dims, points, tables, probes)
        balls = columns.filter(member).mapInArrow(enter, schema).distinct()
        return columns.filter(single).mapInArrow(enter, schema).unionByName(balls)

    homes, guests = entered(1).alias("h"), entered(PROBES).alias("g")
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"h.{name}").bitwiseXOR(F.col(f"g.{name}"))) for name in _SKETCHES])
    theta = math.acos(threshold)
    # A ball shows its centre, which a linked vector may be farther from by half the angle.
    limit = (
        F.when(F.col("h.ball") & F.col("g.ball"), SKETCH_BITS)
        .when(F.col("h.ball") | F.col("g.ball"), sketch_limit(math.cos(1.5 * theta)))
        .otherwise(sketch_limit(threshold))
    )
    meet = (F.col("h.cell") == F.col("g.cell")) & (F.col("h.cls") != F.col("g.cls")) & (bits <= limit)
    return homes.join(guests, meet).select(
        F.least("h.cls", "g.cls").alias("a"), F.greatest("h.cls", "g.cls").alias("b")
    ).distinct()


def _compare(pairs: DataFrame, dims: int, threshold: float) -> DataFrame:
    """`pairs` with `linked`: true if all vectors of both sides are linked, false if none is, NULL if it takes a closer look.

    Each side has an embedding or a centre (`x`, `y`) and a radius (`x_radius`, `y_radius`).
    """
    theta = math.acos(threshold)
    kept = [c for c in pairs.columns if c not in ("x", "y")]
    schema = ", ".join(f"{n} {t}" for n, t in pairs.select(*kept).dtypes) + ", linked boolean"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, x_size), (y, y_size) = _rows(batch.column("x"), dims), _rows(batch.column("y"), dims)
            cosine = (x * y).sum(1)
            angle = np.arccos(np.clip(cosine, -1.0, 1.0))
            spread = batch.column("x_radius").to_numpy() + batch.column("y_radius").to_numpy()
            all_, none = angle + spread <= theta - _SLACK, angle - spread > theta + _SLACK
            all_, none = np.where(spread == 0, cosine >= threshold, all_), np.where(spread == 0, cosine < threshold, none)
            none |= (x_size != y_size) & (spread == 0)
            linked = pa.array(all_ & ~none, mask=~(all_ | none))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], linked], [*kept, "linked"])

    return pairs.mapInArrow(compare, schema)


def linked_classes(nodes: DataFrame, dims: int, points: int, tables: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) between classes, and additions (node or NULL, cls, links) to the links of a node or of all of a class."""
    ball = F.col("centre").isNotNull()
    balls = nodes.filter(ball).groupBy("cls").agg(F.sum("n").alias("n"), F.max("angle").alias("radius"), F.any_value("centre").alias("shown"))
    singles = nodes.filter(~ball).select("cls", "n", F.lit(0.0).alias("radius"), F.col("embedding").alias("shown"))
    kind = dict(singles.dtypes)["shown"]
    classes = singles.unionByName(balls.withColumn("shown", F.col("shown").cast(kind)))

    def beside(pairs: DataFrame, own: str, name: str) -> DataFrame:
        """`pairs` with the shown vector, radius and count of the class in the column `own`."""
        of = classes.select(
            F.col("cls").alias("beside"), F.col("n").alias(f"{name}_n"), F.col("radius").alias(f"{name}_radius"),
            F.col("shown").alias(name),
        )
        return pairs.join(of, F.col(own) == F.col("beside")).drop("beside")

    met = stored(_meetings(nodes, dims, points, tables, threshold), "vector-meetings")
    compared = _compare(beside(beside(met, "a", "x"), "b", "y"), dims, threshold)
    first = stored(compared.filter("linked is null or linked"), "class-links")
    whole = first.filter("linked")

    # Undecided: the members of one ball, the one with more vectors where both are, against the other class.
    open_ = first.filter(F.col("linked").isNull())
    flip = (F.col("b") < 0) & ((F.col("a") >= 0) | (F.col("y_n") > F.col("x_n")))
    asked = open_.select(F.when(flip, F.col("b")).otherwise(F.col("a")).alias("ball"), F.when(flip, F.col("a")).otherwise(F.col("b")).alias("other"))
    members = nodes.filter(ball).select(
        "node", F.col("cls").alias("of"), "n", F.lit(0.0).alias("radius"), F.col("embedding").alias("shown")
    )
    inside = members.select("node", "of", F.col("n").alias("x_n"), F.col("radius").alias("x_radius"), F.col("shown").alias("x"))
    second = beside(asked.join(inside, F.col("ball") == F.col("of")).drop("of"), "other", "y")
    second = stored(_compare(second, dims, threshold).filter("linked is null or linked"), "member-links")
    near = second.filter("linked")

    # Still undecided: that member against each member of the other ball.
    rest = second.filter(F.col("linked").isNull()).select("ball", "node", "other")
    one = inside.select(F.col("node").alias("one"), "x_n", "x_radius", "x")
    two = members.select(F.col("node").alias("other_node"), "of", F.col("n").alias("y_n"), F.col("radius").alias("y_radius"), F.col("shown").alias("y"))
    third = rest.join(one, F.col("node") == F.col("one")).drop("one").join(two, F.col("other") == F.col("of")).drop("of")
    third = stored(_compare(third, dims, threshold).filter("linked"), "vector-links")

    none = F.lit(None).cast("long")
    edges = whole.select("a", "b").unionByName(near.select(F.col("ball").alias("a"), F.col("other").alias("b"))).unionByName(
        third.select(F.col("ball").alias("a"), F.col("other").alias("b"))
    )
    more = [
        whole.select(none.alias("node"), F.col("a").alias("cls"), F.col("y_n").alias("links")),
        whole.select(none.alias("node"), F.col("b").alias("cls"), F.col("x_n").alias("links")),
        near.select("node", none.alias("cls"), F.col("y_n").alias("links")),
        near.select(none.alias("node"), F.col("other").alias("cls"), F.col("x_n").alias("links")),
        third.select("node", none.alias("cls"), F.col("y_n").alias("links")),
        third.select(F.col("other_node").alias("node"), none.alias("cls"), F.col("x_n").alias("links")),
    ]
    return edges.distinct(), reduce(DataFrame.unionByName, more)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding).

    Links are pairs of rows whose cosine is `threshold` or more; none below it counts, and about one in a thousand
    at the threshold is not found, fewer the closer they are. `component_id` is the smallest vec_id that can be
    reached, and its row is kept. Vectors that are NULL, empty or all zero, or hold a NULL or a component that is
    not finite, link with nothing, nor do vectors of different lengths with each other. Rows that repeat an
    identifier are rows of their own. A NULL identifier counts as a link and is kept only where its whole component has
    none. Other columns may have any name. An empty table gives an empty result.
    """
    rows = stored(_keyed(vectors), "vectors")
    groups = (
        rows.filter(F.col("vector_key").isNotNull())
        .groupBy("vector_key")
        .agg(F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("n"), F.any_value("embedding").alias("embedding"))
    )
    distinct = stored(groups.select(F.monotonically_increasing_id().alias("node"), "*"), "distinct-vectors")
    count, dims = distinct.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    dims = dims or 1
    points, tables = design(count)
    nodes = stored(_balls(distinct, dims, points + 1, math.acos(threshold) / 2 - _SLACK), "vector-balls")
    edges, more = linked_classes(nodes, dims, points, tables, threshold)
    reached = connected_components(edges).withColumnRenamed("node", "reached")

    of_class = nodes.groupBy(F.col("cls").alias("class_id")).agg(F.sum("n").alias("class_n"), F.min("rep_id").alias("class_rep"))
    added = more.filter(F.col("cls").isNotNull()).groupBy(F.col("cls").alias("added_cls")).agg(F.sum("links").alias("class_links"))
    of_class = of_class.join(added, F.col("class_id") == F.col("added_cls"), "left").join(reached, F.col("class_id") == F.col("reached"), "left")
    of_class = stored(
        of_class.select(
            "class_id", "class_rep", F.coalesce("component", "class_id").alias("component"),
            (F.col("class_n") - 1 + F.coalesce("class_links", F.lit(0))).alias("class_links"),
        ),
        "vector-classes",
    )
    smallest = of_class.groupBy(F.col("component").alias("of")).agg(F.min("class_rep").alias("component_id"))
    of_class = of_class.join(smallest, F.col("component") == F.col("of"))
    own = more.filter(F.col("node").isNotNull()).groupBy(F.col("node").alias("own_node")).agg(F.sum("links").alias("own_links"))
    found = (
        nodes.select("node", "cls", F.col("vector_key").alias("found_key"))
        .join(of_class, F.col("cls") == F.col("class_id"))
        .join(own, F.col("node") == F.col("own_node"), "left")
        .select("found_key", (F.col("class_links") + F.coalesce("own_links", F.lit(0))).alias("n_links"), "component_id")
    )
    joined = rows.select("vec_id", "vector_key").join(found, F.col("vector_key") == F.col("found_key"), "left")
    component = F.when(F.col("found_key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
