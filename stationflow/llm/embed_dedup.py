"""Near-duplicate embeddings by products of int8 tiles with rigorous error bounds.

Each vector, scaled to length 1, is x = s q + e with integers q in -127..127. With a = |s q| and r = |e|, both
measured, the product of two vectors differs from s s' (q.q') by at most a r' + r a' + r r'. The integer product is exact in
single precision up to 1040 dimensions (in double beyond). A pair surely below the threshold is dropped, one surely
above is a link, and only the rest is computed again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.bytesops import matrices
from stationflow.llm.common import written
from stationflow.llm.graph import components

BLOCK = 2048
# Blocks that travel together: at most so many, and about so many bytes of them.
BAND = 8
BAND_BYTES = 32 << 20
STRIP = 512
PIVOTS = 256
PAIRS = 1 << 16
# Room for rounding in double precision, taken into every bound.
ROUNDING = 1e-9


def usable(vector: str | Column) -> Column:
    """Neither null, empty nor zero, every component present and finite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by their largest component first, so that squares neither vanish nor overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return (unit(x.astype(np.float64)) * unit(y.astype(np.float64))).sum(axis=1)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, lengths of the coded vectors and of what the codes leave out."""
    scale = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    rest = vectors - coded
    return codes, scale, np.sqrt((coded**2).sum(axis=1)), np.sqrt((rest**2).sum(axis=1))


class Block:
    """Vectors that meet other blocks as one side of a tile."""

    def __init__(self, row, exact: type) -> None:
        self.ids = np.frombuffer(row.ids, np.int64)
        self.copies = np.frombuffer(row.copies, np.int64)
        self.vectors = np.frombuffer(row.vectors, exact).reshape(len(self.ids), -1)
        self.codes = np.frombuffer(row.codes, np.int8).reshape(len(self.ids), -1)
        self.scale, self.coded, self.rest = np.frombuffer(row.bounds, np.float64).reshape(3, -1)
        self.centre, self.width = np.array(row.centre), row.width

    def reaches(self, other: Block, angle: float) -> bool:
        """Whether some vector of the other block may be within the angle of one of this."""
        return self is other or angle_of(self.centre, other.centre) - self.width - other.width <= angle

    def product_codes(self) -> np.ndarray:
        return self.codes.astype(np.float32 if self.codes.shape[1] <= 1040 else np.float64)


def angle_of(x: np.ndarray, y: np.ndarray) -> float:
    return float(np.arccos(np.clip(x @ y, -1, 1)))


def centred(vectors: np.ndarray, widths: np.ndarray | float = 0.0) -> tuple[np.ndarray, float]:
    """A centre of length 1 and the angle around it that holds all vectors, each with its own width."""
    centre = vectors.sum(axis=0)
    centre = centre / length if (length := np.sqrt((centre**2).sum())) > 1e-9 else vectors[0]
    return centre, float((np.arccos(np.clip(vectors @ centre, -1, 1)) + widths).max())


def _links(a: Block, b: Block, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, rows of b) at the threshold or above, strip by strip."""
    right = b.product_codes().T.copy()
    left = a.product_codes()
    wide_coded, wide_rest = b.coded.max(), b.rest.max()
    for low in range(0, len(a.ids), STRIP):
        rows = slice(low, low + STRIP)
        product = left[rows] @ right
        product *= b.scale.astype(np.float32)
        slack = a.coded[rows] * wide_rest + a.rest[rows] * (wide_coded + wide_rest) + 1e-5
        i, j = np.nonzero(product >= ((threshold - slack) / a.scale[rows]).astype(np.float32)[:, None] * np.float32(1 - 1e-6))
        i = i + low
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), PAIRS):
            u, v = i[part : part + PAIRS], j[part : part + PAIRS]
            whole = np.einsum("ij,ij->i", a.codes[u].astype(np.float64), b.codes[v].astype(np.float64))
            about = whole * a.scale[u] * b.scale[v]
            bound = a.coded[u] * b.rest[v] + a.rest[u] * (b.coded[v] + b.rest[v]) + ROUNDING
            linked = about - bound >= threshold
            unsure = np.flatnonzero(~linked & (about + bound >= threshold))
            linked[unsure] = cosines(a.vectors[u[unsure]], b.vectors[v[unsure]]) >= threshold
            yield u[linked], v[linked]


def joined_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of u[k] and v[k]; a label is the smallest index of its class."""
    while True:
        x, y = label[u], label[v]
        apart = x != y
        if not apart.any():
            return label
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def linked(rows: DataFrame, threshold: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Of (id, copies, vector) with one row per distinct vector: (id, n) with n the copies linked to it, and (u, v)
    links that connect the same rows as all links do.

    Vectors are dealt to clusters around at most PIVOTS vectors and, by a hash, to blocks of about BLOCK rows, so
    a crowded cluster is only more blocks. The blocks of a cluster travel in bands, and a task takes a pair of bands. Pairs
    of clusters, bands and blocks are left out when the angle between their centres, less their widths, exceeds the
    threshold's angle. Pairs are found by joins; only the pivots are on the driver.
    Only vectors of the same length meet.
    """
    spark = rows.sparkSession
    n = rows.count()
    wanted = max(1, min(PIVOTS, n // (BLOCK * BAND // 2)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vector").toPandas()["vector"]
    pivots = [unit(np.array([x], np.float64))[0] for x in sample]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.zeros(batch.num_rows, np.int64)
            for at, vectors in matrices(batch.column(2)):
                same = [p for p in pivots if len(p) == vectors.shape[1]]
                if same:
                    best[at] = np.argmax(unit(vectors.astype(np.float64)) @ np.array(same).T, axis=1)
            yield batch.append_column("cluster", pa.array(best))

    kind = rows.schema["vector"].dataType
    exact = np.float32 if kind.elementType == T.FloatType() else np.float64
    schema = T.StructType([*rows.select("id", "copies", "vector").schema, T.StructField("cluster", T.LongType())])
    dealt = written(rows.select("id", "copies", "vector").mapInArrow(near, schema), "dealt")
    sizes = dealt.groupBy("cluster", F.size("vector").alias("dims")).count().withColumn("parts", F.ceil(F.col("count") / BLOCK))
    sizes = written(sizes.select(F.col("cluster").alias("c"), F.col("dims").alias("d"), "parts"), "sizes")
    placed = dealt.join(sizes, (F.col("cluster") == F.col("c")) & (F.size("vector") == F.col("d")))
    placed = placed.select("id", "copies", "vector", "c", "d", F.pmod(F.xxhash64("id"), "parts").alias("part"))
    packed_type = "d int, c long, part long, ids binary, copies binary, vectors binary, codes binary, bounds binary, centre array<double>, width double"

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        originals = np.array(frame["vector"].tolist(), exact)
        vectors = unit(originals.astype(np.float64))
        codes, *bounds = quantised(vectors)
        centre, width = centred(vectors)
        blobs = [x.tobytes() for x in (frame["id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64), originals, codes, np.stack(bounds))]
        return pd.DataFrame([[*map(int, key), *blobs, centre, width]], columns=[x.split()[0] for x in packed_type.split(", ")])

    blocks = written(placed.groupBy("d", "c", "part").applyInPandas(pack, packed_type), "blocks")
    near_enough = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6
    room = F.floor(F.lit(BAND_BYTES) / (BLOCK * (np.dtype(exact).itemsize + 1) * F.col("d")))
    blocks = blocks.withColumn("band", F.floor(F.col("part") / F.greatest(F.lit(1), F.least(F.lit(BAND), room))))

    def ball(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        d, c, band = map(int, key)
        centre, width = centred(np.array(frame["centre"].tolist()), frame["width"].to_numpy())
        of = [p for p in pivots if len(p) == d]
        # Lengths without a pivot are one cluster, which meets itself alone.
        reach = angle_of(of[c], centre) + width if of else 0.0
        return pd.DataFrame([[d, c, band, centre, width, reach]], columns=["d", "c", "band", "centre", "width", "reach"])

    small = blocks.select("d", "c", "part", "band", "centre", "width")
    bands = small.groupBy("d", "c", "band").applyInPandas(ball, "d int, c long, band long, centre array<double>, width double, reach double")
    bands = written(bands, "bands")
    reaches = written(bands.groupBy("d", "c").agg(F.max("reach").alias("reach")), "reaches")
    by_length: dict[int, list[np.ndarray]] = {}
    for p in pivots:
        by_length.setdefault(len(p), []).append(p)
    # At most PIVOTS squared entries.
    apart = [(d, x, y, angle_of(of[x], of[y])) for d, of in by_length.items() for y in range(len(of)) for x in range(y)]
    apart = spark.createDataFrame(apart, "d int, c1 long, c2 long, apart double")
    clusters = apart.join(reaches.select("d", F.col("c").alias("c1"), F.col("reach").alias("r1")), ["d", "c1"])
    clusters = clusters.join(reaches.select("d", F.col("c").alias("c2"), F.col("reach").alias("r2")), ["d", "c2"])
    clusters = clusters.where(F.col("apart") - F.col("r1") - F.col("r2") <= near_enough).select("d", "c1", "c2")
    clusters = clusters.unionByName(reaches.select("d", F.col("c").alias("c1"), F.col("c").alias("c2")))
    one, two = ([F.col(x).alias(f"{x}{k}") for x in ("c", "band", "centre", "width")] for k in (1, 2))
    pairs = clusters.join(bands.select("d", *one), ["d", "c1"]).join(bands.select("d", *two), ["d", "c2"])
    product = F.aggregate(F.zip_with("centre1", "centre2", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product))) - F.col("width1") - F.col("width2")
    itself = (F.col("c1") == F.col("c2")) & (F.col("band1") == F.col("band2"))
    pairs = pairs.where((F.col("c1") < F.col("c2")) | (F.col("band1") < F.col("band2")) | itself)
    pairs = pairs.where(itself | (between <= near_enough)).select("d", "c1", "band1", "c2", "band2", itself.alias("itself"))
    pairs = written(pairs.withColumn("tile", F.monotonically_increasing_id()), "pairs")
    ends = pairs.select("d", F.col("c1").alias("c"), F.col("band1").alias("band"), "tile", F.lit(1).alias("side"))
    ends = ends.unionByName(pairs.where(~F.col("itself")).select("d", F.col("c2").alias("c"), F.col("band2").alias("band"), "tile", F.lit(2).alias("side")))
    sides = blocks.join(ends, ["d", "c", "band"]).select("tile", "side", "part", "ids", "copies", "vectors", "codes", "bounds", "centre", "width")

    def tile(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "part"])
        side, sorted_blocks = frame["side"].to_numpy(), [Block(row, exact) for row in frame.itertuples()]
        ids = np.concatenate([b.ids for b in sorted_blocks])
        start = np.r_[0, np.cumsum([len(b.ids) for b in sorted_blocks])]
        alone = side[0] == side[-1]
        counts, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for x, a in enumerate(sorted_blocks):
            for y, b in enumerate(sorted_blocks[x:], x):
                if (alone or side[x] != side[y]) and a.reaches(b, near_enough):
                    for u, v in _links(a, b, x == y, threshold):
                        np.add.at(counts, u + start[x], b.copies[v])
                        np.add.at(counts, v + start[y], a.copies[u])
                        label = joined_labels(label, u + start[x], v + start[y])
        some = np.flatnonzero(counts)
        return pd.DataFrame({"id": ids[some], "root": ids[label[some]], "n": counts[some]})

    found = written(sides.groupBy("tile").applyInPandas(tile, "id long, root long, n long"), "tiles")
    return found.groupBy("id").agg(F.sum("n").alias("n")), found.select(F.col("id").alias("u"), F.col("root").alias("v"))


def near_duplicates(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component): links between rows whose cosine, in double precision, is `threshold` or more.

    Equal vectors are one node with a count, so a large group of copies costs one row. Vectors that are null,
    empty or zero or hold null or non-finite components link with nothing: no links, the row's own id as component. The same
    holds for rows with a null id. Rows that share an id are one node of the graph, and their links are counted apart.
    """
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    valid = F.col("id").isNotNull() & usable("vector")
    rows = rows.withColumns({"h1": F.when(valid, F.xxhash64("vector")), "h2": F.when(valid, F.xxhash64(F.reverse("vector")))})
    rows = written(rows, "rows")
    classes = rows.where("h1 is not null").groupBy("h1", "h2")
    classes = written(classes.agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "classes")
    counts, links = linked(classes.select(F.col("node").alias("id"), "copies", "vector"), threshold)
    found = components(links).withColumnRenamed("node", "in_id")
    known = classes.select("h1", "h2", "node", "copies").join(counts.withColumnRenamed("id", "of"), F.col("node") == F.col("of"), "left")
    known = known.join(found, F.col("node") == F.col("in_id"), "left")
    known = written(
        known.select(
            F.col("h1").alias("k1"),
            F.col("h2").alias("k2"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "known",
    )
    joined = rows.select("id", "h1", "h2").join(known, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    return joined.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "id").alias("component"))
