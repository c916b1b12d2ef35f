"""SimHash fingerprints, and exact tiled comparison of those that may be near."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import slices
from delayflow.llm.components import connected
from delayflow.operators.joins import join_dimension
from delayflow.workspace import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
# Fingerprints in a tile; a pair of tiles is one piece of work.
TILE = 1_024
# Hashes whose bits are unpacked at once.
BLOCK = 65_536

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles of a text in order, repeats included; none without words."""
    # Bytes split at the six ASCII white-space characters alone.
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, np.dtype("<u8"))
    joined = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
    ends = ends[width - 1 :]
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(view[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())),
        np.dtype("<u8"),
        len(ends),
    )


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without words."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    # A bit takes a byte when unpacked, so long texts are summed in blocks.
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over_half = 2 * ones > len(hashes)
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id and fingerprint (long) of each row; NULL texts are empty."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("fingerprint", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=schema.names
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _bands(radius: int) -> list[tuple[int, int]]:
    """Shift and mask of ``radius + 1`` parts of the bits.

    Values that differ in ``radius`` bits at most agree in one part at least.
    """
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def tile_units(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Rows of work: each fingerprint in every unit in which it has to be compared.

    Fingerprints that agree in a part of their bits form a group. A group of at most ``tile``
    is one unit. A larger one is cut into tiles of one population count each; a unit is then
    a pair of tiles, and pairs whose counts differ beyond the radius are not made at all.
    """
    value = F.col("fingerprint")
    parts = [
        F.struct(
            F.lit(i).alias("band"),
            F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(mask)).alias("part"),
        )
        for i, (shift, mask) in enumerate(_bands(radius))
    ]
    keyed = prints.select(value, F.explode(F.array(*parts)).alias("_p")).select(
        "fingerprint", F.col("_p.band").alias("band"), F.col("_p.part").alias("part"),
        F.bit_count(value).alias("ones"),
    )
    counts = keyed.groupBy("band", "part", "ones").agg(F.count("*").alias("n"))
    # At most 65 population counts meet in a group.
    tiles = F.map_from_entries(
        F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    )
    groups = (
        counts.groupBy("band", "part")
        .agg(F.sum("n").alias("_n"), tiles.alias("_tiles"))
        .filter(F.col("_n") > 1)
        .withColumn("_tiles", F.when(F.col("_n") > tile, F.col("_tiles")))
    )
    placed = join_dimension(keyed, groups, ["band", "part"], "inner")
    ones = F.col("ones")

    def tiles_of(count):
        return F.coalesce(F.try_element_at(F.col("_tiles"), count), F.lit(0))

    own = F.pmod(F.xxhash64("fingerprint"), F.greatest(tiles_of(ones), F.lit(1))).cast("int")
    mine = F.struct(ones.alias("ones"), own.alias("tile"))
    others = F.flatten(
        F.transform(
            F.sequence(ones - radius, ones + radius),
            lambda count: F.transform(
                F.filter(F.sequence(F.lit(0), tiles_of(count)), lambda t: t < tiles_of(count)),
                lambda t: F.struct(count.alias("ones"), t.alias("tile")),
            ),
        )
    )
    pairs = F.transform(
        others, lambda other: F.struct(F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b"))
    )
    whole = F.array(
        F.struct(
            F.struct(F.lit(-1).alias("ones"), F.lit(0).alias("tile")).alias("a"),
            F.struct(F.lit(-1).alias("ones"), F.lit(0).alias("tile")).alias("b"),
        )
    )
    unit = F.explode(F.when(F.col("_tiles").isNull(), whole).otherwise(pairs))
    return placed.select("band", "part", unit.alias("unit"), "fingerprint")


def spanning_links(values: np.ndarray, radius: int, step: int = 512) -> list[tuple[int, int]]:
    """Near pairs that join all that near pairs join, at most one fewer than the values.

    Values are ordered by population count and compared tile by tile with exclusive-or and
    bit counts; tile pairs whose counts lie apart beyond the radius are skipped.
    """
    ones = np.bitwise_count(values)
    order = np.argsort(ones, kind="stable")
    values, ones = values[order], ones[order].astype(np.int64)
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for a in range(0, len(values), step):
        last = ones[min(a + step, len(values)) - 1]
        left = values[a : a + step, None]
        for b in range(a, len(values), step):
            if ones[b] - last > radius:
                break
            near = np.bitwise_count(left ^ values[None, b : b + step]) <= radius
            for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
                one, other = root(a + i), root(b + j)
                if one != other:
                    parent[max(one, other)] = min(one, other)
                    links.append((int(values[a + i]), int(values[b + j])))
    return links


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints; their components are those of all
    pairs that differ in at most ``radius`` bits, though not every such pair is given out.
    """
    units = tile_units(prints, radius, tile)
    keys = ["band", "part", "unit"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(key, parts: list[np.ndarray]) -> list[tuple[int, int]]:
            values = np.concatenate(parts).view(np.uint64)
            return spanning_links(values, radius) if len(values) > 1 else []

        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).flatten().flatten()
            names = [n for n in table.column_names if n != "fingerprint"]
            columns = np.stack([np.asarray(table[n], dtype=np.int64) for n in names])
            values = np.asarray(table["fingerprint"], dtype=np.int64)
            cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
            out = []
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
                now = tuple(columns[:, start].tolist())
                if now != key and held:
                    out += linked(key, held)
                    held = []
                key = now
                held.append(values[start:end])
            yield _pairs(out)
        if held:
            yield _pairs(linked(key, held))

    return dealt.mapInArrow(run, schema)


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"]
    )


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """Columns doc_id, fingerprint (long), component and component_id of each document.

    ``component`` is the least fingerprint of the group (as a signed number), ``component_id``
    the least id that near fingerprints reach, a document's own included; groups that share an
    id on several rows may share a ``component_id``, never a ``component``. Only distinct
    fingerprints are compared, so copies cost nothing. Texts without words have fingerprint 0
    and are linked like others. Rows with a NULL id are members but name a component only if it
    has no other id. Repeated rows stay; other columns are not read; no documents give no rows.
    """
    marked = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    first = materialize(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct"
    )
    links = near_links(first.select("fingerprint"), radius)
    nodes = connected(links, "a", "b")
    reached = join_dimension(
        first, nodes.withColumnRenamed("node", "fingerprint"), ["fingerprint"], "left"
    ).withColumn("component", F.coalesce("component", "fingerprint"))
    least = reached.groupBy("component").agg(F.min("first").alias("component_id"))
    named = join_dimension(reached, least, ["component"], "left")
    return join_dimension(
        marked, named.select("fingerprint", "component", "component_id"), ["fingerprint"], "left"
    ).select("doc_id", "fingerprint", "component", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One document of each group of near ones stays, that with the least id.

    Where an id stands on several rows, a row is told by its id and its fingerprint: each group
    keeps the row of its least id, of several the least by fingerprint and then by all
    columns. Rows with a NULL id cannot be named and stay. All columns are kept; empty texts
    are one group; no documents give no rows.
    """
    groups = materialize(near_groups(docs, id_col, text_col, radius), "groups")
    per_id = groups.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("least")
    )
    ids = materialize(per_id.filter("least").select(F.col("doc_id").alias("_kept"), "rows"), "kept")
    key = F.col(f"`{id_col}`")

    def with_ids(wanted: DataFrame) -> DataFrame:
        side = wanted.select(F.col("_kept").alias(id_col))
        return join_dimension(docs, side, [id_col], "left_semi")

    once = with_ids(ids.filter("rows = 1")).unionByName(docs.filter(key.isNull()))
    repeated = ids.filter("rows > 1")
    if repeated.isEmpty():
        return once
    own = groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("component")
    survivors = own.agg(F.min(F.struct("fingerprint", "doc_id")).alias("_least")).select(
        F.col("_least.doc_id").alias("_id"), F.col("_least.fingerprint").alias("_print")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    several = with_ids(repeated).select(key.alias("_id"), F.col(f"`{text_col}`").alias("_text"), row)
    marked = _marked(several)
    reduced = join_dimension(marked, survivors, ["_id", "_print"], "left_semi")
    return once.unionByName(
        reduced.groupBy("_id", "_print").agg(F.min("_row").alias("_row")).select("_row.*")
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Columns _id, _print and _row of rows with columns _id, _text and _row."""
    schema = T.StructType(
        [rows.schema["_id"], T.StructField("_print", T.LongType()), rows.schema["_row"]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64)), batch.column(2)], names=schema.names
            )

    return rows.mapInArrow(run, schema)
