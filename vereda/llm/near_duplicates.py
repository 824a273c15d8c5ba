"""Near-duplicate documents by fast similarity sketching, banding and exact checks.

A sketch (Dahlgaard, Knudsen and Thorup, 2017) throws all elements of a set into
its bins, round after round, until every bin holds its smallest value of the first
round that reached it; a last series of rounds visits each bin by itself, so every
coordinate fills and estimates concentrate as with independent minima.

Documents with one set are one node. Nodes that share a band are candidates, but
the members of a bucket are never paired with each other: they are compared with
pivots of the bucket, and only members of different components that remain are
compared further, in cells of bounded size. Every link is confirmed on full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, gram_hashes, hashed_words, mixed, n_words, raw, slices, stretches
from vereda.session import discard, materialize

catalog = Catalog()

#: sketch coordinates; bands of coordinates. A pair at 0.8 misses all bands with odds of 3e-9
COORDINATES, BANDS, ROWS = 256, 50, 5
#: coordinates that a pair at 0.8 has in common but for odds of 1e-8
LEAST_EQUAL = 169
CELL = 512
SIMILARITY = 80
#: what tells rows with another id or text apart
KEY, KEY_TYPES = ["_no_id", "_id", "_h1", "_h2"], "_no_id boolean, _id long, _h1 long, _h2 long"


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of ``width`` words of each text, and their text, sorted by
    text and hash; a text of fewer words has all of them as one, a text of none nothing."""
    h, owner = hashed_words([t.lower() for t in texts])
    counts = np.bincount(owner, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    values, owners = [], []
    for n in range(1, width + 1):
        g = gram_hashes(h, n)
        if n == width:
            at = np.flatnonzero(owner[: len(g)] == owner[n - 1 :][: len(g)])
            values.append(g[at])
        else:
            at = starts[counts == n]
            values.append(mixed(~g[at]))
        owners.append(owner[at])
    values, owners = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (np.diff(values) != 0) | (np.diff(owners) != 0)
    return values[new], owners[new]


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two hashes of each whole set; 0 for empty ones."""
    keys = np.zeros((len(sizes), 2), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        heads = (np.cumsum(sizes) - sizes)[some]
        keys[some, 0] = np.add.reduceat(mixed(values), heads)
        keys[some, 1] = np.add.reduceat(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), heads)
    return keys.view(np.int64)


def sketches(values: np.ndarray, owners: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """The ``t`` coordinates of ``n`` sets; rows of empty sets stay at the largest value."""
    shift = np.uint64(64 - (t.bit_length() - 1))
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    cells = np.full(n * t, empty)
    left = np.full(n, t)
    for r in range(2 * t):
        active = left[owners] > 0
        if not active.all():
            values, owners = values[active], owners[active]
        if not len(values):
            break
        x = mixed(values + np.uint64((0x9E3779B97F4A7C15 * (r + 1)) & 0xFFFFFFFFFFFFFFFF))
        bins = (x >> shift).astype(np.int64) if r < t else np.full(len(x), r - t)
        at = owners * t + bins
        free = cells[at] == empty
        at, x = at[free], mixed(x[free] ^ np.uint64(r)) >> np.uint64(1)
        np.minimum.at(cells, at, x)
        filled = np.unique(at)
        left -= np.bincount(filled // t, minlength=n)
    return cells.reshape(n, t)


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` with all columns, ``doc_id, text`` and ``_no_id, _id, _h1, _h2``, which rows
    with one id and text share and no others. Names inside ``row`` can't clash."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2"),
    )


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``_no_id, _id, _h1, _h2, n_shingles, k1, k2, bands, small`` per row of ``keyed``: set
    size, two hashes of the whole set, a key per band, and a byte per coordinate. A band's
    key is the bytes of its coordinates and its number, so that ``small`` tells all keys."""
    places = np.uint64(8) * np.arange(1, ROWS + 1, dtype=np.uint64)

    def run(batches):
        for b in slices(batches):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            values, owners = shingle_sets(texts, width)
            n = len(texts)
            sizes = np.bincount(owners, minlength=n)
            cells = sketches(values, owners, n)
            keys = set_keys(values, sizes)
            cells &= np.uint64(255)
            parts = cells[:, : BANDS * ROWS].reshape(n, BANDS, ROWS)
            bands = (parts << places).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
            ends = np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)
            small = [x.tobytes() for x in cells.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in KEY), pa.array(sizes.astype(np.int64)), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.reshape(-1).view(np.int64))), pa.array(small, pa.binary())],
                names=[*KEY, "n_shingles", "k1", "k2", "bands", "small"],
            )

    return raw(docs, *KEY).mapInArrow(run, f"{KEY_TYPES}, n_shingles long, k1 long, k2 long, bands array<long>, small binary")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, n, members``: the sorted shingle hashes of the nodes (``node, k1, k2,
    n_shingles`` and ``first``, the key of a row that has the set)."""

    def run(batches):
        for b in slices(batches):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            values, owners = shingle_sets(texts, width)
            sizes = np.bincount(owners, minlength=len(texts))
            keys = set_keys(values, sizes)
            parts = np.split(values, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sizes.astype(np.int64)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["k1", "k2", "n", "members"])

    wanted = raw(docs, *KEY).join(nodes.select("first.*"), KEY, "left_semi").dropDuplicates(KEY)
    sets = wanted.select("doc_id", "text").mapInArrow(run, "k1 long, k2 long, n long, members binary")
    return sets.join(nodes.select("node", "k1", "k2", F.col("n_shingles").alias("n")), ["k1", "k2", "n"]).select("node", "n", "members").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets have 100 * common >= 80 * together."""

    def run(batches):
        for batch in batches:
            a, b, keep = [], [], []
            for x, y, mx, my in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ma", "mb")), strict=True):
                p, q = np.frombuffer(mx, np.uint64), np.frombuffer(my, np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                a.append(x), b.append(y), keep.append(100 * common >= SIMILARITY * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    small = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SIMILARITY
    return (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("members").alias("mb")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("members").alias("ma")), "a")
        .where(small).select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node with a link, by large
    and small stars (Kiveris et al., 2014), each round a stored table."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "star-0")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        last, edges = edges, materialize(small.select("e.u", "e.v").where("u != v").distinct(), "star")
        discard(last)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many coordinates each row of ``x`` shares with each row of ``y``."""
    return np.stack([(y == row).sum(1) for row in x])


def met_before(x: np.ndarray, y: np.ndarray, band: int) -> np.ndarray:
    """Which rows of ``y`` share a band before ``band`` with the row ``x``."""
    return (y[:, : band * ROWS] == x[: band * ROWS]).reshape(len(y), band, ROWS).all(2).any(1)


def pivot_pairs(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, if their components differ."""
    pivots = buckets.groupBy("key").agg(
        F.min(F.struct(F.xxhash64(F.lit(0), "node").alias("h"), "node", "component", "small")).alias("p"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low != high").select("key", F.col("p.node").alias("pivot"), F.col("p.component").alias("pivot_component"), F.col("p.small").alias("pivot_small"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("small", "pivot_small"))
                near = (x == y).sum(1) >= LEAST_EQUAL
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(near))

    pairs = buckets.join(pivots, "key").where("component != pivot_component")
    pairs = pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "small", "pivot_small")
    return pairs.mapInArrow(run, "a long, b long").distinct()


def common_members(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """The number of elements that each set of ``x`` shares with each of ``y``."""
    sizes = np.array([len(p) // 8 for p in x + y])
    flat, owner = np.frombuffer(b"".join(x + y), np.uint64), np.repeat(np.arange(len(sizes)), sizes)
    values, code = np.unique(flat, return_inverse=True)
    mine = owner < len(x)
    shared = np.zeros(len(values), bool)
    shared[code[mine]] = True
    shared[np.setdiff1d(np.arange(len(values)), code[~mine])] = False
    number = np.cumsum(shared) - 1
    held = shared[code]
    code, owner = number[code[held]], owner[held]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out, width = np.zeros((len(x), len(y)), np.float32), 4096
    for start in range(0, int(shared.sum()), width):
        a, z = np.searchsorted(code, [start, start + width])
        has = np.zeros((len(sizes), width), np.float32)
        has[owner[a:z], code[a:z] - start] = 1
        out += has[: len(x)] @ has[len(x) :].T
    return out


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links ``a, b``, taken in order, join two groups."""
    above: dict[int, int] = {}

    def root(v: int) -> int:
        while above.setdefault(v, v) != v:
            above[v] = v = above[above[v]]
        return v

    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            above[x], keep[i] = y, True
    return keep


def cell_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components in all buckets that still have several.

    The members outside one component of the bucket meet all members, in cells of
    at most two times ``CELL`` expected rows. A pair that shares several bands counts
    in the bucket of the first only. A cell first compares sketches; only those that
    may be alike get their sets, which then decide each pair exactly. The cell gives
    out only links that join components: fewer than its rows, however many pairs it
    holds.
    """
    lead = buckets.groupBy("key").agg(
        F.min(F.struct(F.xxhash64(F.lit("lead"), "node").alias("h"), "component")).alias("p"), F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("m")
    ).where("low != high").select("key", F.col("p.component").alias("lead"), "m")
    rows = buckets.join(lead, "key")
    sides = rows.where("component != lead").groupBy("key").agg(F.count(F.lit(1)).alias("u"))
    rows = rows.join(sides, "key")
    us, ms = F.ceil(F.col("u") / CELL).cast("int"), F.ceil(F.col("m") / CELL).cast("int")
    place = lambda n: F.pmod(F.xxhash64(F.lit("cell"), "node"), n).cast("int")
    out = ["key", "node", "component", "n", "small"]
    everyone = rows.select(*out, F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), us - 1)).alias("i"), place(ms).alias("j"))
    others = rows.where("component != lead").select(*out, F.lit(1).alias("side"), place(us).alias("i"), F.explode(F.sequence(F.lit(0), ms - 1)).alias("j"))
    at = ["key", "i", "j"]
    cells = everyone.union(others).repartition(*at).sortWithinPartitions(*at, "side")

    def near(cell):
        node, comp, n, side = (cell.column(c).to_numpy() for c in ("node", "component", "n", "side"))
        small = np.frombuffer(b"".join(cell.column("small").to_pylist()), np.uint8).reshape(len(node), -1)
        x, y = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        if not len(x) or not len(y):
            return x, y, np.zeros((len(x), len(y)), bool)
        ok = (alike(small[x], small[y]) >= LEAST_EQUAL) & (comp[x][:, None] != comp[y][None, :])
        ok &= np.minimum(n[x][:, None], n[y]) * 100 >= np.maximum(n[x][:, None], n[y]) * SIMILARITY
        band = cell.column("key")[0].as_py() & 255
        for i in np.flatnonzero(ok.any(1)):
            j = np.flatnonzero(ok[i])
            ok[i, j] = ~met_before(small[x[i]], small[y[j]], band)
        return x[ok.any(1)], y[ok.any(0)], ok[ok.any(1)][:, ok.any(0)]

    def maybe(batches):
        for cell in stretches(batches, at):
            x, y, _ = near(cell)
            if len(x):
                yield from cell.take(pa.array(np.sort(np.append(x, y)))).combine_chunks().to_batches()

    schema = "key long, node long, component long, n long, small binary, side int, i int, j int"
    hopeful = materialize(cells.select(*out, "side", "i", "j").mapInArrow(maybe, schema), "near-cells")

    def decide(batches):
        for cell in stretches(batches, at):
            x, y, ok = near(cell)
            if not len(x):
                continue
            node, comp, n = (cell.column(c).to_numpy() for c in ("node", "component", "n"))
            members = cell.column("members")
            common = common_members(members.take(pa.array(x)).to_pylist(), members.take(pa.array(y)).to_pylist())
            i, j = np.nonzero(ok & (100 * common >= SIMILARITY * (n[x][:, None] + n[y] - common)))
            keep = spanning(comp[x][i], comp[y][j])
            a, b = node[x][i[keep]], node[y][j[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    whole = hopeful.join(sets.select("node", "members"), "node").repartition(*at).sortWithinPartitions(*at, "side")
    links = materialize(whole.mapInArrow(decide, "a long, b long").distinct(), "near-cell-links")
    discard(hopeful)
    return links


def linked_sets(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` from ``keyed``: the sketched rows, and ``k1, k2, n_shingles, first``
    per distinct set that is not empty. ``first`` is the key of the row with the smallest id, rows
    without one last, of all rows whose sets are linked to this one."""
    sketches_of = materialize(sketched(docs, width), "near-sketches")
    sets_of = sketches_of.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(
        F.min(F.struct(*KEY)).alias("first"), F.first("bands").alias("bands"), F.first("small").alias("small")
    )
    classes = materialize(sets_of.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    table = materialize(sketches_of.drop("bands", "small"), "near-rows")
    discard(sketches_of)
    members = classes.select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    buckets = materialize(
        members.join(shared, "key").join(classes.select("node", F.col("n_shingles").alias("n"), "small"), "node"), "near-buckets"
    )
    nodes = materialize(classes.select("node", "k1", "k2", "n_shingles", "first"), "near-nodes")
    discard(classes)
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi")
    sets = materialize(full_sets(docs, wanted, width), "near-sets")
    # a large group has a pivot in each of its buckets; the cells decide what these leave
    pairs = materialize(pivot_pairs(buckets.withColumn("component", F.col("node"))), "near-pairs")
    found = materialize(confirmed(pairs, sets), "near-links")
    labels = None if found.isEmpty() else components(found)
    if labels is None:
        now = buckets.withColumn("component", F.col("node"))
    else:
        now = buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = cell_links(now, sets)
    if not more.isEmpty():
        # components so far stand in for the links that made them
        if labels is not None:
            more = more.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = components(more)
    discard(buckets, sets, pairs, found)
    if labels is None:
        return table, nodes.drop("node")
    nodes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = nodes.groupBy("component").agg(F.min("first").alias("first"))
    return table, nodes.drop("first").join(firsts, "component").select("k1", "k2", "n_shingles", "first")


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row, by shingles of ``width`` words.

    Every distinct set is a node, whatever the ids of its rows; ``component_id`` is the
    smallest id among the linked rows, NULL if none has an id. Then the rows of one
    text are kept. NULL and blank texts have an empty set and stay by themselves. A row
    that repeats another in full has its result. Other columns are ignored.
    """
    table, sets = linked_sets(keyed(docs.select("doc_id", "text")), width)
    own = table.where("n_shingles > 0").select(*KEY, "n_shingles", "k1", "k2").join(sets, ["k1", "k2", "n_shingles"])
    one = F.when(F.col("_no_id"), F.struct(*KEY) == F.col("first")).otherwise(F.col("_id") == F.col("first._id"))
    linked = own.select(
        F.when(~F.col("_no_id"), F.col("_id")).alias("doc_id"), "n_shingles", F.when(~F.col("first._no_id"), F.col("first._id")).alias("component_id"), one.alias("kept")
    )
    empty = table.where("n_shingles = 0").select(F.when(~F.col("_no_id"), F.col("_id")).alias("doc_id"), "n_shingles")
    return linked.union(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def one_of_each(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each component, the first by id, with all its columns, whatever their
    names. Rows without words stay, but one of those that share an id and text."""
    rows = keyed(docs)
    _, sets = linked_sets(keyed(docs.select("doc_id", "text")), width)
    blank = n_words(F.col("text")) == 0
    firsts = sets.select("first.*").distinct()
    chosen = rows.where(~blank).join(firsts, KEY, "left_semi").select(*rows.columns).union(rows.where(blank & ~F.col("_no_id"))).dropDuplicates(KEY)
    return chosen.union(rows.where(blank & F.col("_no_id"))).select("row.*")


@catalog.add("""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> '') as ws
  from documents),
s as (
  select doc_id, case when len(ws) = 0 then [] when len(ws) = 1 then ws
    else list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) end as sh from w),
x as (select doc_id, len(sh) as n, unnest(sh) as g from s),
common as (
  select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as c
  from x a join x b on a.g = b.g and a.doc_id < b.doc_id and a.n * 100 >= b.n * 80 and b.n * 100 >= a.n * 80 group by all),
link as (select a, b from common where 100 * c >= 80 * (na + nb - c)),
edge as (select a, b from link union all select b, a from link),
reach(a, b) as (select doc_id, doc_id from documents union select reach.a, edge.b from reach join edge on reach.b = edge.a)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, r.c as component_id, r.c = s.doc_id as kept
from s join (select a, min(b) as c from reach group by a) r on r.a = s.doc_id
""")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their components at a similarity of 0.8 of 2-word shingles."""
    return near_duplicates(documents(spark, sf_dir), 2)
