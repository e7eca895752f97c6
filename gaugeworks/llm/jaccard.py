"""N-gram Jaccard join in the metric space of shingle sets, exact.

Two texts link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct word
shingles. Equal sets are one point, named by a 64-bit digest, so copies cost one row each; a second
digest tells whether two sets have one name, and all are named anew then.

Distances between unrelated texts are all close to 1, so whole documents as pivots cannot part
a corpus. The join therefore goes down in three steps, each exact for links:

1. *Size windows.* The empty set is the first pivot; in the metric |A xor B| a set lies at its
   own size. Sizes are cut into ranges, and a set within the triangle window of a range above
   is replicated into it.
2. *Regions in hash ranges.* In a size range, linked sets differ in at most t shingles. The hash
   space is cut into t + s ranges, so linked sets have s parts or more in common. The part of a set
   in one range is a pivot, and its region is every set with exactly that part (radius 0). Parts
   have one order for all sets, by how many shingles they hold. A set is only in the regions of its
   last t + 1 parts in that order: the last common part of linked sets has s - 1 parts before it in
   both, so they share its region. Small parts, which unrelated sets share by chance, fall away.
3. *Pivots inside a region.* Regions of two or more sets get a pivot set: the member of most
   regions, which is the middle of its copies. All members are measured against it. Those within
   the join distance are its ball, already connected. Regions of one pivot go on as one group. What
   is left are pairs that are not in the ball together; the triangle inequality on differences from
   the pivot (see ``_across``) leaves few of them, which are measured one by one. A group of
   up to ``PART`` members does all this inside a task. A larger one recurses over the cluster:
   members outside get a pivot of their own, and so on for some levels. Pairs that the links found
   so far connect, in whatever group, are then left out, and the others meet by their group's
   rarest differences first.

Shingles are compared by 64-bit hashes. No size, bucket or candidate is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import PIECE_BYTES, Shared, pieces, query, table
from gaugeworks.llm.components import components
from gaugeworks.llm.tokens import mix, shingle_sets, split

ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
  FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.doc_id AND r.c < p.b)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(g)
"""

_U = np.uint64
SLACK = 3
#: Members of a group that a task holds; larger groups are dealt out in parts of about so many.
PART = 200
#: Pairs of members that one numpy pass looks at.
CELLS = 1 << 17
#: Steps in which the small groups are worked on: each holds its shuffles only.
SLICES = 2
#: Bits of a difference's hash by which a large group counts its differences.
BUCKET_BITS = 12
#: Parts into which the rows of one component are dealt.
SALTS = 16


def row_key() -> Column:
    """A number for a row by its id and text, equal for repeated rows only."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def digest(own: np.ndarray, salt: int = 0) -> int:
    """Name of a set, as a signed 64-bit number; each salt gives names of its own."""
    return int((np.add.reduce(mix(own ^ mix(np.array([salt], _U)))) ^ _U(len(own))).view(np.int64))


def size_ranges(top: int = 1 << 40) -> np.ndarray:
    bounds = [1]
    while bounds[-1] < top:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 5 // 4))
    return np.array(bounds, np.int64)


_BOUNDS = size_ranges()
_edges: dict[int, np.ndarray] = {}


def spare_ranges(t: int) -> int:
    """Hash ranges beyond the t that may differ. A set's smallest parts, one fewer than these, make
    no region."""
    return SLACK + t // 4


def region_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Region numbers of one set (sorted hashes)."""
    n, sums, out = len(own), None, []
    k = int(np.searchsorted(_BOUNDS, n, "right")) - 1
    while n and _BOUNDS[k] <= n * 100 // percent:
        t = int(_BOUNDS[k + 1] - 1) * (100 - percent) // percent
        if t:  # else only equal sets link
            spare = spare_ranges(t)
            m = t + spare
            if m not in _edges:
                _edges[m] = np.array([i * (1 << 64) // m for i in range(1, m)], _U)
            if sums is None:
                sums = np.zeros(n + 1, _U)
                np.cumsum(mix(own), out=sums[1:])
            at = np.empty(m + 1, np.int64)
            at[0], at[-1] = 0, n
            at[1:-1] = np.searchsorted(own, _edges[m])
            part = np.diff(sums[at])
            keys = mix(part + mix(np.arange(m, dtype=_U) + _U(k << 44)))
            out.append(keys[np.lexsort((keys, np.diff(at)))[spare - 1 :]])
        k += 1
    return np.concatenate(out) if out else np.zeros(0, _U)


def _members(n_words: int, salt: int):
    def each(batches):
        for batch in pieces(batches):
            sets = list(shingle_sets(split(batch.column("text")), n_words))
            names = [[digest(s, k) if len(s) else None for s in sets] for k in (salt, salt + 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("doc_id"),
                    *[pa.array(n, pa.int64()) for n in names],
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                ["key", "doc_id", "node", "other", "n_shingles"],
            )

    return each


def _named(docs: DataFrame, shared: Shared, n_words: int) -> tuple[DataFrame, int]:
    """(key, doc_id, node, n_shingles), and the salt of the names: the first under which no two
    different sets have one name, as far as another name tells them apart."""
    salt = 0
    while True:
        made = docs.mapInArrow(_members(n_words, salt), "key long, doc_id long, node long, other long, n_shingles long")
        members = shared.keep(made, f"members-{salt}")
        names = members.where("node IS NOT NULL").groupBy("node").agg(F.min("other").alias("a"), F.max("other").alias("b"))
        if names.where("a <> b").isEmpty():
            return members.drop("other"), salt
        salt += 2


def _regions(n_words: int, percent: int, salt: int):
    def each(batches):
        for batch in pieces(batches):
            keys, nodes, seen = [np.zeros(0, _U)], [np.zeros(0, np.int64)], set()
            for own in shingle_sets(split(batch.column("text")), n_words):
                if len(own) and (node := digest(own, salt)) not in seen:
                    seen.add(node)
                    keys.append(region_keys(own, percent))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))],
                ["region", "node"],
            )

    return each


def _shared_regions(batches):
    """Rows sorted by (region, node), without repeats: those whose region has another node.
    One row is held back, so a region may be of any size."""
    held, held_kept = np.zeros((0, 2), np.int64), False

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], ["region", "node"])

    for batch in batches:
        rows = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        rows = np.concatenate([held, rows])
        if not len(rows):
            continue
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[new]
        same = rows[1:, 0] == rows[:-1, 0]
        kept = np.zeros(len(rows), bool)
        kept[1:] |= same
        kept[:-1] |= same
        kept[0] |= held_kept and len(held) > 0
        yield out(rows[:-1][kept[:-1]])
        held, held_kept = rows[-1:], bool(kept[-1])
    if len(held) and held_kept:
        yield out(held)


def _packed(batches):
    """Texts as compressed bytes: they go through several shuffles."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [pack((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.binary())], ["key", "packed"])


def _unpacked(batches):
    """Short batches with ``packed`` made ``text`` again."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in pieces(batches, "packed", PIECE_BYTES // 4, 256):
        at = batch.schema.get_field_index("packed")
        texts = pa.array([unpack(t) for t in batch.column(at).to_pylist()], pa.large_binary())
        yield batch.set_column(at, "text", texts.cast(pa.large_string()))


def _beside(pairs: DataFrame, texts: DataFrame, *more: str, heads: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, ...) with the text of b, dealt by a; a's own text stands before, as the pair
    (a, a). Each member's text travels once a pair and the pivot's once a task: pivots of many
    members are dealt out in parts of about ``PART`` pairs. Further columns of ``heads`` (a, ...)
    stand in the pivot's rows only."""
    counted = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    members = pairs.join(counted, "a").select("a", "b", F.expr("pmod(xxhash64(b), parts)").cast("int").alias("part"), *more)
    extra = [] if heads is None else [c for c in heads.columns if c != "a"]
    members = members.select("*", *[F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in extra])
    own = (counted if heads is None else counted.join(heads, "a", "left")).select(
        "a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in more], *extra,
    )
    rows = members.union(own).join(texts.select(F.col("node").alias("b"), "packed"), "b")
    return (
        rows.select("a", "part", F.expr("a <> b").alias("member"), "b", *more, *extra, "packed")
        .repartition("a", "part").sortWithinPartitions("a", "part", "member")
    )


def _measure(n_words: int):
    """Rows of ``_beside`` to (a, b) with the sizes of what both sets share and of both."""

    def each(batches):
        own = None
        for batch in _unpacked(batches):
            found, members = [], []
            sets = shingle_sets(split(batch.column("text")), n_words)
            for i, (other, member) in enumerate(zip(sets, batch.column("member").to_pylist(), strict=True)):
                if not member:
                    own = other
                    continue
                both = len(own) + len(other) - len(np.union1d(own, other))
                found.append((both, len(own) + len(other) - both))
                members.append(i)
            inter, union = np.array(found, np.int64).reshape(-1, 2).T
            rows = pa.array(members, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(rows), batch.column("b").take(rows), pa.array(inter), pa.array(union)],
                ["a", "b", "inter", "whole"],
            )

    return each


def inside(s: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements of the sorted set ``s`` are in ``own``, and which of ``own`` in ``s``."""
    at = np.searchsorted(own, s)
    at[at == len(own)] = 0
    here = own[at] == s
    there = np.zeros(len(own), bool)
    there[at[here]] = True
    return here, there


def difference(s: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Elements of one of two sets only, those of ``s`` first."""
    here, there = inside(s, own)
    return np.concatenate([s[~here], own[~there]])


def _bucket(elements: np.ndarray) -> np.ndarray:
    return (elements >> _U(64 - BUCKET_BITS)).astype(np.int64)


def _bucket_counts(n_words: int):
    """Rows of ``_beside`` to (group, bucket, n): how many differences from the pivot the members
    of a part have in each bucket of hashes."""

    def each(batches):
        group, own, counts = None, None, np.zeros(1 << BUCKET_BITS, np.int64)

        def ready():
            at = np.flatnonzero(counts)
            columns = [pa.array(np.full(len(at), group, np.int64)), pa.array(at.astype(np.int32)), pa.array(counts[at])]
            counts[:] = 0
            return pa.RecordBatch.from_arrays(columns, ["group", "bucket", "n"])

        for batch in _unpacked(batches):
            rows = zip(
                shingle_sets(split(batch.column("text")), n_words), batch.column("member").to_pylist(), batch.column("a").to_pylist(),
                strict=True,
            )
            for s, member, a in rows:
                if member:
                    counts += np.bincount(_bucket(difference(s, own)), minlength=len(counts))
                    continue
                if counts.any():
                    yield ready()
                group, own = a, s
        if counts.any():
            yield ready()

    return each


def rarest_first(delta: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Differences in the one order of their group: by how many its bucket has, then by hash."""
    return delta[np.lexsort((delta, counts[_bucket(delta)]))]


def _differences(n_words: int, percent: int):
    """Rows of ``_beside`` with ``root`` and, in the pivot's rows, ``counts``: where each member b
    differs from its group's pivot a, rarest first, as far as a partner can need."""

    def each(batches):
        own, counts = None, np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in _unpacked(batches):
            elements, at, owner, sizes = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            sets = shingle_sets(split(batch.column("text")), n_words)
            for i, (other, member) in enumerate(zip(sets, batch.column("member").to_pylist(), strict=True)):
                if not member:
                    own = other
                    sizes.append((0, 0))
                    counts[:] = 0
                    if (counted := batch.column("counts")[i].values) is not None:
                        counts[counted.field("bucket").to_numpy()] = counted.field("n").to_numpy()
                    continue
                delta = difference(other, own)
                sizes.append((len(delta), len(other)))
                delta = rarest_first(delta, counts)[: len(other) * (100 - percent) // percent + 1]
                elements.append(delta)
                at.append(np.arange(len(delta)))
                owner.append(np.full(len(delta), i))
            rows = np.concatenate(owner)
            size = np.array(sizes, np.int64).reshape(-1, 2)[rows]
            of = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a").take(of), batch.column("b").take(of), batch.column("root").take(of),
                    pa.array(np.concatenate(elements).view(np.int64)), pa.array(np.concatenate(at)),
                    pa.array(size[:, 0].copy()), pa.array(size[:, 1].copy()),
                ],
                ["group", "node", "root", "element", "at", "differs", "n"],
            )

    return each


def group_links(pivot: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links inside one group as pairs of numbers, -1 for the pivot: all to the pivot, and of the
    others all that are not in its ball together (these are connected through it).

    Pairs are found by common differences from the pivot, as in ``_across``.
    """
    near, differs, elements, at, owner = [], [], [], [], []
    for i, s in enumerate(sets):
        here, there = inside(s, pivot)
        both = int(here.sum())
        near.append(100 * both >= percent * (len(pivot) + len(s) - both))
        delta = np.concatenate([s[~here], pivot[~there]])
        differs.append(len(delta))
        delta = delta[: len(s) * (100 - percent) // percent + 1]
        elements.append(delta)
        at.append(np.arange(len(delta)))
        owner.append(np.full(len(delta), i))
    links = [(-1, i) for i, x in enumerate(near) if x]
    if len(sets) < 2 or all(near):
        return links
    near, differs, size = np.array(near), np.array(differs), np.array([len(s) for s in sets])
    elements, at, owner = np.concatenate(elements), np.concatenate(at), np.concatenate(owner)
    order = np.argsort(elements, kind="stable")
    elements, at, owner = elements[order], at[order], owner[order]
    begin = np.flatnonzero(np.append(True, elements[1:] != elements[:-1])) if len(elements) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(elements)))
    found = [np.zeros(0, np.int64)]
    for r in np.unique(count[count > 1]).tolist():  # runs of one element, those of one length together
        x, y = np.triu_indices(r, 1)
        runs = begin[count == r]
        for k in range(0, len(runs), max(1, CELLS // (r * r))):
            rows = runs[k : k + max(1, CELLS // (r * r)), None] + np.arange(r)
            i, j = rows[:, x].ravel(), rows[:, y].ravel()
            a, b = owner[i], owner[j]
            needed = differs[a] + differs[b] - (size[a] + size[b]) * (100 - percent) // (100 + percent)
            kept = ~(near[a] & near[b]) & (2 * (differs[a] - at[i]) >= needed) & (2 * (differs[b] - at[j]) >= needed)
            found.append(np.unique(np.minimum(a[kept], b[kept]) * len(sets) + np.maximum(a[kept], b[kept])))
    for key in np.unique(np.concatenate(found)).tolist():
        i, j = divmod(key, len(sets))
        both = int(inside(sets[i], sets[j])[0].sum())
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            links.append((i, j))
    return links


def _group_links(n_words: int, percent: int):
    """Rows of ``_beside`` whose groups are whole to links (a, b)."""

    def each(batches):
        pivot, own, names, sets = None, None, [], []
        out: list[tuple[int, int]] = []

        def close():
            for i, j in group_links(own, sets, percent):
                out.append((pivot if i < 0 else names[i], names[j]))
            names.clear()
            sets.clear()

        def ready():
            rows = np.array(out, np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], ["a", "b"])

        for batch in _unpacked(batches):
            rows = zip(
                shingle_sets(split(batch.column("text")), n_words), batch.column("member").to_pylist(), batch.column("b").to_pylist(),
                strict=True,
            )
            for s, member, b in rows:
                if member:
                    names.append(b)
                    sets.append(s)
                    continue
                if sets:
                    close()
                pivot, own = b, s
            if len(out) > 10_000:
                yield ready()
        if sets:
            close()
        if out:
            yield ready()

    return each


def _across(state: DataFrame, texts: DataFrame, shared: Shared, n_words: int, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of a group (group, node, root) that no links connect so far.

    Sets differ from each other where one of them alone differs from the pivot, so with d(x) the
    number of shingles in which x differs from it, |x xor y| = d(x) + d(y) - 2 common. A pair
    of different roots is beyond d(x) + d(y) <= t, which would put both into the pivot's ball, and
    must have differences in common: (d(x) + d(y) - t) / 2 at least. Differences are put in one
    order for the group, so the first common one must leave that many in both. What most members
    of a group have in common against the pivot (it need not be the middle of all its regions) would
    bring all of them together; so the rarest come first, as counted by buckets of hashes, which is a
    bounded table for a group of any size.
    """
    left = state.where("group <> node").select(F.col("group").alias("a"), F.col("node").alias("b"), "root")
    counted = _beside(left.select("a", "b"), texts).mapInArrow(_bucket_counts(n_words), "group long, bucket int, n long")
    counts = counted.groupBy("group", "bucket").agg(F.sum("n").alias("n"))
    heads = shared.keep(
        counts.groupBy(F.col("group").alias("a")).agg(F.collect_list(F.struct("bucket", "n")).alias("counts")), "counts"
    )
    rows = _beside(left, texts, "root", heads=heads).mapInArrow(
        _differences(n_words, percent),
        "group long, node long, root long, element long, at long, differs long, n long",
    )
    x, y = rows.alias("x"), rows.alias("y")
    most = F.floor((F.col("x.n") + F.col("y.n")) * (100 - percent) / (100 + percent))
    needed = F.col("x.differs") + F.col("y.differs") - most
    condition = (
        (F.col("x.group") == F.col("y.group"))
        & (F.col("x.element") == F.col("y.element"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.root") != F.col("y.root"))
        & (2 * (F.col("x.differs") - F.col("x.at")) >= needed)
        & (2 * (F.col("y.differs") - F.col("y.at")) >= needed)
    )
    return x.join(y, condition).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _distances(pairs: DataFrame, texts: DataFrame, n_words: int) -> DataFrame:
    """(a, b) to (a, b, inter, whole)."""
    return _beside(pairs.select("a", "b"), texts).mapInArrow(_measure(n_words), "a long, b long, inter long, whole long")


def _large_links(
    pairs: DataFrame, weights: DataFrame, texts: DataFrame, found: DataFrame, shared: Shared, n_words: int, percent: int, levels: int
) -> DataFrame:
    """Links (a, b) of groups that are too large for a task, (a, b, size): level by level over the
    cluster. `ball` is the pivot whose ball holds the member. The links of the other groups,
    ``found``, are in the result as far as they connect anything."""
    linked = F.col("inter") * 100 >= F.lit(percent) * F.col("whole")
    far = shared.keep(_distances(pairs, texts, n_words), "measured-0")
    links = far.where(linked).select("a", "b")
    # A pair without the pivot lies in a region of three at least.
    others = far.join(pairs.where("size > 2").select("a", "b"), ["a", "b"], "left_semi")
    members_of = others.select(F.col("a").alias("group"), F.col("b").alias("node"), F.when(linked, F.col("a")).alias("ball"))
    unsettled = members_of.where("ball IS NULL").select("group").distinct()
    state = shared.keep(members_of.join(unsettled, "group", "left_semi").join(weights, "node"), "level-0")
    # Further levels: the middle of what is outside all balls so far.
    for level in range(1, levels):
        pivots = (
            state.where("ball IS NULL")
            .groupBy("group")
            .agg(F.max(F.struct("weight", "node")).alias("best"))
            .select("group", F.col("best.node").alias("pivot"))
        )
        around = state.join(pivots, "group", "left")
        beside = around.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        far = shared.keep(_distances(beside, texts, n_words), f"measured-{level}")
        links = links.union(far.where(linked).select("a", "b"))
        near = far.where(linked).select(F.col("a").alias("pivot"), F.col("b").alias("node"), F.lit(True).alias("near"))
        within = F.col("ball").isNull() & (F.col("near") | (F.col("node") == F.col("pivot")))
        state = shared.keep(
            around.join(near, ["pivot", "node"], "left").select(
                "group", "node", F.when(within, F.col("pivot")).otherwise(F.col("ball")).alias("ball"), "weight"
            ),
            f"level-{level}",
        )
        if state.where("ball IS NULL").isEmpty():
            break
    # What is connected by now is named by its root; groups of one root are settled.
    roots = shared.keep(components(found.union(links), shared, "found"), "roots")
    state = state.select("group", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_groups = state.groupBy("group").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    state = shared.keep(state.join(open_groups.select("group"), "group", "left_semi"), "open")
    left_over = shared.keep(_across(state, texts, shared, n_words, percent), "across")
    far = shared.keep(_distances(left_over, texts, n_words), "measured-across")
    return roots.select("node", "root").toDF("a", "b").union(far.where(linked).select("a", "b"))


def jaccard_groups(
    docs: DataFrame, shared: Shared, n_words: int = 5, percent: int = 80, levels: int = 3, keyed: bool = False
) -> DataFrame:
    """(doc_id, text) to (doc_id, node, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest doc_id that links reach, the row's own included. Texts
    without words (null too) have no node and are their own component. A null doc_id takes the
    component of its text and names none. With ``keyed`` the columns are (key, doc_id, root), root
    naming the component or null for texts without words. ``levels`` is how often a region recurses before pairs
    of different balls are measured; it changes the cost only.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", row_key())
    members, salt = _named(docs, shared, n_words)
    regions = shared.keep(
        docs.select("text")
        .mapInArrow(_regions(n_words, percent, salt), "region long, node long")
        .repartition("region")
        .sortWithinPartitions("region", "node")
        .mapInArrow(_shared_regions, "region long, node long"),
        "regions",
    )
    # One text for each set that has a neighbour in some region; the join has dealt them by key.
    weights = regions.groupBy("node").agg(F.count("*").alias("weight"))
    chosen = members.groupBy("node").agg(F.min("key").alias("key")).join(weights, "node").select("node", "key")
    packed = docs.select("key", "text").mapInArrow(_packed, "key long, packed binary")
    texts = shared.keep(packed.join(chosen, "key").groupBy("key", "node").agg(F.first("packed").alias("packed")).drop("key"), "texts")

    # Each region's pivot. Regions with one pivot go on as one group.
    pivots = (
        regions.join(weights, "node")
        .groupBy("region")
        .agg(F.max(F.struct("weight", "node")).alias("best"), F.count("*").alias("size"))
        .select("region", F.col("best.node").alias("a"), "size")
    )
    pairs = shared.keep(
        regions.join(pivots, "region")
        .where("node <> a")
        .groupBy("a", F.col("node").alias("b"))
        .agg(F.max("size").alias("size")),
        "pairs",
    )
    sizes = shared.keep(pairs.groupBy("a").count(), "sizes")
    links = docs.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).limit(0)
    # Groups of up to PART members recurse inside a task, some of the groups at a time.
    small = pairs.join(sizes.where(F.col("count") <= PART).select("a"), "a", "left_semi")
    for k in range(SLICES):
        own = small.where(F.pmod(F.xxhash64("a"), F.lit(SLICES)) == k).select("a", "b")
        links = links.union(shared.keep(_beside(own, texts).mapInArrow(_group_links(n_words, percent), "a long, b long"), f"links-{k}"))
    if not sizes.where(F.col("count") > PART).isEmpty():
        large = pairs.join(sizes.where(F.col("count") > PART).select("a"), "a", "left_semi")
        links = _large_links(large, weights, texts, links, shared, n_words, percent, levels)
    roots = components(links, shared)
    grouped = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if keyed:
        return grouped.select("key", "doc_id", "root")
    # A root may be that of very many rows, so its least id is there once for each salt.
    least = grouped.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt_of = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    return grouped.withColumn("salt", salt_of).join(salted, ["root", "salt"], "left").select(
        "doc_id", "node", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all columns, less those near another one: of each component one row
    stays, the one with the smallest doc_id (a row without an id only where there is no other;
    of rows with one id, the first by a hash of the text; of repeated rows, any). Texts without
    words have no neighbours and stay."""
    shared = Shared(docs.sparkSession, "jaccard")
    groups = shared.keep(jaccard_groups(docs, shared, n_words, percent, keyed=True), "groups")
    best = groups.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    )
    stays = best.select(F.col("best.key").alias("key"), F.lit(True).alias("one")).union(
        groups.where("root IS NULL").select("key", F.lit(False)).distinct()
    )
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key")).join(stays, "key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    return rows.withColumn("nth", nth).where("nth = 1 OR NOT one").select("row.*")


@query("op8_jaccard_join", ORACLE)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, 3-word shingles, links at 90 percent."""
    docs = table(spark, sf_dir, "documents")
    groups = jaccard_groups(docs, Shared(spark, "op8"), n_words=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id")
