"""Merkle manifest of a table of documents, with nested-interval labels.

Each row is a leaf, the digest of its fields. The leaves of a language ascend by doc_id (null first,
rows of one id by digest); every two consecutive nodes become their parent until one, the
language's subroot, remains, and the subroots, by language (null first, bytewise), become the root
the same way. A last node without a partner is hashed alone.

Every node carries the interval of leaf ranks that it covers, ``[lo, hi)``:

1. *Ranks.* Leaf digests (no texts) are sorted by range over the cluster; a rank is the place in the
   range plus the sizes of the ranges before it, so no language is one task's work.
2. *Bands.* Ten levels are built at a time, in blocks of 1,024 nodes, so n leaves take log(n) / 10
   shuffles. Inside a parent's interval the siblings of a node are the interval difference: the
   parent's interval less the node's own.
3. *Ancestors.* A leaf's ancestors in a band are found by a containment join: the node of level l
   whose interval holds rank r stands in the bucket ``r >> l`` of that level. Only the first node of
   each 1,024 goes on to the next band; its ancestors are then handed down, top band first, so a
   join key never has more than 1,024 rows and a long proof is never shuffled once a level.

An empty table has no rows. Repeated rows are leaves of their own with equal digests. A null doc_id
is never tampered with. Columns other than the five are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, query, table

#: Levels that one pass builds.
BAND = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7

NODES = "g string, n long, level int, lo long, hi long, digest binary, sibling binary, before boolean, top boolean"


def field(value: Column) -> Column:
    """A field as a digest reads it: ``-`` for null, else its bytes' count, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(**changed: Column) -> Column:
    """Hex digest of a row's fields; ``changed`` replaces some of them."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, source, n_chars) to (g, doc_id, leaf, tampered), digests in binary.

    ``g`` names the language so that its byte order is the languages', null first.
    """
    unsigned = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    touched = F.coalesce(unsigned % TAMPER == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(38,0)") + F.when(touched, 1).otherwise(0)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(row_digest()).alias("leaf"),
        F.when(touched, F.unhex(row_digest(n_chars=more))).alias("tampered"),
    )


def ranked(rows: DataFrame, order: list[str], shared: Shared, name: str) -> DataFrame:
    """Adds ``lo``, the row's rank in its group ``g`` by ``order``, and ``n``, the group's size.

    The sort is by range, ties dealt apart by the row's own number, so neither a large group nor
    many equal rows meet in one task.
    """
    keys = ["g", *order, "tie"]
    placed = shared.keep(
        rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("tie").withColumn("place", F.monotonically_increasing_id()),
        f"{name}-placed",
    )
    part = F.shiftright("place", 33).alias("part")
    ranges = placed.groupBy("g", part).agg(F.min("place").alias("first"), F.count("*").alias("size"))
    of, up_to = Window.partitionBy("g"), Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "g", "part", "first", F.sum("size").over(of).alias("n"), F.coalesce(F.sum("size").over(up_to), F.lit(0)).alias("skipped")
    )
    lo = F.col("place") - F.col("first") + F.col("skipped")
    return placed.withColumn("part", part).join(ranges, ["g", "part"]).withColumn("lo", lo).drop("part", "first", "skipped", "place")


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _block(base: int):
    """The nodes above up to 1,024 neighbours of level ``base``."""

    def each(group: pa.Table) -> pa.Table:
        g, n = group.column("g")[0].as_py(), group.column("n")[0].as_py()
        lo = group.column("lo").to_numpy()
        order = np.argsort(lo)
        lo = lo[order]
        digests = group.column("digest").combine_chunks().take(pa.array(order)).to_pylist()
        out = {k: [] for k in ("level", "lo", "hi", "digest", "sibling", "before", "top")}

        def emit(level, lo, hi, digests, siblings, before, top):
            for k, v in zip(out, (np.full(len(lo), level), lo, hi, digests, siblings, before, [top] * len(lo)), strict=True):
                out[k].extend(v)

        level = base
        while True:
            hi = np.minimum(((lo >> level) + 1) << level, n)
            if len(lo) == 1 and (level == base + BAND or (lo[0] == 0 and hi[0] == n)):
                emit(level, lo, hi, digests, [None], [None], True)
                break
            # The parent's interval less the own one is what the sibling covers, if anything.
            above = level + 1
            parent_lo = (lo >> above) << above
            parent_hi = np.minimum(parent_lo + (1 << above), n)
            before = lo > parent_lo
            rest_lo, rest_hi = np.where(before, parent_lo, hi), np.where(before, lo, parent_hi)
            at = np.searchsorted(lo, rest_lo)
            siblings = [digests[i] if a < b else None for i, a, b in zip(at, rest_lo, rest_hi, strict=True)]
            emit(level, lo, hi, digests, siblings, before, False)
            first = np.flatnonzero(lo == parent_lo)
            digests = [
                hashlib.sha256((digests[i].hex() + (siblings[i].hex() if siblings[i] is not None else "")).encode()).digest()
                for i in first
            ]
            lo, level = lo[first], above
        size = len(out["lo"])
        return pa.table(
            {
                "g": pa.array([g] * size, pa.string()), "n": pa.array(np.full(size, n, np.int64)),
                "level": pa.array(np.array(out["level"], np.int32)), "lo": pa.array(np.array(out["lo"], np.int64)),
                "hi": pa.array(np.array(out["hi"], np.int64)), "digest": pa.array(out["digest"], pa.binary()),
                "sibling": pa.array(out["sibling"], pa.binary()),
                "before": pa.array([None if b is None else bool(b) for b in out["before"]], pa.bool_()),
                "top": pa.array(out["top"], pa.bool_()),
            }
        )

    return each


class Tree:
    """The trees of all groups, band by band: ``bands[k]`` has the nodes of levels 10 k to 10 k + 9
    with their siblings, and those of level 10 k + 10 and the roots as ``top`` rows."""

    def __init__(self, ranks: DataFrame, digest: str, shared: Shared, name: str):
        """``ranks``: (g, n, lo) and the digest's column."""
        self.bands: list[DataFrame] = []
        units = ranks.select("g", "n", "lo", F.col(digest).alias("digest"))
        levels = ranks.agg(F.max(height(F.col("n")))).first()[0]
        for base in range(0, 0 if levels is None else max(levels, 1), BAND):
            block = F.shiftright("lo", base + BAND).alias("block")
            nodes = shared.keep(units.groupBy("g", "n", block).applyInArrow(_block(base), NODES), f"{name}-{base}")
            self.bands.append(nodes)
            units = nodes.where(F.col("top") & ~self._root()).select("g", "n", "lo", "digest")
        self.empty = units.select("g", F.col("digest").alias("root")).limit(0)

    @staticmethod
    def _root() -> Column:
        return F.col("top") & (F.col("lo") == 0) & (F.col("hi") == F.col("n"))

    def roots(self) -> DataFrame:
        """(g, root)."""
        out = self.empty
        for nodes in self.bands:
            out = out.union(nodes.where(self._root()).select("g", F.col("digest").alias("root")))
        return out

    def paths(self, k: int) -> DataFrame:
        """(g, lo, path) of the nodes of level 10 k: the siblings of their ancestors in that band, from
        the bottom up, as (level, before, sibling). A level without sibling has a null one.

        The ancestors come by a containment join in buckets of a level.
        """
        nodes, base = self.bands[k], k * BAND
        units = nodes.where((F.col("level") == base) & ~self._root()).select("g", "n", F.col("lo").alias("rank"))
        last = F.least(F.lit(base + BAND), height(F.col("n"))) - 1
        units = units.select("g", "rank", F.explode(F.sequence(F.lit(base), last)).alias("level"))
        units = units.select("g", "rank", "level", F.expr("shiftright(rank, level)").alias("bucket"))
        above = nodes.where(~F.col("top")).select(
            "g", "level", F.expr("shiftright(lo, level)").alias("bucket"), "lo", "hi", "sibling", "before"
        )
        held = units.join(above, ["g", "level", "bucket"]).where("lo <= rank AND rank < hi")
        step = F.struct("level", "before", "sibling")
        return held.groupBy("g", F.col("rank").alias("lo")).agg(F.array_sort(F.collect_list(step)).alias("path"))

    def proofs(self, top: DataFrame) -> DataFrame:
        """(g, lo, path, ...) of all leaves; ``top`` has (g, path) of what lies above each group's
        root, and further columns that every leaf of the group gets.

        Paths are handed down: a node's is that of its band and then that of its block.
        """
        more = [c for c in top.columns if c not in ("g", "path")]
        above = top.select("g", F.lit(0).cast("long").alias("block"), "path", *more)
        for k in reversed(range(len(self.bands))):
            base = k * BAND
            units = self.bands[k].where(F.col("level") == base).select("g", "lo", F.shiftright("lo", base + BAND).alias("block"))
            own = self.paths(k).withColumnRenamed("path", "own")
            path = F.concat(F.coalesce("own", F.array().cast(own.schema["own"].dataType)), "path")
            units = units.join(above, ["g", "block"]).join(own, ["g", "lo"], "left").select("g", "lo", path.alias("path"), *more)
            if k:  # with the trees that end in the band below
                lower = top.join(self.bands[k - 1].where(self._root()).select("g"), "g")
                above = units.withColumn("block", F.shiftright("lo", base)).select("g", "block", "path", *more)
                above = above.union(lower.select("g", F.lit(0).cast("long"), "path", *more))
            else:
                above = units
        return above


def folded(leaf: Column, path: Column) -> Column:
    """Hex digest of the root that a leaf and the siblings on its way lead to."""

    def up(node: Column, step: Column) -> Column:
        sibling = F.lower(F.hex(step["sibling"]))
        pair = F.when(step["sibling"].isNull(), node).when(step["before"], F.concat(sibling, node)).otherwise(F.concat(node, sibling))
        return F.sha2(pair, 256)

    return F.aggregate(path, F.lower(F.hex(leaf)), up)


def proof_digest(path: Column) -> Column:
    """Hex digest of the siblings on a way, from the bottom up."""
    held = F.filter(path, lambda step: step["sibling"].isNotNull())
    return F.sha2(F.array_join(F.transform(held, lambda step: F.lower(F.hex(step["sibling"]))), ""), 256)


def manifest(docs: DataFrame, shared: Shared) -> tuple[DataFrame, Tree, Tree]:
    """Proofs of all rows, (doc_id, leaf, tampered, subroot, root, path); the trees of the languages;
    and the tree of their subroots. Digests are binary."""
    own = ranked(shared.keep(leaves(docs), "leaves"), ["doc_id", "leaf"], shared, "leaves")
    own = shared.keep(own, "ranks")
    trees = Tree(own, "leaf", shared, "tree")
    subroots = shared.keep(trees.roots().withColumnsRenamed({"g": "name", "root": "subroot"}).withColumn("g", F.lit("")), "subroots")
    names = shared.keep(ranked(subroots, ["name"], shared, "subroots"), "names")
    tree = Tree(names, "subroot", shared, "top")
    steps = "array<struct<level int, before boolean, sibling binary>>"
    whole = tree.roots().select("g", F.array().cast(steps).alias("path"), "root")
    top = names.join(tree.proofs(whole), ["g", "lo"]).select(F.col("name").alias("g"), "path", "subroot", "root") if tree.bands else None
    if top is None:
        top = names.select(F.col("name").alias("g"), F.array().cast(steps).alias("path"), "subroot", F.col("subroot").alias("root"))
    proofs = trees.proofs(shared.keep(top, "tops")) if trees.bands else top.withColumn("lo", F.lit(0).cast("long"))
    return own.join(proofs, ["g", "lo"]).drop("g", "n", "lo"), trees, tree


ORACLE = r"""
WITH RECURSIVE own AS (
  SELECT doc_id, lang, n_chars, coalesce('=' || lang, '') AS g,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, b:
      list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, i:
        CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS crc
  FROM documents),
leaf AS (
  SELECT doc_id, g, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || tail) AS more,
    coalesce(xor(crc, 4294967295::BIGINT) % 7 = 0, false) AS touched
  FROM own),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaf),
t(g, level, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM l
  UNION ALL
  SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY g, level, i // 2, n),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, i, n, h) AS (
  SELECT 0, i, n, subroot FROM s
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY level, i // 2, n),
way AS (
  SELECT l.g, l.i, k.level AS step, b.h, (l.i >> k.level) % 2 = 1 AS before
  FROM l JOIN (SELECT DISTINCT g, level FROM t WHERE n > 1) k ON k.g = l.g
  LEFT JOIN t b ON b.g = l.g AND b.level = k.level AND b.i = xor(l.i >> k.level, 1)
  UNION ALL
  SELECT l.g, l.i, 1000 + k.level, b.h, (s.i >> k.level) % 2 = 1
  FROM l JOIN s ON s.g = l.g CROSS JOIN (SELECT DISTINCT level FROM u WHERE n > 1) k
  LEFT JOIN u b ON b.level = k.level AND b.i = xor(s.i >> k.level, 1)),
p AS (SELECT g, i, list({'h': h, 'before': before} ORDER BY step) AS path, coalesce(string_agg(h, '' ORDER BY step), '') AS proof FROM way GROUP BY g, i),
f(g, i, left_, h) AS (
  SELECT l.g, l.i, coalesce(p.path, []), CASE WHEN touched THEN more ELSE leaf END FROM l LEFT JOIN p ON p.g = l.g AND p.i = l.i
  UNION ALL
  SELECT g, i, left_[2:], sha256(CASE WHEN left_[1].h IS NULL THEN h WHEN left_[1].before THEN left_[1].h || h ELSE h || left_[1].h END) FROM f WHERE len(left_) > 0)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM l JOIN s ON s.g = l.g JOIN (SELECT h FROM u WHERE n = 1) r ON true LEFT JOIN p ON p.g = l.g AND p.i = l.i
JOIN f ON f.g = l.g AND f.i = l.i AND len(f.left_) = 0
"""


@query("op12_merkle_manifest", ORACLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents: leaf, roots, proof, and what the proof makes of a tampered row."""
    rows, _, _ = manifest(table(spark, sf_dir, "documents"), Shared(spark, "op12"))
    text = lambda c: F.lower(F.hex(c))
    fold = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = rows.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
