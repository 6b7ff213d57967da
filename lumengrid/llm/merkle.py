"""Merkle manifest of a dataset: leaves by source, trees of three children a node, proofs, and what tampering breaks.

A leaf is the digest of a row's fields. The leaves of a source, in the order of their ids, are cut into aligned blocks of
BLOCK = 3^DEEP. A task walks a block recursively, children first: each subtree returns its digest, and while unwinding
appends to every leaf below it the digests of the subtrees beside it. A block of a longer source always reaches level
DEEP, whatever follows it, so its root is a node of the source's tree; these roots are the nodes of another distributed
walk, and so on until one block holds a tree. The subroots of the sources, in order, make one more tree. Proofs are put
together from above: a block's path is joined to the block, not to its leaves.

Places within a source come without ordering a source in one task: rows are dealt by range over (source, doc_id), each
task numbers its own, and the counts of the tasks, a row for each task and source, are added up.

A proof is stored as levels, from below: the place within the run, the number of siblings, and their digests (32 bytes
each). proof_sha256 is taken over their hex texts.

Defined cases: of rows with equal (or null) doc_id, null first, the smaller leaf digest goes first, and equal rows have
equal results up to their places; rows with a null doc_id aren't tampered with; a null text stays null; a source may be
null or empty, which differ; very long texts are hashed whole, in the JVM; an empty table gives an empty result; only
the five named columns are read, so others can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import matched, saved, table

#: Children of a node, and levels that a block spans.
ARITY, DEEP = 3, 5
BLOCK = ARITY**DEEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(parts: list[bytes]) -> bytes:
    """Digest of digests, which count as hex text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def leaf_of(fields: list[Column]) -> Column:
    """Hex digest of the fields: each `-` if null, else its length in bytes, a colon, and itself."""
    told = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in fields]
    return F.sha2(F.concat(*told), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf and, where rows are tampered with, the leaf after it (else null); raw digests."""
    own = lambda text: F.unhex(leaf_of([F.col(c) for c in FIELDS[:-1]] + [text]))
    odd = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    return docs.select("source", "doc_id", own(F.col("text")).alias("leaf"), F.when(odd, own(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("tampered"))


def numbered(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """rows (written; by is never null) with their place, from 0, among those of `by`, and the number n of those. Tasks hold ranges of (by, order...) and number them as they stream; then only counts, a row for each task and value in it, are added up."""
    kind = rows.schema
    at, keys = kind.names.index(by), [by, *order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(at).dictionary_encode()
            names, value = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))).tolist()
            place = np.arange(len(value))
            for a, b in zip(starts, [*starts[1:], len(value)]):
                n = n if names[value[a]] == last else 0
                place[a:b] += n - a
                n, last = n + b - a, names[value[a]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "_place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, f"{fields}, _place long")
    here = saved(dealt.withColumn("_task", F.spark_partition_id()), name)
    counts = here.groupBy("_task", by).agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(by)
    counts = counts.select("_task", by, F.coalesce(F.sum("_n").over(every.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(every).alias("n"))
    return matched(here, saved(counts, f"{name}-counts"), ["_task", by]).withColumn("place", F.col("_place") + F.col("_before")).drop("_task", "_place", "_before")


def walk(digests: list[bytes], deep: int) -> tuple[bytes, list[bytearray]]:
    """Root of a block `deep` levels high, and of each leaf the proof up to it."""
    proofs = [bytearray() for _ in digests]

    def visit(first: int, level: int) -> bytes:
        if not level:
            return digests[first]
        width = ARITY ** (level - 1)
        starts = range(first, min(len(digests), first + ARITY * width), width)
        below = [visit(s, level - 1) for s in starts]
        for k, s in enumerate(starts):
            beside = bytes((k, len(below) - 1)) + b"".join(below[:k] + below[k + 1 :])
            for i in range(s, min(len(digests), s + width)):
                proofs[i] += beside
        return H(below)

    return visit(0, deep), proofs


def levels(n: int) -> int:
    """Height of the tree of n leaves."""
    deep, width = 0, 1
    while width < n:
        deep, width = deep + 1, width * ARITY
    return deep


def siblings(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(proof):
        place, n = proof[at], proof[at + 1]
        yield place, [proof[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(n)]
        at += 2 + 32 * n


def fold(digest: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, others in siblings(proof):
        digest = H([*others[:place], digest, *others[place:]])
    return digest


def _walked(nodes: DataFrame, carried: str, name: str) -> DataFrame:
    """Blocks of nodes (tree, place, n, digest and the columns `carried`, as DDL), written: tree, block, n, root, members (proof and what was carried, in order). A group is one block, at most BLOCK nodes, however many its tree has."""
    names = [c.split()[0] for c in carried.split(", ")] if carried else []
    ddl = "".join(f", {c.replace(' ', ':')}" for c in carried.split(", ")) if carried else ""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        n = group.column("n")[0].as_py()
        root, proofs = walk(group.column("digest").to_pylist(), min(DEEP, levels(n)))
        members = pa.StructArray.from_arrays([pa.array(map(bytes, proofs), pa.binary()), *(group.column(c).combine_chunks() for c in names)], ["proof", *names])
        tree, block = (k.as_py() for k in key)
        return pa.table({"tree": pa.array([tree], pa.string()), "block": pa.array([block], pa.int64()), "n": pa.array([n], pa.int64()), "root": pa.array([root], pa.binary()), "members": pa.ListArray.from_arrays(pa.array([0, len(members)], pa.int32()), members)})

    kind = f"tree string, block long, n long, root binary, members array<struct<proof:binary{ddl}>>"
    grouped = nodes.withColumn("block", F.expr(f"place div {BLOCK}")).groupBy("tree", "block")
    return saved(grouped.applyInArrow(run, kind), name)


_NOTHING = "cast('' as binary)"


def climbed(nodes: DataFrame, carried: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The trees over nodes (tree, place, n, digest, carried...): their lowest blocks, with the path from each block's root to its tree's, and (tree, root). Each walk has BLOCK times fewer nodes than the one before."""
    walks = [_walked(nodes, carried, name)]
    most = walks[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        upper = walks[-1].where(F.col("n") > BLOCK).select("tree", F.col("block").alias("place"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("root").alias("digest"))
        walks.append(_walked(upper, "", name))
        most = -(-most // BLOCK)
    roots = None
    for w in walks:
        own = w.where(F.col("n") <= BLOCK).select("tree", "root")
        roots = own if roots is None else roots.unionByName(own)
    paths = None
    for w in reversed(walks):
        told = w.withColumn("path", F.expr(_NOTHING)) if paths is None else w.join(paths, ["tree", "block"], "left").withColumn("path", F.coalesce("path", F.expr(_NOTHING)))
        if w is not walks[0]:
            paths = told.select("tree", "block", "path", F.posexplode("members").alias("i", "m")).select("tree", (F.col("block") * BLOCK + F.col("i")).alias("block"), F.concat("m.proof", "path").alias("path"))
    return told, roots


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf, if there is one), verified."""
    rows = leaves(docs).select(F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.col("leaf").alias("digest"), "tampered")
    placed = numbered(saved(rows, "leaves"), "tree", ["doc_id", "digest"], "leaves-placed")
    blocks, subroots = climbed(placed.withColumn("leaf", F.col("digest")), "doc_id long, leaf binary, tampered binary", "merkle")
    sources = saved(subroots.select(F.lit("").alias("all"), F.col("tree").alias("source"), F.col("root").alias("digest")), "subroots")
    placed = numbered(sources, "all", ["source"], "subroots-placed").withColumnRenamed("all", "tree").withColumn("subroot", F.col("digest"))
    tops, top = climbed(placed, "source string, subroot binary", "merkle-top")
    root = top.first()
    root = root.root if root else b""
    up = tops.select("path", F.explode("members").alias("m")).select(F.col("m.source").alias("tree"), "m.subroot", F.concat("m.proof", "path").alias("above"))
    every = matched(blocks.select("tree", "path", "members"), saved(up, "subroot-paths"), ["tree"])
    every = every.select("path", "above", "subroot", F.explode("members").alias("m")).select("m.*", "path", "above", "subroot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[bytes, bytes, bytes], bytes] = {}
        for batch in batches:
            ids, proofs, folded, fits = batch.column(batch.schema.get_field_index("doc_id")), [], [], []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("leaf", "tampered", "proof", "path", "above", "subroot")]
            for leaf, bad, proof, path, above, _ in zip(*columns):
                told = hashlib.sha256()
                for part in (proof, path, above):
                    for _, others in siblings(part):
                        told.update(b"".join(o.hex().encode() for o in others))
                proofs.append(told.hexdigest())
                block = fold(bad or leaf, proof)
                key = (block, path, above)  # leaves of a block that weren't tampered with share the rest of the way
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = fold(fold(block, path), above)
                folded.append(known[key].hex())
                fits.append(known[key] == root)
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.hex() for x in columns[0]], pa.string()), pa.array([x.hex() for x in columns[5]], pa.string()), pa.array([root.hex()] * len(fits), pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array(fits, pa.bool_())], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return every.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _leaf(text: str) -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    return "sha256(" + " || ".join([*(field(c) for c in FIELDS[:-1]), field(text)]) + ")"


def _tree(name: str, nodes: str) -> str:
    """SQL of all nodes above `nodes` (tree, lev, i, d, m: nodes of that level), and of what stands beside each."""
    return f"""
     {name}(tree, lev, i, d, m) AS ({nodes} UNION ALL
         SELECT tree, lev + 1, i // {ARITY}, sha256(string_agg(d, '' ORDER BY i)), (m + {ARITY - 1}) // {ARITY} FROM {name} WHERE m > 1 GROUP BY tree, lev, i // {ARITY}, m),
     {name}_side AS (SELECT tree, lev, i, coalesce(string_agg(d, '') OVER (PARTITION BY tree, lev, i // {ARITY} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
                            coalesce(string_agg(d, '') OVER (PARTITION BY tree, lev, i // {ARITY} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name} WHERE m > 1),"""


#: CRC-32 before its last inversion, bit by bit (the polynomial is a fixed value); an odd one has an even CRC-32.
_CRC = "list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: [ascii(s), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END)"

SQL = f"""
WITH RECURSIVE
     l AS (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS cut, {_CRC} & 1 = 1 AS odd FROM documents),
     p AS (SELECT doc_id, leaf, CASE WHEN odd THEN cut ELSE leaf END AS bad, coalesce('=' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS r FROM l),{_tree("t", "SELECT tree, 0, i, leaf, n FROM p")}
     sub AS (SELECT tree, d, lev, row_number() OVER (ORDER BY tree) - 1 AS k FROM t WHERE m = 1),{_tree("u", "SELECT 'top', 0, k, d, count(*) OVER () FROM sub")}
     f(r, tree, lev, i, d, told) AS (SELECT r, tree, 0, i, bad, '' FROM p UNION ALL
         SELECT r, f.tree, f.lev + 1, f.i // {ARITY}, sha256(lft || d || rgt), told || lft || rgt FROM f JOIN t_side s ON f.tree = s.tree AND f.lev = s.lev AND f.i = s.i),
     g(r, lev, i, d, told, subroot) AS (SELECT r, 0, k, f.d, told, sub.d FROM f JOIN sub ON f.tree = sub.tree AND f.lev = sub.lev UNION ALL
         SELECT r, g.lev + 1, g.i // {ARITY}, sha256(lft || d || rgt), told || lft || rgt, subroot FROM g JOIN u_side s ON g.lev = s.lev AND g.i = s.i),
     top AS (SELECT d AS root, lev FROM u WHERE m = 1)
SELECT p.doc_id, p.leaf, g.subroot, top.root, sha256(g.told) AS proof_sha256, g.d AS folded_root, g.d = top.root AS verified
FROM p JOIN g USING (r) JOIN top ON g.lev = top.lev
"""
