"""A Merkle manifest of a dataset: a tree of rows per source, a tree of sources, and proofs by multiproof.

Trees take runs of three nodes; the last run of a level may have fewer, even one. Nodes are lowercase hex SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import small, stage

ARITY = 3
#: levels that one task builds at once, from ARITY ** LEVELS nodes at most
LEVELS = 6
CHUNK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values: Column) -> Column:
    """The digest of values, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree of ``n`` leaves."""
    for _ in range(level):
        n = -(-n // ARITY)
    return n


def run_of(place: int, n: int) -> range:
    """The places of a level of ``n`` nodes that are hashed together with ``place``."""
    first = place - place % ARITY
    return range(first, min(first + ARITY, n))


def missing_nodes(places: Iterable[int], n: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes from which, with the leaves at ``places``, all their proofs can be made.

    Level by level, siblings that are neither known nor derived from known nodes are missing; what can be derived
    from runs that are then whole is not fetched again.
    """
    known, level, missing = set(places), 0, []
    while n > 1:
        runs = {p // ARITY for p in known}
        missing += [(level, p) for r in sorted(runs) for p in run_of(r * ARITY, n) if p not in known]
        known, n, level = runs, -(-n // ARITY), level + 1
    return missing


def derived(leaves: Mapping[int, str], n: int, fetched: Mapping[tuple[int, int], str]) -> list[dict[int, str]]:
    """All nodes of each level on the paths of ``leaves`` and beside them, the root last."""
    levels, known, m = [], dict(leaves), n
    while m > 1:
        here = dict(known)
        for run in {p // ARITY for p in known}:
            for p in run_of(run * ARITY, m):
                if p not in here:
                    here[p] = fetched[len(levels), p]
        levels.append(here)
        known = {r: digest(*[here[p] for p in run_of(r * ARITY, m)]) for r in {p // ARITY for p in known}}
        m = -(-m // ARITY)
    return [*levels, known]


def siblings(levels: list[dict[int, str]], place: int, n: int) -> list[tuple[str, str]]:
    """The proof of a leaf: of each level, the joined digests left and right of its path's node."""
    proof = []
    for nodes in levels[:-1]:
        run = run_of(place, n)
        proof.append(("".join(nodes[p] for p in run if p < place), "".join(nodes[p] for p in run if p > place)))
        place, n = place // ARITY, -(-n // ARITY)
    return proof


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's siblings, from the leaf's level up and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def _ranked(rows: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place``, from 0 within ``tree`` by ``order``, and ``n``, the rows of that tree.

    Rows are dealt to ranges of (tree, order, a number of the row), so that neither a hot tree nor rows that are
    alike meet in one task. What is counted is a row for each tree in each range.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_row")]
    dealt = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    # the number of a row within its partition is written together with the row, so that no later run can deal otherwise
    kept = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), label).withColumn("_part", F.shiftrightunsigned("_at", 33))
    parts = kept.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = small(stage(parts.select(
        F.col(tree).alias("_tree"),
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
        F.sum("_n").over(whole).alias("n"),
    ), label + "-bases"))
    found = kept.join(bases, (kept["_part"] == bases["_of"]) & kept[tree].eqNullSafe(bases["_tree"]))
    return found.withColumn("place", F.col("_base") + F.col("_at")).drop("_at", "_part", "_tree", "_of", "_base")


NODES = "tree {}, n long, level int, place long, hash string"


def _raised(nodes: DataFrame, kind: str, tops_only: bool = False) -> DataFrame:
    """The nodes above chunks of ``CHUNK`` neighbours of one level, up to the chunk's top or the tree's root, or that node alone."""
    import pyarrow as pa

    schema = NODES.format(kind)

    def run(table: pa.Table) -> pa.Table:
        tree, n, level = table["tree"][0], table["n"][0].as_py(), table["level"][0].as_py()
        here = dict(zip(table["place"].to_pylist(), table["hash"].to_pylist(), strict=True))
        levels, places, hashes, m, last = [], [], [], width(n, level), min(level + LEVELS, height(n))
        for up in range(level + 1, last + 1):
            runs = sorted({p // ARITY for p in here})
            here = {r: digest(*[here[p] for p in run_of(r * ARITY, m)]) for r in runs}
            m = -(-m // ARITY)
            if up == last or not tops_only:
                levels += [up] * len(here)
                places += here
                hashes += here.values()
        k = len(places)
        arrays = [pa.array([tree.as_py()] * k, tree.type), pa.array([n] * k, pa.int64()), pa.array(levels, pa.int32()), pa.array(places, pa.int64()), pa.array(hashes, pa.string())]
        return pa.Table.from_arrays(arrays, ["tree", "n", "level", "place", "hash"])

    chunk = F.floor(F.col("place") / CHUNK).alias("chunk")
    return nodes.select("tree", "n", F.col("level").cast("int").alias("level"), "place", "hash").groupBy("tree", chunk).applyInArrow(run, schema)


def _upper_nodes(leaves: DataFrame, kind: str, label: str) -> DataFrame:
    """The tops of all chunks of leaves, and all nodes above them.

    What lies below is made again where it is needed, so a node is kept for every ``CHUNK`` leaves and for each run
    above. A round builds ``LEVELS`` levels: four do for 10**11 leaves.
    """
    tall = height(leaves.agg(F.max("n")).first()[0] or 0)
    rounds = [stage(_raised(leaves.withColumn("level", F.lit(0)), kind, tops_only=True), f"{label}-0")]
    for level in range(LEVELS, tall, LEVELS):
        rounds.append(stage(_raised(rounds[-1].where(F.col("level") == level), kind), f"{label}-{level}"))
    out = rounds[0]
    for more in rounds[1:]:
        out = out.union(more)
    # a tree of one leaf has no level above: the leaf is its root
    return out.union(leaves.where(F.col("n") == 1).select("tree", "n", F.lit(0), F.lit(0).cast("long"), "hash"))


PROOF = "array<struct<left:string,right:string>>"


def _proofs(leaves: DataFrame, upper: DataFrame, kind: str, carried: list[str], above: DataFrame | None = None) -> DataFrame:
    """``leaves`` (tree, n, place, hash and ``carried`` columns) with the ``subroot`` of their tree, ``root`` and ``proof``.

    A leaf partition is a chunk of neighbours of one tree. It names the nodes that all its proofs together miss,
    gets each of them once by a join, derives the inner nodes that they share, and expands the proof of each row.
    ``above`` (tree, root, proof) carries the trees' roots on; without it a tree's root is the last.
    """
    import pyarrow as pa

    own = leaves.select("tree", "n", "place", "hash", *carried, F.floor(F.col("place") / CHUNK).alias("chunk"))
    chunks = own.select("tree", "n", "chunk").distinct()
    names = ["tree", "chunk", "level", "place"]

    def octopus(batches):
        for b in batches:
            out = []
            for tree, n, chunk in zip(*[b.column(c).to_pylist() for c in ("tree", "n", "chunk")], strict=True):
                # nothing below a chunk's top is missing; above it the rest of each run on its way is
                rise = min(LEVELS, height(n))
                lacking = [(level + rise, p) for level, p in missing_nodes([chunk], width(n, rise))]
                out += [(tree, chunk, level, p) for level, p in [*lacking, (height(n), 0)]]
            if out:
                types = [b.schema.field("tree").type, pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    wanted = chunks.mapInArrow(octopus, f"tree {kind}, chunk long, level int, place long")
    nodes = upper.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("place").alias("_place"), "hash")
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("level") == F.col("_level")) & (F.col("place") == F.col("_place"))
    fetched = wanted.join(nodes, same).select(*names, "hash", F.lit(None).cast(PROOF).alias("above"))
    if above is not None:
        roots = above.select(F.col("tree").alias("_tree"), F.col("root").alias("hash"), F.col("proof").alias("above"))
        rest = chunks.join(roots, F.col("tree").eqNullSafe(F.col("_tree")))
        fetched = fetched.union(rest.select("tree", "chunk", F.lit(-1), F.lit(0).cast("long"), "hash", "above"))

    types = dict(own.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in carried], f"tree {kind}, hash string, subroot string, root string, proof {PROOF}"])
    pair = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def expand(leaf_rows: pa.Table, node_rows: pa.Table) -> pa.Table:
        places, n = leaf_rows["place"].to_pylist(), leaf_rows["n"][0].as_py()
        got, last, beyond = {}, None, []
        for level, p, value, rest in zip(*[node_rows[c].to_pylist() for c in ("level", "place", "hash", "above")], strict=True):
            if level < 0:
                last, beyond = value, rest
            else:
                got[level, p] = value
        levels = derived(dict(zip(places, leaf_rows["hash"].to_pylist(), strict=True)), n, got)
        subroot = levels[-1][0]
        if subroot != got[height(n), 0]:
            raise ValueError("the proofs of a partition do not lead to its tree's root")
        made = [[*({"left": a, "right": b} for a, b in siblings(levels, p, n)), *beyond] for p in places]
        same = lambda value: pa.array([value] * len(places), pa.string())
        arrays = [*[leaf_rows[c] for c in carried], leaf_rows["tree"], leaf_rows["hash"], same(subroot), same(last or subroot), pa.array(made, pair)]
        return pa.Table.from_arrays(arrays, [*carried, "tree", "hash", "subroot", "root", "proof"])

    return own.groupBy("tree", "chunk").cogroup(fetched.groupBy("tree", "chunk")).applyInArrow(expand, schema)


def manifest(docs: DataFrame, shown: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root and ``proof``, and the ``shown`` columns, computed where the texts are.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a source ascend by doc_id (null first;
    rows of one doc_id by leaf, and copies of one row take neighbouring places), subroots by source (null first).
    ``proof`` has, of each level from the leaf to the root, the joined digests left and right of the path's node;
    both are empty where it is hashed alone. A single leaf is its subroot, a single subroot the root. Empty texts
    are values, null ones are not. Other columns are not read. An empty table gives no row.

    Only digests are shuffled. A task holds ``CHUNK`` leaves or nodes; no tree, source or level passes through one
    task or the driver.
    """
    own = [F.col(c) for c in FIELDS]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"), leaf(*own).alias("hash"),
        *[c.alias(name) for name, c in (shown or {}).items()],
    )
    carried = ["doc_id", *(shown or {})]
    leaves = _ranked(rows, "tree", ["doc_id", "hash"], "merkle-leaves")
    upper = _upper_nodes(leaves, "string", "merkle-nodes")
    # the tree of sources, by the same steps
    subroots = upper.where(F.col("place") == 0).groupBy("tree").agg(F.max_by("hash", "level").alias("hash"))
    sources = _ranked(subroots.select(F.lit(0).alias("one"), F.col("tree").alias("source"), "hash"), "one", ["source"], "merkle-sources")
    sources = sources.withColumnRenamed("one", "tree")
    top = _proofs(sources, _upper_nodes(sources, "int", "merkle-top"), "int", ["source"])
    above = stage(top.select(F.col("source").alias("tree"), "root", "proof"), "merkle-above")
    proofs = _proofs(leaves, upper, "string", carried, above)
    return proofs.select(*carried, F.col("hash").alias("leaf"), "subroot", "root", "proof")
