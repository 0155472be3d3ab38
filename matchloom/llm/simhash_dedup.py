"""SimHash near-duplicates by a byte-position index with count filtering, and their components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import NO_ID, scratch, small, stage, text_or_empty, with_row_key

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
# two differing bits touch two bytes at most, so six of eight bytes agree at their places
LEAST_EQUAL_BYTES = BYTES - MAX_BITS
# two differing bytes leave two of these four groups whole; a posting list is named by two groups
GROUPS = ((0, 1), (2, 3), (4, 5), (6, 7))
# a longer posting list is not paired but searched by flipped bits, which finds the same links
LONG_LIST = 64


def _fingerprint(text: str | None) -> int:
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(h), 1 << 15):  # bounded memory for long texts
        part = h[start : start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, fp): the 64-bit SimHash of every text as a signed number, and a hash of the text."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            fps = pa.array([_fingerprint(t) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], ["doc_id", "k1", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty()).alias("k1"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, k1 long, fp long")


def _byte(x: Column, i: int) -> Column:
    return F.shiftrightunsigned(x, 8 * (BYTES - 1 - i)).bitwiseAND(F.lit(255))


def _mask(groups) -> int:
    value = sum(255 << (8 * (BYTES - 1 - b)) for g in groups for b in g)
    return value - (1 << 64) if value >= 1 << 63 else value


def _choices() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(GROUPS)) for j in range(i + 1, len(GROUPS))]


def postings(values: DataFrame) -> DataFrame:
    """(choice, key, fp): six lists for each fingerprint; each key holds four bytes at their places."""
    lists = [
        F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(_mask((GROUPS[i], GROUPS[j])))).alias("key"))
        for n, (i, j) in enumerate(_choices())
    ]
    return values.select("fp", F.explode(F.array(*lists)).alias("x")).select("x.choice", "x.key", "fp")


def links(values: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that connect all those within MAX_BITS of each other.

    In a short posting list every pair whose equal bytes reach the least number is verified. In a long list
    each fingerprint names itself and what it becomes if one bit outside the list's bytes flips: two
    fingerprints share such a name if and only if they differ in two bits at most. All that share a name
    (33 at most) are linked to the smallest, so the number of links stays in proportion to the fingerprints.
    """
    posted = postings(values)
    sizes = posted.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(posted.join(sizes, ["choice", "key"]), "simhash-postings")
    short = shared.where(F.col("n") <= LONG_LIST)
    pairs = (
        short.alias("a")
        .join(short.alias("b"), (F.col("a.choice") == F.col("b.choice")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )
    tally = sum((F.when(_byte(F.col("a"), i) == _byte(F.col("b"), i), 1).otherwise(0) for i in range(BYTES)), F.lit(0))
    near = pairs.where(tally >= LEAST_EQUAL_BYTES).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)

    free = F.lit(None).cast("array<int>")
    for n, (i, j) in enumerate(_choices()):
        bits = [8 * (BYTES - 1 - b) + k for b in range(BYTES) if b not in (*GROUPS[i], *GROUPS[j]) for k in range(8)]
        free = F.when(F.col("choice") == n, F.lit(bits)).otherwise(free)
    flips = F.transform(free, lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    named = shared.where(F.col("n") > LONG_LIST).select("choice", "fp", F.explode(F.concat(F.array("fp"), flips)).alias("name"))
    stars = (
        named.groupBy("choice", "name")
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .where("a < b")
    )
    return near.unionAll(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) reaches, by alternating stars.

    Each round links larger neighbours, then smaller ones, to the smallest neighbour; it ends when the links
    do not change. Only counts and sums of hashes reach the driver.
    """
    links, seen = stage(edges.select("a", "b").where("a <> b").distinct(), "links"), None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # links of ``large`` point from b to the smaller a
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("x"))
        links = stage(small.where("m <> x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
                links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        seen = now


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, fp, root, component_id) for every row; ``root`` is the component's smallest fingerprint.

    Fingerprints of two rows link them if they differ in two bits at most; ``component_id`` is the smallest
    doc_id that links reach. Texts without words (null, empty) have fingerprint zero and link like any other.
    Equal fingerprints are one node, so copies are never paired. Repeated rows are returned each; null ids
    are not smallest (a component of null ids only has a null component_id). Other columns are not read.
    """
    rows = stage(fingerprints(docs), "simhash-fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    grouped = components(links(nodes.select("fp")))
    rooted = nodes.join(grouped, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "k1", "fp", "root", "component_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest (doc_id, hash of the text); all columns stay.

    A null id sorts first. Rows of one id and one text are one document, of which one row stays.
    """
    with scratch():
        found = simhash_components(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("kd"), "k1", "root")
        first = found.groupBy("root").agg(F.min(F.struct("kd", "k1")).alias("f")).select("f.kd", "f.k1", F.lit(True).alias("stays"))
        rows = found.groupBy("kd", "k1").agg(F.count(F.lit(1)).alias("n_rows"))
        # the rows that go or repeat are few against those that stay: their keys meet the texts where these are
        changed = rows.join(first, ["kd", "k1"], "left").where("stays is null or n_rows > 1")
        changed = stage(changed, "simhash-changed", keep=True)
    gone, repeated = (small(changed.where(c).select("kd", "k1")) for c in ("stays is null", "stays"))
    keyed = with_row_key(docs.select(F.struct("*").alias("row"), "doc_id", text_or_empty().alias("t")), F.col("t"))
    left = keyed.join(gone, ["kd", "k1"], "left_anti").select("kd", "k1", "row")
    if changed.where("stays").take(1):
        once = left.join(repeated, ["kd", "k1"], "left_anti")
        left = once.unionAll(left.join(repeated, ["kd", "k1"], "left_semi").dropDuplicates(["kd", "k1"]))
    return left.select([F.col("row")[c].alias(c) for c in docs.columns])
