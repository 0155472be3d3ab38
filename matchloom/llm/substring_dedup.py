"""Removing repeated word sequences: windows are grouped by a hash of words inside them, sorted and compared."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import pieces_of, small, stage, text_or_empty, with_row_key

WINDOW = 35
# A window goes to a group by the hash of those ANCHOR consecutive words inside it that have the least hash.
# Equal windows have equal anchors, so they meet in one group.
ANCHOR = 12
# windows of anchors with more places than this are grouped by a digest of all their words
MEMORY_ROWS = 2_000


def _windows(texts, window: int = WINDOW, anchor: int = ANCHOR):
    """Of all texts: bytes, word starts and ends, text of each word, window starts and each window's anchor and hash."""
    import numpy as np

    from matchloom.llm import bytesplit as B

    data, doc_starts = B.buffers(texts)
    starts, ends = B.word_spans(data)
    owner = B.texts_of_words(doc_starts, starts)
    h = B.word_hashes(data, starts, ends)
    n = len(h)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return data, starts, ends, owner, none, none, none.astype(np.uint64)
    grams = np.zeros(n - anchor + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j, odd in enumerate(B.odd_numbers(anchor, 11)):
            grams += h[j : n - anchor + 1 + j] * odd
    grams = B.mix(grams)
    # the least of each run of window - anchor + 1 grams, the first of equals, by doubling
    best, at, width, want = grams, np.arange(len(grams)), 1, window - anchor + 1
    while width < want:
        step = min(width, want - width)
        left, right, lp, rp = best[:-step], best[step:], at[:-step], at[step:]
        first = left <= right
        best, at, width = np.where(first, left, right), np.where(first, lp, rp), width + step
    inside = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    return data, starts, ends, owner, inside, at[inside], best[inside]


def _anchors(docs: DataFrame) -> DataFrame:
    """(kd, k1, h, n): how often each anchor stands in each document."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for b in pieces_of(batches, 2):
            _, _, _, owner, _, at, h = _windows(b.column(2))
            new = np.flatnonzero(np.diff(at, prepend=-1))
            own, h = owner[at[new]], h[new].astype(np.int64)
            order = np.lexsort((h, own))
            own, h = own[order], h[order]
            edge = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(h, prepend=h[:1] + 1) != 0))
            counts = np.diff(np.append(edge, len(h)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(own[edge])), b.column(1).take(pa.array(own[edge])), pa.array(h[edge]), pa.array(counts)],
                ["kd", "k1", "h", "n"],
            )

    return docs.mapInArrow(run, "kd long, k1 long, h long, n long")


def _contexts(docs: DataFrame) -> DataFrame:
    """(h, hot, kd, k1, first, n, words): for each place of a repeated anchor the n suffixes that it names.

    They start at word ``first`` and after; ``words`` is the text that they cover.
    """
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for b in pieces_of(batches, 2):
            data, starts, ends, owner, inside, at, h = _windows(b.column(2))
            edge = np.flatnonzero(np.diff(at, prepend=-1))
            counts = np.diff(np.append(edge, len(at)))
            own, hs, p = owner[at[edge]], h[edge].astype(np.int64), inside[edge]
            wanted, hot = np.zeros(len(edge), bool), np.zeros(len(edge), bool)
            bounds = np.searchsorted(own, np.arange(b.num_rows + 1))
            for d, anchors in enumerate(b.column(3)):
                lo, hi = bounds[d], bounds[d + 1]
                if lo < hi:
                    a = np.sort(anchors.values.field("h").to_numpy())
                    k = np.minimum(np.searchsorted(a, hs[lo:hi]), len(a) - 1)
                    wanted[lo:hi] = a[k] == hs[lo:hi]
                    order = np.argsort(anchors.values.field("h").to_numpy())
                    hot[lo:hi] = anchors.values.field("hot").to_numpy(zero_copy_only=False)[order][k]
            keep = np.flatnonzero(wanted)
            p, counts, own, hs, hot = p[keep], counts[keep], own[keep], hs[keep], hot[keep]
            raw = data.tobytes()
            first_word = np.searchsorted(owner, np.arange(b.num_rows))
            texts = [
                b" ".join(raw[starts[i] : ends[i + c + WINDOW - 2]].split())
                for i, c in zip(p.tolist(), counts.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hs), pa.array(hot), b.column(0).take(pa.array(own)), b.column(1).take(pa.array(own)),
                    pa.array((p - first_word[own]).astype(np.int32)), pa.array(counts.astype(np.int32)), pa.array(texts, pa.binary()),
                ],
                ["h", "hot", "kd", "k1", "first", "n", "words"],
            )

    return docs.mapInArrow(run, "h long, hot boolean, kd long, k1 long, first int, n int, words binary")


def suffixes(words: bytes, n: int, window: int = WINDOW) -> list[bytes]:
    """The first n suffixes of a piece of text, cut after ``window`` words."""
    cuts = [-1]
    at = words.find(b" ")
    while at >= 0:
        cuts.append(at)
        at = words.find(b" ", at + 1)
    cuts.append(len(words))
    return [words[cuts[i] + 1 : cuts[i + window]] for i in range(n)]


def deep_leaves(group: list[tuple[bytes, object]]) -> list[object]:
    """The windows of a group that are equal to another one: they are sorted, and equal neighbours are repeats."""
    group.sort(key=lambda x: x[0])
    found = []
    for _, leaves in groupby(group, key=lambda x: x[0]):
        below = [leaf for _, leaf in leaves]
        if len(below) > 1:
            found += below
    return found


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """Sorted window starts as ranges (first start, last start) without gaps."""
    out: list[list[int]] = []
    for s in sorted(starts):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [(a, b) for a, b in out]


def _repeats_in_groups(contexts: DataFrame) -> DataFrame:
    """(kd, k1, lo, hi): window starts lo to hi repeat; groups have MEMORY_ROWS places at most."""
    import pyarrow as pa

    def solve(rows):
        group = [
            (suffix, (place, first + i))
            for place, (_, _, first, n, words) in enumerate(rows)
            for i, suffix in enumerate(suffixes(words, n))
        ]
        by_place: dict[int, list[int]] = {}
        for place, start in deep_leaves(group):
            by_place.setdefault(place, []).append(start)
        return [(*rows[place][:2], lo, hi) for place, starts in by_place.items() for lo, hi in _runs(starts)]

    def out(found):
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["kd", "k1", "lo", "hi"]
        )

    def run(batches):
        rows, now = [], None
        for b in batches:
            found = []
            for h, *row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
                if h != now and rows:
                    found += solve(rows)
                    rows = []
                now = h
                rows.append(row)
            yield out(found)
        if rows:
            yield out(solve(rows))

    grouped = contexts.select("h", "kd", "k1", "first", "n", "words").repartition("h").sortWithinPartitions("h")
    return grouped.mapInArrow(run, "kd long, k1 long, lo int, hi int")


def _repeats_of_long_prefixes(contexts: DataFrame) -> DataFrame:
    """(kd, k1, spans) for anchors with very many places: a window's group is named by a digest of all its words.

    All windows of such a group are equal, so it need only be counted, which combines before the shuffle. Places
    whose whole text occurs again are repeats by that alone; only one of each such text is cut into suffixes.
    The places of one text in one document are one row, however often the document repeats it.
    """
    import pyarrow as pa

    def run(batches):
        from hashlib import blake2b

        for b in batches:
            rows = [
                (blake2b(s, digest_size=16).digest(), alone, kd, k1, first + i)
                for alone, kd, k1, first, n, words in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)
                for i, s in enumerate(suffixes(words, n))
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["digest", "alone", "kd", "k1", "lo"]
            )

    named = contexts.withColumn("text", F.md5("words"))
    texts = stage(
        named.groupBy("text").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("kd", "k1", "first", "n", "words")).alias("p")),
        "repeat-texts",
    )
    span = F.struct(F.col("first").alias("lo"), (F.col("first") + F.col("n") - 1).alias("hi"))
    placed = named.groupBy("text", "kd", "k1").agg(F.collect_list(span).alias("spans"))
    copied = placed.join(texts.where("times > 1").select("text"), "text").select("kd", "k1", "spans")
    single = texts.select((F.col("times") == 1).alias("alone"), "p.*").mapInArrow(
        run, "digest binary, alone boolean, kd long, k1 long, lo int"
    )
    deep = single.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    shared = single.where("alone").join(deep, "digest").select("kd", "k1", _spans(F.col("lo"), F.col("lo")))
    return copied.unionAll(shared)


def _spans(lo: Column, hi: Column) -> Column:
    return F.array(F.struct(lo.alias("lo"), hi.alias("hi"))).alias("spans")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Remove each word that a repeated window of 35 words covers.

    One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (the kept words, joined by one
    blank) and ``removed`` (an array of word ranges from, to). A window repeats if its words also start
    anywhere else, in the same or another row; windows are judged on the input. Null and empty texts, and
    texts under 35 words, keep all they have. Rows of one id and one text repeat each other. Other columns are
    not read.
    """
    import pyarrow as pa

    keyed = with_row_key(docs.select("doc_id", text_or_empty().alias("text")), F.col("text"))
    keyed = keyed.withColumn("k2", F.xxhash64(F.lit(1), F.col("text")))
    # all windows of a whole text that occurs again repeat, so one row stands for its copies in the search
    copies = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("times"), F.min("kd").alias("first_kd")).where("times > 1")
    copies = small(stage(copies.select("k1", "k2", "first_kd"), "repeat-copies"))
    keyed = keyed.join(copies, ["k1", "k2"], "left")
    texts = keyed.where("first_kd is null or kd = first_kd").select("kd", "k1", "text")
    anchors = stage(_anchors(texts), "repeat-anchors")
    repeated = anchors.groupBy("h").agg(F.sum("n").alias("places")).where("places > 1")
    mine = (
        anchors.select("kd", "k1", "h")
        .join(repeated, "h")
        .select("kd", "k1", F.struct("h", (F.col("places") > MEMORY_ROWS).alias("hot")).alias("a"))
        .groupBy("kd", "k1")
        .agg(F.collect_set("a").alias("anchors"))
    )
    contexts = stage(_contexts(texts.join(mine, ["kd", "k1"])), "repeat-contexts")
    found = _repeats_in_groups(contexts.where("not hot")).select("kd", "k1", _spans(F.col("lo"), F.col("hi")))
    marks = stage(found.unionAll(_repeats_of_long_prefixes(contexts.where("hot"))), "repeat-marks")
    # no order and no distinctness is needed: each range is only marked
    marks = marks.groupBy("kd", "k1").agg(F.flatten(F.collect_list("spans")).alias("marks"))

    def cut(batches):
        import numpy as np

        for b in batches:
            out = []
            columns = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()
            for doc_id, text, ranges, copied in zip(*columns, strict=True):
                words = text.encode().split()
                if copied and len(words) >= WINDOW:
                    kept, spans = [], [{"from": 0, "to": len(words)}]
                elif ranges.is_valid and len(ranges):
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(gone, ranges.values.field("lo").to_numpy(), 1)
                    np.add.at(gone, ranges.values.field("hi").to_numpy() + WINDOW, -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    spans = [{"from": int(x), "to": int(y)} for x, y in zip(edge[0::2], edge[1::2], strict=True)]
                else:
                    kept, spans = words, []
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode(), spans))
            span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
            )

    joined = keyed.join(marks, ["kd", "k1"], "left").select(
        F.col("doc_id").cast("long"), "text", "marks", F.col("first_kd").isNotNull().alias("copied")
    )
    return joined.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<from:long,to:long>>"
    )
