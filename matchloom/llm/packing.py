"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import stage, text_or_empty

CAPACITY = 2048
END_ID = 0


def _added_tokens(path: str) -> dict[str, int]:
    """The tokens that a vocabulary file adds to those of the ranks."""
    import json

    with open(path.removesuffix(".tiktoken").removesuffix(".json") + ".json", encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t[k] for t in tokens for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("added tokens that take blanks or match whole words only are not supported")
    return {t["content"]: t["id"] for t in tokens}


def _encoder(path: str, added_tokens: bool = False):
    """The byte-level tokenizer whose ranks lie beside ``path``: the same ids, six times as fast.

    ``path`` names the vocabulary file; a ``.tiktoken`` file beside it, or itself, has its ranks.
    """
    import base64

    import public_tokenizers
    import tiktoken

    ranks_path = path.removesuffix(".json").removesuffix(".tiktoken") + ".tiktoken"
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=_added_tokens(path) if added_tokens else {})


def pieces_of_length(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): pieces of ``capacity``, the first of them shorter if need be."""
    first = n % capacity or capacity
    bounds = [0, *range(first, n + 1, capacity)]
    return list(zip(bounds, [b - a for a, b in zip(bounds, bounds[1:], strict=False)], strict=False))


def tokenize(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, added_tokens: bool = False
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, part, place) and, on demand, their ids.

    ``part`` is the task that made the piece, ``place`` counts the task's pieces of that length. Nothing is
    collected by length.
    """
    import pyarrow as pa

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + (
        ", ids array<int>" if keep_ids else ""
    )

    def run(batches):
        import zlib
        from collections import Counter

        import numpy as np
        from pyspark import TaskContext

        part, seen, encoder = TaskContext.get().partitionId(), Counter(), _encoder(tokenizer, added_tokens)
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(np.asarray(encoder.encode_to_numpy(text or "", allowed_special="all", disallowed_special=()), dtype="<u4"), np.uint32(END_ID))
                for k, (start, length) in enumerate(pieces_of_length(len(ids), capacity)):
                    own = ids[start : start + length].astype("<u4")
                    row = (doc_id, k, start, length, zlib.crc32(own.tobytes()), part, seen[length])
                    out.append((*row, own.astype(np.int32)) if keep_ids else row)
                    seen[length] += 1
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=False)], names[: len(columns)]
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The lengths of the fullest bin that holds the longest piece, each with how often it is taken.

    Subset sums are the bits of a whole number; lengths are added from the longest, and a length that is not
    needed to reach the sum is left out, so long pieces go first.
    """
    longest = max(counts)
    reach, steps = 1, []
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = counts[length] - (length == longest)
        left, take = min(left, room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, first sequence, taken in each, offset) for all bins.

    Works on how many pieces there are of each length, of which there are ``capacity`` at most, and fills as
    many bins alike as the counts allow; its size does not grow with the pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used, rows, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        chosen = fullest(left, capacity)
        bins = min(left[n] // k for n, k in chosen.items())
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            rows.append((n, used[n], used[n] + bins * k, sequence, k, offset))
            used[n] += bins * k
            left[n] -= bins * k
            offset += n * k
            if not left[n]:
                del left[n]
        sequence += bins
    return rows


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, added_tokens: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) and, on demand, ids, of every piece.

    A document is its ids and an end id; only documents longer than ``capacity`` are cut. Null texts are
    empty: their piece is the end id alone. With ``added_tokens`` a text that spells a token which the vocabulary
    file adds has its one id, as by the library's default; else it is split like other text. Repeated rows are packed each. An empty table gives no piece.
    The driver holds the number of pieces of each length and the plan made of it, both bounded by
    ``capacity``; pieces find their bins by their rank among those of their length.
    """
    pieces = stage(tokenize(docs, tokenizer, capacity, keep_ids, added_tokens), "packing-pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    bases = _bases(by_part)
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    return _assigned(ranked, plan(counts, capacity), keep_ids)


def _bases(by_part: DataFrame) -> DataFrame:
    """How many pieces of a length the tasks before a task have made; a row for each task and length."""
    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _assigned(ranked: DataFrame, rows, keep_ids: bool) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    table: dict[int, np.ndarray] = {}
    for row in rows:
        table.setdefault(row[0], []).append(row[1:])
    shared = ranked.sparkSession.sparkContext.broadcast({n: np.array(r, dtype=np.int64) for n, r in table.items()})
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at, plan_rows = np.flatnonzero(length == n), shared.value[int(n)]
                row = plan_rows[np.searchsorted(plan_rows[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + nth // row[:, 3]
                offset[at] = row[:, 4] + nth % row[:, 3] * n
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return ranked.select(*names, "rank").mapInArrow(run, schema + ", sequence_id long, offset long")
