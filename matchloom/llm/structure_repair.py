"""Repair of conversations whose turns are lost, emptied, cut, repeated or given a wrong role.

The cheapest list of edits that makes a conversation's role initials ``(s?(ua)+)?`` is found by depth-first
branch and bound. A row is kept (0), given the role user or assistant (2) or deleted (3); an empty turn of either
role may be inserted anywhere (2). Blank and repeated rows must be deleted; a truncated row that stays adds 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import inf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import OTHER_SPACE

START, SYSTEM, USER, ASSISTANT = range(4)
#: where an inserted or re-roled turn leads to, and its role
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: what must be inserted if a conversation ends in a state
AT_END = (0, 4, 2, 0)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}

#: a row that must go; other rows are their initial (- if none of s, u and a), in capitals (_) if truncated
GONE = "x"
#: rows of one search
ROWS = 32
_CAPITAL = {"s": "S", "u": "U", "a": "A", "-": "_"}
_PLAIN = {capital: plain for plain, capital in _CAPITAL.items()}


def suffix_bounds(initials: list[str], cut: list[int], ends: tuple[int, ...]) -> list[list[int]]:
    """A lower bound of the cost of rows i.. from each state, as ``bounds[state][i]``; ``ends`` is exact after the last row.

    Rows count what each must cost alone. Two rows of one role with only deleted rows between them cost 2 more,
    spent on either row or on the gap; such pairs are added up where they share no row. The state before row i and
    what follows the last row count as neighbours too.
    """
    n = len(initials)
    bounds = [[0] * n + [ends[q]] for q in range(4)]
    # of the next row that need not go: its place, what pairs add among the rows from it on, and among those after it
    first, pairs, pairs_after = n, 0, 0
    fresh, later, floor = 0, 0, min(ends)
    for i in range(n - 1, -1, -1):
        x = initials[i]
        if x == GONE:
            fresh, later = fresh + DELETE, later + DELETE
        else:
            apart = 0
            if x in "ua":
                apart = min(INSERT, ends[USER if x == "u" else ASSISTANT] - floor) if first == n else 2 * (initials[first] == x)
            pairs, pairs_after = max(pairs, apart + pairs_after), pairs
            first = i
            fresh += cut[i] + REROLE * (x == "-")
            later += cut[i] + REROLE * (x in "s-")
        for q in range(4):
            own = fresh if q == START else later
            if first == n:
                bounds[q][i] = own + ends[q]
            else:
                lead = 2 * (initials[first] in "ua" and initials[first] not in KEEPS[q])
                bounds[q][i] = own + floor + max(pairs, lead + pairs_after)
    return bounds


def _edits(initials: list[str], cut: list[int], bounds: list[list[int]], i: int, q: int) -> list[tuple]:
    """(bound, letter, cost, next row, next state) of each edit at a node, the most promising first."""
    edits = [("D", DELETE, i + 1, q), ("I", INSERT, i, NEXT[q])]
    if (x := initials[i]) != GONE:
        kept = KEEPS[q].get(x)
        if kept is not None:
            edits.append(("K", cut[i], i + 1, kept))
        if kept != NEXT[q]:
            edits.append(("R", REROLE + cut[i], i + 1, NEXT[q]))
    return sorted((cost + bounds[q2][j], letter, cost, j, q2) for letter, cost, j, q2 in edits)


@lru_cache(maxsize=1 << 16)
def search(codes: str, ends: tuple[int, ...], start: int) -> tuple[int, str, int]:
    """(cost, audit, last state) of the cheapest edits of some rows from state ``start``, with ``ends`` to pay after them.

    Depth first with an explicit stack. A node is (row, state); the path to it is dropped if it costs more than
    another one to the same node (the dominance table), or if its cost and the suffix bound exceed the incumbent's
    cost, or equal it while the path is no smaller than the incumbent's audit. A node that is done tightens its
    bound by its edits' bounds. The search ends when the stack is empty: the incumbent is then proved. Paths to one
    node at one cost differ before either ends, so the smaller one stays smaller whatever follows. What is inserted
    after the last row belongs to ``ends``.
    """
    n = len(codes)
    if n == 0:
        return ends[start], "", start
    initials = [_PLAIN.get(c, c) for c in codes]
    cut = [CUT * (c in _PLAIN) for c in codes]
    bounds = suffix_bounds(initials, cut, ends)
    least = [[inf] * (n + 1) for _ in NEXT]
    least[start][0] = 0
    best, audit, last = inf, "", start
    path: list[str] = []
    # of each prefix of the path: -1, 0 or 1 as it is smaller than, the start of, or greater than the incumbent's audit
    against = [0]
    stack = [(0, start, 0, _edits(initials, cut, bounds, 0, start), [0])]
    while stack:
        i, q, cost, edits, done = stack[-1]
        if done[0] == len(edits):
            bounds[q][i] = max(bounds[q][i], min(c + bounds[q2][j] for _, _, c, j, q2 in edits))
            stack.pop()
            if stack:
                path.pop()
                against.pop()
            continue
        _, letter, step, j, q2 = edits[done[0]]
        done[0] += 1
        now = cost + step
        bound = now + bounds[q2][j]
        side = against[-1]
        if side == 0 and best < inf:
            at = audit[len(path) : len(path) + 1]
            side = (letter > at) - (letter < at)
        if bound > best or bound == best and side >= 0:
            continue
        if now > least[q2][j] or now == least[q2][j] and side >= 0:
            continue
        least[q2][j] = now
        if j == n:
            best, audit, last = bound, "".join(path) + letter, q2
            against = [0] * len(against)
            continue
        path.append(letter)
        against.append(side)
        stack.append((j, q2, now, _edits(initials, cut, bounds, j, q2), [0]))
    return int(best), audit, last


def cheapest_edits(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation's row codes; of equal ones the ASCII-least audit.

    Up to ``ROWS`` rows are one search. Longer conversations are nested suffixes: a search of the last rows from each
    state gives the exact ends of the rows before them, and so on, so that the work grows with the rows.
    """
    cuts = list(range(0, max(len(codes), 1), ROWS))
    ends, base, found = AT_END, 0, []
    for a in reversed(cuts):
        found.append([search(codes[a : a + ROWS], ends, q) for q in (range(4) if a else (START,))])
        least = min(f[0] for f in found[-1])
        base, ends = base + least, tuple(f[0] - least for f in found[-1])
    state, audit = START, []
    for results in reversed(found):
        _, letters, state = results[state]
        audit.append(letters)
    return base, "".join(audit) + "I" * (AT_END[state] // INSERT)


def _or_blank(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def turns_of(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, a null role or text being one space."""
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _or_blank("role").alias("role"), _or_blank("text").alias("text"))


def _by_conversation(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation together in one partition and in order; sorting spills, nothing is collected."""
    order = [*first, F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


class _Conversation:
    """What a plan needs of the rows of one conversation, fed in order: a byte and a digest a row."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.codes, self.seen = conv_id, [], set()
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, turn, initial: str, is_blank: bool, is_cut: bool, digest: str) -> None:
        if self.n and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last, self.n = initial, self.n + 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        code = initial if initial in ("s", "u", "a") else "-"
        if is_blank:
            self.blank, code = self.blank + 1, GONE
        elif digest in self.seen:
            self.duplicate, code = self.duplicate + 1, GONE
        elif is_cut:
            self.truncated, code = self.truncated + 1, _CAPITAL[code]
        if not is_blank:
            self.seen.add(digest)
        self.codes.append(code)

    def plan(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = cheapest_edits("".join(self.codes))
        return self.conv_id, self.n, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


PLAN = "conv_id long, n_turns long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plan_repairs(turns: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: its faults, and the cost and audit of its cheapest repair.

    Rows are taken by turn, nulls first; rows of one turn by role and text. Null roles and texts are one space. The
    first fault of a row counts: blank (no character but white space), duplicate (role and text of an earlier row),
    truncated (the last character that is no white space is none of ``.!?``). ``gaps`` are the numbers missing
    between the least and the greatest turn (0 if all are null), ``illegal`` the neighbours whose initials are not
    su, ua or au. ``audit`` has a letter for each edit in order: K(eep), R(erole), D(elete), I(nsert). An empty role
    fits nowhere. Rows with a null ``conv_id`` are one conversation; other columns are not read; an empty table
    gives no row. Texts stay on the JVM's side: a task holds one byte and one digest for each row of a conversation.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def flushed():
            kinds = [pa.int64()] * 8 + [pa.string()]
            names = [c.split()[0] for c in PLAN.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for b in batches:
            for conv_id, *row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.plan())
                        if len(out) >= 4096:
                            yield flushed()
                            out = []
                    now = _Conversation(conv_id)
                now.add(*row)
        if now is not None:
            out.append(now.plan())
            yield flushed()

    body = F.btrim("text", F.lit(" " + OTHER_SPACE))
    compact = _by_conversation(turns_of(turns)).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        (body == "").alias("is_blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("is_cut"),
        F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256).alias("digest"),
    )
    return compact.mapInArrow(run, PLAN)


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit) of the conversations after the edits of ``plans``.

    ``place`` counts from 0; ``edit`` is K, R or I. A kept row has its own role and text, an inserted one an empty
    text. The rows of a conversation stand in one partition and in order of place; a conversation without rows after
    the edits gives none. Nulls, ties and other columns are as in ``plan_repairs``, which made the plans of these
    rows. A task streams the rows and holds one audit at a time.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, audit, at, place, state = None, "", 0, 0, START
        for b in batches:
            out = []

            def inserted():
                nonlocal at, place, state
                while audit[at : at + 1] == "I":
                    state = NEXT[state]
                    out.append((conv_id, place, ROLES[state], "", "I"))
                    at, place = at + 1, place + 1

            for key, plan, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if plan is not None:
                    conv_id, audit, at, place, state = key, plan, 0, 0, START
                    inserted()
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = KEEPS[state][role[:1]] if edit == "K" else NEXT[state]
                    out.append((key, place, role if edit == "K" else ROLES[state], text, edit))
                    place += 1
                inserted()
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "role", "text", "edit"])

    rows = turns_of(turns).select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", "text")
    none = F.lit(None)
    heads = plans.select("conv_id", F.lit(0), "audit", none.cast("long"), none.cast("string"), none.cast("string"))
    both = _by_conversation(rows.union(heads), "kind").select("conv_id", "audit", "role", "text")
    return both.mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` of each conversation's turns, newline-joined.

    Takes the rows as ``repaired_turns`` gives them, together and in order, and holds one hash state a task.
    """
    import hashlib

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in out], pa.int64()), pa.array([s.hexdigest() for _, s in out])], ["conv_id", "sha256"]
        )
        for b in batches:
            for conv_id, place, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if state is None or place == 0:
                    if state is not None:
                        out.append((now, state))
                    now, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if out:
                yield batch()
                out = []
        if state is not None:
            out.append((now, state))
            yield batch()

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, "conv_id long, sha256 string")
