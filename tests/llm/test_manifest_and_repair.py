"""The manifest against a tree built in one piece, and repairs against the best of all edits."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.llm import merkle_manifest, queries, structure_repair

DIRECTORY = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# manifest


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root, and of each leaf the (left, right) siblings of every level."""
    proofs, owner, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(owner):
            first = place // 3 * 3
            proofs[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + 3])))
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        owner = [p // 3 for p in owner]
    return level[0], proofs


def plain_manifest(rows):
    """A row (doc_id, leaf, subroot, root, proof digest, folded root, verified) of each (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(sources[s], key=lambda x: x[:3])) for s in order}
    made = {s: plain_tree([x[2] for x in trees[s]]) for s in order}
    root, above = plain_tree([made[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, _, leaf, row), proof in zip(trees[s], made[s][1], strict=True):
            whole = [*proof, *above[k]]
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                shown = (*row[:4], row[4].replace("\n", ""))
            fold = plain_leaf(shown)
            for left, right in whole:
                fold = sha(left + fold + right)
            out.append((row[0], leaf, made[s][0], root, sha("".join(a + b for a, b in whole)), fold, fold == root))
    return Counter(out)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def written(spark, folder, rows, schema, name):
    df = spark.createDataFrame(rows, schema)
    df.withColumns({c: F.lit(7) for c in ("tree", "n", "place", "hash", "chunk", "root", "proof", "col", "kind", "audit")}).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_manifest_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = queries.op11_merkle_manifest(spark, DIRECTORY)
    assert Counter(tuple(r) for r in found.collect()) == plain_manifest(rows)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_of_awkward_rows(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    monkeypatch.setattr(merkle_manifest, "CHUNK", 3**levels)
    rng = random.Random(2)
    rows = [(i, "hot", "en", 3, "a\nb") for i in range(100)]
    rows += [(rng.randrange(40), rng.choice([None, "", "é", "z", "hot", "Z"]), rng.choice([None, "de"]), None, rng.choice([None, "", "\n\n", "x" * 99_999 + "\n"])) for _ in range(90)]
    rows += [(None, "z", None, None, "n\n")] * 3 + [(5, "alone", "en", 1, "x")] + [(6, "twice", "en", 1, "x\n")] * 2
    found = queries.op11_merkle_manifest(spark, written(spark, tmp_path, rows, DOCS, "documents"))
    assert Counter(tuple(r) for r in found.collect()) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_manifest_of_few_rows(spark, tmp_path, n):
    rows = [(i, f"s{i % 2}", None, i, "t\n") for i in range(n)]
    found = queries.op11_merkle_manifest(spark, written(spark, tmp_path, rows, DOCS, "documents"))
    assert Counter(tuple(r) for r in found.collect()) == (plain_manifest(rows) if rows else Counter())


def test_missing_nodes_are_enough_and_each_is_needed():
    rng = random.Random(3)
    for n in (1, 2, 3, 4, 10, 28, 82):
        leaves = [sha(str(i)) for i in range(n)]
        _, proofs = plain_tree(leaves)
        whole = merkle_manifest.derived(dict(enumerate(leaves)), n, {})
        for _ in range(5):
            places = rng.sample(range(n), rng.randint(1, n))
            missing = merkle_manifest.missing_nodes(places, n)
            assert len(missing) == len(set(missing))
            fetched = {(level, p): whole[level][p] for level, p in missing}
            levels = merkle_manifest.derived({p: leaves[p] for p in places}, n, fetched)
            assert levels[-1] == whole[-1]
            assert [merkle_manifest.siblings(levels, p, n) for p in places] == [proofs[p] for p in places]
            for gone in fetched:
                with pytest.raises(KeyError):
                    merkle_manifest.derived({p: leaves[p] for p in places}, n, {k: v for k, v in fetched.items() if k != gone})


# structure repair


def all_edits(rows):
    """The cheapest (cost, audit, repaired) of all lists of edits, by trying every edit at every row."""
    best = {"": (0, "", ())}
    fits = lambda s: s in ("", "s", "u", "su") or s.lstrip("s") and len(s) - len(s.lstrip("s")) < 2 and set(zip(s.lstrip("s"), s.lstrip("s")[1:], strict=False)) <= {("u", "a"), ("a", "u")} and s.lstrip("s")[0] == "u"

    def inserted(states):
        todo = list(states)
        while todo:
            s = todo.pop()
            cost, audit, out = states[s]
            if len(s) < 2 * len(rows) + 4:
                for role in ("user", "assistant"):
                    new = (cost + 2, audit + "I", (*out, f"{role}:"))
                    if fits(s + role[0]) and (s + role[0] not in states or new < states[s + role[0]]):
                        states[s + role[0]] = new
                        todo.append(s + role[0])
        return states

    best = inserted(best)
    for role, text, must_go, cut in rows:
        after = {}

        def put(s, new):
            if fits(s) and (s not in after or new < after[s]):
                after[s] = new

        for s, (cost, audit, out) in best.items():
            put(s, (cost + 3, audit + "D", out))
            if not must_go:
                if role:
                    put(s + role[0], (cost + cut, audit + "K", (*out, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    put(s + other[0], (cost + 2 + cut, audit + "R", (*out, f"{other}:{text}")))
        best = inserted(after)
    return min(v for s, v in best.items() if s == "" or s[-1] == "a")


def plain_repair(conv_id, rows):
    """The row that the contract asks for, of damaged (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    counts, seen, judged = Counter(), set(), []
    for _, role, text in rows:
        body = text.strip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = all_edits(judged)
    return conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, int(cost), audit, sha("\n".join(out))


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain_repairs(rows):
    convs = {r[0]: [] for r in rows}
    for conv_id, *rest in plain_damage(rows):
        convs[conv_id].append(tuple(rest))
    return Counter(plain_repair(c, convs[c]) for c in convs)


def test_repair_of_conversations(spark):
    directory = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = Counter(tuple(r) for r in queries.op13_structure_repair(spark, directory).collect())
    assert found == plain_repairs(rows)


def test_repair_of_awkward_conversations(spark, tmp_path):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", None, "", "aide", "user", "assistant"]
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t", None, "same.", "same.", "漢字。", "\x1c", "x" * 50_000 + "."]
    rows = [(c if c else None, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(90, 1, "user", "Yes."), (90, 1, "user", "Yes."), (90, 1, "assistant", "a."), (90, 5, "user", None)]
    rows += [(91, None, "user", "Yes."), (91, None, "user", "No."), (92, t_of_drop(92), "user", "gone.")]
    found = queries.op13_structure_repair(spark, written(spark, tmp_path, rows, "conv_id long, turn long, role string, text string", "conversations"))
    assert Counter(tuple(r) for r in found.collect()) == plain_repairs(rows)


def t_of_drop(conv_id):
    """A turn that the damage drops."""
    return next(t for t in range(1000) if zlib.crc32(f"{conv_id}:{t}".encode()) % 20 == 0)


def test_repair_of_no_conversations(spark, tmp_path):
    folder = written(spark, tmp_path, [], "conv_id long, turn long, role string, text string", "conversations")
    assert queries.op13_structure_repair(spark, folder).count() == 0


def plain_codes(codes):
    """The rows whose codes these are, for the list of all edits."""
    roles = {"s": "system", "u": "user", "a": "assistant", "-": "tool", "x": "user"}
    plain = {"S": "s", "U": "u", "A": "a", "_": "-"}
    return [(roles[plain.get(c, c)], "t", c == "x", c in plain) for c in codes]


@pytest.mark.parametrize("rows", [2, 32])
def test_search_against_all_edits(monkeypatch, rows):
    monkeypatch.setattr(structure_repair, "ROWS", rows)
    rng = random.Random(rows)
    for _ in range(300):
        codes = "".join(rng.choice("xsuaSUA-_uuaa") for _ in range(rng.randrange(8)))
        assert structure_repair.cheapest_edits(codes) == all_edits(plain_codes(codes))[:2]


def test_bounds_never_exceed_the_cost():
    rng = random.Random(7)
    for _ in range(300):
        codes = "".join(rng.choice("xsuaSUA-_uuaa") for _ in range(rng.randrange(1, 9)))
        plain = [structure_repair._PLAIN.get(c, c) for c in codes]
        cut = [c in structure_repair._PLAIN for c in codes]
        bounds = structure_repair.suffix_bounds(plain, cut, structure_repair.AT_END)
        for q in range(4):
            for i in range(len(codes) + 1):
                assert bounds[q][i] <= structure_repair.search(codes[i:], structure_repair.AT_END, q)[0]


def test_one_very_long_conversation(spark):
    turns = spark.range(60_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 7 < 3, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    plan = structure_repair.plan_repairs(turns).first()
    kinds = Counter(plan.audit)
    assert plan.n_turns == 60_000 == kinds["K"] + kinds["R"] + kinds["D"] and plan.cost == 2 * kinds["R"] + 3 * kinds["D"] + 2 * kinds["I"]
    repaired = structure_repair.repaired_turns(turns, structure_repair.plan_repairs(turns))
    n = kinds["K"] + kinds["R"] + kinds["I"]
    assert repaired.groupBy("role", F.col("place") % 2).count().count() == 2 and repaired.count() == n
