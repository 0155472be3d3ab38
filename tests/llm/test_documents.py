"""Document operators against brute force, exact round trips and held-out labels, and on awkward tables."""

import functools
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, oracle_rows, rows_of
from matchloom.llm import (
    chat_format,
    decontamination,
    license_scan,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    sampling,
    simhash_dedup,
    substring_dedup,
    toxicity,
)
from matchloom.llm.common import stage

DIRECTORY = "/root/testdata/sf0.001"
TOKENIZER = queries.public_tokenizers.path(queries.TOKENIZER)


def texts_of(spark):
    rows = spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, very long and repeated texts, ties, and columns whose names the operators use inside."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    line = " ".join(rng.sample(words, 20)) + "."
    texts = [
        None,
        "",
        " \n\t\n ",
        "one",
        passage + " tail one",
        "head two " + passage,
        " ".join(rng.choice(words) for _ in range(9000)),
        "\n".join([line, line, "short", line.replace("w1 ", "x1 ", 1)]),
        "\n".join([line.replace(" ", "  ", 2), "other words here", ""]),
        "Spam!! Spam!! Spam!! | a | b | c | d\nAll rights reserved.",
        passage + "\x00\x02 é ü 漢字  \\ $1 [INST]",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, texts[5]), (None, texts[5]), (4, "another text of four")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ("n_words", "kept", "row", "t", "kd", "k1", "lines", "w", "score", "item_id", "h", "tokens", "label", "start")
    df = df.select("*", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    return df.select("*", *[F.lit(5).alias(c) for c in extra]).repartition(3).cache()


@pytest.fixture(scope="module")
def plain_rows(awkward):
    return [(r.doc_id, r.text or "") for r in awkward.select("doc_id", "text").collect()]


def counts_of(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_and_sql(spark, name):
    df = queries.QUERIES[name](spark, DIRECTORY)
    names, expected = oracle_rows(connect(DIRECTORY), queries.ORACLES[name])
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, expected)


# quality rules


def base_counts(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(awkward, plain_rows):
    found = quality_rules.quality_rules(awkward).select("row.doc_id", "n_words", "n_dup_lines", "n_repeat_words").collect()
    assert counts_of(found) == Counter((i, *base_counts(t)) for i, t in plain_rows)
    kept = quality_rules.clean_documents(awkward)
    assert kept.columns == awkward.columns
    assert 9 not in {r.doc_id for r in kept.collect()}


def test_boilerplate_and_navigation_lines_go(spark):
    good = "This is a plain sentence of quite a few words that nobody would remove."
    text = "\n".join([good, "Home | News | Sport | About", "All Rights Reserved by us", "", good + " Again."])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules.quality_rules(docs).first().cleaned_text == "\n".join([good, "", good + " Again."])


# substring dedup


def brute_substrings(rows, window=35):
    words = [t.encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return Counter(out)


@pytest.mark.parametrize("memory_rows", [1, 2000])
def test_substring_dedup(awkward, plain_rows, monkeypatch, memory_rows):
    monkeypatch.setattr(substring_dedup, "MEMORY_ROWS", memory_rows)
    found = substring_dedup.substring_dedup(awkward).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_substrings(plain_rows)


def test_substrings_that_a_document_repeats_itself(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MEMORY_ROWS", 1)
    period = " ".join(f"p{i}" for i in range(40))
    rows = [(1, " ".join([period] * 30)), (2, "a " + " ".join([period] * 3) + " z"), (None, period + " own end"), (3, "p0 p1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_substrings(rows)


# licences


def test_license_scan(spark, awkward):
    text = "Licensed under CC BY-NC 4.0. The GNU General\nPublic License! cc\tby x\nSPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0"
    docs = spark.createDataFrame([(1, text), (2, "ccc by, all rights\xa0reserved"), (3, None)], "doc_id long, text string")
    one, two, three = license_scan.license_scan(docs).orderBy("doc_id").collect()
    assert (one.n_base, one.first_word, one.last_word, one.base_labels) == (3, 2, 12, "cc-by,gpl")
    assert {"cc-by-nc", "mit", "apache-2.0", "notice"} <= set(one.labels.split(","))
    assert [(e.valid, e.free) for e in one.expressions] == [(True, True)]
    assert (two.n_words, two.n_base, two.first_word) == (4, 0, None)
    assert (three.n_words, three.score, three.labels) == (0, 0.0, "")
    assert license_scan.license_scan(awkward).count() == awkward.count()


def brute_licenses(text):
    """Words, starts of base phrases and labels of phrases, by looking for every phrase at every word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = {}
    for phrase, label in [*license_scan.BASE.items(), *license_scan.NOTICES.items()]:
        parts = phrase.split()
        found[phrase] = (label, [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts])
    starts = [i for phrase in license_scan.BASE for i in found[phrase][1]]
    base = {label for phrase, label in license_scan.BASE.items() if found[phrase][1]}
    labels = {label for label, at in found.values() if at}
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base))), labels


@pytest.mark.parametrize("table", ["documents", "awkward"])
def test_license_places_and_labels(spark, awkward, table):
    rows = awkward if table == "awkward" else spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = rows.select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, "All rights reserved, cc by sa! general public license cc-by cc by"), (-2, "mit licence; ALL\nRIGHTS reserved")], "doc_id long, text string")
    )
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.license_scan(rows).collect())
    assert found == Counter((r.doc_id, *brute_licenses(r.text)[0]) for r in rows.collect())
    automaton = license_scan._automaton()
    for r in rows.collect():
        own = {x for x in license_scan.scan(r.text, automaton)["labels"].split(",") if x}
        assert brute_licenses(r.text)[1] <= own
        if "spdx" not in (r.text or "").lower():
            assert brute_licenses(r.text)[1] == own


def test_license_scan_of_a_text_full_of_phrases():
    started = time.time()
    found = license_scan.scan("cc by text " * 300_000, license_scan._automaton())
    assert (found["n_base"], found["first_word"], found["last_word"]) == (300_000, 0, 899_997)
    assert time.time() - started < 10


@pytest.mark.parametrize(
    ("text", "label", "names"),
    [
        ("/* SPDX-License-Identifier: MIT */ int main() {}", "tag-free", ["mit"]),
        ("<!-- SPDX-License-Identifier: MIT --> <p>and more", "tag-free", ["mit"]),
        ("# SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0; x", "tag-restricted", ["gpl-2.0"]),
        ("SPDX-License-Identifier: Proprietary-X", "tag-restricted", ["proprietary-x"]),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0", "tag-malformed", []),
        ("SPDX-License-Identifier: ", "tag-malformed", []),
    ],
)
def test_license_tags(text, label, names):
    found = license_scan.scan(text, license_scan._automaton())
    assert label in found["labels"].split(",") and found["expressions"][0]["licenses"] == names
    free = license_scan.scan("SPDX-License-Identifier: MIT", license_scan._automaton())["score"]
    assert found["score"] == free if label == "tag-free" else 0 < found["score"] < free


@pytest.mark.parametrize(
    ("said", "free"),
    [
        ("mit", True),
        ("gpl-2.0 or mit", True),
        ("gpl-2.0 and mit or isc", True),
        ("gpl-2.0 and (mit or isc)", False),
        ("apache-2.0 with llvm-exception", True),
        ("gpl-2.0 with classpath-exception and mit", False),
    ],
)
def test_license_expressions(said, free):
    assert license_scan.evaluate(license_scan.postfix(said))[0] is free


@pytest.mark.parametrize("said", ["", "and", "mit mit", "(mit", "mit)", "mit or", "()"])
def test_malformed_license_expressions(said):
    assert license_scan.postfix(said) is None


# classifiers


@pytest.mark.parametrize(("model", "label", "least", "floor"), [(quality_classifier, "quality", 0.7, 0.9), (toxicity, "toxic", 0.3, 0.85)])
def test_held_out_labels(spark, model, label, least, floor):
    directory = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").join(labels.select("doc_id"), "doc_id")
    known = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    scored = model.classify(docs, known).collect()
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(scored) == docs.count() and len(held) > 50
    assert np.mean([(s >= least) == t for s, t in held]) >= floor


def test_rare_subwords_have_a_weight():
    """A misspelling that one labelled text holds moves the score, by less than a frequent one."""
    rng = random.Random(5)
    plain = [" ".join(rng.choice(["red", "blue", "green", "stone", "river", "cloud"]) for _ in range(20)) for _ in range(200)]
    sample = [(t + (" vilest" if i < 60 else " zwqk" if i == 60 else ""), int(i <= 60)) for i, t in enumerate(plain)]
    model = toxicity.fit(sample, 0.3)
    often, rare, none = model.scores(pa.array([f"red river {w}" for w in ("vilest", "zwqk", "stone")]))
    assert often > rare > none


@pytest.mark.parametrize("model", [quality_classifier, toxicity])
def test_classifiers_on_awkward_tables(spark, awkward, model):
    labels = spark.createDataFrame([(6, 1, 1), (7, 0, 0), (8, 0, 0), (10, 1, 1), (None, 1, 1), (6, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    scores = model.classify(awkward, labels).collect()
    assert len(scores) == awkward.count() and all(0 <= r.score <= 1 for r in scores)
    assert model.classify(awkward, labels.limit(0)).count() == awkward.count()


# near duplicates


def test_sample_has_one_text_of_each_id(spark):
    rows = [(1, f"copy {i % 3}") for i in range(30)] + [(2, "two"), (3, None), (4, "four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    found = sampling.labelled_sample(docs, labels, "toxic", 2)
    assert Counter(label for _, label in found) == {0: 2, 1: 2}
    assert sorted(t for t, _ in found if not t.startswith("copy")) == ["", "four", "two"]
    assert sampling.labelled_sample(docs.repartition(7), labels, "toxic", 2) == found


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return Counter((d, p, least.get(top(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True)))


@pytest.mark.parametrize("long_list", [1, 64])
def test_simhash_components(spark, awkward, plain_rows, monkeypatch, long_list):
    monkeypatch.setattr(simhash_dedup, "LONG_LIST", long_list)
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "text")
    for df, rows in ((awkward, plain_rows), (docs, [(i, t or "") for i, t in texts_of(spark).items()])):
        found = simhash_dedup.simhash_components(df).collect()
        assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in found) == brute_components(rows)


def test_links_of_near_fingerprints_by_both_ways(spark, monkeypatch):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(150):
        x = rng.choice(sorted(values))
        values.add(x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = []
    for long_list in (2, 1000):
        monkeypatch.setattr(simhash_dedup, "LONG_LIST", long_list)
        roots.append({r.node: r.root for r in simhash_dedup.components(simhash_dedup.links(df)).collect()})
    group = {v: v for v in signed}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v

    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) % 2**64).count("1") <= 2:
                lo, hi = sorted((top(a), top(b)))
                group[hi] = lo
    assert roots[0] == roots[1] == {v: top(v) for v in signed if any(top(o) == top(v) for o in signed if o != v)}


def test_near_dedup_keeps_one_of_each(awkward):
    kept = simhash_dedup.near_dedup(awkward)
    assert kept.columns == awkward.columns
    components = {(r.root) for r in simhash_dedup.simhash_components(awkward).collect()}
    assert kept.count() == len(components)


# chats


def test_chats_can_be_read_back(spark):
    rng = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[NEXT]", "<<SYS>>", "<</SYS>>", "\\", "$1", "[", "<", "s>", "x", "\n", "é", "NEXT]"]
    rows, expected = [], {}
    for c in range(60):
        turns = []
        for k in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "[TEXT]", ""])
            turns.append((role, "".join(rng.choice(bits) for _ in range(rng.randrange(8)))))
            rows.append((c, k, role or None, turns[-1][1] or None))
        expected[c] = turns
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("blocks", F.lit(1)).repartition(4)
    formatted = chat_format.format_chats(df)
    for r in chat_format.read_chats(formatted).collect():
        turns = expected[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
    one = next(r for r in formatted.collect() if r.conv_id == 0)
    assert one.formatted.startswith("<s>[ROLE]") and one.formatted.endswith("</s>")
    assert chat_format.format_chats(df.limit(0)).count() == 0


# packing


def test_ids_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    texts = texts_of(spark)
    texts.update({1000: " <|endoftext|> \t\n  a\x0bb 漢字 é'll 12½ \U0001f600", 1001: ""})
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    by_doc = {}
    for r in packing.pack(df, TOKENIZER, keep_ids=True).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [i for p in parts for i in p.ids] == ids
        assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts[:-1]]]))
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in parts)
        assert all(p.length == 2048 for p in parts[1:]) and (len(ids) > 2048 or len(parts) == 1)


def test_added_tokens_have_one_id_in_the_query(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = {0: "see <|endoftext|> here", 1: "<|endoftext|><|endoftext|>\n a<|endoftext|>b <|endoftext", 2: "none"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    assert {r.doc_id: r.ids for r in packing.pack(df, TOKENIZER, keep_ids=True, added_tokens=True).collect()} == ids
    found = {r.doc_id: r.ids_crc32 for r in queries.op8_best_fit_packing(spark, str(tmp_path)).collect()}
    assert found == {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in ids.items()}


def valid_sequences(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_sequences_are_few_and_without_gaps(awkward):
    rows = packing.pack(awkward, TOKENIZER).collect()
    total = sum(r.length for r in rows)
    assert valid_sequences(rows) <= -(-total // 2048) + 1
    assert packing.pack(awkward.limit(0), TOKENIZER).count() == 0


def test_plan_takes_every_piece_once():
    rng = random.Random(3)
    counts = {rng.randrange(1, 2049): rng.randrange(1, 400) for _ in range(300)}
    used, bins = Counter(), Counter()
    for length, lo, hi, first, each, _ in packing.plan(counts):
        assert lo == used[length]
        used[length] = hi
        for s in range((hi - lo) // each):
            bins[first + s] += length * each
    assert used == Counter(counts) and max(bins.values()) <= 2048
    assert len(bins) <= 1.01 * least_bins(counts) + 1


def least_bins(counts, capacity=2048):
    """A lower bound: for any k, pieces over capacity - k stand without those of k and more."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(c for n, c in counts.items() if n > capacity - k)
        half = {n: c for n, c in counts.items() if capacity // 2 < n <= capacity - k}
        rest = sum(n * c for n, c in counts.items() if k <= n <= capacity // 2)
        room = sum((capacity - n) * c for n, c in half.items())
        best = max(best, alone + sum(half.values()) + max(0, -(-(rest - room) // capacity)))
    return best


# lines


def brute_lines(rows):
    """Of the distinct (id, text): the lines that stay, and their numbers."""
    seen, out = [], {}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        kept, n, gone = [], 0, 0
        for line in text.split("\n"):
            s = set(line.encode().split())
            if s:
                n += 1
                if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                    gone += 1
                else:
                    kept.append(line)
                seen.append(s)
            else:
                kept.append(line)
        out[doc_id, text] = (n, gone, "\n".join(kept))
    return Counter((d, *out[d, t]) for d, t in rows)


def test_line_dedup(spark, awkward, plain_rows):
    single = [r for r in plain_rows if r != (4, "another text of four")]  # one id with one text
    df = awkward.where("text is null or text <> 'another text of four'")
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(single)
    assert line_dedup.dedup_documents(awkward).columns == awkward.columns


def test_lines_of_one_place_and_parity_under_a_null_id(spark):
    bit = lambda w: xxhash.xxh64_intdigest(w.encode(), 42) >> 33 & 63
    base = [f"a{i}" for i in range(10)]
    twin = [next(w for w in (f"b{i}x{j}" for j in range(10**5)) if bit(w) == bit(a)) for i, a in enumerate(base)]
    rows = [(None, " ".join(base)), (None, " ".join(twin)), (1, " ".join([*base, "more"])), (2, " ".join([*twin, "more"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parities = {r.parity for r in line_dedup.line_sets(line_dedup.line_rows(df.where("doc_id is null"))).collect()}
    assert len(parities) == 1
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(rows)


def test_variants_of_one_line(spark):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(30)]
    rows = []
    for i in range(120):
        words = list(base[: rng.choice([30, 30, 12, 5, 4])])
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words) + "\n" + " ".join(rng.choice(base) for _ in range(6))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(rows)


def test_variants_of_long_lines(spark):
    """Lines about the length from which posting lists carry the longer parity, and far longer ones."""
    rng = random.Random(6)
    base = [f"v{i}" for i in range(600)]
    rows = []
    for i in range(60):
        words = rng.sample(base[:90], rng.choice([55, 63, 64, 66, 75])) if i % 2 else base[: rng.choice([62, 64, 70, 520, 600])]
        words = [f"e{rng.randrange(200)}" if rng.random() < rng.choice([0.02, 0.12]) else w for w in words]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(rows)


def test_candidate_lines_are_verified_in_one_pass(spark, monkeypatch):
    """Words are intersected once for each pair, and pairs are not settled in several rounds that read all lines."""
    rng = random.Random(8)
    rows = []
    for i in range(40):
        words = [f"v{j}" if rng.random() < 0.93 else f"e{rng.randrange(30)}" for j in range(30)]
        rows.append((i, " ".join(words) + "\n" + " ".join(f"a{i}b{j}" for j in range(8))))
    plans = {}

    def seen(df, label, *args, **options):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, label, *args, **options)

    monkeypatch.setattr(line_dedup, "stage", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(rows)
    assert plans["line-settled"].count("array_intersect(") == 1
    assert "line-others" not in plans and any("left_semi" in p.lower() or "LeftSemi" in p for k, p in plans.items() if k.endswith("-words"))


def test_levels_of_words_stay_out_of_plans_and_rows(spark, monkeypatch):
    """As a literal, the levels of all buckets stood in each plan's text and filled the driver's memory."""
    rows = [(i, " ".join(f"v{i * j % 97}" for j in range(4 + i % 90))) for i in range(60)]
    plans = {}

    def seen(df, label, *args, **options):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, label, *args, **options)

    monkeypatch.setattr(line_dedup, "stage", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.line_dedup(df).select("row.doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert counts_of(found) == brute_lines(rows)
    assert max(map(len, plans.values())) < 100_000
    # read inside the expression that ranks words: a column of its own would be copied into every row
    assert "scalar-subquery" in plans["line-classes"] and "AS levels" not in plans["line-classes"].split("Subquery")[0]


def test_a_pair_is_made_in_one_of_its_lists(spark):
    """Two variants of one line share nearly all of their posted tokens: they were joined in each such list."""
    line = " ".join(f"v{j}" for j in range(40))
    rows = [(i, f"{line} e{i}") for i in range(2)]
    sets = stage(line_dedup.line_sets(line_dedup.line_rows(spark.createDataFrame(rows, "doc_id long, text string"))), "sets")
    classes = stage(line_dedup.line_classes(sets, stage(line_dedup.token_rarity(sets), "rarity")), "classes")
    posted = line_dedup.prefixes(classes, whole=True)
    lists = posted.groupBy("token").count().where("count > 1").count()
    assert lists > 1 and line_dedup._list_pairs(posted, posted).count() == 1


# decontamination


ITEM = "In the old town Maria sold 12 kg of apples to Peter, and Peter gave 3 kg back to Maria. How many kg of apples were left?"


def test_new_numbers_and_names_are_found_if_they_are_consistent(spark):
    bench = spark.createDataFrame([(7, ITEM), (8, "too short"), (9, None), (7, ITEM)], "item_id long, text string")
    swap = lambda *pairs: " ".join(dict(pairs).get(w, w) for w in ITEM.split(" "))
    texts = [
        ITEM,
        "Some words before.\n" + ITEM.replace("\n", " ") + " and after",
        swap(("Maria", "Anna"), ("Maria.", "Anna."), ("Peter,", "Otto,"), ("Peter", "Otto"), ("12", "250"), ("3", "41.5")),
        swap(("Maria", "Anna"), ("Maria.", "Paul."), ("Peter,", "Otto,"), ("Peter", "Hugo")),
        "A clean text about something else that sells apples, of 12 kg and more, to nobody in the old town.",
        None,
        "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("item_id", F.lit(1))
    found = decontamination.benchmark_matches(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 7), (1, 7), (2, 7)]
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench).collect()) == [3, 4, 5, 6]
    assert decontamination.benchmark_matches(docs, bench.limit(0)).count() == 0


def test_slots_outside_of_matched_windows_say_nothing(spark):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    rest = " ".join(f"Else{i} {i}" for i in range(30))
    texts = [
        ITEM[: ITEM.index(" back")] + " " + rest,
        ITEM.replace("back to", "back again to"),
        ITEM.replace(" back", ""),
        rest + " " + ITEM[ITEM.index("sold") :],
        ITEM.replace("to Peter, and Peter", "to Peter, and Hugo"),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in decontamination.benchmark_matches(docs, bench).collect()} == {0, 1, 2, 3}
    assert [r.doc_id for r in decontamination.decontaminate(docs, bench).collect()] == [4]


def test_names_that_open_sentences_and_names_of_several_words(spark):
    opening = "Natalia sold clips to 48 friends in April. Natalia then sold half as many clips in May. How many clips did Natalia sell?"
    only = "Natalia ran 12 miles on one day and 5 miles on the next. Natalia wants to know the mean of all her runs"
    pair = "Natalia met Otto at noon. Natalia left Otto at one"
    bench = spark.createDataFrame([(1, opening), (2, ITEM), (3, only), (4, pair)], "item_id long, text string")
    named = lambda text, *pairs: functools.reduce(lambda t, p: t.replace(*p), pairs, text)
    texts = [
        opening,
        named(opening, ("Natalia", "Weng")),
        named(opening, ("Natalia", "Mary Ann"), ("48", "7"), ("April", "June")),
        "Question Two: " + named(opening, ("Natalia", "Anne-Marie")) + " Answer",
        "see Old " + named(opening, ("Natalia", "Weng")),
        named(ITEM, ("Maria", "Mary Ann"), ("Peter", "Jean Paul")),
        named(only, ("Natalia", "Mary Ann Smith")),
        named(pair, ("Natalia", "Weng")),
        named(pair, ("Natalia left", "Weng left")),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.benchmark_matches(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 3), (7, 4)}
    assert {(r.doc_id, r.start) for r in found if r.doc_id in (0, 1, 3)} == {(0, 0), (1, 0), (3, 2)}
    # Natalia once stays and once is Weng
    assert not [r for r in found if r.doc_id == 8]


def test_windows_of_numbers_alone_are_not_counted(spark):
    table = " ".join(str(3 * i) for i in range(40))
    mixed = "The table of all the sums that were paid out: " + table + " and so it ended on the last of these days"
    bench = spark.createDataFrame([(1, table), (2, mixed), (3, mixed + " " + table)], "item_id long, text string")
    texts = [" ".join(map(str, range(100_000))), mixed, mixed.replace("39", "40"), table]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(docs, bench).collect()}
    assert found == {(1, 2), (1, 3), (2, 2), (2, 3)}


def test_codes_tell_the_forms_apart(spark):
    text = "Old Tom paid 5 kg, 12 KG. Mary-Ann Lee ran; USA said\t7.5 Miles (kg) in O'Neil"
    m = decontamination.marked(F.lit(text))
    codes = decontamination.token_codes(m)
    row = spark.range(1).select(
        *[decontamination.codes_in_form(codes, o).alias(f"c{o}") for o in (False, True)],
        *[decontamination.raw_tokens(m, o).alias(f"t{o}") for o in (False, True)],
    ).first()
    kinds = {decontamination.NUMBER: "#", decontamination.NAME: "N", decontamination.UNIT: "u"}
    read = lambda o: "".join(kinds.get(c, "w") for c in row[f"c{o}"])
    assert read(False) == "wNw#u#uwNwww#NwwwN"  # O and Neil are two tokens
    assert [len(row[f"c{o}"]) for o in (False, True)] == [len(row[f"t{o}"]) for o in (False, True)]
    assert read(True) == "Nw#u#uNwww#NwwwN"


def test_templates_are_found_as_by_search(spark):
    """Items of lower-case words and numbers against a plain search over all places of all texts."""
    rng = random.Random(5)
    tokens = lambda n: [rng.choice(["ab", "cd", "ef", "gh", "1", "22", "303"]) for _ in range(n)]
    items = [tokens(rng.choice([5, 6, 7, 8, 9, 14, 20])) for _ in range(40)]
    texts = []
    for k in range(120):
        body = list(rng.choice(items))
        if k % 2:
            swap = {"1": rng.choice("14"), "22": rng.choice(["22", "5"]), "303": "6"}
            body = [swap.get(w, w) for w in body]
        if k % 3 == 0:
            body[rng.randrange(len(body))] = rng.choice(["ab", "9", "zz"])
        texts.append(tokens(rng.randrange(6)) + body + tokens(rng.randrange(6)))
    digit = lambda w: w[0].isdigit()
    shape = lambda ws: ["#" if digit(w) else w for w in ws]

    def holds(doc, item):
        size = min(8, len(item))
        places = [i for i in range(len(item) - size + 1) if not all(map(digit, item[i : i + size]))]
        for start in range(1 - len(item), len(doc)):
            met = [i for i in places if i + start >= 0 and shape(doc[i + start : i + start + size]) == shape(item[i : i + size])]
            slots = {s for i in met for s in range(i, i + size) if digit(item[s])}
            pairs = {(item[s], doc[s + start]) for s in slots}
            one_to_one = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
            if met and 2 * len(met) >= len(places) and one_to_one:
                return True
        return False

    expected = {(d, i) for d, doc in enumerate(texts) for i, item in enumerate(items) if holds(doc, item)}
    docs = spark.createDataFrame([(d, " ".join(ws)) for d, ws in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(docs, bench).collect()}
    assert found == expected and len(expected) > 60


def test_passages_are_found_as_by_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    squeeze = lambda t: " ".join(t.split())
    items = [(r.item_id, squeeze(r.text)) for r in bench.collect()]
    expected = {(r.doc_id, i) for r in docs.select("doc_id", "text").collect() for i, t in items if t in squeeze(r.text or "")}
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(docs, bench).collect()}
    assert expected and found == expected


# all


def test_operators_delete_what_they_staged(spark, awkward, tmp_path, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    monkeypatch.setattr("matchloom.session.work_folder", lambda spark, label: f"{tmp_path}/{label}-{len(labels.append(label) or labels)}")
    labels = []
    results = [
        line_dedup.dedup_documents(awkward),
        simhash_dedup.near_dedup(awkward),
        decontamination.decontaminate(awkward, bench),
    ]
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert left == ["benchmark-held", "line-kept", "simhash-changed"] and len(labels) > 9
    counts = [df.count() for df in results]
    assert counts[0] == awkward.count() and all(counts)


def test_empty_tables(awkward):
    none = awkward.limit(0)
    labels = awkward.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = awkward.sparkSession.createDataFrame([], "item_id long, text string")
    for df in (
        quality_rules.quality_rules(none),
        substring_dedup.substring_dedup(none),
        license_scan.license_scan(none),
        quality_classifier.classify(none, labels),
        toxicity.classify(none, labels),
        simhash_dedup.simhash_components(none),
        line_dedup.line_dedup(none),
        decontamination.benchmark_matches(none, bench),
    ):
        assert df.count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for _, function in corpus_pipeline.STAGES[:-1]:
        steps.append(corpus_pipeline.stage(function(spark, steps[-1], DIRECTORY), "test"))
        assert steps[-1].columns == columns
    quality, lines, near, clean = [[(r.doc_id, r.text) for r in s.collect()] for s in steps[1:]]
    assert {i for i, _ in quality} == {r.row.doc_id for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert Counter((i, t) for i, t in lines) == Counter((r[0], r[3]) for r in brute_lines(quality).elements())
    assert Counter(i for i, _ in near) == Counter({c for _, _, c in brute_components(lines)})
    bench = spark.read.parquet(f"{DIRECTORY}/benchmark.parquet")
    held = {r.doc_id for r in decontamination.benchmark_matches(steps[3], bench).collect()}
    assert {i for i, _ in clean} == {i for i, _ in near} - held
    packed = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in clean}
    assert valid_sequences(packed) > 0
