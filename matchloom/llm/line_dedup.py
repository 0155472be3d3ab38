"""Removing lines that resemble an earlier line: an exact set-similarity join, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import MAX_BROADCAST_ROWS, has_word, scratch, small, stage, text_or_empty, with_row_key, words

# Jaccard similarity as a fraction, so that every bound is exact whole-number arithmetic
NUMERATOR, DENOMINATOR = 4, 5
# tokens are ordered by the count of their bucket; any order gives the same result, a better one is quicker
RARITY_BUCKETS = 1 << 19
# sets of at least this many words carry a second parity of 64 bits in their posting lists: one tells short
# sets apart, but those of any two long sets differ in fewer bits than similar ones may
LONG = 64


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(RARITY_BUCKETS - 1))


def token_rarity(sets: DataFrame) -> DataFrame:
    """One row: a level from 0 to 127 per bucket that grows with how often the tokens of the bucket occur in all lines.

    Its size is fixed, whatever the data.
    """
    seen = (
        sets.select(F.explode("tokens").alias("t"))
        .groupBy(_bucket(F.col("t")).cast("long").alias("b"))
        .agg(F.least(F.lit(127), F.floor(3 * F.log2(F.count(F.lit(1)).cast("double")))).cast("byte").alias("level"))
    )
    every = seen.unionAll(sets.sparkSession.range(0, RARITY_BUCKETS, 1, 1).select("id", F.lit(0).cast("byte")))
    levels = every.groupBy("b").agg(F.max("level").alias("level"))
    ordered = levels.agg(F.sort_array(F.collect_list(F.struct("b", "level"))).alias("x"))
    return ordered.select(F.col("x.level").alias("levels"))


def line_rows(docs: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(kd, k1, line_no, line) of every line that has a word, in all documents or in those whose keys ``of`` has."""
    keyed = with_row_key(docs.select("doc_id", text_or_empty().alias("t")), F.col("t"))
    if of is not None:
        keyed = keyed.join(of, ["kd", "k1"], "left_semi")
    lines = keyed.select("kd", "k1", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))
    return lines.where(has_word(F.col("line")))


def _shift(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))


def _parity(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(_shift(t)))


def line_sets(lines: DataFrame) -> DataFrame:
    """Per line the set of its words: two hashes that name it, its size, its parity and a token per word.

    Words are split and hashed here only. ``tokens`` are 31 bits of each word's hash, with repeats where these
    bits of two words are equal, so that sets which share words share as many tokens at least. ``parity`` has
    bit i set if an odd number of the tokens end in i, so sets that differ in few words differ in few bits.
    """
    # distinct hashes, not distinct strings: numbers are quicker to tell apart
    hashes = F.sort_array(F.array_distinct(F.transform(words(F.col("line")), lambda w: F.xxhash64(w))))
    hashed = lines.select("kd", "line_no", "k1", hashes.alias("s"))
    named = hashed.select(
        "kd",
        "line_no",
        "k1",
        F.xxhash64("s").alias("c1"),
        F.xxhash64(F.lit(1), F.col("s")).alias("c2"),
        F.size("s").alias("n"),
        F.transform("s", lambda h: F.shiftrightunsigned(h, 33).cast("int")).alias("tokens"),
    )
    return named.withColumn("parity", _parity(F.col("tokens")))


def _prefix_size(n: Column) -> Column:
    return (n - F.call_function("div", n * NUMERATOR + (DENOMINATOR - 1), F.lit(DENOMINATOR)) + 1).cast("int")


def line_classes(sets: DataFrame, rarity: DataFrame) -> DataFrame:
    """One row per distinct set of words: the first line that has it and its rarest tokens, rarest first.

    ``prefix`` has one token more than a similar set must share one of. ``more`` is the parity of those tokens
    of a long set whose bit 6 is set; null for other sets.
    """
    # a scalar subquery: as a literal the levels are megabytes of text in each description of the plan. It is named
    # first, as functions over arrays take no subquery, and merged into the next projection by the optimiser
    leveled = sets.withColumn("levels", rarity.scalar())
    # level and token in one number, so that the order is that of numbers
    level = lambda t: F.call_function("shiftleft", F.get("levels", _bucket(t)).cast("long"), F.lit(32))
    ranked = F.transform("tokens", lambda t: level(t).bitwiseOR(t.cast("long")))
    rarest = F.slice(F.sort_array(ranked), F.lit(1), _prefix_size(F.col("n")) + 1)
    prefix = F.transform(rarest, lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int"))
    more = F.when(F.col("n") >= LONG, _parity(F.filter("tokens", lambda t: t.bitwiseAND(F.lit(64)) != 0))).alias("more")
    rows = leveled.select("c1", "c2", F.struct("kd", "line_no", "k1", "n", "parity", more, prefix.alias("prefix")).alias("first"))
    return rows.groupBy("c1", "c2").agg(F.min("first").alias("first")).select("c1", "c2", "first.*")


def _least_overlap(n: Column, m: Column) -> Column:
    """Words that sets of n and m words must share to be similar enough."""
    return F.call_function("div", NUMERATOR * (n + m) + (NUMERATOR + DENOMINATOR - 1), F.lit(NUMERATOR + DENOMINATOR))


def prefixes(classes: DataFrame, whole: bool = False) -> DataFrame:
    """The rarest tokens of every class: sets that are similar enough share one of them.

    ``next`` is the token that follows in the order. Sets of fewer than four words have no similar set but
    themselves. With ``whole``, each row has all of them as ``posted``.
    """
    tokens = F.slice("prefix", F.lit(1), F.size("prefix") - 1)
    rows = classes.where(F.col("n") >= NUMERATOR).select("*", F.posexplode(tokens).alias("pos", "token"))
    # the join asks for this of one side only; asked of both, they read one shuffle
    following = F.get("prefix", F.col("pos") + 1).alias("next")
    every = [tokens.alias("posted")] if whole else []
    return rows.select("token", following, *KEY, "n", "parity", "more", "pos", *every).where("token is not null and parity is not null")


# of the first line of a class: no other class has it, also under a null or repeated id
KEY = ("kd", "line_no", "k1")
_ROW = (*KEY, "n", "parity", "more", "pos")
_PAIR = [f"{side}_{c}" for side in "yx" for c in KEY]


def _named(side: str, names=_ROW) -> list[Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in names]


def _earlier(y: str, x: str) -> Column:
    kd, line, text = [(F.col(f"{x}_{c}"), F.col(f"{y}_{c}")) for c in KEY]
    return (kd[0] < kd[1]) | ((kd[0] == kd[1]) & ((line[0] < line[1]) | ((line[0] == line[1]) & (text[0] < text[1]))))


def _differing_bits(y: str, x: str) -> Column:
    """Differing bits of the two parities of two long sets; null if one has no second."""
    both, more = [F.col(f"{y}_{name}").bitwiseXOR(F.col(f"{x}_{name}")) for name in ("parity", "more")]
    return F.bit_count(more) + F.bit_count(both.bitwiseXOR(more))


def _may_be_similar(y: str, x: str) -> Column:
    """Length, parity and positional filters for two rows of one token's posting list, the cheapest first."""
    c = lambda side, name: F.col(f"{side}_{name}")
    ny, nx = c(y, "n"), c(x, "n")
    shared = _least_overlap(ny, nx)
    most = nx + ny - 2 * shared
    return (
        (nx * DENOMINATOR >= ny * NUMERATOR)
        & (ny * DENOMINATOR >= nx * NUMERATOR)
        & (F.bit_count(c(y, "parity").bitwiseXOR(c(x, "parity"))) <= most)
        & (F.least(ny - c(y, "pos"), nx - c(x, "pos")) + F.least(c(y, "pos"), c(x, "pos")) >= shared)
        & ((F.least(ny, nx) < LONG) | (_differing_bits(y, x) <= most))
    )


def _list_pairs(ys: DataFrame, xs: DataFrame) -> DataFrame:
    """Pairs of a row y and an earlier row x of one posting list that pass the filters.

    Similar sets pass them in each list that both are in. Variants of one line are in many, so a pair is
    made in one list only, that of the least token they share.
    """
    names = (*_ROW, "posted")
    y, x = [of.select(F.col("token").alias(f"{side}_token"), *_named(side, names)) for of, side in ((ys, "y"), (xs, "x"))]
    least = F.array_min(F.array_intersect("y_posted", "x_posted")) == F.col("y_token")
    return y.join(x, (F.col("y_token") == F.col("x_token")) & _earlier("y", "x") & _may_be_similar("y", "x") & least).select(*_PAIR)


def candidate_pairs(posted: DataFrame) -> DataFrame:
    """Distinct pairs (y, x) of class keys, x earlier, with ``head``: whether x stood first among rows like y.

    Variants of one line share most of their adjacent prefix tokens. A row that passes the filters against the
    first row with its pair of tokens is paired with that row only; other rows meet the whole posting list.
    So a group of variants gives a pair for each variant and not all pairs of variants. Rows whose only
    pairs fail the verification meet their lists again later.
    """
    # one struct over the whole group: the window is run once for each group, not for each row and column
    same = Window.partitionBy("token", "next").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # renamed above the window, whose order then serves the join as well
    headed = posted.withColumn("h", F.first(F.struct(*_ROW)).over(same))
    headed = headed.select(F.col("token").alias("y_token"), *_named("y"), *[F.col("h")[c].alias(f"h_{c}") for c in _ROW])
    headed = headed.withColumn("head", _earlier("y", "h") & _may_be_similar("y", "h"))
    headed = headed.select("y_token", *[f"y_{c}" for c in _ROW], *[f"h_{c}" for c in KEY], "head")
    # the same columns on both sides, so that both read one shuffle
    xs = posted.select(F.col("token").alias("x_token"), F.col("next").alias("x_next"), *_named("x"))
    met = (F.col("y_token") == F.col("x_token")) & ~F.col("head") & _earlier("y", "x") & _may_be_similar("y", "x")
    joined = headed.join(xs, met, "left").where("head or x_token is not null")
    other = [F.when(F.col("head"), F.col(f"h_{c}")).otherwise(F.col(f"x_{c}")).alias(f"x_{c}") for c in KEY]
    pairs = joined.select(*[f"y_{c}" for c in KEY], *other, "head", "x_next")
    return pairs.groupBy(*_PAIR).agg(*[F.max(c).alias(c) for c in ("head", "x_next")])


def _words_of(pairs: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """The classes that pairs are of, with the distinct words of their first lines; staged."""
    keys = [pairs.select(*[F.col(f"{side}_{c}").alias(c) for c in KEY]) for side in "yx"]
    wanted = stage(keys[0].unionAll(keys[1]).distinct(), label + "-keys")
    few = wanted.count() <= MAX_BROADCAST_ROWS
    # few lines: only their documents are split; many: nearly all documents have some
    lines = line_rows(docs, F.broadcast(wanted.select("kd", "k1").distinct())) if few else line_rows(docs)
    found = lines.join(F.broadcast(wanted) if few else wanted, list(KEY)).groupBy(*KEY).agg(F.min("line").alias("line"))
    return stage(found.select(*KEY, F.array_distinct(words(F.col("line"))).alias("words")), label + "-words")


def _verified(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """The keys of the later classes of pairs whose word sets are similar enough; staged."""
    side = lambda s: sets.select(*_named(s, (*KEY, "words")))
    both = pairs.select(*_PAIR).join(side("y"), [f"y_{c}" for c in KEY]).join(side("x"), [f"x_{c}" for c in KEY])
    # shared / (all - shared) >= NUMERATOR / DENOMINATOR with the intersection, the dear part, named once
    shared = F.size(F.array_intersect("y_words", "x_words"))
    similar = both.where(shared * (NUMERATOR + DENOMINATOR) >= (F.size("y_words") + F.size("x_words")) * NUMERATOR)
    return stage(similar.select(*[F.col(f"y_{c}").alias(c) for c in KEY]).distinct(), label)


def kept_first_lines(docs: DataFrame) -> DataFrame:
    """(kd, k1, line_no) of the lines with a word that stay."""
    with scratch():  # the tokens of all words go before their posting lists are written
        sets = stage(line_sets(line_rows(docs)), "line-sets", hashes=True)
        rarity = stage(token_rarity(sets), "line-rarity")
        classes = stage(line_classes(sets, rarity), "line-classes", keep=True, hashes=True)
    pairs = stage(candidate_pairs(prefixes(classes).repartition("token")), "line-pairs")
    gone = _verified(pairs, _words_of(pairs, docs, "line-own"), "line-settled")
    # classes that were paired with heads in vain: the rest of their lists
    y_keys = [F.col(f"y_{c}").alias(c) for c in KEY]
    again = stage(pairs.where("head").select(*y_keys).distinct().join(gone, list(KEY), "left_anti"), "line-again")
    if again.take(1):
        # met before their prefixes are written out, which are of all classes else
        rows = small(stage(prefixes(classes.join(small(again), list(KEY), "left_semi"), whole=True), "line-again-rows"))
        rest = stage(_list_pairs(rows, prefixes(classes, whole=True)).distinct(), "line-again-pairs")
        gone = gone.unionAll(_verified(rest, _words_of(rest, docs, "line-own-again"), "line-settled-last"))
    return classes.select(*KEY).join(gone.distinct(), list(KEY), "left_anti").select("kd", "k1", "line_no")


def line_dedup(docs: DataFrame) -> DataFrame:
    """Remove every line whose set of words has a Jaccard similarity of 0.8 or more with an earlier line's.

    Lines are ordered by (doc_id, place); a null id comes first. A line stays if no line before it, kept or
    not, has the same or a similar set. Lines without a word always stay and match nothing. Rows of one id and
    one text are one document: they keep the same lines. Where one id has several texts, lines of equal place
    are ordered by a hash of the text. A null text is empty. Gives one row per input row: ``row`` (a struct of all
    columns, so that none can clash), ``n_lines`` and ``n_removed`` (lines with a word), ``kept_text``.
    """
    with scratch():
        kept = kept_first_lines(docs).groupBy("kd", "k1").agg(F.collect_set("line_no").alias("keep"))
        kept = stage(kept, "line-kept", keep=True)
    base = docs.select(F.struct("*").alias("row"), "doc_id", text_or_empty().alias("t"))
    joined = with_row_key(base, F.col("t")).join(kept, ["kd", "k1"], "left").select(
        "row", F.split("t", "\n").alias("lines"), F.coalesce("keep", F.array().cast("array<int>")).alias("keep")
    )
    full = F.filter("lines", has_word)
    left = F.filter("lines", lambda x, i: F.array_contains("keep", i) | ~has_word(x))
    return joined.select(
        "row",
        F.size(full).cast("long").alias("n_lines"),
        (F.size(full) - F.size("keep")).cast("long").alias("n_removed"),
        F.array_join(left, "\n").alias("kept_text"),
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """All documents, without the lines that resemble an earlier one."""
    values = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return line_dedup(docs).select([values.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
