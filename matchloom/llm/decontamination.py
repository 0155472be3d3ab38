"""Finding benchmark passages in documents, also with other numbers, names and units, in column expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import bind, scratch, small, stage, text_or_empty, with_row_key, words

WINDOW = 8
MIN_TOKENS = 5
# of an item's windows that must stand in a document, in one alignment
LEAST_SHARE = 0.5
UNITS = (
    "mm cm m km mg g kg t ml l s sec min h hours minutes seconds days weeks years inch inches ft feet yards miles"
    " oz lb pounds euros dollars cents percent degrees"
).split()
# keep these between digits; all other ASCII punctuation ends a token
_PUNCTUATION = "\"#$%&'()*+-;<=>?@[\\]^_`{|}~!\t\r\x0b\f\x00\x01\x02"
# a capital and small letters, no name yet; a blank or hyphen between two of them joins them to one name
_CAPITAL = r"\p{Lu}\p{Ll}"
_RUN = rf"(?<![\p{{L}}\p{{N}}])({_CAPITAL}\p{{L}}*)(?:[ \t]+|-)(?={_CAPITAL})"
OPENER, JOIN, _OPENING_JOIN = "\ue000", "\ue004", "\ue005"
_START = rf"(^|[.!?:\n][\"')\]]*\s*)(?:({_CAPITAL}\p{{L}}*){JOIN}|(?=\p{{Lu}}))"
_BETWEEN = rf"[{re.escape(_PUNCTUATION)}\n]+|(?<![0-9])[.,:/]+|[.,:/]+(?![0-9])"
# codes of placeholders; the codes of words are hashes whose last two bits are unset
NUMBER, NAME, UNIT = 4, 8, 12
# last two bits of a code: a capital that opens a sentence, a name that such a capital joins
_OPENS, _JOINED = 1, 2
# whether a capital that opens a sentence makes a name; both ways are searched, as neither is always right
FORMS = (False, True)


def marked(text: Column) -> Column:
    """Tokens between blanks, runs of capitalised words joined; the first capital of a sentence has a mark before it."""
    runs = F.regexp_replace(text, _RUN, "$1" + JOIN)
    starts = F.regexp_replace(runs, _START, f"$1 {OPENER}$2{_OPENING_JOIN}")
    joined = F.replace(starts, F.lit(OPENER + _OPENING_JOIN), F.lit(OPENER))
    return F.regexp_replace(joined, _BETWEEN, " ")


def _in_form(marked_text: Column, openers: bool) -> Column:
    """Words that open a sentence are joined to the name after them if they count as names themselves."""
    return F.replace(marked_text, F.lit(_OPENING_JOIN), F.lit(JOIN if openers else " "))


def token_codes(marked_text: Column) -> Column:
    """One number for every token: typed placeholders for numbers, names and units after numbers, else a hash.

    The last two bits tell the forms apart: ``_OPENS`` is a name in the form with openers only, and ``_JOINED`` is
    in that form no token of its own, as the capital before it has taken it.
    """
    apart = F.replace(marked_text, F.lit(_OPENING_JOIN), F.lit(" " + _OPENING_JOIN))
    number = lambda x: (x >= "0") & (x < ":")
    word = lambda x: F.xxhash64(x).bitwiseAND(F.lit(~3))
    long = lambda x: F.lit(x).cast("long")

    def code(w, x, i):
        lower = F.lower(x)
        plain = F.when(lower.isin(UNITS) & number(F.get(w, i - 1)), long(UNIT)).otherwise(word(lower))
        opener = word(F.replace(lower, F.lit(OPENER), F.lit("")))
        return (
            F.when((x >= "a") & (x < "{"), plain)
            .when(number(x), long(NUMBER))
            .when(x.startswith(OPENER), F.when(x.rlike("^" + OPENER + _CAPITAL), opener.bitwiseOR(long(_OPENS))).otherwise(opener))
            .when(x.startswith(_OPENING_JOIN), long(NAME | _JOINED))
            .when(x.rlike("^" + _CAPITAL), long(NAME))
            .otherwise(plain)
        )

    # all other white space has become blanks
    return bind(F.array_remove(F.split(apart, " "), ""), lambda w: F.transform(w, lambda x, i: code(w, x, i)))


def codes_in_form(codes: Column, openers: bool) -> Column:
    """The codes of one form: with ``openers`` a capitalised word that opens a sentence is a name, else it never is."""
    if not openers:
        return F.transform(codes, lambda c: c.bitwiseAND(F.lit(~3)))
    own = F.filter(codes, lambda c: c.bitwiseAND(F.lit(3)) != _JOINED)
    return F.transform(own, lambda c: F.when(c.bitwiseAND(F.lit(3)) == _OPENS, F.lit(NAME).cast("long")).otherwise(c))


def _is_slot(code: Column) -> Column:
    return code.isin(NUMBER, NAME, UNIT)


def raw_tokens(marked_text: Column, openers: bool) -> Column:
    """The tokens as they are but for case, in step with the canonical ones; openers keep their mark."""
    return words(F.lower(_in_form(marked_text, openers)))


def _with_later(hashes: Column, step: int, *more: Column) -> Column:
    """Every hash joined with the one ``step`` places later; the last ``step`` have none to join."""
    return bind(hashes, lambda a: F.zip_with(a, F.slice(a, F.lit(step + 1), F.size(a)), lambda x, y: F.xxhash64(x, y, *more)))


def window_hashes(codes: Column, openers: Column, sizes) -> Column:
    """An array for every size of the hashes of all windows of so many codes; each form and size has its own.

    Codes are hashed in pairs, pairs in fours, and two fours cover a window of five to eight.
    """
    fours = _with_later(_with_later(codes, 1), 2)
    kind = lambda size: openers.cast("int") + F.lit(2 * size)
    whole = lambda a, size: F.greatest(F.size(a) - (size - 1), F.lit(0))
    return bind(fours, lambda a: F.array(*[F.slice(_with_later(a, size - 4, kind(size)), F.lit(1), whole(a, size)) for size in sizes]))


SIZES = range(MIN_TOKENS, WINDOW + 1)


def _item_codes(benchmark: DataFrame, *more: Column) -> DataFrame:
    """(item_id, openers, codes) of the items that have a text, in both forms; ``more`` may name ``m``, the marked text."""
    texts = benchmark.where(F.col("text").isNotNull()).select("item_id", marked(F.col("text").cast("string")).alias("m"))
    forms = bind(
        token_codes(F.col("m")),
        lambda c: F.array(*[F.struct(F.lit(o).alias("openers"), codes_in_form(c, o).alias("codes")) for o in FORMS]),
    )
    return texts.select("item_id", "m", F.explode(forms).alias("f")).select("item_id", "m", "f.*").select("item_id", "openers", "codes", *more)


def _benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, openers, size, n_windows, i, h) of all windows with a word.

    Items shorter than a window are one window of their own size.
    """
    sized = _item_codes(benchmark).where(F.size("codes") >= MIN_TOKENS).withColumn("size", F.least(F.size("codes"), F.lit(WINDOW)))
    hashes = F.get(window_hashes(F.col("codes"), F.col("openers"), SIZES), F.col("size") - MIN_TOKENS)
    worded = lambda h, i: F.exists(F.slice("codes", i + 1, F.col("size")), lambda c: ~_is_slot(c))
    placed = F.filter(F.transform(hashes, lambda h, i: F.struct(i.alias("i"), h.alias("h"), worded(h, i).alias("worded"))), lambda w: w["worded"])
    kept = sized.select("item_id", "openers", "size", placed.alias("ws"))
    return kept.select("item_id", "openers", "size", F.size("ws").alias("n_windows"), F.explode("ws").alias("w")).select(
        "item_id", "openers", "size", "n_windows", "w.i", "w.h"
    )


def _within(slots: Column, places: Column, size: Column) -> Column:
    """The slots that lie inside a matched window; the windows begin at ``places``."""
    return F.filter(slots, lambda s: F.exists(places, lambda i: (i <= s) & (s < i + size)))


def _without_opener(value: Column, other: Column) -> Column:
    """A slot value that opens a sentence without its first word, if the value that it meets has the same one."""
    first = lambda x: F.substring_index(x, JOIN, 1)
    both = value.startswith(OPENER) & other.startswith(OPENER) & value.contains(JOIN) & other.contains(JOIN) & (first(value) == first(other))
    rest = F.when(both, F.substring(value, F.length(first(value)) + 2, F.length(value))).otherwise(value)
    return F.translate(rest, OPENER, "")


def _consistent(item_tokens: Column, item_slots: Column, doc_tokens: Column, start: Column) -> Column:
    """Whether each slot value of the item always meets one value in the document, and each of those one in the item.

    A name of several words at the first or last place of the item may have taken words of the text around it,
    so it is not asked.
    """
    pairs = bind(
        F.struct(item_tokens.alias("item"), doc_tokens.alias("doc")),
        lambda t: F.array_distinct(
            F.transform(
                F.filter(
                    item_slots,
                    lambda i: ~(((i == 0) | (i == F.size(t["item"]) - 1)) & F.get(t["doc"], i + start).contains(JOIN)),
                ),
                lambda i: F.struct(
                    _without_opener(F.get(t["item"], i), F.get(t["doc"], i + start)).alias("a"),
                    _without_opener(F.get(t["doc"], i + start), F.get(t["item"], i)).alias("b"),
                ),
            )
        ),
    )
    one = lambda p, name: F.size(F.array_distinct(F.transform(p, lambda x: x[name])))
    return bind(pairs, lambda p: (one(p, "a") == F.size(p)) & (one(p, "b") == F.size(p)))


def _words_before(tokens: Column, start: Column) -> Column:
    """How many words the first ``start`` tokens have."""
    joined = lambda: F.array_join(F.slice(tokens, F.lit(1), start), JOIN)
    return F.when(start > 0, F.size(F.split(joined(), JOIN))).otherwise(start)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(kd, k1, doc_id, item_id, start, n_matched, n_windows): the items that documents hold.

    A run of capitalised words is one token, a name. Whether a capitalised word that opens a sentence is a name
    cannot be seen, so texts are compared in two forms, with all such words as names and with none, and either
    is enough. Windows of 8 canonical tokens are joined by hash; a document holds an item if half of the item's windows
    stand in it at the item's places and the slots inside these windows are consistent: the same number, name
    or unit of the item always meets the same one in the document. Places outside of the windows that stand in
    the document, as after a cut or an insertion, say nothing about slots. Repeated passages give the start with the
    most windows, then the first; ``start`` is the place of a word, whatever the form. Items with fewer than 5 tokens say nothing and match nothing; those with
    fewer than 8 are one window. Windows of placeholders alone stand in any table of numbers, so they are not counted, and an
    item without a word in it matches nothing. Null texts and null items match nothing. Rows of one id and text are one
    document; a null id is kept as null. Only windows that stand in the benchmark are shuffled.
    """
    windows = small(stage(_benchmark_windows(benchmark), "benchmark-windows"))
    keyed = with_row_key(docs.select("doc_id", text_or_empty().alias("t")), F.col("t"))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect()) or [WINDOW]  # four values at most
    by_form = lambda c: F.concat(*[window_hashes(codes_in_form(c, o), F.lit(o), sizes) for o in FORMS])
    hashes = bind(token_codes(marked(F.col("t"))), by_form)
    # outer forms, as the filter that the optimiser infers for others would work out all windows a second time
    stood = keyed.select("kd", "k1", F.explode_outer(hashes).alias("hs")).select("kd", "k1", F.posexplode_outer("hs").alias("at", "h"))
    found = stood.join(windows, "h").withColumn("start", F.col("at") - F.col("i"))
    aligned = (
        found.groupBy("kd", "k1", "item_id", "openers", "start", "n_windows", "size")
        # rows of one id and text, and items with one id, meet here: places, not rows; as many as the item's windows
        .agg(F.collect_set("i").alias("places"))
        .withColumn("n_matched", F.size("places").cast("long"))
        .where(F.col("n_matched") >= LEAST_SHARE * F.col("n_windows"))
    )
    candidates = small(stage(aligned, "benchmark-candidates"))
    texts = keyed.join(candidates.select("kd", "k1"), ["kd", "k1"], "left_semi").dropDuplicates(["kd", "k1"])
    item_tokens = F.when(F.col("openers"), raw_tokens(F.col("m"), True)).otherwise(raw_tokens(F.col("m"), False))
    items = _item_codes(benchmark, item_tokens.alias("item_tokens"))
    slots = F.filter(F.transform("codes", lambda x, i: F.when(_is_slot(x), i)), lambda x: x.isNotNull())
    held = texts.select("kd", "k1", "doc_id", marked(F.col("t")).alias("m"))
    doc_tokens = F.when(F.col("openers"), raw_tokens(F.col("m"), True)).otherwise(raw_tokens(F.col("m"), False))
    checked = (
        candidates.join(items.select("item_id", "openers", "item_tokens", slots.alias("slots")), ["item_id", "openers"])
        .join(held, ["kd", "k1"])
        .withColumn("doc_tokens", doc_tokens)
        .withColumn("slots", _within(F.col("slots"), F.col("places"), F.col("size")))
        .where(_consistent(F.col("item_tokens"), F.col("slots"), F.col("doc_tokens"), F.col("start")))
        .withColumn("start", _words_before(F.col("doc_tokens"), F.col("start")))
    )
    order = F.struct(F.col("n_matched"), -F.col("start"), ~F.col("openers"), "n_windows")
    best = F.max_by(F.struct("start", "n_matched", "n_windows"), order)
    return checked.groupBy("kd", "k1", "doc_id", "item_id").agg(best.alias("m")).select("kd", "k1", "doc_id", "item_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    with scratch():
        held = benchmark_matches(docs, benchmark).select(F.col("kd").alias("__kd"), F.col("k1").alias("__k1")).distinct()
        held = stage(held, "benchmark-held", keep=True)
    held = small(held)  # few keys: texts need no shuffle
    kd, k1 = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.xxhash64(text_or_empty())
    return docs.join(held, (kd == F.col("__kd")) & (k1 == F.col("__k1")), "left_anti")
