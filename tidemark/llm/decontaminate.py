"""Benchmark decontamination over canonical templates.

Numbers, names and units become typed placeholders, so that a question whose
parameters were changed still has the template of the original. The benchmark
is indexed by all its windows of ``TILE`` template tokens; a document is cut
into adjoining tiles of that size. A copied stretch of 2 * TILE - 1 tokens holds
a whole tile wherever it starts, and the hash join finds it. What the join
finds is laid out along the item: a position agrees when the literal tokens are
equal, or when both are placeholders of one type and the values correspond one
to one throughout the stretch; stretches apart from each other don't matter to it. An item has leaked into a document when
``MIN_RUN`` positions in a row agree, or all of a shorter item's. Placeholders
alone say too little: ``MIN_EQUAL`` of these positions, or half of a shorter
item's, must agree in their tokens.

A name may stand in small or capital letters in a copy. So the index holds every
window with each of its names as a placeholder and as a plain word, and a tile
is looked up as it stands and with all its names as plain words. The capital that
opens a sentence may be a name or not: both are looked up, and two that differ
agree as long as they contradict no other name of the stretch. Items of fewer
than 2 * TILE - 1 tokens may hold no tile; they are found by their whole
template, which is looked up at every place of a document.

Defined results: missing texts have no tokens. Items of fewer than ``MIN_ITEM``
tokens are not searched: so short a phrase turns up in clean text. Items or
documents that repeat are reported each; a missing document or item id stays
missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rows
from tidemark.sources import workdir

TILE = 6
MIN_RUN = 13
MIN_EQUAL = 4
MIN_ITEM = 3
# A larger index is not broadcast: 2 million entries are under 100 MB.
BROADCAST_ENTRIES = 2_000_000
UNITS = (
    "mm cm m km in ft yd mi g kg mg lb oz l ml h hr hrs min mins s sec secs ms "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent"
).split()
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
# Before a word that is a name, or that opens a sentence and may be one; no token has these signs.
NAMED, OPENER = "+", "^"
# Everything between tokens: ASCII signs but full stop and comma, and the general punctuation block.
_BETWEEN = r"[\x00-\x2B\x2D\x2F\x3A-\x40\x5B-\x60\x7B-\x7F -⁯]+"


def tokens(text: Column) -> Column:
    """Runs of letters and digits with the full stops and commas in or behind them."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def templates(found: Column) -> Column:
    """The canonical form of each token; a name is its word behind ``NAMED`` or ``OPENER``.

    A capital starts a name. It opens a sentence when the token before ends
    with a full stop or there is none. Words in capitals are
    plain words, so that shouted copies keep their template.
    """

    def canonical(token: Column, i: Column) -> Column:
        def form(bare: Column) -> Column:
            head = F.ascii(bare)
            capital = head.between(65, 90) | head.between(192, 222)
            opens = (i == 0) | F.endswith(F.get(found, i - 1), F.lit("."))
            return (
                F.when(head.between(48, 57), NUMBER)
                .when(capital, F.when(bare == F.upper(bare), F.lower(bare)).otherwise(F.concat(F.when(opens, OPENER).otherwise(NAMED), F.lower(bare))))
                .when(bare.isin(UNITS), UNIT)
                .otherwise(bare)
            )

        return rows.let(F.rtrim(token, F.lit(".,")), form)

    return F.transform(found, canonical)


def _word(form: Column) -> Column:
    """The plain word of a form that may be a name."""
    return F.ltrim(form, F.lit(NAMED + OPENER))


def _named(form: Column) -> Column:
    return F.startswith(form, F.lit(NAMED))


def _opener(form: Column) -> Column:
    return F.startswith(form, F.lit(OPENER))


def _spellings(window: Column, choices: Callable[[Column], Column]) -> Column:
    """Hashes of all the ways to write a window, given the choices for each form."""
    start = F.array(F.array().cast("array<string>"))
    each = lambda ways, form: F.flatten(F.transform(choices(form), lambda c: F.transform(ways, lambda w: F.concat(w, F.array(c)))))
    return F.transform(F.aggregate(window, start, each), lambda way: F.xxhash64(way))


def _of_item(window: Column) -> Column:
    """Hashes of an item's window: each name, sure or not, as a placeholder and as a plain word."""
    return _spellings(window, lambda form: F.when(_named(form) | _opener(form), F.array(F.lit(NAME), _word(form))).otherwise(F.array(form)))


def _of_document(window: Column) -> Column:
    """Hashes of a document's window: openers as either, names as placeholders; and with all names as plain words."""
    masked = F.transform(window, lambda form: F.when(_named(form), NAME).otherwise(form))
    either = lambda form: F.when(_opener(form), F.array(F.lit(NAME), _word(form))).otherwise(F.array(form))
    stands = F.when(F.exists(window, _opener), _spellings(masked, either)).otherwise(F.array(F.xxhash64(masked)))
    plain = F.array(F.xxhash64(F.transform(window, _word)))
    return F.when(F.exists(window, _named), F.array_union(stands, plain)).otherwise(stands)


def _index(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(items with their tokens, windows (hash, item, at)), both saved."""
    items = benchmark.select(F.col(item_id).alias("item_id"), rows.text_of(text).alias("text")).distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "text")).withColumn("raw", tokens(F.col("text")))
    items = items.withColumn("form", templates(F.col("raw"))).filter(F.size("raw") >= MIN_ITEM)
    items = workdir.saved(items.select("item", "item_id", "raw", "form"), "items")
    short = F.size("form") < 2 * TILE - 1
    starts = F.when(short, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.greatest(F.size("form") - TILE, F.lit(0))))
    windows = (
        items.select("item", "form", F.when(short, F.size("form")).otherwise(TILE).alias("width"), F.explode(starts).alias("at"))
        .select("item", "at", F.explode(_of_item(F.slice("form", F.col("at") + 1, F.col("width")))).alias("hash"))
        .distinct()
    )
    return items, workdir.saved(windows, "windows")


def _keys(form: Column, widths: list[int]) -> Column:
    """(hash, place) of each whole tile of a template, and of every window of the widths."""
    empty = F.array().cast("array<struct<hash:bigint,place:int>>")

    def at(places: Column, width: int) -> Column:
        found = lambda p: F.transform(_of_document(F.slice(form, p + 1, width)), lambda h: F.struct(h.alias("hash"), p.cast("int").alias("place")))
        return F.when(F.size(form) >= width, F.flatten(F.transform(places, found))).otherwise(empty)

    last = lambda width: F.greatest(F.size(form) - width, F.lit(0))
    tiles = at(F.sequence(F.lit(0), last(TILE), F.lit(TILE)), TILE)
    return F.concat(tiles, *[at(F.sequence(F.lit(0), last(width)), width) for width in widths])


def _aligned(item_form: Column, item_raw: Column, form: Column, raw: Column, at: Column) -> Column:
    """(run, agreed, slots): the longest run of agreeing positions, all of them, and the slots among them."""
    bare = lambda token: F.lower(F.rtrim(token, F.lit(".,")))
    # A place before the document's first token is no place.
    there = lambda array, j: F.when(at + j >= 0, F.get(array, at + j))
    name = lambda form: _named(form) | _opener(form)

    def pair(x: Column, j: Column) -> Column:
        mine, theirs, y = bare(F.get(item_raw, j)), bare(there(raw, j)), there(form, j)
        return F.struct(
            F.coalesce((y == x) | (name(y) & name(x)) | (theirs == mine), F.lit(False)).alias("same"),
            F.when(name(x), NAME).when(x.isin(NUMBER, UNIT), x).alias("slot"),
            # Nothing but its place says that an opener is a name: sure ones don't yield to it.
            F.coalesce(_opener(x) | (_opener(y) & (theirs != mine)), F.lit(False)).alias("unsure"),
            mine.alias("mine"),
            theirs.alias("theirs"),
        )

    pairs = F.transform(item_form, pair)

    def judged(stretch: Column) -> Column:
        filled = F.filter(stretch, lambda p: p["slot"].isNotNull())

        def agreeing(slots: Column) -> Column:
            clash = lambda p: F.exists(
                slots,
                lambda o: (o["slot"] == p["slot"])
                & (p["unsure"] | ~o["unsure"])
                & ((o["mine"] == p["mine"]) != (o["theirs"] == p["theirs"])),
            )
            plain = lambda p: p["slot"].isNull() | (p["unsure"] & (p["mine"] == p["theirs"]))
            return F.transform(stretch, lambda p: F.struct((plain(p) | ~clash(p)).alias("yes"), (p["mine"] == p["theirs"]).alias("equal")))

        def runs(agree: Column) -> Column:
            start = F.struct(*[F.lit(0).alias(x) for x in ("now", "equal", "verbatim", "best")])
            enough = F.least(F.lit(MIN_EQUAL), F.ceil(F.size(item_form) / 2).cast("int"))

            def step(acc: Column, p: Column) -> Column:
                now = F.when(p["yes"], acc["now"] + 1).otherwise(0)
                equal = F.when(p["yes"], acc["equal"] + p["equal"].cast("int")).otherwise(0)
                # Equal tokens in a row agree, whatever the slots around them say.
                verbatim = F.when(p["equal"], acc["verbatim"] + 1).otherwise(0)
                best = F.greatest(acc["best"], F.when(equal >= enough, now).otherwise(0), verbatim)
                return F.struct(now.alias("now"), equal.alias("equal"), verbatim.alias("verbatim"), best.alias("best"))

            return F.struct(
                F.aggregate(agree, start, step, lambda acc: acc["best"]).alias("run"),
                F.size(F.filter(agree, lambda p: p["yes"] | p["equal"])).alias("agreed"),
                F.size(filled).alias("slots"),
            )

        return rows.let(rows.let(filled, agreeing), runs)

    def stretches(all_pairs: Column) -> Column:
        """The stretches of positions in a row that can agree: from behind one that cannot up to the next."""
        places = F.sequence(F.lit(0), F.size(all_pairs))
        breaks = F.filter(places, lambda j: ~F.coalesce(F.get(all_pairs, j)["same"], F.lit(False)))
        behind = lambda ends, k: F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1
        cut = lambda ends: F.transform(ends, lambda end, k: F.slice(all_pairs, behind(ends, k) + 1, end - behind(ends, k)))
        return F.transform(rows.let(breaks, cut), judged)

    def together(found: Column) -> Column:
        total = lambda name: F.aggregate(found, F.lit(0), lambda n, x: n + x[name]).alias(name)
        return F.struct(F.array_max(F.transform(found, lambda x: x["run"])).alias("run"), total("agreed"), total("slots"))

    return rows.let(rows.let(pairs, stretches), together)


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, text_hash, item_id, run, agreed, n_slots, n_tokens): one row per document and leaked item."""
    items, windows = _index(benchmark, item_id, item_text)
    entries = windows.count()
    widths = [r[0] for r in items.select(F.size("form")).filter(F.size("form") < 2 * TILE - 1).distinct().collect()]  # one row per width
    whole = rows.text_of(text)
    key = [F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash")]
    keys = rows.let(tokens(whole), lambda x: rows.let(templates(x), lambda form: _keys(form, sorted(widths))))
    tiles = docs.select(*key, F.explode(keys).alias("k")).select("doc_id", "text_hash", "k.hash", "k.place")
    small = F.broadcast(windows) if entries <= BROADCAST_ENTRIES else windows
    found = tiles.join(small, "hash").select("doc_id", "text_hash", "item", (F.col("place") - F.col("at")).alias("at"))
    found = workdir.saved(found.distinct(), "candidates")
    # The texts with a candidate are cut once, not once for each.
    asked = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    texts = docs.select(*key, whole.alias("text")).join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    texts = texts.groupBy("_id", "_hash").agg(F.any_value("text").alias("text"))
    cut = rows.let(tokens(F.col("text")), lambda x: F.struct(x.alias("raw"), templates(x).alias("form")))
    texts = workdir.saved(texts.select("_id", "_hash", cut.alias("cut")), "texts")
    met = found.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).join(items, "item")
    laid = met.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.size("form").alias("n_tokens"),
        _aligned(F.col("form"), F.col("raw"), F.col("cut.form"), F.col("cut.raw"), F.col("at")).alias("a"),
    )
    held = laid.filter(F.col("a.run") >= F.least(F.lit(MIN_RUN), F.col("n_tokens")))
    best = held.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("a.run", "a.agreed", "a.slots", "n_tokens")).alias("b"))
    return best.select("doc_id", "text_hash", "item_id", "b.run", "b.agreed", F.col("b.slots").alias("n_slots"), "b.n_tokens")


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents into which no item has leaked, with their own columns."""
    found = leaks(docs, benchmark, doc_id, text)
    gone = workdir.saved(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    whole = docs.select(rows.packed(docs).alias("doc"), F.col(doc_id).alias("_d"), F.xxhash64(rows.text_of(text)).alias("_h"))
    clean = whole.join(gone, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left_anti")
    return rows.unpacked(clean)
