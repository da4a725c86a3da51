"""Operators on document texts against plain answers, with rows of every odd kind."""

import contextlib
import glob
import math
import os
import random
import threading
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cuckoo, decontaminate, line_dedup, quality, simhash, substrings


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns carry the names that the operators use inside.
    clash = {c: F.lit("x") for c in ("doc", "kept", "line", "node", "row", "id", "hash", "fp", "n_words", "shard", "slot", "ids")}
    return spark.createDataFrame(brute.ROWS, brute.SCHEMA).withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_line_dedup(docs, none):
    got = line_dedup.dedup_lines(docs).select("doc.doc_id", "doc.text", "kept", "n_dropped").collect()
    kept = brute.without_frequent_lines([r[1] for r in brute.ROWS], 10)
    lines = lambda t: (t or "").count("\n") + 1
    for row in got:
        at = [r[:2] for r in brute.ROWS].index((row.doc_id, row.text))
        assert row.kept == kept[at]
        left = 0 if row.n_dropped == lines(row.text) else lines(row.kept)
        assert row.n_dropped == lines(row.text) - left
    assert len(got) == len(brute.ROWS)
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_is_reversible(spark, docs):
    first, more = docs.filter("doc_id < 106"), docs.filter("doc_id >= 106")
    one = line_dedup.inserted(line_dedup.empty_index(spark, shards=3), first)
    both = line_dedup.inserted(one, more)
    back = line_dedup.deleted(both, more)
    state = lambda index: bag(index.refs.select("k1", "k2", "docs").collect())
    assert state(back) == state(one)
    frequent = lambda index: {r.k1 for r in index.refs.filter("docs >= 10").collect()}
    assert frequent(both) and not frequent(back)
    dropped = lambda index: line_dedup.without_lines(index, docs).agg(F.sum("n_dropped")).first()[0]
    assert dropped(both) == 24 + 2 and dropped(back) == 0
    assert state(line_dedup.deleted(one, first)) == Counter()


def test_cuckoo_filter():
    import numpy as np

    keys = np.random.default_rng(5).integers(0, 1 << 63, 5000).astype(np.uint64)
    table = cuckoo.built(keys[:3000])
    assert cuckoo.contains(table, keys[:3000]).all()
    assert cuckoo.contains(table, keys[3000:]).mean() < 0.01
    cuckoo.delete(table, keys[:1000])
    assert cuckoo.contains(table, keys[1000:3000]).all()
    assert cuckoo.contains(table, keys[:1000]).mean() < 0.01
    # Keys that agree in their low half fill the same shard evenly enough to be found as well.
    assert cuckoo.contains(cuckoo.built(keys[:1]), keys[:1]).all()


def test_quality(docs, none):
    got = quality.judged(quality.measure(docs)).select("doc.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == len(brute.ROWS)
    for r in got:
        w = brute.words(r.text)
        lines = [x for x in (r.text or "").split("\n") if brute.words(x)]
        repeated = brute.repeated_words(r.text)
        want = (len(w), sum(map(len, w)), sum(map((r.text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), repeated)
        assert tuple(r)[1:6] == want
        assert r.base_failed == (len(w) < 10 or 100 * repeated > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.judged(quality.measure(none)).count() == 0
    assert set(quality.quality_filter(docs).columns) == set(docs.columns)


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_quality_thresholds_follow_the_source(spark, monkeypatch, hot):
    monkeypatch.setattr(quality, "HOT", hot)  # all groups are hot, some, or none
    plain = lambda k, mark: " ".join(f"word{(k * 31 + j) % 997}{mark if j % 2 else ''}" for j in range(60))
    # Half of all words end with a symbol in one source, as its style; in the other that is junk.
    rows = [(k, plain(k, "#"), "en", "code") for k in range(150)] + [(1000 + k, plain(k, ""), "en", "news") for k in range(150)]
    rows += [(5000, plain(7, "#"), "en", "news"), (5001, plain(9, "#"), "en", "tiny"), (5002, plain(9, ""), None, None)]
    got = {r.doc_id: r.kept for r in quality.judged(quality.measure(spark.createDataFrame(rows, brute.SCHEMA))).select("doc.doc_id", "kept").collect()}
    assert not got.pop(5000)
    assert all(got.values())


def test_quality_of_long_words_and_many_symbols(spark):
    # Sources whose middle half lies beyond the even grid: words of 60 to 90 characters, 3 symbols a word.
    long = lambda k, n: " ".join("字" * n + chr(0x4E00 + 12 * (k % 900) + j) for j in range(12))
    marks = lambda k, n: " ".join(f"word{(k * 31 + j) % 997}{'#' * n}" for j in range(12))
    rows = [(k, long(k, 60 + k % 3 * 10), "zh", "a") for k in range(150)] + [(1000, long(0, 5000), "zh", "a"), (1001, long(1, 43), "zh", "a")]
    rows += [(2000 + k, marks(k, 3), "en", "b") for k in range(150)] + [(3000, marks(0, 40), "en", "b")]
    got = {r.doc_id: r.kept for r in quality.judged(quality.measure(spark.createDataFrame(rows, brute.SCHEMA))).select("doc.doc_id", "kept").collect()}
    assert {k for k, kept in got.items() if not kept} == {1000, 3000}


def test_fingerprints_and_components(docs, none):
    marked = docs.select("doc_id", "text", simhash.fingerprint(F.col("text")).alias("fp"))
    got = simhash.clusters(marked).collect()
    assert len(got) == len(brute.ROWS)
    fps = [brute.fingerprint(t, 3) for _, t, *_ in brute.ROWS]
    roots = brute.components(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    least = {}
    for (doc_id, *_), root in zip(brute.ROWS, roots):
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    want = bag((r[0], r[1], least[root]) for r, root in zip(brute.ROWS, roots))
    assert bag((r.doc_id, r.text, r.component_id) for r in got) == want
    assert {r.fp % (1 << 64) for r in got} == set(fps)
    assert simhash.clusters(none.select("doc_id", simhash.fingerprint(F.col("text")).alias("fp"))).count() == 0


@pytest.mark.parametrize("distance", [2, 5])
def test_links_of_skewed_fingerprints(spark, distance):
    rnd = random.Random(distance)
    hub, fps = rnd.getrandbits(64), set()
    for k in range(400):
        x = hub if k % 2 else rnd.getrandbits(64)
        for _ in range(rnd.randint(0, 7)):
            x ^= 1 << rnd.choice([0, 1, 2, 3, 4, 5, 40, 63])
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    marked = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.clusters(marked, distance=distance).collect()}
    want = brute.components(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= distance)
    assert [got[k] for k in range(len(fps))] == want


def test_one_of_each(spark, docs, none):
    rnd = random.Random(2)
    rows = list(brute.ROWS)
    for k in range(30):
        w = [f"v{rnd.randrange(500)}" for _ in range(120)]
        for j in range(rnd.randint(1, 6)):
            rows.append((1000 + 10 * k + j, " ".join(w), "en", "a"))
            w[rnd.randrange(120)] = "changed"
    got = simhash.one_of_each(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()
    sets = [brute.shingles(t) for _, t, *_ in rows]

    def alike(a, b):
        common = len(sets[a] & sets[b])
        return 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)

    roots = brute.components(len(rows), alike)
    groups = {}
    for row, root in zip(rows, roots):
        groups.setdefault(root, []).append(row[0])
    least = Counter(min((x for x in ids if x is not None), default=None) for ids in groups.values())
    assert Counter(r.doc_id for r in got) == least
    assert simhash.one_of_each(none).count() == 0
    assert set(simhash.one_of_each(docs).columns) == set(docs.columns)


def test_one_of_each_finds_contiguous_edits(spark):
    rnd = random.Random(6)
    rows, similar = [], []
    for k in range(150):
        w = [f"v{rnd.randrange(4000)}" for _ in range(rnd.randrange(200, 1000))]
        n, at = round(len(w) * rnd.choice([0.1, 0.15, 0.19])), rnd.randrange(len(w) // 2)
        copy = w[:at] + w[at + n :] if k % 2 else w[:at] + [f"n{rnd.randrange(4000)}" for _ in range(n)] + w[at:]
        a, b = (brute.shingles(" ".join(x)) for x in (w, copy))
        similar.append(100 * len(a & b) >= 80 * len(a | b))
        rows += [(2 * k, " ".join(w), "en", "a"), (2 * k + 1, " ".join(copy), "en", "a")]
    got = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    assert got == {2 * k for k in range(150)} | {2 * k + 1 for k in range(150) if not similar[k]}
    assert sum(similar) > 100


def test_near_copies_are_proposed_by_fingerprints(spark):
    rnd = random.Random(8)
    w = [f"v{rnd.randrange(4000)}" for _ in range(300)]
    other = [f"v{rnd.randrange(4000)}" for _ in range(300)]
    texts = [w, w[:270], other, ["A"] + w]
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(texts)], "node long, text string")
    nodes = df.select("node", simhash.fingerprints(F.col("text"), 5).alias("prints")).localCheckpoint()
    prints = {r.node: r.prints for r in nodes.collect()}
    bits = simhash.BITS * simhash.FINGERPRINTS
    differ = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(prints[a], prints[b])) / bits
    # A tenth cut off: the cosine is sqrt(0.9). Unrelated texts differ in half of the bits.
    assert abs(differ(0, 1) - math.acos(math.sqrt(266 / 296)) / math.pi) < 0.03
    assert abs(differ(0, 2) - 0.5) < 0.05
    got = {(r.a, r.b) for r in simhash.print_links(nodes, 80, lambda pairs: pairs).collect()}
    assert {(0, 1), (0, 3)} <= got and not any(2 in pair for pair in got)


def test_values_that_nodes_share(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_VALUES", 12_000)
    monkeypatch.setattr(simhash, "TASK_VALUES", 3_000)
    rnd = random.Random(9)
    parts = [(list(range(22)), 0), (list(range(22, 43)), 0), (list(range(43, 64)), 1)]
    drawn = lambda: [rnd.getrandbits(64) for _ in range(simhash.FINGERPRINTS)]
    hub, prints = drawn(), [drawn() for _ in range(25)]
    # A large group that differs in few bits: its values stand several times in every block.
    prints += [[x ^ (1 << rnd.randrange(64)) for x in hub] for _ in range(15)]
    want = {}
    for row, own in enumerate(prints):
        for number, x in enumerate(own):
            for k, (group, t) in enumerate(parts):
                key = x & sum(1 << b for b in group)
                for flip in [0, *(1 << b for b in group if t)]:
                    want.setdefault((number, k, key ^ flip), set()).add(7 * row << 33)
    signed = [(7 * row << 33, [x - (1 << 64) if x >> 63 else x for x in own]) for row, own in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "row long, prints array<long>").repartition(3)
    got = simhash.shared_values(nodes, parts).groupBy("at").agg(F.sort_array(F.collect_list("row")).alias("rows")).collect()
    assert Counter(tuple(r.rows) for r in got) == Counter(tuple(sorted(x)) for x in want.values() if len(x) > 1)
    assert max(len(r.rows) for r in got) == 15
    assert simhash.shared_values(nodes.filter("false"), parts).count() == 0


def test_nodes_that_meet_by_chance_are_dropped_where_they_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_VALUES", 4_000)
    monkeypatch.setattr(simhash, "TASK_VALUES", 9_000)
    monkeypatch.setattr(simhash, "MET_LAGS", 8)
    rnd = random.Random(11)
    parts, most = [(list(range(10)), 0), (list(range(10, 20)), 0)], 14
    drawn = lambda: [rnd.getrandbits(64) for _ in range(simhash.FINGERPRINTS)]
    prints = [drawn() for _ in range(200)]
    prints += [[x ^ sum(1 << rnd.randrange(64) for _ in range(6)) % (1 << 64) for x in own] for own in prints[:40]]
    # A value of more nodes than are compared there: all stay, though their other bits are far.
    hub = rnd.getrandbits(10)
    prints += [[own[0] >> 10 << 10 | hub, *own[1:]] for own in (drawn() for _ in range(15))]
    values = {}
    for row, own in enumerate(prints):
        for number, x in enumerate(own):
            for k in (0, 10):
                values.setdefault((number, k, x >> k & 1023), []).append(row)
    want = Counter()
    for (number, *_), met in values.items():
        near = [a for a in met if any(a != b and (prints[a][number] ^ prints[b][number]).bit_count() <= most for b in met)]
        want[tuple(met if len(met) > 9 else near)] += 1
    signed = [(row, [x - (1 << 64) if x >> 63 else x for x in own]) for row, own in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "row long, prints array<long>").repartition(3)
    got = simhash.shared_values(nodes, parts, most).groupBy("at").agg(F.sort_array(F.collect_list("row")).alias("rows")).collect()
    del want[()]
    assert Counter(tuple(r.rows) for r in got) == want
    assert max(len(r.rows) for r in got) >= 15 and sum(len(x) > 1 for x in values.values()) > 2 * len(got)


def test_relatives_are_told_from_near_copies_before_they_are_verified(spark, monkeypatch):
    rnd = random.Random(12)
    base = [f"v{rnd.randrange(4000)}" for _ in range(400)]
    rows = []
    for k in range(150):
        at, n = rnd.randrange(300), rnd.randrange(20, 100)
        rows.append((k, " ".join(base[:at] + [f"n{rnd.randrange(4000)}" for _ in range(30)] + base[at + n :]), "en", "a"))
    # The smallest sets that can be alike: their bits are often tied, so more of them differ.
    rows += [(200 + 2 * k + j, " ".join(f"s{k}x{i}" for i in range(8 + j)), "en", "a") for k in range(40) for j in range(2)]
    sets = [brute.shingles(t) for _, t, *_ in rows]
    alike = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    roots = brute.components(len(rows), alike)
    groups = {}
    for (doc_id, *_), root in zip(rows, roots):
        groups[root] = min(doc_id, groups.get(root, doc_id))
    similar, asked = simhash.similar, []

    def counted(pairs, *args):
        asked.append(pairs.count())
        return similar(pairs, *args)

    monkeypatch.setattr(simhash, "similar", counted)
    got = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    large = {x for x in groups.values() if x < 200}
    assert {x for x in got if x < 200} == large
    # A pair of four and five shingles shares no value with a chance of one in ten.
    assert len(got) - len(large) <= 48
    assert 0 < sum(asked) < 150 * 149 / 2 / 3


def test_one_of_each_shuffles_little(spark):
    rnd = random.Random(10)
    rows = [(k, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(500)), "en", "a") for k in range(1500)]
    rows += [(2000 + k, rows[k][1] + " tail", "en", "a") for k in range(100)]
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    sizes, ended = {}, threading.Event()

    def look():  # Spark may delete a file before the end
        while not ended.wait(0.05):
            for path in (f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")):
                with contextlib.suppress(OSError):
                    sizes[path] = max(sizes.get(path, 0), os.path.getsize(path))

    before = {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    looking = threading.Thread(target=look)
    looking.start()
    try:
        got = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    finally:
        ended.set()
        looking.join()
    assert got == set(range(1500))
    shuffled = sum(n for path, n in sizes.items() if path not in before)
    # Neither a row for each of 192 values of a text nor the texts themselves are shuffled.
    assert 0 < shuffled < 10 * 192 * len(rows)


@pytest.mark.parametrize(("window", "hot"), [(35, 4096), (10, 4096), (10, 0)])
def test_substrings(docs, none, monkeypatch, window, hot):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)
    got = substrings.without_repeats(docs, window=window).select("doc.doc_id", "doc.text", "kept", "n_words", "n_removed").collect()
    kept = brute.without_repeats([r[1] for r in brute.ROWS], window)
    want = bag((r[0], r[1], k, len(brute.words(r[1])), len(brute.words(r[1])) - len(brute.words(k))) for r, k in zip(brute.ROWS, kept))
    assert bag(got) == want
    assert substrings.without_repeats(none).count() == 0


def test_suffix_automaton():
    rnd = random.Random(1)
    for _ in range(200):
        texts = [[rnd.randrange(3) for _ in range(rnd.randint(1, 12))] for _ in range(rnd.randint(1, 4))]
        times = [rnd.randint(1, 2) for _ in texts]
        automaton = substrings.Automaton()
        paths = [automaton.add(t, n) for t, n in zip(texts, times)]
        automaton.finish()
        seen = Counter()
        for t, n in zip(texts, times):
            for a in range(len(t)):
                for b in range(a + 1, len(t) + 1):
                    seen[tuple(t[a:b])] += n
        for t, path in zip(texts, paths):
            want = [max((b - a for a in range(b) if seen[tuple(t[a:b])] > 1), default=0) for b in range(1, len(t) + 1)]
            assert automaton.statistics(path).tolist() == want


ITEM = "A train leaves Boston at 7 with 120 riders on board and Alice counts 7 bags of 5 kg each before it stops again."
OTHER = "The quick method of solving this needs nothing but patience and a little paper to write every step on it."


def leaked(spark, texts, benchmark=((1, ITEM), (2, OTHER), (3, "too short"), (4, None))):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(list(benchmark), "item_id long, text string")).collect()}


def test_decontamination(spark):
    changed = ITEM.replace("Boston", "Denver").replace("120", "95").replace("7", "9").replace("5 kg", "8 lb").replace("Alice", "Bob")
    # One 7 became 9, the other 8: the slots contradict each other.
    clash = ITEM.replace("at 7", "at 9").replace("counts 7", "counts 8").replace("120", "9")
    padding = "some plain words that stand around it for a while"
    texts = [
        f"{padding} {ITEM} {padding}",
        f"{padding}. {changed}",
        ITEM.upper(),
        f"{padding} {ITEM.lower()}\n{OTHER}",
        clash,
        padding,
        None,
        "",
        "too short",
        " ".join(f"{k}" for k in range(200)),
        ("filler " * 20_000) + OTHER,
        "7 " * 50,
    ]
    got = leaked(spark, texts)
    assert got == {(0, 1), (1, 1), (2, 1), (3, 1), (3, 2), (10, 2)}
    assert leaked(spark, []) == set()
    assert leaked(spark, texts, ((3, "too short"),)) == set()
    # Wherever the passage starts, a whole tile falls into it.
    for shift in range(decontaminate.TILE):
        assert leaked(spark, ["x " * shift + OTHER]) == {(0, 2)}
    docs = spark.createDataFrame([(k, t, "y") for k, t in enumerate(texts)] + [(None, ITEM, "y")], "doc_id long, text string, item string")
    clean = decontaminate.without_leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7, 8, 9, 10, 11]
    assert clean.columns == docs.columns


def test_decontamination_of_slot_rich_and_short_items(spark):
    title = "The Great Garden Of Queen Maria And Her Seven Sisters Was Built In Old Vienna By Anton Huber"
    numbers = "12 15 18 21 24 27 30 34 36 39 42 45 48 51 54"
    short = "Paula eats 3 apples and 4 pears"
    benchmark = ((1, title), (2, numbers), (3, short))
    other = " ".join(str(k) for k in range(100, 160))
    for shift in range(decontaminate.TILE):
        texts = ["x " * shift + t for t in (title, title.lower(), title.upper(), numbers, short.replace("3", "5"), other, "eats 3 apples and 4 plums")]
        want = {(0, 1), (1, 1), (2, 1), (3, 2), (4, 3)}
        if shift == 0:
            assert leaked(spark, texts, benchmark) == want
            every = texts
            continue
        every += texts
    assert leaked(spark, every, benchmark) == {(7 * s + d, i) for s in range(decontaminate.TILE) for d, i in want}


def test_decontamination_of_names_that_open_sentences(spark):
    item = "Tom has 5 apples. Ann gives Tom 3 more. How many apples does Tom have now"
    changed = item.replace("Tom", "Bob").replace("Ann", "Eve")
    # Tom is Bob in one place and Carl in the others.
    clash = item.replace("Tom", "Carl").replace("Carl has", "Bob has").replace("gives Carl", "gives Bob")
    texts = [f"{'x ' * k}x. {changed}" for k in range(decontaminate.TILE)] + [clash, f"so {item[0].lower()}{item[1:]}"]
    assert leaked(spark, texts, ((1, item),)) == {(k, 1) for k in range(decontaminate.TILE)} | {(7, 1)}


def test_slots_outside_a_quoted_stretch_do_not_contradict_it(spark):
    item = "Maria counts 14 small boats in the old harbour and tells Maria that 14 of them are for sale. Then Maria buys one of the boats."
    quoted = "counts 14 small boats in the old harbour and tells Maria that 14 of them"
    texts = [f"Here {quoted} should be red. Then Peter sold it for a coin", f"so Paula {quoted.replace('Maria', 'Paula')} were gone. Later Peter had 14"]
    assert leaked(spark, texts, ((1, item),)) == {(0, 1), (1, 1)}
