import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import blocks
from tidemark.functions import text as tx
from tidemark.operators import chunking, lexical


def one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def plain_chunks(text, target, overlap, min_chars):
    """Windows by their start offsets, the definition the blocks must reproduce."""
    text = text.strip()
    starts = [0]
    while starts[-1] + target < len(text):
        starts.append(starts[-1] + target - overlap)
    pieces = (text[s : s + target].strip() for s in starts)
    return [p for p in pieces if len(p) >= min_chars]


def random_text(rng, n):
    return "".join(rng.choice("ab é한😀 \n\t　\x1f\xa0") for _ in range(n))


def test_chunks_match_plain_windows(spark):
    rng = random.Random(3)
    texts = [random_text(rng, n) for n in [0, 1, 49, 50, 51, 99, 100, 101, 180, 181, 260, 261, 999]]
    texts += [random_text(rng, rng.randrange(1500)) for _ in range(40)]
    for target, overlap, min_chars in [(100, 20, 10), (100, 0, 1), (100, 70, 5), (100, 99, 1), (2000, 200, 50)]:
        df = spark.createDataFrame(list(enumerate(texts)), "source_id int, text string")
        rows = chunking.chunk_documents(
            df, target=target, overlap=overlap, min_chars=min_chars
        ).collect()
        for i, text in enumerate(texts):
            got = sorted((r.chunk_index, r.text, r.token_count) for r in rows if r.source_id == i)
            want = plain_chunks(text, target, overlap, min_chars)
            assert got == [(k, p, len(p)) for k, p in enumerate(want)]


def test_chunk_sizes_are_checked(spark):
    df = spark.createDataFrame([(1, "x")], "source_id int, text string")
    try:
        chunking.chunk_documents(df, target=10, overlap=10)
    except ValueError:
        return
    raise AssertionError("accepted an endless overlap")


def test_strip_matches_python(spark):
    rng = random.Random(5)
    values = [random_text(rng, rng.randrange(12)) for _ in range(200)]
    assert one(spark, values, tx.strip) == [v.strip() for v in values]


def test_titles(spark):
    title = lambda s: tx.document_title(s, F.lit("file.md"))
    cases = {
        "\n  \n# Heading \nrest": "Heading",
        "plain first\n# Heading": "plain first",
        "# ": "#",
        "#tag": "#tag",
        "   ": "file.md",
        "": "file.md",
        "a" * 200: "a" * 120,
        "one\x0btwo": "one",
        "one two": "one",
    }
    assert one(spark, list(cases), title) == list(cases.values())
    given = one(spark, ["  first  \nsecond"], lambda s: tx.note_title(F.lit(""), s))
    assert given == ["first  "]
    assert one(spark, ["x"], lambda s: tx.note_title(F.lit("T"), s)) == ["T"]


def test_redaction(spark):
    secrets = [
        "sk-ant-" + "a1" * 12,
        "sk-" + "B2" * 12,
        "sk-proj-" + "c_" * 12,
        "pa-" + "d-" * 12,
        "ghp_" + "e3" * 18,
        "github_pat_" + "f4" * 12,
        "AKIA" + "G5" * 8,
        "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh123",
        "0123456789abcdef" * 2,
    ]
    text = " and ".join(secrets)
    clean = one(spark, [text], tx.redact)[0]
    assert clean == " and ".join([fixed.REDACTED] * len(secrets))
    hits = one(spark, [text, "nothing here", "risk-averse sk-short"], lambda s: tx.redaction_hits(s, tx.redact(s)))
    assert hits == [len(secrets), 0, 0]


def test_marks_cover_every_marked_pattern():
    for name, pattern in fixed.SECRET_PATTERNS:
        heads = re.sub(r"\\b", "", pattern)
        if name == "hex":
            continue
        expected = {"github": "gh", "aws": "A"}.get(name)
        assert any(heads.startswith(m) for m in fixed.SECRET_MARKS) or expected, name


def test_render_turn_and_preview(spark):
    rows = spark.createDataFrame([("u", "a"), ("", "a"), ("u", ""), ("", "")], "u string, a string")
    got = [r[0] for r in rows.select(tx.render_turn(F.col("u"), F.col("a"))).collect()]
    assert got == ["User: u\n\nAssistant: a", "Assistant: a", "User: u", ""]
    assert one(spark, ["a\nb" + "c" * 200, None], tx.preview_text) == ["a b" + "c" * 117, ""]


def test_escape(spark):
    assert one(spark, ["a<b>&amp;", None], tx.escape_markup) == ["a&lt;b&gt;&amp;amp;", ""]


CONTENT = {
    '"hello"': "hello",
    "[]": "",
    "5": "",
    '{"type":"text","text":"x"}': "",
    '[{"type":"text","text":"a"},{"type":"text","text":""},{"type":"other"},"s",{"type":"text"}]': "a",
    '[{"type":"tool_use","name":"run","input":{"x":1}}]': '[tool: run({"x":1})]',
    '[{"type":"tool_use"}]': "[tool: ({})]",
    '[{"type":"tool_result","content":"out"}]': "[tool-result: out]",
    '[{"type":"tool_result","content":[{"text":"a"},"b",{"t":1}]}]': "[tool-result: a b ]",
    '[{"type":"tool_result"}]': "[tool-result: ]",
    '[{"type":"text","text":"a"},{"type":"tool_result","content":"b"}]': "a\n[tool-result: b]",
}


def test_flatten_content(spark):
    got = one(spark, list(CONTENT), lambda s: blocks.flatten_content(F.try_parse_json(s)))
    assert got == list(CONTENT.values())


def test_flatten_content_cuts(spark):
    long = '[{"type":"tool_use","name":"n","input":{"k":"%s"}},{"type":"tool_result","content":"%s"}]' % (
        "a" * 300,
        "b" * 600,
    )
    got = one(spark, [long], lambda s: blocks.flatten_content(F.try_parse_json(s)))[0]
    tool, result = got.split("\n")
    assert tool == "[tool: n(" + ('{"k":"' + "a" * 300)[:200] + ")]"
    assert result == "[tool-result: " + "b" * 500 + "]"


TEXTS = ["The cat, the hat; THE end_of 2nd", "", "!!!", "ß Été 한국어 한국어", "a a b", None]


def words_of(text):
    return re.findall(r"\w+", (text or "").lower())


def test_postings_count_words(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "chunk_id long, text string")
    got = {(r.chunk_id, r.term): (r.tf, r.n_words) for r in lexical.postings(df).collect()}
    want = {
        (i, w): (n, len(words_of(t))) for i, t in enumerate(TEXTS) for w, n in Counter(words_of(t)).items()
    }
    assert got == want
    terms = ["the", "한국어", "a", "missing"]
    key = lambda r: (r.chunk_id, r.term, r.tf, r.n_words)
    scanned = sorted(map(key, lexical.scan(df, terms).collect()))
    assert scanned == sorted((c, t, *v) for (c, t), v in want.items() if t in terms)


def test_stored_index_reads_only_its_buckets(spark, tmp_path):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(200)]
    df = spark.createDataFrame(rows, "chunk_id long, text string")
    index = lexical.postings(df)
    path = str(tmp_path / "index")
    lexical.write_index(index, path, buckets=8)
    terms = ["w3", "w47", "nowhere"]
    stored = lexical.read_index(spark, path, terms, buckets=8)
    key = lambda r: (r.chunk_id, r.term, r.tf, r.n_words)
    assert sorted(map(key, stored.collect())) == sorted(map(key, lexical.scan(df, terms).collect()))
    plan = stored._jdf.queryExecution().toString()
    pushed = re.findall(r"PushedFilters: \[(.*)\], ReadSchema", plan)
    # A list of terms, or one equality for each.
    assert "PartitionFilters: [" in plan and pushed and all("In(term" in p or "EqualTo(term,w3)" in p for p in pushed)
    assert lexical.read_index(spark, path, [], buckets=8).count() == 0


def test_query_terms(spark):
    assert lexical.query_terms(spark, "The a THE x-ray: (ok)") == ["ok", "ray", "the"]
    assert lexical.query_terms(spark, "a ? !") == []


def test_rank_score_of_one_chunk(spark):
    df = spark.createDataFrame([(1, "cat cat cat dog")], "chunk_id long, text string")
    row = lexical.lexical_scores(lexical.postings(df), ["cat", "dog", "eel"]).first()
    weight = lambda tf: 0.1 * sum(1 / j**2 for j in range(1, tf + 1)) / 1.64493406685
    assert abs(row.score - (weight(3) + weight(1)) / 3) < 1e-11
