"""Every operator against a plain version on awkward rows, and on empty tables."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import plain
import pytest
from pyspark.sql import functions as F
from tables import awkward, empty  # noqa: F401  fixtures

from salescompass.llm import (
    decontaminate, fingerprints, line_dedup, near_dedup, rule_quality, sharding, source_mix, substring_dedup, toxicity, url_filter,
)
from salescompass.llm.decontaminate import n_marked

KEYS = lambda r: (r[0] is not None, r[0] or 0)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (KEYS(r), repr(r)))


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 3000, "bucket_words": 300}, {"window": 3}])
def test_substring_dedup(awkward, settings):
    rows, df = awkward
    kept = substring_dedup.remove_repeats(df, **settings)
    mine = kept.select("doc_id", "n_words", n_marked("removed"), F.sha2("kept_text", 256))
    assert tuples(mine) == sorted(plain.substring_dedup(pairs(rows), settings.get("window", 13)), key=lambda r: (KEYS(r), repr(r)))


def test_substring_spans_are_maximal(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    df = spark.createDataFrame([(1, f"a b {shared} c"), (2, f"{shared} d"), (2, f"{shared} d"), (3, f"x {shared} c y")], "doc_id int, text string")
    got = {(r["doc_id"], str(r["removed"])) for r in substring_dedup.remove_repeats(df).collect()}
    assert {(i, s) for i, s in got if i == 1} == {(1, "[]")}
    assert {s for i, s in got if i == 2} == {"[Row(start=0, end=20)]"}
    assert {s for i, s in got if i == 3} == {"[Row(start=1, end=22)]"}


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_line_dedup(awkward, window):
    rows, df = awkward
    kept = line_dedup.remove_repeated_lines(df, window)
    mine = kept.select("doc_id", "n_lines", F.size("removed"), F.sha2("kept_text", 256))
    assert tuples(mine) == sorted(plain.line_dedup(pairs(rows), window), key=lambda r: (KEYS(r), repr(r)))


def test_line_dedup_of_long_lines_and_short_documents(spark):
    long = "one two three four five six seven eight"
    rows = [
        (1, f"{long}\nx"), (2, f"y\n{long}"), (3, f"{long}\nx"), (4, f"{long} nine\n{long}  "), (5, "x"), (6, "x"), (7, "x\n"), (8, "x\n"),
        (9, f"a\n\nb\n{long}\n\nc\x00{long}"), (10, f"c\x00{long}\n{long}\n{long}"), (11, "short line\n\nshort line"), (12, f"\n{long}\r\n{long}\x0b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    mine = line_dedup.remove_repeated_lines(df).select("doc_id", "n_lines", F.size("removed"), F.sha2("kept_text", 256))
    assert tuples(mine) == plain.line_dedup(rows)


def test_line_dedup_finds_every_run_of_random_lines(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randrange(12)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    mine = line_dedup.remove_repeated_lines(df, 4).select("doc_id", "n_lines", F.size("removed"), F.sha2("kept_text", 256))
    assert tuples(mine) == plain.line_dedup(rows, 4)


ITEMS = [(1, "one two"), (2, ""), (3, None), (4, "W1, w2"), (5, "日本語"), (7, "x x x x x x x x x x x")]


@pytest.mark.parametrize("block_bytes", [10**6, 40])
def test_contamination(spark, awkward, block_bytes):
    rows, df = awkward
    text = next(t for i, t in pairs(rows) if t and len(t) > 20_000 and t.startswith("x ") is False)
    words = plain.LETTER_WORD.findall(plain.lowered(text))
    items = [*ITEMS, (10, " ".join(words[50:75]).upper()), (11, "new words " + " ".join(words[200:212]) + " more new words"), (9, " ".join(words[60:69]) + " other")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.contamination(df, benchmark, block_bytes=block_bytes)
    mine = found.select("doc_id", "n_words", n_marked("spans"), F.size("items"), F.sha2(F.array_join("items", ","), 256), F.size("spans") > 0)
    expected = plain.contamination(pairs(rows), items)
    assert tuples(mine) == sorted(expected, key=lambda r: (KEYS(r), repr(r)))
    assert 0 < sum(r[-1] for r in expected) < len(rows)
    clean = decontaminate.decontaminated(df, benchmark, block_bytes=block_bytes)
    assert clean.columns == df.columns and Counter(r["doc_id"] for r in clean.collect()) == Counter(r[0] for r in expected if not r[-1])
    assert decontaminate.contamination(df, benchmark.limit(0)).filter("n_words > 0 and size(spans) = 0").count() > 20


def test_contamination_by_share(spark):
    item = " ".join(f"i{k}" for k in range(10))
    docs = [(1, "a b " + item), (2, item.replace("i0 ", "zz ")), (3, item.replace("i4", "zz")), (4, "i0 i1 i2"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id int, text string")
    hit = lambda share: sorted(r["doc_id"] for r in decontaminate.contamination(df, benchmark, containment=share).filter("size(spans) > 0").collect())
    # a changed first word spoils one of eight shingles, one in the middle three
    assert hit(1.0) == [1] and hit(7 / 8) == [1, 2] and hit(5 / 8) == [1, 2, 3]


def test_sharding(awkward):
    _, df = awkward
    n = df.count()
    out = sharding.shard_rows(df, ["doc_id"], 7)
    rows = out.collect()
    assert set(df.columns) | {"row", "shard", "slot"} == set(out.columns)
    assert sorted(r["row"] for r in rows) == list(range(n))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert {s: sorted(x) for s, x in slots.items()} == {s: list(range(len(x))) for s, x in slots.items()}
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_rows(df.repartition(5), ["doc_id"], 7)
    key = lambda rs: sorted(((r["doc_id"], r["shard"], r["slot"]) for r in rs), key=KEYS)
    assert key(again.collect()) == key(rows)
    # any row's place can be computed alone
    alone = df.sparkSession.createDataFrame([(rows[0]["row"],)], "r long").select(*sharding.place(F.col("r"), F.lit(n), 7, 0)).first()
    assert (alone[0], alone[1]) == (rows[0]["shard"], rows[0]["slot"])


def test_sharding_is_a_plain_feistel_walk(spark):
    n, shards, seed = 43, 7, 3
    side = int(n**0.5) + 1
    hashes = spark.range(side + 1).select("id", *[F.xxhash64(F.xxhash64(F.lit("shards"), F.lit(seed)), F.lit(k), F.col("id")).alias(f"h{k}") for k in range(6)])
    table = {(k, r["id"]): r[f"h{k}"] for r in hashes.collect() for k in range(6)}
    out = sharding.shard_rows(spark.range(n).withColumnRenamed("id", "doc_id"), ["doc_id"], shards, seed).collect()
    for r in out:
        at = plain.feistel(r["row"], n, lambda step, value: table[step, value])
        assert (r["shard"], r["slot"]) == (at % shards, at // shards)


def test_equal_rows_are_spread(spark):
    """A third of the rows are equal, a third have one id, and a third have none."""
    rows = [(7, "the same words in a row")] * 3000 + [(8, f"text {i}") for i in range(3000)] + [(None, "no id here")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sharding.shard_rows(df, ["doc_id"], 7)
        parts = sorted(spark.read.parquet(f).count() for f in out.inputFiles())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and parts[-1] <= 3 * parts[1] and sorted(r["row"] for r in out.collect()) == list(range(9000))
    removed = substring_dedup.remove_repeats(df, 3, chunk_bytes=20_000).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(n_marked("removed")).alias("words"))
    assert {tuple(r) for r in removed.collect()} == {(7, 3000, 0), (8, 3000, 0), (None, 3000, 0)}


def test_chunks_share_one_exchange(spark, empty):  # noqa: F811
    """The three steps of substring dedup read the texts that one exchange has dealt."""
    df = spark.createDataFrame([(i, f"a b c {i} " * 9) for i in range(50)], "doc_id long, text string")
    out = substring_dedup.remove_repeats(df, 5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_sizes(spark):
    df = spark.createDataFrame([(None,), ("",), ("é日",)], "text string")
    assert [tuple(r) for r in df.select(*sharding.row_sizes(F.col("text"))).collect()] == [(16, 0), (16, 0), (21, crc32("é日".encode()))]


RULES = [url_filter.Rule(*r) for r in (("net/", "block"), ("example.net/en/", "allow"), ("a*b.org/x*y/", "block"), ("q?.com", "allow"))]


def test_url_filter(spark):
    cases = [
        (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme.net/", "", "", None, "allow"),
        ("http://NET/", "net", "/", "net/", "block"), ("http://a.NeT/É?x", "a.net", "/É", "net/", "block"), ("http://a.net", "a.net", "", None, "allow"),
        ("http://anet/", "anet", "/", None, "allow"), ("http://x.example.net/en/1#t", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"), ("http://foo.com/x.net/", "foo.com", "/x.net/", None, "allow"),
        ("http://a.c.b.org/x/1/y/z", "a.c.b.org", "/x/1/y/z", "a*b.org/x*y/", "block"), ("http://ab.org/xy/", "ab.org", "/xy/", "a*b.org/x*y/", "block"),
        ("http://ab.org/xy", "ab.org", "/xy", None, "allow"), ("http://qz.com", "qz.com", "", "q?.com", "allow"), ("http://q.com", "q.com", "", None, "allow"),
        ("ftp://u://net/", "u:", "//net/", None, "allow"), ("http://?net/", "", "", None, "allow"),
        ("http://" + "a." * 5000 + "net/" + "p" * 3000, "a." * 5000 + "net", "/" + "p" * 3000, "net/", "block"),
    ]
    df = spark.createDataFrame([(u, 1) for u, *_ in cases] * 2, "url string, host int")
    got = url_filter.filter_urls(df, RULES).select("url", "host", "path", "rule", "verdict").collect()
    assert Counter(map(tuple, got)) == Counter(cases * 2)
    assert url_filter.filter_urls(df, []).filter("rule is null and verdict = 'allow'").count() == len(got)


def test_many_rules_need_many_words(spark):
    rng = random.Random(2)
    hosts = ["".join(rng.choice("ab.") for _ in range(rng.randrange(1, 5))).strip(".") or "a" for _ in range(60)]
    rules = [url_filter.Rule(f"{h}/{p}", "block") for h in hosts for p in ("", "a/")]
    urls = [f"{h}/{p}" for h in hosts for p in ("", "a/b", "ab")] + [f"x.{h}/a/" for h in hosts]
    automaton = url_filter.Automaton([r.pattern for r in rules])
    assert automaton.words > 5
    found = automaton.matches([f".{u}".encode() for u in urls])
    for i, u in enumerate(urls):
        host, _, path = u.partition("/")
        for k, r in enumerate(rules):
            rule_host, _, rule_path = r.pattern.partition("/")
            assert found[i, k] == (("." + host).endswith("." + rule_host) and path.startswith(rule_path))


@pytest.mark.parametrize("part_bytes", [10**7, 2000])
def test_fingerprint_edits(awkward, part_bytes):
    rows, df = awkward
    got = fingerprints.fingerprint_edits(df, part_bytes=part_bytes).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=KEYS) == plain.fingerprint_rows(pairs(rows))
    text = dict(pairs(rows))
    by_text = defaultdict(set)
    for r in got:
        by_text[text[r["doc_id"]] or ""].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_add_up():
    a, b = ["p one", "p two", "p one"], ["p three"]
    whole, part, other, turned = fingerprints.sums([a + b, a, b, b + a[::-1]])
    assert (whole == part + other).all() and (whole - other == part).all() and (whole == turned).all()
    assert fingerprints.likeness(whole[None], turned[None])[0] == 1
    many = [f"paragraph {i}" for i in range(40)]
    x, y, z = fingerprints.sums([many, many[:30] + [f"new {i}" for i in range(10)], [f"else {i}" for i in range(40)]])
    assert 0.6 < fingerprints.likeness(x[None], y[None])[0] < 0.9 and fingerprints.likeness(x[None], z[None])[0] < 0.25
    assert fingerprints.likeness(*fingerprints.sums([[], []])[:, None])[0] == 1


def test_fingerprint_parts_are_cut_within_hot_ids_and_equal_rows(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    ids = np.concatenate([np.full(7000, 5), np.full(7000, 9), rng.integers(10, 10**6, 7000)])
    ties = np.concatenate([np.full(7000, 3), rng.integers(0, 2**62, 7000), rng.integers(0, 2**62, 7000)])
    rows = np.stack([ids, ties, np.arange(21_000)], axis=1)
    cuts = fingerprints.Cuts(rows[rng.random(21_000) < 0.02], 30)
    parts = cuts.parts(list(rows.T))
    sizes = np.bincount(parts, minlength=30)
    assert len(cuts) == 29 and sizes.max() <= 3 * np.median(sizes)
    order = np.lexsort(rows.T[::-1])
    assert (np.diff(parts[order]) >= 0).all()
    hot = [(5, "one text. And another one.")] * 60 + [(9, "A line of nine."), (None, "no id. At all.")] * 1 + [(i, f"text {i}. " * 5) for i in range(10, 30)]
    df = spark.createDataFrame(hot, "doc_id long, text string").repartition(5)
    got = fingerprints.fingerprint_edits(df, part_bytes=150).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=lambda r: (KEYS(r), r[2])) == sorted(plain.fingerprint_rows(hot), key=lambda r: (KEYS(r), r[2]))


def test_one_document_is_its_own_next(spark):
    df = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    row = fingerprints.fingerprint_edits(df).first()
    assert row["edited_sha256"] == plain.sha("abcdefab") and row["near_next"] == 1


def test_near_duplicates(awkward):
    rows, df = awkward
    expected = plain.near_classes([t for _, t in pairs(rows)])
    ids = [i for i, _ in pairs(rows)]
    least = defaultdict(list)
    for i, c in zip(ids, expected):
        least[c].append(i)
    wanted = sorted(((i, min((x for x in least[c] if x is not None), default=None)) for i, c in zip(ids, expected)), key=KEYS)
    found = near_dedup.NearDuplicates(df)
    assert sorted(map(tuple, found.classes().collect()), key=KEYS) == wanted
    kept = near_dedup.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"],) for r in kept.collect()), key=KEYS) == sorted({(c,) for _, c in wanted}, key=KEYS)


def test_near_duplicates_in_one_large_group(spark, monkeypatch):
    """Bands with more members than are compared at once, some of them near to few others."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(150)] = f"n{i}"
        texts.append(" ".join(w))
    texts += [" ".join(f"v{rng.randrange(500)}" for _ in range(100)) for _ in range(20)]
    expected = plain.near_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block, rounds, small in ((7, 1, 2), (256, 2, 8), (16, 0, 4)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "SMALL_BAND", small)
        monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
        got = dict(map(tuple, near_dedup.NearDuplicates(df).classes().collect()))
        assert [got[i] for i in range(len(texts))] == expected


@pytest.mark.parametrize("n", [300, 1200])
def test_links_are_few(spark, monkeypatch, n):
    """Near copies of one text: the component search gets two links per document at most."""
    from salescompass.llm import components as module
    from salescompass.llm.storage import stored

    rng = random.Random(n)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    texts = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(200)] = f"n{i}"
        texts.append(" ".join(w))
    seen, original = [], module.components

    def counted(links):
        links = stored(links, "test-links")
        seen.append(links.count())
        return original(links)

    monkeypatch.setattr(near_dedup, "components", counted)
    monkeypatch.setattr(module, "components", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = dict(map(tuple, near_dedup.NearDuplicates(df).classes().collect()))
    assert set(got.values()) == {0}  # 20 of 196 shingles differ at most, a similarity of 0.81
    assert 0.6 * n < sum(seen) <= 2 * n  # equal texts are one node


def test_compared_texts_and_components_take_turns(spark, monkeypatch):
    """The component search reads verified links from a table: no task holds a Python process for each of the two."""
    original, plans = near_dedup.components, []

    def seen(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return original(links)

    monkeypatch.setattr(near_dedup, "components", seen)
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, f"{text} x"), (3, "other words")], "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    assert dict(map(tuple, near_dedup.NearDuplicates(df).classes().collect())) == {1: 1, 2: 1, 3: 3}
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_repeated_rows_and_ids(spark):
    one = "a b c d e f g h"
    df = spark.createDataFrame([(1, one), (1, one), (1, "other text of this id here"), (2, one), (3, None), (4, "")], "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.deduplicated(df).collect()), key=str) == sorted([(1, one), (1, "other text of this id here"), (3, None)], key=str)


def test_signatures_estimate_the_weighted_similarity():
    import numpy as np

    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 80).astype(np.uint64)
    a, b = rng.integers(0, 9, 80), rng.integers(0, 9, 80)
    text = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
    points = near_dedup.bag_min_hash(text, np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 4000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((points[0] == points[1]).mean() - true) < 4 * (true * (1 - true) / 4000) ** 0.5


def test_mix(awkward):
    rows, df = awkward
    mix = source_mix.Mix(df, block=8)
    out = mix.taken().collect()
    sizes = defaultdict(int)
    for _, t, _, s, *_ in rows:
        sizes[s] += len(plain.words(t))
    wanted = plain.targets(sizes, source_mix.WEIGHTS)
    taken = defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, target in wanted.items():
        assert abs(taken[s] - target) <= 8 * 6 + 0.02 * target, (s, taken[s], target)
    drawn = mix.plan.collect()
    assert len({(r["no"], r["pass"], r["block"]) for r in drawn}) == len(drawn)
    walked = Counter()  # every slot takes the block that a plain walk of the permutation gives
    blocks = {r["no"]: -(-r["source_size"] // 8) for r in mix.sources.collect()}
    spans = defaultdict(list)
    for r in mix.docs.collect():
        spans[r["no"]].append((r["start"], r["start"] + r["size"], r["row"]))
    for r in drawn:
        low, high = r["block"] * 8, r["block"] * 8 + 8
        assert r["draw"] // blocks[r["no"]] == r["pass"]
        for begin, end, row in spans[r["no"]]:
            walked[row] += max(0, min(high, end) - max(low, begin))
    assert +walked == +Counter({r["row"]: r["taken"] for r in mix.pieces().groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken")).collect()})
    again = source_mix.Mix(df.repartition(4), block=8).taken().collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in out)


def test_mixed_documents(awkward):
    rows, df = awkward
    out = source_mix.mixed_documents(df, block=8)
    assert out.columns == df.columns
    taken = {r["doc_id"]: r["taken"] for r in source_mix.Mix(df, block=8).taken().collect()}
    whole = {i: plain.words(t) for i, t in pairs(rows)}
    got = Counter()
    for r in out.collect():
        mine = plain.words(r["text"])
        assert r["n_chars"] == len(r["text"]) and not Counter(mine) - Counter(whole[r["doc_id"]])
        got[r["doc_id"]] += len(mine)
    assert +Counter(taken) == got


def test_tiny_sources_meet_their_targets(spark):
    sizes = {"big": 60_000} | {f"s{i:02}": n for i, n in enumerate([1, 40, 100, 33, 64, 300] * 4)} | {"z0": 9000, "z1": 9000}
    rows = [(i, "w " * (n // 3 + (n % 3 > k)), s) for i, (s, n, k) in enumerate((s, n, k) for s, n in sizes.items() for k in range(3))]
    mix = source_mix.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken, wanted = Counter(), plain.targets(sizes, source_mix.WEIGHTS)
    for r in mix.taken().collect():
        taken[rows[r["doc_id"]][2]] += r["taken"]
    full = {s for s, n in sizes.items() if wanted[s] == 2 * n}
    assert len(full) >= 24 and {s: taken[s] for s in full} == {s: 2 * sizes[s] for s in full}
    assert all(abs(taken[s] - wanted[s]) < 64 for s in sizes)
    assert set(range(8)) == {r["shard"] for r in mix.plan.collect()}


def test_shard_counts_are_multinomial(spark):
    """400 sources of 800 draws over 8 shards: mean 100 and variance 800 x 1/8 x 7/8 in every shard."""
    import numpy as np

    draws = spark.range(400).select(F.col("id").cast("int").alias("no"), F.lit(800).cast("long").alias("total"))
    rows = source_mix.shard_counts(draws, 8, 5).collect()
    counts = np.zeros((400, 8))
    for r in rows:
        counts[r["no"], r["shard"]] = r["count"]
    assert (counts.sum(axis=1) == 800).all()
    assert abs(counts.mean(axis=0) - 100).max() < 4 * (87.5 / 400) ** 0.5
    assert abs(counts.var(axis=0) / 87.5 - 1).max() < 4 * (2 / 400) ** 0.5
    shared = np.corrcoef(counts.T)[np.triu_indices(8, 1)]
    assert abs(shared + 1 / 7).max() < 4 / 400**0.5  # what one shard has another lacks
    assert sorted(rows) == sorted(source_mix.shard_counts(draws.repartition(7), 8, 5).collect())
    other = source_mix.shard_counts(draws, 8, 6).collect()
    assert sorted(rows) != sorted(other)


def test_many_sources_are_shared_out_in_parts(spark):
    rng = random.Random(7)
    sizes = {f"s{i:04}": rng.choice([0, 1, 30, 500, 4000]) for i in range(2000)} | {None: 70, "": 9}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    shared = source_mix.stored(source_mix.source_targets(df.repartition(5)), "test-targets")
    wanted = plain.targets(sizes, source_mix.WEIGHTS)
    got = {r["source"]: r for r in shared.collect()}
    assert set(got) == set(sizes) and all(abs(got[s]["target"] - t) < 1e-6 * max(t, 1) for s, t in wanted.items())
    assert [got[s]["no"] for s in sorted(filter(None, sizes))] == list(range(1, 2001)) and (got[""]["no"], got[None]["no"]) == (0, 2001)
    # no window, and no array, holds all sources
    for out in (source_mix.source_targets(df), source_mix.shard_counts(source_mix.source_draws(shared, 32, 0), 8, 0)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan and all("_part" in line for line in plan.splitlines() if "Window [" in line)


def test_shares_when_nothing_or_one_source_has_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"]) for r in source_mix.Mix(df).taken().collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(1, "w " * 640, "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["target"], r["taken"]) for r in source_mix.Mix(one).taken().collect()} == {(1, 960.0, 960), (2, 0.0, 0)}


def labelled(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        n = rng.randrange(20, 60)
        text = [rng.choice(["river", "stone", "green", "walks", "often", "house", "under"]) + str(rng.randrange(40)) for _ in range(n)]
        kind = i % 5
        if kind == 1:
            text = ["BUY!!!"] * n
        if kind == 2:
            text[rng.randrange(n)] = rng.choice(["vile", "vileness", "nasty"])
        if kind == 3 and i % 2:
            text += ["nasty", "vile", "vile"] * 3
        docs.append((i, " ".join(text)))
        labels.append((i, int(kind != 1), int(kind == 2 or (kind == 3 and i % 2))))
    docs += [(1000, None), (1001, ""), (None, "some text")]
    labels += [(2000, 1, 0), (None, 1, 1), (3, None, None), (4, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("own")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rule_quality(spark):
    docs, labels = labelled(spark)
    model = rule_quality.fit_rules(docs, labels)
    assert model.rules and model == rule_quality.fit_rules(docs.repartition(3), labels.repartition(2))
    out = rule_quality.scored(docs, model)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows.values())
    held = [i for i in range(600) if crc32(str(i).encode()) % 3 == 1]
    assert {r["doc_id"] for r in out.filter(rule_quality.held_out()).collect()} & set(range(600)) == set(held)
    assert sum((rows[i]["score"] >= 0.5) == (i % 5 != 1) for i in held) > 0.97 * len(held)
    for r in docs.withColumn("s", rule_quality.text_statistics(F.col("text"))).collect():  # the rules, one by one
        values = [r["s"][name] for name in rule_quality.STATISTICS]
        total = model.intercept + sum(w for bounds, w in model.rules if all(low < values[k] <= high for k, low, high in bounds))
        assert abs(rows[r["doc_id"]]["score"] - 1 / (1 + 2.718281828459045 ** -total)) < 1e-9
    kept = rule_quality.accepted(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["score"] >= 0.5}


def test_a_repeated_doc_id_is_one_sample_row(spark):
    docs, labels = labelled(spark)
    often = docs.crossJoin(spark.range(50)).filter("doc_id = 0").select(F.lit(0).cast("long").alias("doc_id"), F.concat("text", F.lit(" "), F.col("id")).alias("text"))
    rows = rule_quality.labelled_sample(docs.select("doc_id", "text").unionAll(often), labels, "quality", sample=300).collect()
    assert 0 in (ids := {r["doc_id"] for r in rows}) and len(rows) == len(ids) <= 300
    empty = spark.createDataFrame([(0, None)] * 3, "doc_id long, text string")
    assert [tuple(r) for r in rule_quality.labelled_sample(empty, labels, "quality").collect()] == [(0, 1.0, None)]


def test_rule_weights_are_fitted_to_the_default_tolerance(spark, monkeypatch):
    asked = []
    lasso = rule_quality.LogisticRegression
    monkeypatch.setattr(rule_quality, "LogisticRegression", lambda **settings: asked.append(lasso(**settings)) or asked[0])
    rule_quality.fit_rules(*labelled(spark))
    assert (asked[0].getTol(), asked[0].getMaxIter()) == (1e-6, 100)


def test_rule_quality_without_two_classes(spark):
    docs, labels = labelled(spark)
    none = rule_quality.fit_rules(docs, labels.limit(0))
    good = rule_quality.fit_rules(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in rule_quality.scored(docs, none).collect()} == {0.5}
    assert min(r["score"] for r in rule_quality.scored(docs, good).collect()) > 0.99


def test_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_severity(docs, labels)
    assert len(model.thresholds) >= 2 and (model.thresholds[1:] >= model.thresholds[:-1]).all()
    rows = {r["doc_id"]: r for r in toxicity.graded(docs.withColumn("grade", F.lit(1)), model).collect()}
    toxic = {i for i in range(600) if i % 5 == 2 or (i % 5 == 3 and i % 2)}
    held = [i for i in range(600) if crc32(str(i).encode()) % 3 == 1]
    assert sum(rows[i]["toxic"] == (i in toxic) for i in held) > 0.97 * len(held)
    bad = [i for i in held if i in toxic]
    assert sum(rows[i]["toxic"] for i in bad) >= 0.9 * len(bad) > 0
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for r in docs.collect():  # P(severity > k) = logistic(weights - threshold k), text by text
        _, features, counts = toxicity.feature_counts([(r["text"] or "").encode()])
        eta = sum(weight.get(f, 0.0) * (1 + math.log(n)) for f, n in zip(features.tolist(), counts.tolist(), strict=True))
        above = [1 / (1 + math.exp(t - eta)) for t in model.thresholds.tolist()]
        assert abs(rows[r["doc_id"]]["severity"] - sum(above)) < 1e-9 and rows[r["doc_id"]]["toxic"] == (above[0] >= toxicity.TOXIC_FROM)
    mean = lambda ids: sum(rows[i]["severity"] for i in ids) / len(ids)
    mild, strong = [i for i in toxic if i % 5 == 2], [i for i in toxic if i % 5 == 3]
    assert mean(strong) > mean(mild) + 0.5 > mean(set(range(600)) - toxic) + 0.5
    assert not rows[1000]["toxic"] and not rows[1001]["toxic"] and rows[1000]["severity"] == rows[1001]["severity"]


def test_toxicity_without_two_classes(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_severity(docs, labels.filter("toxic = 0"))
    assert {(r["severity"], r["grade"], r["toxic"]) for r in toxicity.graded(docs, model).collect()} == {(0.0, 0, False)}


def test_cumulative_link_recovers_its_own_model():
    import numpy as np

    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 4))
    weights, cuts = np.array([1.5, -1.0, 0.0, 0.5]), np.array([-0.5, 0.8, 2.0])
    u = rng.random(6000)
    grade = (u[:, None] > 1 / (1 + np.exp(x @ weights - cuts[:, None]).T)).sum(axis=1)
    of, column = np.nonzero(x)
    found, thresholds = toxicity.fit_cumulative_link(toxicity.Sparse(of, column, x[of, column], x.shape), grade, penalty=1e-4)
    assert np.abs(found - weights).max() < 0.15 and np.abs(thresholds - cuts).max() < 0.15


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    quality = rule_quality.fit_rules(empty, labels)
    for df in (
        substring_dedup.remove_repeats(empty), line_dedup.remove_repeated_lines(empty), source_mix.Mix(empty).taken(),
        source_mix.mixed_documents(empty), decontaminate.contamination(empty, benchmark), fingerprints.fingerprint_edits(empty),
        near_dedup.NearDuplicates(empty).classes(), near_dedup.deduplicated(empty), sharding.shard_rows(empty, ["doc_id"], 4),
        rule_quality.scored(empty, quality), rule_quality.accepted(empty, labels), toxicity.graded(empty, toxicity.fit_severity(empty, labels)),
        url_filter.filter_urls(pages, RULES),
    ):
        assert df.count() == 0
