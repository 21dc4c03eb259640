"""The contract queries over the given small tables: against SQL, or a plain version."""

import os
from collections import Counter, defaultdict
from zlib import crc32

import plain
import pytest
from check_oracle import compare, connect
from test_whitening import check

import __spark_entry__ as contract
import corpus_pipeline
from salescompass.llm.oracle import ORACLE
from salescompass.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def given(duck):
    return duck.execute("select doc_id, text, source from documents order by doc_id").fetchall()


@pytest.fixture(scope="module")
def out(spark):
    done = {}

    def rows(name):
        if name not in done:
            done[name] = QUERIES[name](spark, SF_DIR).collect()
        return done[name]

    return rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


def test_all_and_the_pipeline_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_whitening(out, duck):
    vectors = [v for (v,) in duck.execute("select embedding from embeddings order by vec_id").fetchall()]
    ids = {i: n for n, (i,) in enumerate(duck.execute("select vec_id from embeddings order by vec_id").fetchall())}
    check([r.asDict() | {"vec_id": ids[r["vec_id"]]} for r in out("op11_embedding_whitening")], vectors, 4)


def test_token_files(out, given):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, wanted = 0, []
    for doc_id, text, _ in given:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.append((doc_id, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out("op12_token_files")) == wanted


def test_mix(out, given):
    sizes, taken, count = defaultdict(int), defaultdict(int), {}
    source = {i: s for i, _, s in given}
    for i, t, s in given:
        count[i] = len(plain.words(t))
        sizes[s] += count[i]
    wanted = plain.targets(sizes, (3, 1, 2))
    for r in out("op2_source_mix"):
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (count[r["doc_id"]], sizes[s]) and abs(r["target"] - wanted[s]) < 1e-6
        assert r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(out("op2_source_mix")) == len(given)
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= 0.04 * t + 64


def test_fingerprints(out, given):
    rows = out("op5_fingerprints")
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == plain.fingerprint_rows([d[:2] for d in given])
    nearer = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert nearer > 0.9 * len(rows)
    text = {i: t for i, t, _ in given}
    assert len({r["fingerprint"] for r in rows}) <= len(set(text.values()))
    assert len({(text[r["doc_id"]], r["fingerprint"]) for r in rows}) == len(set(text.values()))


def test_sharding(out, given):
    rows = out("op7_sharding")
    text = {i: t for i, t, _ in given}
    slots = defaultdict(list)
    for r in rows:
        data = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, crc32(data), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(40)) and len(rows) == len(given)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_classifiers_on_held_out_rows(out, duck):
    labels = {i: (q, t) for i, q, t in duck.execute("select doc_id, quality, toxic from labels").fetchall()}
    quality = [r for r in out("op8_rule_quality") if r["doc_id"] in labels and r["held_out"]]
    assert sum(r["predicted"] == labels[r["doc_id"]][0] for r in quality) >= 0.9 * len(quality)
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out("op8_rule_quality"))
    toxic = [r for r in out("op10_toxicity") if r["doc_id"] in labels]
    assert sum(r["toxic"] for r in toxic if not labels[r["doc_id"]][1]) <= 0.05 * len(toxic)


def test_near_duplicates(out, given):
    classes = plain.near_classes([t for _, t, _ in given])
    expected = {given[i][0]: given[c][0] for i, c in enumerate(classes)}  # in order of ids: the first is the smallest
    assert {r["doc_id"]: r["class_id"] for r in out("op9_near_dedup")} == expected


def test_pipeline_stage_by_stage(spark, duck):
    """Each stage, on what its predecessor kept, does what a plain version does."""
    from salescompass.llm import rule_quality
    from salescompass.llm.storage import stored

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF_DIR), f"test-{name}"))
    assert all(t.columns == docs.columns for t in tables[:-1])
    read = lambda t: sorted((r["doc_id"], r["text"]) for r in t.collect())
    given, good, single, clean, mixed, placed = map(read, tables)

    model = rule_quality.fit_rules(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert good == read(rule_quality.scored(docs, model).filter("score >= 0.5")) and 0 < len(good) < len(given)
    classes = plain.near_classes([t for _, t in good])
    assert single == [d for i, d in enumerate(good) if classes[i] == i]
    items = duck.execute("select item_id, text from benchmark").fetchall()
    hit = {r[0] for r in plain.contamination(single, items) if r[-1]}
    assert clean == [d for d in single if d[0] not in hit] and hit
    taken = Counter()
    whole = {i: Counter(plain.words(t)) for i, t in clean}
    for i, t in mixed:
        assert not Counter(plain.words(t)) - whole[i]
        taken[i] += len(plain.words(t))
    assert all(n <= 2 * sum(whole[i].values()) for i, n in taken.items())
    assert abs(sum(taken.values()) / (1.5 * sum(sum(w.values()) for w in whole.values())) - 1) < 0.05
    assert placed == mixed
    slots = defaultdict(list)
    for r in tables[-1].collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(slots) == 40


def test_pipeline_run(spark):
    out = contract.queries()["pipeline"](spark, SF_DIR)
    assert out.count() > 0 and {"shard", "slot"} <= set(out.columns)


def test_the_rest_works_without_this_part(tmp_path):
    """The entry module imports and lists its other queries when this part is not installed."""
    import subprocess
    import sys

    root = contract.__file__.rpartition("/")[0]
    code = (
        "import sys\n"
        "class Missing:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'salescompass.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Missing())\n"
        f"sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and 'pipeline' not in e.queries()\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0


