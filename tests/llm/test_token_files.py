"""Token files: ids as the library gives them, exact round trips, access to single documents."""

import hashlib
import random
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs as pafs
from tables import awkward, empty  # noqa: F401  fixtures
from tokenizers import Tokenizer

from salescompass.llm import token_files

BYTE_BPE = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
WORD_BPE = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
ENCODER, LIBRARY = token_files.Encoder(BYTE_BPE), Tokenizer.from_str(BYTE_BPE)


def plain(rows, definition=BYTE_BPE):
    """doc_id, start, ids in order of ids; ties in any order are not for comparing starts."""
    tokenizer = Tokenizer.from_str(definition)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0  　abzÄßé'sd.,!0²½_-\x00😀日")) | st.text() | st.sampled_from(["<|endoftext|>", "don't", "  "]), max_size=8))
def test_ids_are_those_of_whole_texts(parts):
    text = "".join(parts)
    assert ENCODER([text, "", text + " a"])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_code_point_next_to_blanks_and_letters():
    texts = [f"a{c}b! {c}! {c}{c} x{c}  {c}\n{c}y'{c}s 1{c}2 {c}" for c in map(chr, [*range(0x3100), 0xFEFF, 0x1F600, 0x10FFFF])]
    assert [x.tolist() for x in ENCODER(texts)] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_forgotten_chunks_are_learnt_again(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_CHARS", 10)
    encode = token_files.Encoder(BYTE_BPE)
    for text in ["one two three four", "one two three four", "", "five one"]:
        assert encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert encode([]) == []


@pytest.mark.parametrize(("definition", "file_bytes"), [(BYTE_BPE, 16_000_000), (BYTE_BPE, 300), (WORD_BPE, 1000)])
def test_round_trip(awkward, definition, file_bytes):  # noqa: F811
    rows, df = awkward
    files = token_files.write_token_files(df, definition, file_bytes=file_bytes)
    got = sorted(files.documents(with_ids=True).collect(), key=lambda r: r["start"])
    wanted = plain([r[:2] for r in rows], definition)
    key = lambda i: (i is not None, i or 0)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=lambda r: (key(r[0]), r[1])) == sorted(wanted, key=lambda r: (key(r[0]), r[1]))
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in wanted), key=key)
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(r["ids"]), crc(r["ids"]))
        start += len(r["ids"])
    if file_bytes == 300:
        assert files.manifest.count() > 4 and files.manifest.agg({"seq": "max"}).first()[0] > 0


def test_one_document_is_read_alone(spark, monkeypatch):
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(40))) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    files = token_files.write_token_files(df, BYTE_BPE)
    store, _ = pafs.FileSystem.from_uri(files.folder)
    found = {}
    for path in [r["path"] for r in files.manifest.collect()]:
        file = token_files.TokenFile(store, path, files.dictionary)
        places = {int(i): p for i in file.index["doc_id"] for p in file.find(int(i))}
        found |= {i: file[p].tolist() for i, p in places.items()}
        assert len(file.find(10_000)) == 0 and len(file) == len(places)
        with pytest.raises(ValueError, match="no token file of this dictionary"):
            token_files.TokenFile(store, path, b"another")
    assert found == {i: ids for i, ids in plain(texts.items())}


def test_the_dictionary_helps_short_documents(spark):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in "bdfg" for b in "aeio" for c in ("lor", "mip", "nat", "sun")]
    df = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary) for _ in range(25)) + " and so on to the end of it all.") for i in range(3000)], "doc_id long, text string")
    files = token_files.write_token_files(df, BYTE_BPE)
    assert files.dictionary and Path(files.folder.removeprefix("file://"), hashlib.sha256(files.dictionary).hexdigest() + ".dict").read_bytes() == files.dictionary
    monkey = token_files.train_dictionary
    try:
        token_files.train_dictionary = lambda *a, **k: (b"", 0.0)
        without = token_files.write_token_files(df, BYTE_BPE)
    finally:
        token_files.train_dictionary = monkey
    total = lambda f: f.manifest.agg({"n_bytes": "sum"}).first()[0]
    assert total(files) < 0.9 * total(without)
    assert sorted(files.documents().collect()) == sorted(without.documents().collect())


def test_what_a_lost_attempt_left_is_not_read(spark):
    df = spark.createDataFrame([(1, "one"), (2, None), (2, None), (3, "")], "doc_id long, text string")
    files = token_files.write_token_files(df, BYTE_BPE)
    Path(files.folder.removeprefix("file://"), "000000-00000-lost.ids").write_bytes(b"TIDS half a file")
    got = sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in files.documents().collect())
    assert got == [(1, 0, 2), (2, 2, 1), (2, 3, 1), (3, 4, 1)]


def test_hot_rows_are_spread(spark):
    rows = [(5, "the same text")] * 4000 + [(i, f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = token_files.write_token_files(df, BYTE_BPE, part_bytes=20_000)
    docs = [r["n_docs"] for r in files.manifest.collect()]
    assert len(docs) >= 4 and max(docs) <= 3 * sorted(docs)[len(docs) // 2] and files.documents().count() == 8000


def test_empty_table(spark, empty):  # noqa: F811
    files = token_files.write_token_files(empty, BYTE_BPE)
    assert files.documents(with_ids=True).collect() == [] and files.dictionary == b""
