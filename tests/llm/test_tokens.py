"""Byte-level BPE ids, packing and token files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm.bytebpe import ByteBpe
from rollcall.llm.packing import OpenBins, added_tokens, best_fit, pack_documents, with_added
from rollcall.llm.token_files import read_blocks, scan_blocks, write_token_files

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, sequence_id string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_librarys(library):
    rnd = random.Random(1)
    letters = list("  \n\t\r'''stremdvl'aéßñ日本123½²!!..__  \x1c\x85Ⅷ😀")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += ["", "a" * 9000 + "b" * 5000, "'s", "x's", "x'", " 's", "'ll", "\n's", "we're they'll I'd"]
    encoder = ByteBpe(RANKS, PATTERN, most=500)
    for _ in range(2):
        ids, ends = encoder.encode(texts)
        parts = np.split(ids, ends[:-1])
        assert [p.tolist() for p in parts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_one_id(library):
    rnd, end = random.Random(2), "<|endoftext|>"
    texts = ["".join(rnd.choice([end, end, " ", "a", " b'", "\n", "<|end"]) for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    texts += [end, f"{end} a", f"a{end}", f" {end} {end}", end * 3, ""]
    added, encoder = added_tokens(public_tokenizers.path("byte_bpe_50k.json")), ByteBpe(RANKS, PATTERN)
    assert added == {end: 50256}
    ids, ends = with_added(encoder.encode, texts, added)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, ends[:-1])] == want
    assert with_added(encoder.encode, texts, added)[0].tolist() == sum(want, [])


def test_few_open_bins_are_enough(spark):
    rnd = random.Random(4)
    data = [(i, 0, rnd.choice([rnd.randint(1, 2047), rnd.randint(1, 300)]), i * 7919 % 10007) for i in range(9000)]
    frame = spark.createDataFrame(data, "doc_id long, piece int, length long, _deal long")
    rows = best_fit(frame, group_rows=10**6).collect()
    least = -(-sum(d[2] for d in data) // 2048)
    assert len({r.sequence_id for r in rows}) <= 1.01 * least and len(rows) == len(data)


def rows(n=60):
    rnd = random.Random(5)
    words = "pack these words into bins until full".split()
    made = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 200, 1500, 5000]))), "x") for i in range(n)]
    return [*made, (None, "no id", "x"), (7, None, "x"), made[3], made[3], (8, "", "x")]


def test_packing_is_whole_and_gapless(spark, library):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    got = pack_documents(docs, RANKS, PATTERN, capacity=256, group_rows=40).collect()
    want = []
    for doc_id, text, _ in data:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 256 + 1
        edges = [0, *range(first, len(ids) + 1, 256)]
        for i, (x, y) in enumerate(zip(edges, edges[1:])):
            want.append((doc_id, i, x, y - x, zlib.crc32(np.array(ids[x:y], "<u4").tobytes())))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r["offset"], r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(w[3] for w in want) // 256) * 1.1 + 2


def test_packing_is_repeatable_and_empty_frames_stay_empty(spark):
    docs = spark.createDataFrame(rows(20), SCHEMA)
    read = lambda: sorted(map(str, pack_documents(docs, RANKS, PATTERN).collect()))
    assert read() == read()
    assert pack_documents(docs.where("false"), RANKS, PATTERN).count() == 0
    sized = spark.createDataFrame([(1, 0, 5, 1, "x")], "doc_id long, piece int, length long, _deal long, note string")
    assert best_fit(sized).columns == ["doc_id", "piece", "length", "note", "sequence_id", "offset"]


def test_fullest_bin_closes_first():
    bins = OpenBins(10, 2)
    assert [bins.place(s) for s in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # bin 1, with 7, closes
    assert bins.place(3) == (0, 6)
    assert bins.place(2) == (2, 8)


@pytest.mark.parametrize("block_tokens", [1, 3, 64, 1 << 20])
def test_token_files(spark, tmp_path, library, block_tokens):
    data = rows(12)
    path = str(tmp_path / "tokens")
    write_token_files(spark.createDataFrame(data, SCHEMA).coalesce(1), path, RANKS, PATTERN)
    got = sorted(scan_blocks(read_blocks(spark, path, block_tokens), span=2).collect(), key=lambda r: r.doc_no)
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in data]
    starts = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])[:-1]
    assert [(r.doc_no, r.start, r.n_tokens, r.closed) for r in got] == [
        (i, s, n, True) for i, (s, n) in enumerate(zip(starts.tolist(), sizes))
    ]


def test_ranges_of_a_long_file(spark, tmp_path):
    """A file above 2 GB, with holes, in a folder with odd characters; empty files have no documents."""
    folder = tmp_path / "odd %20 name"
    folder.mkdir()
    (folder / "part-00001").touch()
    places = [5, (1 << 30) + 7, (1 << 30) + (1 << 27)]
    with open(folder / "part-00000", "wb") as f:
        for place in places:
            f.seek(2 * place)
            f.write((9).to_bytes(2, "little"))
        f.write(bytes(6))
    got = scan_blocks(read_blocks(spark, str(folder), 1 << 24), end_id=9).collect()
    assert sorted((r.doc_no, r.start, r.n_tokens, r.closed) for r in got) == [
        (0, 0, 5, True), (1, 6, places[1] - 6, True), (2, places[1] + 1, places[2] - places[1] - 1, True),
        (3, places[2] + 1, 3, False),
    ]


def test_open_documents_null_blocks_and_no_blocks(spark):
    pack = lambda *ids: np.array(ids, "<u2").tobytes()
    data = [
        ("a", 0, pack(1, 2), 1), ("a", 1, pack(9, 3), 1), ("a", 2, None, 1), ("a", 3, pack(9, 9, 4), 1),
        ("b", 0, pack(5), 1), ("c", 0, pack(9), 1),
    ]
    blocks = spark.createDataFrame(data, "file string, block long, data binary, start int")
    got = scan_blocks(blocks, end_id=9, span=2).collect()
    assert sorted((r.file, r.doc_no, r.start, r.n_tokens, r.closed) for r in got) == [
        ("a", 0, 0, 2, True), ("a", 1, 3, 1, True), ("a", 2, 5, 0, True), ("a", 3, 6, 1, False),
        ("b", 0, 0, 1, False), ("c", 0, 0, 0, True),
    ]
    assert scan_blocks(blocks.where("false")).count() == 0
