"""BPE, token tables and packing."""

import base64
import glob

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import bpe, packing, store, token_table

RANKS = bpe.load_ranks()
QUEUE = bpe.queue_encoder()
SCHEMA = "doc_id BIGINT, text STRING, tokens STRING, n_tokens STRING"


def _library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})


LIBRARY = _library()
DECODER = bpe.Decoder()


def _encode(texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    tokens, first = QUEUE(np.frombuffer(b"".join(raw), np.uint8), off)
    return [tokens[a:b].tolist() for a, b in zip(first, first[1:])]


def slow_merge(piece, ranks):
    """Again and again the leftmost pair of least rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_queue_equals_repeated_search(piece):
    assert bpe.merge_piece(piece, RANKS) == ([RANKS[piece]] if piece in RANKS else slow_merge(piece, RANKS))


def test_stale_entries_of_equal_pairs():
    for piece in (b"aaaaaaaaaaa", b"abababababab", b"  " * 20, b"-" * 333):
        assert bpe.merge_piece(piece, RANKS) == ([RANKS[piece]] if piece in RANKS else slow_merge(piece, RANKS))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t' 　sdlervtm09.,!é漢٣²"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_tokens_and_text_round_trip(texts):
    got = _encode(texts)
    assert got == [LIBRARY.encode_ordinary(t) for t in texts]
    flat = np.array([x for g in got for x in g], np.int64)
    assert DECODER(flat, np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int64)) == texts


def test_rows_of_any_kind(spark):
    long = "wort und mehr " * 40_000
    rows = [(1, "It's  a test.", "old", "old"), (2, "", "", ""), (3, None, None, None), (None, "x", None, None), (1, "It's  a test.", "old", "old"), (4, long, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = bpe.with_tokens(df, count_col="n_tokens")
    assert got.columns == ["doc_id", "text", "n_tokens", "tokens"]
    back = bpe.with_text(got).collect()
    assert len(back) == 6 and all(r["decoded"] == r["text"] for r in back)
    assert {r["n_tokens"] for r in back if r["text"] is None} == {None}
    assert all(r["n_tokens"] == len(r["tokens"]) for r in back if r["text"] is not None)
    assert bpe.with_text(bpe.with_tokens(df.limit(0))).count() == 0


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError):
        bpe.Decoder()(np.array([60_000]), np.array([0, 1]))


def test_other_vocabulary(tmp_path, spark):
    path = tmp_path / "tiny.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)) + base64.b64encode(b"ab") + b" 256\n")
    got = bpe.with_tokens(spark.createDataFrame([(1, "abba")], "i INT, text STRING"), path=str(path)).first()
    assert got["tokens"] == [256, 98, 97]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_table(spark, encoding):
    rows = [(5, "en", 3, [1, 2, 3]), (None, None, None, None), (2, "fr", 0, []), (5, "en", 3, [1, 2, 3]), (9, "en", 5000, [(i * i) % 97 + 40_000 for i in range(5000)])]
    df = spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, n_tokens INT, tokens ARRAY<INT>").coalesce(1)
    token_table.write_tokens(df, path := store.new_path(spark, "t"), encoding=encoding)
    back = [tuple(r) for r in token_table.read_tokens(spark, path).collect()]
    assert sorted(back, key=str) == sorted(rows, key=str)
    (file,) = glob.glob(path.removeprefix("file://") + "/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    by_name = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    used = by_name["tokens.list.element"].encodings
    assert ("RLE_DICTIONARY" in used) == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
    assert by_name["doc_id"].has_offset_index and by_name["doc_id"].has_column_index


def test_selective_read(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(2).alias("n_tokens"), F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.pmod(F.hash("id", i), F.lit(50_000))).alias("tokens"))
    token_table.write_tokens(df.repartition(2), path := store.new_path(spark, "t"), row_group=1 << 16, page=1 << 12, page_rows=200)
    got = token_table.read_tokens(spark, path, ["doc_id", "tokens"], F.col("doc_id").between(500, 502))
    assert sorted(r["doc_id"] for r in got.collect()) == [500, 501, 502]
    plan = got._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,500)" in plan and "n_tokens" not in plan.split("ReadSchema")[1]
    for file in glob.glob(path.removeprefix("file://") + "/*.parquet"):
        assert pq.ParquetFile(file).metadata.num_row_groups > 1
    token_table.write_tokens(df.limit(0), path := store.new_path(spark, "t"))
    assert token_table.read_tokens(spark, path).count() == 0


def _valid(sizes, packed, capacity):
    """Every token in one segment; no sequence too full; segments of a sequence follow each other."""
    spans, packs = {}, {}
    for r in packed:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        packs.setdefault(r["pack_id"], []).append((r["slot"], r["offset"], r["length"]))
    for parts in packs.values():
        at = 0
        for slot, (k, offset, length) in enumerate(sorted(parts)):
            assert (k, offset) == (slot, at) and length > 0
            at += length
        assert at <= capacity
    for i, n in sizes.items():
        at = 0
        for start, length in sorted(spans.pop(i, [])):
            assert start == at
            at += length
        assert at == n
    assert not spans
    return len(packs)


@pytest.mark.parametrize("shard", [200_000, 300])
def test_packing(spark, shard):
    rng = np.random.default_rng(1)
    sizes = {i: int(n) for i, n in enumerate(np.concatenate([rng.integers(1, 400, 900), rng.integers(1500, 7000, 100), [2048, 4096, 1]]))}
    df = spark.createDataFrame(list(sizes.items()), "doc_id BIGINT, n_tokens INT")
    got = packing.pack(df, shard_rows=shard).collect()
    packs = _valid(sizes, got, packing.CAPACITY)
    assert packs <= 1.03 * np.ceil(sum(sizes.values()) / packing.CAPACITY) + 8
    assert sorted(map(tuple, got)) == sorted(map(tuple, packing.pack(df.repartition(7), shard_rows=shard).collect()))


def test_packing_of_odd_rows(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (2, 0, "b"), (3, None, "c"), (None, 7, "d"), (4, -3, "e"), (1 << 60 | 1, 5, "f")], "doc_id BIGINT, n_tokens INT, pack_id STRING")
    got = packing.pack(df).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in got) == [(0, 7), (1, 5), (1, 5), (1 << 60 | 1, 5)]
    assert len({r["pack_id"] for r in got}) == 1
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, width=33)


def unpacked(sequences, capacity):
    """The tokens of each document, in segments, and how many sequences there are."""
    parts = {}
    for r in sequences:
        assert 0 < len(r["tokens"]) <= capacity and len(r["doc_ids"]) == len(r["starts"]) == len(r["lengths"]) and sum(r["lengths"]) == len(r["tokens"])
        at = 0
        for i, start, n in zip(r["doc_ids"], r["starts"], r["lengths"]):
            parts.setdefault(i, []).append((start, r["tokens"][at : at + n]))
            at += n
    return parts


@pytest.mark.parametrize("shard_tokens", [2 << 20, 5000])
def test_sequences_hold_every_token(spark, shard_tokens):
    rng = np.random.default_rng(2)
    docs = {i: rng.integers(0, 50_000, int(n)).tolist() for i, n in enumerate(np.concatenate([rng.integers(1, 300, 120), [2048, 4096, 5000, 1]]))}
    df = spark.createDataFrame(list(docs.items()), "doc_id BIGINT, tokens ARRAY<INT>")
    got = packing.sequences(df, shard_tokens=shard_tokens).collect()
    assert len({r["pack_id"] for r in got}) == len(got)
    for i, parts in unpacked(got, packing.CAPACITY).items():
        assert [t for _, p in sorted(parts) for t in p] == docs.pop(i)
        assert [s for s, _ in sorted(parts)] == np.cumsum([0, *[len(p) for _, p in sorted(parts)][:-1]]).tolist()
    assert not docs
    assert sorted(map(str, got)) == sorted(map(str, packing.sequences(df.repartition(5), shard_tokens=shard_tokens).collect()))


def test_sequences_of_odd_rows(spark):
    rows = [(1, [1, 2], "a"), (1, [1, 2], "a"), (1, [3], "b"), (2, [], "c"), (3, None, "d"), (None, [9], "e"), (4, list(range(9000)), "f")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, tokens ARRAY<INT>, pack_id STRING").withColumn("n", F.lit("x")).withColumn("id", F.lit(1)).withColumn("h", F.lit(2))
    parts = unpacked(packing.sequences(df).collect(), packing.CAPACITY)
    assert sorted(parts[1]) == [(0, [1, 2]), (0, [1, 2]), (0, [3])] and parts[None] == [(0, [9])] and set(parts) == {1, None, 4}
    assert [t for _, p in sorted(parts[4]) for t in p] == list(range(9000))
    assert packing.sequences(df.limit(0)).count() == 0


def test_least_squares():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 8)), rng.random(12)
        x = packing.nnls(a, b)
        w = a.T @ (b - a @ x)
        assert (x >= 0).all() and (w <= 1e-8).all() and np.abs(w[x > 0]).max(initial=0) < 1e-8  # the optimum's conditions


def test_patterns():
    found = {tuple(p) for p in packing.patterns(6, 3).tolist()}
    assert found == {(0, 0, 0, 0, 0, 1), (1, 0, 0, 0, 1, 0), (0, 1, 0, 1, 0, 0), (0, 0, 2, 0, 0, 0), (2, 0, 0, 1, 0, 0), (1, 1, 1, 0, 0, 0), (0, 3, 0, 0, 0, 0)}


def test_sequences_are_put_together_in_parts(spark, monkeypatch):
    """A worker gives out a shard's sequences some at a time; they are the same however many."""
    rows = [(i % 40, list(range(i, i + 1 + i * 37 % 700))) for i in range(300)] + [(None, list(range(5000))), (7, []), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, tokens ARRAY<INT>")
    whole = {r["pack_id"]: tuple(r) for r in packing.sequences(docs).collect()}
    monkeypatch.setattr(packing, "_TOKENS", 4096)
    table = packing.sequences(docs)
    assert {r["pack_id"]: tuple(r) for r in table.collect()} == whole
    assert sum(len(r[4]) for r in whole.values()) == sum(len(t or []) for _, t in rows)


ODD = ["one two  three's 12,5\n\n x", "", None, "a\0b \0 c", "\0", "é日本 naïve", "x" * 3000, "the the the " * 2000]


def test_library_gets_the_pieces_of_a_block_together(monkeypatch):
    """A call for every new piece was most of what encoding cost; pieces with a null character still go one by one."""
    import tiktoken

    calls, whole = [], tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: calls.append(text) or whole(self, text))
    texts = [" ".join(f"w{i * 7919 % 10007}x" for i in range(500)), "ab 'll  cd"]
    for some in (texts, [t for t in ODD if t], texts):
        encode = bpe.library_encoder()
        calls.clear()
        buf = np.frombuffer("".join(some).encode(), np.uint8)
        tokens, first = encode(buf, np.cumsum([0, *[len(t.encode()) for t in some]]))
        assert some is not texts or len(calls) == 1
        assert [tokens[a:b].tolist() for a, b in zip(first, first[1:])] == [whole(LIBRARY, t) for t in some]


def test_sequences_of_bytes_hold_every_token(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD * 3)] + [(None, "no id")], "doc_id BIGINT, text STRING")
    tokens = bpe.with_tokens(df, kind="library", binary=True)
    assert dict(tokens.dtypes)["tokens"] == "binary"
    for r in tokens.collect():
        assert (r["tokens"] is None) if r["text"] is None else np.frombuffer(r["tokens"], "<i4").tolist() == LIBRARY.encode_ordinary(r["text"])
    got = packing.sequences(tokens)
    assert got.schema == packing.sequences(bpe.with_tokens(df, kind="library")).schema
    parts = unpacked(got.collect(), packing.CAPACITY)
    assert {i: [t for _, p in sorted(q) for t in p] for i, q in parts.items()} == {r["doc_id"]: LIBRARY.encode_ordinary(r["text"]) for r in df.collect() if r["text"]}
    assert packing.sequences(tokens.limit(0)).count() == 0
    assert packing.sequences(tokens, shard_tokens=500).agg(F.sum(F.size("tokens"))).first()[0] == sum(len(LIBRARY.encode_ordinary(r["text"])) for r in df.collect() if r["text"])
