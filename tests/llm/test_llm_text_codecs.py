"""Byte-level BPE and packing against the libraries and an exact round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relaydesk.llm import byte_bpe, packing, residual_packing, word_ids

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = [chr(c) for c in [*range(0, 0x180), 0x2028, 0x3000, 0x180E, 0x200B, 0x661, 0x4E2D, 0x1F600, 0x301, 0x3A3, 0x130, 0xFEFF]]
PIECES = ["the", "In", "ing", " ", "  ", "\n", "a", "é", "!!", "'s", "ll", "ed", "<|endoftext|>", "́", "x"]


def random_texts(n):
    draw = random.Random(5)
    for i in range(n):
        yield "".join(draw.choice(LETTERS if i % 2 else PIECES) for _ in range(draw.randint(0, 40)))


TEXTS = [None, "", " ", "word", "ab" * 3000, " " * 500, "word", *random_texts(300)]


@pytest.fixture(scope="module")
def library():
    tokens = byte_bpe.read_ranks(RANKS)
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_that_of_the_library_and_decodes_to_the_text(spark, library):
    codec = byte_bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    # columns of other meaning but clashing names
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_tokens string")
    ids = docs.select("doc_id", "text", codec.encode(F.col("text")).alias("ids"))
    rows = ids.withColumn("n", codec.count(F.col("ids"))).withColumn("back", codec.decode(F.col("ids"))).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        expected = library.encode_ordinary(row.text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == expected
        assert row.n == len(expected)
        assert bytes(row.back) == (row.text or "").encode()


def test_round_trip_encodes_once(spark, library):
    codec = byte_bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    texts = [*TEXTS, "x" * (byte_bpe.REMEMBERED_LENGTH + 1)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    made = docs.select("text", codec.round_trip(F.col("text")).alias("made"))
    made = made.select("text", "made.ids", "made.content", codec.count(F.col("made.ids")).alias("n"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == plan.count("there_and_back(text") == 1
    for row in made.collect():
        expected = library.encode_ordinary(row.text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == expected and row.n == len(expected)
        assert bytes(row.content) == (row.text or "").encode()


def test_no_rows_no_ids(spark):
    codec = byte_bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    empty = spark.createDataFrame([], "text string")
    assert empty.select(codec.encode(F.col("text")).alias("ids")).count() == 0
    assert spark.range(1).select(codec.decode(F.lit(None).cast("binary")).alias("x")).first().x == b""


def test_ranks_must_have_no_gaps(tmp_path):
    (tmp_path / "bad").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "bad"))


def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_words_encode_as_the_whole_text():
    words, whole = word_ids.WordTokenizer(definition()), Tokenizer.from_str(definition())
    whole.encode_special_tokens = True
    for text in TEXTS[1:]:
        for _ in range(2):  # the second time from memory
            ids = np.frombuffer(words.encode(text), "<u4").tolist()
            assert ids == whole.encode(text, add_special_tokens=False).ids, repr(text)


ADDED = ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "it's<|endoftext|><|startoftext|>  É\n"]


def test_added_tokens_are_those_of_the_library():
    words, whole = word_ids.WordTokenizer(definition(), added=True), Tokenizer.from_str(definition())
    for text in [*ADDED, *TEXTS[1:]]:
        ids = np.frombuffer(words.encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, repr(text)
    assert np.frombuffer(words.encode(ADDED[0]), "<u4").tolist() == [320, 49407, 321]
    assert np.frombuffer(words.encode(ADDED[1]), "<u4").tolist() == [343, 49406, 344]


def test_query_gives_the_ids_of_added_tokens(spark, tmp_path):
    from relaydesk.llm import queries

    whole = Tokenizer.from_str(definition())
    spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in queries.op6_packing(spark, str(tmp_path)).collect() if r.length == r.doc_tokens}
    assert out
    for key, row in out.items():
        ids = [*whole.encode(ADDED[key], add_special_tokens=False).ids, 1]
        assert (row.doc_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_choice_is_the_closest_fill():
    draw = random.Random(3)
    for _ in range(200):
        counts = {draw.randint(1, 30): draw.randint(1, 4) for _ in range(draw.randint(1, 5))}
        target = draw.randint(0, 80)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        picked = packing.choose(counts, target)
        assert all(0 < n <= counts[length] for length, n in picked.items())
        assert sum(length * n for length, n in picked.items()) == max(s for s in sums if s <= target)


@pytest.mark.parametrize("window", [4, 64])
def test_every_id_lies_in_one_piece_and_nothing_is_padded(spark, window):
    whole = Tokenizer.from_str(definition())
    whole.encode_special_tokens = True
    texts = [*TEXTS, *("some words and more " * n for n in (3, 40, 700))]
    rows = [(i // 2, t, 7) for i, t in enumerate(texts)]  # every id twice, as rows of their own
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    out = packing.pack(docs, definition(), capacity=256, window=window).toPandas()
    sequences = out.groupby("sequence_id")
    for _, pieces in sequences:
        pieces = pieces.sort_values("offset")
        assert (pieces.offset.to_numpy() == np.cumsum([0, *pieces.length[:-1]])).all()
    sizes = sequences.length.sum()
    assert all(n == 256 or n & (n - 1) == 0 for n in sizes) and sizes.max() == 256
    expected = {}
    for key, text, _ in rows:
        expected.setdefault(key, []).append([*whole.encode(text or "", add_special_tokens=False).ids, 1])
    assert sum(map(sum, [[len(x) for x in v] for v in expected.values()])) == out.length.sum()
    for key, own in out.groupby("doc_id"):
        by_size = {len(x): x for x in expected[key]}
        for _, piece in own.iterrows():
            ids = np.frombuffer(piece.ids, "<u4").tolist()
            candidates = [x for x in expected[key] if len(x) == piece.doc_tokens]
            assert any(x[piece.start : piece.start + piece.length] == ids for x in candidates) and by_size


def test_packing_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, definition()).count() == 0
    row = packing.pack(spark.createDataFrame([(None, None)], "doc_id long, text string"), definition()).first()
    assert (row.doc_id, row.start, row.length, row.doc_tokens, row.offset) == (None, 0, 1, 1, 0)
    assert zlib.crc32(bytes(row.ids)) == zlib.crc32((1).to_bytes(4, "little"))
    with pytest.raises(ValueError):
        packing.pack(empty, definition(), capacity=1000)


def test_digests_of_the_query(spark, library):
    from relaydesk.llm import queries

    out = queries.op5_byte_bpe(spark, "/root/testdata/sf0.001").toPandas().set_index("doc_id")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    for key, text in zip(texts.doc_id, texts.text):
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert out.n_tokens[key] == len(ids)
        assert out.ids_sha256[key] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert out.decoded_sha256[key] == hashlib.sha256(text.encode()).hexdigest()


def test_batches_have_the_ids_of_the_library():
    library, draw = Tokenizer.from_str(definition()), random.Random(9)
    odd = ["'s", "'LL", "''ve", "'", "Σς", "ß", "İ", "中文", "e\u0301", "\u00a0", "\u200b", "\x1c", "\x85", "<|endoftext|>", "²", "Ⅷ"]
    letters = [*"aabesTrv.,12 \t\n", *odd]
    texts = [None, "", " ", "x" * 500, *TEXTS, *("".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(2000))]
    words = word_ids.WordIds(definition())
    for start, n in word_ids.slices(pa.array(texts, pa.string()), at_most=20_000):
        ids, bounds = words.encode(pa.array(texts[start : start + n], pa.string()))
        for text, a, b in zip(texts[start : start + n], bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert words.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_batches_may_split_literals_like_other_text():
    whole, words = word_ids.WordTokenizer(definition()), word_ids.WordIds(definition(), added=False)
    ids, _ = words.encode(pa.array(["a <|endoftext|> b"]))
    assert ids.tobytes() == whole.encode("a <|endoftext|> b")


def test_best_fit_places_each_item_in_the_fullest_bin_with_room():
    draw = random.Random(4)
    for _ in range(200):
        capacity = draw.randint(5, 60)
        counts = {draw.randint(1, capacity): draw.randint(1, 9) for _ in range(draw.randint(0, 9))}
        rooms = []  # one item after the other
        for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is None:
                fit = capacity
            else:
                rooms.remove(fit)
            rooms.append(fit - length)
        kinds = residual_packing.best_fit(counts, capacity)
        assert sorted(room for bins, _, room in kinds for _ in range(bins)) == sorted(rooms)
        held = {}
        for bins, content, room in kinds:
            assert sum(x * n for x, n in content) + room == capacity
            for x, n in content:
                held[x] = held.get(x, 0) + bins * n
        assert held == counts


def tree(spark, rows, capacity, near=2, partitions=20):
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, node int").repartition(partitions)
    out = residual_packing.pack(docs, definition(), capacity=capacity, end_id=0, near=near)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    return out.toPandas()


def test_tree_packing_holds_every_id_once(spark, monkeypatch):
    monkeypatch.setattr(residual_packing, "NUMBERED", 40)
    library = Tokenizer.from_str(definition())
    rows = [(i % 390, t, "x", 1) for i, t in enumerate(TEXTS[:4] + TEXTS[7:] + ["a b c", "a b c"] * 60)] + [(None, "z", "x", 1)]
    out = tree(spark, rows, 64)
    expected = sorted(
        (-1 if k is None else k, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for k, t, _, _ in rows
    )
    # texts of a repeated key cannot be told apart by it: compare whole pieces
    cut = sorted((k, p, ids[64 * p : 64 * p + 64]) for k, ids in expected for p in range(-(-len(ids) // 64)))
    got = sorted(
        (-1 if np.isnan(r.doc_id) else int(r.doc_id), r.piece, np.frombuffer(r.ids, "<u4").tolist()) for r in out.itertuples()
    )
    assert got == cut
    assert (out.start == 64 * out.piece).all() and (out.length == out.ids.str.len() // 4).all()
    for _, sequence in out.sort_values("offset").groupby("sequence_id"):
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all()
        assert sequence.length.sum() <= 64
    sizes = {}
    for _, _, ids in cut:
        sizes[len(ids)] = sizes.get(len(ids), 0) + 1
    whole = sum(bins for bins, _, _ in residual_packing.best_fit(sizes, 64))
    assert out.sequence_id.nunique() <= whole + 2  # as all at once, but for what nearly full bins waste


def test_tree_packing_joins_what_no_task_could_fill(spark):
    # 64 tasks with one short text each: only the rounds above can put them together
    out = tree(spark, [(i, "a", "x", 1) for i in range(128)], 32, near=0, partitions=64)
    assert out.sequence_id.nunique() == 8
    assert tree(spark, [], 32).empty
    with pytest.raises(ValueError):
        residual_packing.pack(spark.createDataFrame([], "doc_id long, text string"), definition(), capacity=0)
