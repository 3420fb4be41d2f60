"""Operators beyond their queries: skew over many partitions, files, models, removal."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from chirplake.llm import (
    bag_search,
    decontaminate,
    host_rules,
    importance,
    line_dedup,
    piece_fst,
    rank_fold,
    rendezvous,
    simhash,
    token_orc,
    token_scan,
    url_filter,
    whitening,
)
from chirplake.llm import queries as q
from chirplake.llm.components import components
from chirplake.llm.encoders import ByteEncoder
from chirplake.llm.gray_index import gray_code, gray_rank, group_cells

RNG = random.Random(7)


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_lines_of_a_hot_key_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    docs = [(i, f"the very same line\nline number {i % 50} here\nown {i} own own") for i in range(900)]
    RNG.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    try:
        found = line_dedup.dedup_lines(frame).select(
            "doc_id", "n_lines", "n_dropped", F.sha2("text", 256)
        )
        assert sorted(map(tuple, found.collect())) == sorted(brute.line_dedup(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_gray_rank_orders_neighbours():
    ranks = np.arange(1000, dtype=np.uint64)
    codes = gray_code(ranks)
    assert (np.bitwise_count(codes[1:] ^ codes[:-1]) == 1).all()
    assert (gray_rank(codes) == ranks).all()


@pytest.mark.parametrize("size", [1, 2, 17, 300, 700])
def test_gray_index_finds_every_group(size):
    base = [RNG.getrandbits(64) for _ in range(6)]
    codes = {RNG.getrandbits(64) for _ in range(size // 3)}
    while len(codes) < size:
        code = RNG.choice(base)
        for _ in range(RNG.randint(0, 9)):
            code ^= 1 << RNG.randrange(64)
        codes.add(code)
    array = np.array(sorted(codes), np.uint64)
    array = array[np.argsort(gray_rank(array))]
    first = group_cells(array, np.array([0]), 4)
    wanted = brute.groups_of(list(enumerate(array.tolist())))
    assert first.tolist() == [root for _, _, root in wanted]


def test_near_links_over_sliced_cells(spark):
    """A chain of codes, each four bits from the last, in cells cut into many slices."""
    code, chain = RNG.getrandbits(64), []
    for _ in range(120):
        chain.append(code)
        for bit in RNG.sample(range(64), 4):
            code ^= 1 << bit
    cloud = list({chain[0] ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)})
    rows = list(enumerate(dict.fromkeys(chain + cloud + [RNG.getrandbits(64) for _ in range(200)])))
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in rows]
    codes = spark.createDataFrame(signed, "id long, code long")
    roots = dict(pairs(components(simhash.near_links(codes, slice_rows=50)), "node", "root"))
    for i, _, root in brute.groups_of(rows):
        assert roots.get(i, i) == root


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(5, 5)]
    RNG.shuffle(links)
    found = dict(pairs(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert found == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 400)}


def test_kept_documents_of_groups(spark):
    text = " ".join(f"word{i}" for i in range(200))
    docs = [(3, text), (1, text), (2, text + " more"), (9, "other text here"), (None, text), (1, text)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_flag", F.lit(0))
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    groups = dict(pairs(simhash.near_groups(frame).where("doc_id is not null"), "doc_id", "component"))
    wanted = [d for d, _ in docs if d is None or groups[d] == d]
    assert sorted(map(repr, (r[0] for r in kept.collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("cut", [1, 3, 1000])
def test_documents_over_edges_of_blocks_and_files(spark, tmp_path, cut):
    ids = np.array([5, 6, 2, 2, 7, 8, 9, 2, 4], "<u2")
    for n, part in enumerate(np.split(ids, [2, 2, 6])):
        (tmp_path / f"part-{n:05d}.bin").write_bytes(part.tobytes())
    found = pairs(token_scan.count_tokens(spark, str(tmp_path), block_ids=cut), "document", "start", "n_tokens", "complete")
    assert found == [(0, 0, 3, True), (1, 3, 1, True), (2, 4, 4, True), (3, 8, 1, False)]


def test_orc_has_bloom_filters_and_prunes(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    token_orc.write_tokens(docs, f"{tmp_path}/o", q.tokenizer_file(q.BYTE_TOKENIZER))
    tokens = token_orc.read_tokens(spark, f"{tmp_path}/o")
    one = tokens.where("doc_id = 17")
    assert one.count() == 1
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().executedPlan().toString()
    raw = b"".join(p.read_bytes() for p in (tmp_path / "o").glob("*.orc"))
    assert raw[:3] == b"ORC"


def unigram(model: bytes) -> bytes:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for i, piece in enumerate(proto.pieces):
        if piece.type == type(piece).NORMAL:
            piece.score = -3.0 - 10 * (i * 0.6180339887498949 % 1.0)
    return proto.SerializeToString()


def test_rows_of_one_id_are_spanned_as_they_lie_in_the_files(spark, tmp_path):
    docs = [(1, "a b c d e"), (1, "z"), (1, "z"), (1, None), (None, "x y"), (2, "m n"), (0, "q" * 300_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    path = f"{tmp_path}/o"
    token_orc.write_tokens(frame, path, q.tokenizer_file(q.BYTE_TOKENIZER))
    stored = []
    for file in sorted(tmp_path.glob("o/*.orc")):
        stored += [r["ids"] for r in spark.read.orc(str(file)).coalesce(1).collect()]
    stream = [i for ids in stored for i in ids]
    spans = token_orc.token_spans(token_orc.read_tokens(spark, path)).collect()
    assert len(spans) == len(docs)
    assert sorted((s["start"], s["n_tokens"]) for s in spans) == [
        (sum(map(len, stored[:i])), len(ids)) for i, ids in enumerate(stored)
    ]
    for span in spans:
        ids = stream[span["start"] : span["start"] + span["n_tokens"]]
        assert ids[-1] == 0 and brute.crc(ids) == span["ids_crc32"]


def test_tokenizers_that_change_the_text_are_refused():
    with pytest.raises(ValueError, match="as it is"):
        ByteEncoder(q.tokenizer_file("word_bpe_49k.json"))


def test_fit_on_a_bounded_part_of_the_targets(spark):
    targets = spark.range(10_000).select(F.col("id").alias("_labelled"))
    assert importance._bounded(targets, 10_000, 10_000, 42).count() == 10_000
    assert 800 < importance._bounded(targets, 10_000, 1_000, 42).count() < 1_200


@pytest.mark.parametrize("kind", ["pairs", "unigram"])
def test_shortest_path_is_the_library_encoding(kind):
    with open(q.tokenizer_file(q.PIECE_MODEL), "rb") as file:
        model = file.read()
    model = unigram(model) if kind == "unigram" else model
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    machine = piece_fst.PieceTransducer(model)
    signs = [*"abcdefghij the ing tion ▁ é☃𝒳日本\n\t  <0x0A>.,!'", "  ", "there", "Zü"]
    for _ in range(1500):
        text = "".join(RNG.choice(signs) for _ in range(RNG.randint(0, 40)))
        ids = np.frombuffer(machine.encode(text), "<i4").tolist()
        assert ids == library.encode(text), text
        assert machine.decode(ids) == library.decode(ids)
    for _ in range(500):
        ids = [RNG.randrange(300 if RNG.random() < 0.5 else 32_000) for _ in range(RNG.randint(0, 9))]
        assert machine.decode(ids) == library.decode(ids)


def test_removal_of_spans_and_documents(spark):
    passage = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, f"Keep me. {passage}! and me"), (2, "clean text"), (3, None), (3, passage), (4, f"({passage.upper()})")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit("clash"))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.remove_documents(frame, items)
    assert kept.columns == frame.columns
    assert pairs(kept, "doc_id", "text") == [(2, "clean text"), (3, None)]
    cut = dict(pairs(decontaminate.remove_spans(frame.where("doc_id <> 3"), items), "doc_id", "text"))
    assert cut[2] == "clean text" and cut[4].strip("() ,") == ""
    assert brute.bench_words(cut[1]) == ["keep", "me", "and", "me"]


def test_decontamination_plan_is_native(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hits = decontaminate.find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_bad_hosts_go_and_small_ones_do_not(spark):
    good = "every word of this text is here once and so it passes all the rules"
    rows = [("bad", "few words")] * 190 + [("bad", good)] * 10 + [("fine", good)] * 600
    rows += [("tiny", "few words"), (None, good)] + [(f"h{i}", good) for i in range(40)]
    frame = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string")
    judged = host_rules.judge(frame)
    assert {r[0] for r in judged.where("host_rejected").select("source").distinct().collect()} == {"bad"}
    kept = host_rules.keep_good(frame)
    assert kept.columns == frame.columns and kept.count() == 600 + 1 + 40
    assert kept.exceptAll(judged.where("kept").join(frame.select("doc_id", "text"), "doc_id").select(*frame.columns)).isEmpty()


def test_rendezvous_moves_few_and_obeys_weights(spark):
    keys = spark.range(20_000).select(
        rendezvous.shard_of(F.col("id"), [1, 1, 2, 0]).alias("a"),
        rendezvous.shard_of(F.col("id"), [1, 1, 2, 0, 1]).alias("b"),
    )
    counts = {r["a"]: r["count"] for r in keys.groupBy("a").count().collect()}
    assert set(counts) == {0, 1, 2} and abs(counts[2] - 10_000) < 500
    assert keys.where("a <> b and b <> 4").isEmpty()
    assert abs(keys.where("b = 4").count() - 4_000) < 400
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.col("id"), [0.0])


def test_names_are_split_into_words():
    cost = {"cheap": 2.0, "pills": 2.5, "he": 3.0, "a": 1.0}
    assert url_filter.split_words("cheappills", cost, 9.0, 24) == ["cheap", "pills"]
    assert url_filter.split_words("xyzcheap", cost, 9.0, 24) == ["xyz", "cheap"]
    assert url_filter.split_words("", cost, 9.0, 24) == []


def test_url_model_on_held_out_pages(spark):
    """Hosts that no rule covers are judged by the words they share with hosts that one does."""
    bad, good = ["cheap", "pills", "casino", "spam", "win"], ["city", "library", "school", "news", "garden"]
    pages, truth = [], {}
    for i in range(600):
        words, ending = (bad, "net") if i % 2 else (good, "org")
        name = "".join(RNG.sample(words, 2))
        tail = f"{ending}/fr/{RNG.choice(words)}" if i < 450 else f"info/en/{RNG.choice(words)}"
        pages.append((i, f"http://{name}.{tail}", "<p>" + " ".join(bad + good) + "</p>"))
        truth[i] = "block" if i % 2 else "allow"
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    judged = url_filter.judge(frame, q.URL_RULES).where("rule is null")
    found = dict(pairs(judged, "page_id", "verdict"))
    assert len(found) == 150
    assert sum(found[i] == truth[i] for i in found) / len(found) > 0.95


def test_resampling_prefers_the_target_on_held_out_documents(spark):
    clean = ["garden", "river", "stone", "letter", "window", "quiet", "summer", "paper"]
    junk = ["buy!!", "$$$", "click", "winner", "###", "free!!!"]
    docs, labels = [], []
    for i in range(800):
        words = clean if i % 4 else junk
        docs.append((i, " ".join(RNG.choice(words) for _ in range(60))))
        if i < 400:
            labels.append((i, int(bool(i % 4)), 0))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    drawn = importance.resample(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held_out = [r for r in drawn.collect() if r["doc_id"] >= 400]
    assert sum(r["kept"] == bool(r["doc_id"] % 4) for r in held_out) / len(held_out) > 0.98


def test_search_in_many_item_blocks_and_small_parts(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 300")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id < 20")
    monkeypatch.setattr(bag_search, "HELD_AT_ONCE", 300)
    found = bag_search.search(docs, items, best=4, postings=150)
    wanted = brute.bag_search(
        pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"), best=4
    )
    assert len(list(bag_search.item_blocks(items, 150))) > 3
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_search_expands_a_class_of_many_copies_by_id(spark):
    docs = [(i, "red green blue" if i % 3 else f"red {i} x") for i in range(900)] + [(5000, "green"), (None, "red green blue")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "Red GREEN"), (2, "blue"), (3, "nothing"), (4, "x"), (4, "x")], "item_id long, text string")
    found = sorted(map(tuple, bag_search.search(frame, items).collect()))
    assert found == sorted(brute.bag_search(docs, items.collect()))
    found = bag_search.bags(frame, bag_search._shared(frame, {b"red": 0, b"green": 1, b"blue": 2, b"x": 3}))
    sizes = bag_search.classes(found, 902, 2707).select("members").collect()
    assert sorted(r[0] for r in sizes) == [1, 300, 601]


@pytest.mark.parametrize("dim, rank", [(40, 40), (40, 5), (60, 30), (3, 2)])
def test_filtered_iteration_finds_the_leading_vectors(dim, rank):
    rng = np.random.default_rng(dim + rank)
    values = np.zeros(dim)
    values[:rank] = 5 + np.sort(rng.random(rank))[::-1]
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    whole = (turn * values) @ turn.T
    found, vectors = whitening.leading(lambda columns: whole @ columns, dim, 8)
    size = min(8, rank)
    assert found[:size] == pytest.approx(values[:size], rel=1e-12)
    assert np.abs(whole @ vectors - vectors * found).max() < 1e-12 * values[0] * dim


def test_whitening_of_wide_numbers_and_other_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(40) * 1e7]) for i in range(300)]
    rows += [(1000, [1.0, 2.0]), (1001, [1e300] * 40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = whitening.whiten(frame, components=3).collect()
    assert {r["vec_id"] for r in found} == set(range(300)) and len(found) == 900
    x = np.floor(1024 * np.array([v for _, v in rows[:300]])).astype(np.int64) + 100_000
    sums = [sum(column) for column in zip(*x.tolist(), strict=True)]
    deviation = {i: sum((300 * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for i, row in enumerate(x.tolist())}
    assert all(r["deviation"] == (d if (d := deviation[r["vec_id"]]) < 1 << 63 else None) for r in found)
    z = np.array([r["whitened"] for r in sorted(found, key=lambda r: (r["vec_id"], r["component"]))]).reshape(300, 3)
    assert np.abs(z.T @ z / 300 - np.eye(3)).max() < 1e-9 and found[0]["identity_error"] < 1e-9


def test_whitening_without_variance_gives_no_rows(spark):
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def ids_of(rows):
    return {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows}


@pytest.mark.parametrize("remembered", [0, 20, 10_000])
def test_folds_are_the_library_encoding(spark, remembered, monkeypatch):
    ranks = q.tokenizer_file(q.RANKS)
    library = brute.rank_encoding(ranks)
    letters = "etaoinshrdluZé\n\t  .,!?'st1 2—☃𝒳\x00▁\u3000\x1c\x85\r"
    docs = [(i, "".join(RNG.choice(letters) for _ in range(RNG.randint(0, 200)))) for i in range(400)]
    docs += [(1000, "zwischenzeitlichster " * 50), (1001, "q" * 250 + "é" * 3 + " " + "ab" * 400), (1002, None), (1003, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_open", F.lit(1)).repartition(3)
    encoded = rank_fold.encode(frame, ranks, remembered=remembered)
    assert encoded.columns == ["doc_id", "text", "_open", "ids"]
    found = ids_of(encoded.collect())
    assert found == {doc: library.encode_ordinary(text or "") for doc, text in docs}
    back = rank_fold.decode(encoded, ranks).select("doc_id", "decoded").collect()
    assert {r[0]: bytes(r[1]).decode() for r in back} == {doc: text or "" for doc, text in docs}


def test_fold_and_heap_agree_where_merges_overlap(spark):
    """Ranks in an order no training would give: pairs that come up after later ones, and repeats."""
    pieces = ["ab", "bc", "abc", "aa", "aaa", "ca", "cab", "bb", "abab", "cc"]
    for turn in range(4):
        RNG.shuffle(pieces)
        ranks = {bytes([b]): b for b in range(256)} | {p.encode(): 256 + i for i, p in enumerate(pieces)}
        library = brute.tiktoken_of(ranks)
        words = ["".join(RNG.choice("abc") for _ in range(RNG.randint(1, 25))) for _ in range(200)]
        frame = spark.createDataFrame([(words,)], "words array<string>")
        folded = frame.select(rank_fold.fold_words(F.col("words"), rank_fold.rank_literal(ranks, 16), 16)).first()[0]
        wanted = [library.encode_ordinary(word) for word in words]
        assert folded == wanted, turn
        assert [rank_fold.merge_by_heap(word.encode(), ranks) for word in words] == wanted


def test_words_of_every_code_point():
    library = brute.rank_encoding(q.tokenizer_file(q.RANKS))
    lookup = rank_fold._Lookup(remembered([], []), rank_fold.read_ranks(q.tokenizer_file(q.RANKS)))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0 or 0x10000 < c < 0x20000)]
    for c in points:
        text = f"x{chr(c)}1{chr(c)} {chr(c)}\n{chr(c)}{chr(c)}a {chr(c)} b"
        known, at, words = lookup.known_and_open(text)
        if not words:
            assert np.frombuffer(known, "<u4").tolist() == library.encode_ordinary(text), hex(c)
    assert rank_fold.words_of_chunk("don't") == ["don", "'t"]


def remembered(words, ids):
    return rank_fold.Remembered(*rank_fold.flat_words(pa.array(words, pa.string()), pa.array(ids, pa.list_(pa.int32()))))


def test_remembered_words_are_found_by_hash_and_content():
    words = [f"w{i}é" for i in range(1_000)]
    table = remembered(words, [[i, i + 1] for i in range(1_000)])
    assert all(np.frombuffer(table.get(w.encode()), "<u4").tolist() == [i, i + 1] for i, w in enumerate(words))
    assert table.get(b"w1") is None and table.get(b"") is None
    # Another word of the same hash is not taken for it.
    table.words = table.words.replace("w7é".encode(), "v7é".encode())
    assert table.get("w7é".encode()) is None


def test_a_batch_is_looked_up_like_its_texts_one_by_one():
    path = q.tokenizer_file(q.RANKS)
    table = remembered(["qzx", " vvkq", "q" * 300], [[1, 2], [3], [4, 5]])
    one, batch = rank_fold._Lookup(table, rank_fold.read_ranks(path)), rank_fold._Batches(table, path)
    signs = "etaoinqzxvkéñZ \n.,!?'s1\t 2—☃𝒳\x00\u3000\xa0\x1c\r×÷ÀƺΑ"
    for turn in range(150):
        letters = signs[: RNG.randint(12, len(signs))]
        texts = ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 60))) for _ in range(RNG.randint(0, 20))]
        texts += ["", " ", "\n", " vvkq vvkq. qzx", "q" * 300] * (turn % 3)
        found = batch.known_and_open(pa.array(texts, pa.string()).slice(turn % 2)).to_pylist()
        assert [(row["ids"], row["at"], row["words"]) for row in found] == list(map(one.known_and_open, texts[turn % 2 :]))


def test_a_part_is_looked_up_once_for_a_batch(monkeypatch):
    """Looking up each text by itself took most of the time in Python."""
    path, met = q.tokenizer_file(q.RANKS), []
    batch = rank_fold._Batches(remembered([], []), path)
    monkeypatch.setattr(batch, "known", lambda words, known=batch.known: met.extend(words.to_pylist()) or known(words))
    batch.known_and_open(pa.array(["so qzxv, so qzxv", "so qzxv"] * 50))
    assert sorted(met) == [" qzxv", " so", ",", "so"]


def test_a_word_of_a_million_characters():
    ranks = rank_fold.read_ranks(q.tokenizer_file(q.RANKS))
    word = "".join(RNG.choice("abcdefghij") for _ in range(1_000_000))
    library = brute.rank_encoding(q.tokenizer_file(q.RANKS))
    assert rank_fold.merge_by_heap(word.encode(), ranks) == library.encode_ordinary(word)


def test_only_the_most_frequent_words_are_remembered(spark):
    docs = [(" ".join(["qzxjw"] * 9 + ["vvkqj"] * 5 + ["jjxqk", "jjxqk"] + ["the"] * 20),)]
    frame = spark.createDataFrame(docs, "text string")
    path = q.tokenizer_file(q.RANKS)
    for most, wanted in ((2, {" qzxjw", " vvkqj"}), (1, {" qzxjw"}), (0, set()), (9, {" qzxjw", " vvkqj", " jjxqk"})):
        assert {r[0] for r in rank_fold.frequent_words(frame, path, most).collect()} == wanted


@pytest.mark.parametrize("joined", ["broadcast", "shuffled"])
def test_few_candidates_however_many_windows(spark, sf_dir, monkeypatch, joined):
    """Far more windows than a bitmap has room for: taken in blocks, with few that are no hits."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 400")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    monkeypatch.setattr(decontaminate, "MIN_BITS", 1 << 12)
    monkeypatch.setattr(decontaminate, "MAX_BITS", 1 << 12)
    if joined == "shuffled":
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    counted, made = [], decontaminate._candidates

    def counting(*args):
        found = made(*args)
        counted.append(found.where("gram is not null").count())
        return found

    monkeypatch.setattr(decontaminate, "_candidates", counting)
    try:
        hits = decontaminate.find_hits(docs, items).collect()
        plan = decontaminate.find_hits(docs, items)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    n_windows = decontaminate.benchmark_windows(items).count()
    n_words = sum(len(brute.bench_words(r["text"])) for r in docs.collect())
    true = sum(len(row["hits"]) for row in hits)
    blocks = -(-n_windows // ((1 << 12) // decontaminate.BITS_LEAST))
    assert blocks > 1 and len(counted) == 2 * blocks
    assert true <= sum(counted[:blocks]) < true + 0.03 * n_words * blocks
    wanted = brute.decontaminate(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert sorted((r["doc_id"], r["n_words"], len(r["items"])) for r in hits) == sorted((w[0], w[1], w[3]) for w in wanted)
    if joined == "shuffled":
        assert "SortMergeJoin [key#" in plan


def test_flat_files_are_bounded_and_in_the_order_of_their_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_scan, "FILE_BYTES", 200)
    docs = spark.range(3_000, numPartitions=2).select(
        F.concat(F.lit("some words "), F.repeat(F.lit("x "), (F.col("id") % 7).cast("int"))).alias("text")
    )
    path, model = f"{tmp_path}/flat", q.tokenizer_file(q.PIECE_MODEL)
    token_scan.write_flat(docs, path, model)
    files = list((tmp_path / "flat").glob("part-*"))
    # More files of one task than three digits hold: their names alone do not give the order.
    assert max(int(f.name.rpartition("-c")[2][:-4]) for f in files if "-c" in f.name) >= 100
    assert max(f.stat().st_size for f in files) < 1_000
    found = sorted(map(tuple, token_scan.count_tokens(spark, path).select("document", "n_tokens").collect()))
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    assert [n for _, n in found] == [len(pieces.encode(r["text"])) + 1 for r in docs.collect()]


@pytest.mark.parametrize("names", [["part-2.bin", "part-10.bin", "part-100000.bin"], ["a.bin", "b.bin", "c.bin"]])
def test_stream_of_files_by_number_and_name(spark, tmp_path, names):
    for n, name in enumerate(names, 3):
        (tmp_path / name).write_bytes(np.array([9] * n + [2], "<u2").tobytes())
    found = pairs(token_scan.count_tokens(spark, str(tmp_path)), "document", "n_tokens")
    assert found == [(0, 4), (1, 5), (2, 6)]
