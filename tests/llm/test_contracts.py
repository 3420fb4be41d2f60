"""The queries against plain Python, over the test tables and over awkward rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chirplake.llm import queries as q
from chirplake.llm import url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _tag string, part int"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven"
AWKWARD = [
    (1, "A shared line of text\nunique one here\nA shared line of text"),
    (2, "  a SHARED line of text \t\nother words stay here"),
    (2, "  a SHARED line of text \t\nother words stay here"),
    (3, None),
    (4, ""),
    (5, "\n\n"),
    (6, LONG),
    (7, LONG + " end"),
    (8, f"x {PASSAGE} y\nshort\nshort"),
    (9, "ten letter\r\nTEN LETTER\nten lette"),
    (10, "ten letter"),
    (11, "Zürich naïve café ☃ 𝒳 <s> \x00 é ▁ <|endoftext|> don't  double \n spaced"),
    (12, "# * $ % & | < >\n#\n#\n" + "again and again and " * 6),
    (None, "a shared line of text\nrow without an id"),
    (13, "Only three Words"),
    (14, "only three words"),
]
ITEMS = [(1, PASSAGE), (20, "ten letter"), (3, None), (4, ""), (None, "Other Words"), (1, PASSAGE)]


def frame(spark, rows):
    full = [(d, t, "xx", f"s{(d or 0) % 3}" if d != 4 else None, 0, "clash", 7) for d, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(5)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    frame(spark, AWKWARD).write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    items.withColumn("tag", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (6, None, None), (None, 1, 0), (99, 1, 0), (7, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    pages = [
        (1, "HTTP://A.Example.NET/en/x?y#z", "<p>hot dog stand</p>"),
        (2, "http://b.example.net/fr", "<p>hot hot dog</p>"),
        (3, "x://example.com/de/", None),
        (4, "x://notexample.com/de/a", ""),
        (5, "x://shop.org/fr/a/../b", "<script>var dog</script>dog"),
        (6, None, "hot"),
        (7, "no scheme", "dog"),
        (8, "x://net", "dog"),
        (9, "x://hotdog.io?u=http://a.net/", "dog"),
        (9, "x://hotdog.io?u=http://a.net/", "dog"),
        (None, "x://user@hotdog.io:80#/en/", "dog"),
        (10, "x://" + "hotdog" * 400 + "/", "dog"),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "word", F.lit("clash")
    ).write.parquet(f"{folder}/pages.parquet")
    inf, nan = float("inf"), float("nan")
    vectors = [
        (1, [0.5, -0.25, 0.125]), (1, [0.5, -0.25, 0.125]), (2, None), (3, []), (4, [1.0, None, 2.0]),
        (5, [inf, 0.0, 0.0]), (6, [nan, 0.0, 0.0]), (7, [0.25, 9.0, -3.5]), (None, [1.5, 2.5, 100.0]),
        (8, [-1e-9, 0.0, 7.0]), (9, [0.1, 0.2, 0.3]), (10, [4.0, -4.0, 0.0]),
    ]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn(
        "ids", F.lit("clash")
    ).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, awkward, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in ("documents", "benchmark", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{awkward}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module", params=["table", "awkward"])
def data(request, sf_dir, awkward):
    return sf_dir if request.param == "table" else awkward


def texts(spark, folder, name="documents", key="doc_id"):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(key, "text").collect()]


def result(spark, name, folder, *columns):
    df = q.QUERIES[name](spark, folder)
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def same(left, right):
    assert sorted(left, key=repr) == sorted(right, key=repr)


def test_op1(spark, data):
    same(result(spark, "op1_line_dedup", data), brute.line_dedup(texts(spark, data)))


def test_op2(spark, data):
    urls = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url").collect()
    found = result(spark, "op2_url_filter", data, "page_id", "host", "path", "rule", "verdict")
    assert {row[4] for row in found} <= {"allow", "block"}
    wanted = []
    for page, url in urls:
        host, path = brute.url_parts(url)
        rule, verdict = brute.url_rule(host, path)
        wanted.append((page, host, path, rule, verdict))
    same([(*row[:4], row[4] if row[3] else None) for row in found], wanted)


def test_op2_scores_and_verdicts(spark, data):
    pages = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    rules = {rule.rule: rule.verdict for rule in q.URL_RULES}
    wanted = sorted(brute.url_scores(pages, rules, url_filter.LONGEST_WORD), key=repr)
    found = sorted(result(spark, "op2_url_filter", data, "page_id", "score", "verdict"), key=repr)
    wanted.sort(key=lambda r: (r[0] or -1, r[1]))
    found.sort(key=lambda r: (r[0] or -1, r[1]))
    assert [(r[0], r[2]) for r in found if abs(r[1]) > 1e-9] == [(r[0], r[2]) for r in wanted if abs(r[1]) > 1e-9]
    assert [r[1] for r in found] == pytest.approx([r[1] for r in wanted], abs=1e-9)


def test_op3(spark, data):
    tokenizer = Tokenizer.from_file(q.tokenizer_file(q.BYTE_TOKENIZER))
    start, wanted = 0, []
    for doc, text in sorted(texts(spark, data), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.append((doc, start, len(ids), brute.crc(ids)))
        start += len(ids)
    same(result(spark, "op3_token_orc", data), wanted)


def test_op4(spark, data):
    pieces = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer_file(q.PIECE_MODEL))
    found = sorted(result(spark, "op4_token_counts", data))
    lengths = [len(pieces.encode(text or "")) + 1 for _, text in texts(spark, data)]
    assert sorted(row[2] for row in found) == sorted(lengths)
    assert [row[0] for row in found] == list(range(len(lengths)))
    assert [row[1] for row in found] == [0, *np.cumsum([row[2] for row in found])[:-1].tolist()]
    assert all(row[3] for row in found)


def test_op4_document_by_document(spark, data):
    pieces = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer_file(q.PIECE_MODEL))
    start, wanted = 0, []
    for number, (_, text) in enumerate(texts(spark, data)):
        n_tokens = len(pieces.encode(text or "")) + 1
        wanted.append((number, start, n_tokens, True))
        start += n_tokens
    assert sorted(result(spark, "op4_token_counts", data)) == wanted


def test_op5(spark, data):
    wanted = [(d, f"{code:016x}", c) for d, code, c in brute.near_groups(texts(spark, data))]
    same(result(spark, "op5_simhash", data), wanted)


def test_op6(spark, data):
    pieces = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer_file(q.PIECE_MODEL))
    found = result(spark, "op6_sentencepiece", data, "doc_id", "n_tokens", "decoded_sha256", "round_trip")
    wanted = []
    for doc, text in texts(spark, data):
        ids = pieces.encode(text or "")
        back = pieces.decode(ids)
        wanted.append((doc, len(ids), brute.sha(back), back == (text or "")))
    same(found, wanted)
    hashes = result(spark, "op6_sentencepiece", data, "doc_id", "ids_xxhash64")
    same(hashes, [(doc, brute.spark_hash(*[(4, i) for i in pieces.encode(text or "")])) for doc, text in texts(spark, data)])


def test_op7(spark, data):
    items = texts(spark, data, "benchmark", "item_id")
    wanted = set(brute.decontaminate(texts(spark, data), items))
    same(result(spark, "op7_decontaminate", data), wanted)


def test_op8(spark, data):
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    wanted = [(doc, *brute.base_metrics(text)) for doc, text in texts(spark, data)]
    same(result(spark, "op8_host_rules", data, *columns), wanted)
    flags = result(spark, "op8_host_rules", data, "base_failed", "host_rejected", "kept")
    assert all(kept == (not failed and not rejected) for failed, rejected, kept in flags)


def test_op8_hosts(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "source").collect()]
    failed = [brute.base_metrics(text)[-1] for _, text, _ in docs]
    rejected = brute.host_verdicts([(source, bad) for (_, _, source), bad in zip(docs, failed, strict=True)])
    wanted = [
        (doc, source, rejected[source], not bad and not rejected[source])
        for (doc, _, source), bad in zip(docs, failed, strict=True)
    ]
    same(result(spark, "op8_host_rules", data, "doc_id", "source", "host_rejected", "kept"), wanted)


def test_op9_shards(spark, data):
    wanted = [
        (doc, brute.rendezvous(doc, q.SHARDS), brute.rendezvous(doc, q.SHARDS + 1)) for doc, _ in texts(spark, data)
    ]
    same(result(spark, "op9_rendezvous", data, "doc_id", "shard", "grown_shard"), wanted)


def test_op9(spark, data):
    found = result(spark, "op9_rendezvous", data)
    raw = [(doc, (text or "").encode()) for doc, text in texts(spark, data)]
    same([row[:4] for row in found], [(doc, len(b) + 16, zlib.crc32(b), "key") for doc, b in raw])
    slots, shards = defaultdict(list), defaultdict(set)
    for row in found:
        slots[row[4]].append(row[5])
        shards[row[0]].add((row[4], row[6]))
        assert 0 <= row[4] < q.SHARDS and row[6] in (row[4], q.SHARDS)
    assert all(sorted(taken) == list(range(len(taken))) for taken in slots.values())
    assert all(len(places) == 1 for places in shards.values())


def test_op10(spark, data):
    found = result(spark, "op10_importance", data, "doc_id", "log_weight", "gumbel", "rank", "kept")
    by_rank = sorted(found, key=lambda row: row[3])
    assert [row[3] for row in by_rank] == list(range(len(texts(spark, data))))
    sums = [row[1] + row[2] for row in by_rank]
    assert all(a >= b - 1e-9 for a, b in zip(sums, sums[1:], strict=False))
    kept = [row[4] for row in by_rank]
    assert kept == sorted(kept, reverse=True)


def test_op10_weights_noise_and_cut(spark, data):
    labels = [tuple(r) for r in spark.read.parquet(f"{data}/labels.parquet").collect()]
    wanted = sorted(brute.importance(texts(spark, data), labels), key=repr)
    found = sorted(result(spark, "op10_importance", data), key=repr)
    assert len(found) == len(wanted)
    by_rank = {row[4]: row for row in wanted}
    for row in found:
        other = by_rank[row[4]]
        assert (row[0], row[1], row[5]) == (other[0], other[1], other[5])
        assert row[2:4] == pytest.approx(other[2:4], abs=2e-6)


def test_op11(spark, data):
    library = brute.rank_encoding(q.tokenizer_file(q.RANKS))
    wanted = []
    for doc, text in texts(spark, data):
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        wanted.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), brute.sha(text or "")))
    same(result(spark, "op11_rank_bpe", data), wanted)


def test_op12(spark, data):
    items = texts(spark, data, "benchmark", "item_id")
    same(result(spark, "op12_bag_search", data), brute.bag_search(texts(spark, data), items))


def whitened(vectors):
    """Of (vec_id, vector): the whole numbers, their eigenvalues and components, by numpy alone."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in good])
    centred = x - x.mean(0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return [i for i, _ in good], x, values[::-1], turn[:, ::-1]


def test_op13(spark, data):
    vectors = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x, values, turn = whitened(vectors)
    n, size = len(x), min(8, int((values > 1e-9 * values[0]).sum()))
    deviations = ((n * x - x.sum(0)) ** 2).sum(1)
    z = (x - x.sum(0) / n) @ turn[:, :size] / np.sqrt(values[:size])
    wanted = [(ids[at], c + 1, n, deviations[at], z[at, c]) for at in range(n) for c in range(size)]
    key = lambda row: (row[0] is not None, row[0] or 0, row[3], row[1])
    found = sorted(result(spark, "op13_whitening", data), key=key)
    assert [row[:4] for row in found] == [row[:4] for row in sorted(wanted, key=key)]
    signs = defaultdict(set)
    for row, (_, component, _, _, value) in zip(found, sorted(wanted, key=key), strict=True):
        assert abs(row[4]) == pytest.approx(abs(value), abs=1e-8)
        assert row[5] == pytest.approx(values[component - 1] / values.sum(), rel=1e-9)
        assert row[6] < 1e-8
        if abs(value) > 1e-6:
            signs[component].add(np.sign(row[4] * value))
    assert all(len(both) == 1 for both in signs.values())


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_empty_tables(name, spark, empty):
    assert q.QUERIES[name](spark, empty).collect() == []


