"""Encoding, token files, packing and recounting against the tokenizer on whole texts."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pacewell.llm import common, encoding, packing, recount, tokenfiles
from pacewell.session import scratch_path

WHITE = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "\u0085", "\x1c", "　", " ", "​"]
PARTS = ["word", "it's", "99", "...", "é", "日本", "😀", "<|endoftext|>", "A-b", "\x00", "ñ", "_"]


def random_text(rng, n):
    return "".join(rng.choice(WHITE if rng.random() < 0.5 else PARTS) for _ in range(n))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_units_give_the_ids_of_whole_texts(tokens):
    rng = random.Random(3)
    texts = [None, "", *[random_text(rng, rng.randint(1, 40)) for _ in range(600)]]
    encoder = encoding.Encoder(common.tokenizer_path(), most=200)  # forgets now and then
    for array in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["cut", *texts])[1:]):
        for first, ids, bounds in encoder.encode(array):
            for row, (a, b) in enumerate(zip(bounds, bounds[1:]), first):
                assert ids[a:b].tolist() == tokens(texts[row])


def test_text_without_blanks_and_a_very_long_one(tokens):
    texts = ["x" * 300_000, "ab " * 200_000]
    for first, ids, bounds in encoding.Encoder(common.tokenizer_path()).encode(pa.array(texts)):
        for row, (a, b) in enumerate(zip(bounds, bounds[1:]), first):
            assert ids[a:b].tolist() == tokens(texts[row])


def test_files_round_trip(spark, documents, odd_rows, tokens):
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_tokens(documents(odd_rows), folder)
    found = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, tuple(r["ids"])) for r in tokenfiles.read_tokens(spark, folder).collect()))
    wanted = sorted((i is not None, i or 0, (*tokens(t), 0)) for i, t, _, _ in odd_rows)
    assert found == wanted
    digests = sorted(tokenfiles.token_digests(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in digests] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    start = 0
    for r in digests:
        assert r["start"] == start
        start += r["n_tokens"]
    assert Counter(r["ids_crc32"] for r in digests) == Counter(crc(ids) for _, _, ids in wanted)


def test_files_give_single_documents_and_check_their_dictionary(spark, documents, odd_rows, tokens):
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_tokens(documents(odd_rows), folder)
    few = tokenfiles.read_tokens(spark, folder, [7, 5]).collect()
    assert {r["doc_id"]: r["ids"] for r in few} == {7: [*tokens("one"), 0], 5: [*tokens(odd_rows[5][1]), 0]}
    assert tokenfiles.read_tokens(spark, folder, [99]).count() == 0
    block = spark.read.parquet(f"{folder}/blocks").head()
    assert block["dictionary_hash"] == spark.read.parquet(f"{folder}/dictionary").head()["hash"]


def test_files_of_an_empty_table(spark, documents):
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_tokens(documents([]), folder)
    assert tokenfiles.token_digests(spark, folder).count() == 0 and tokenfiles.read_tokens(spark, folder).count() == 0


def check_packing(pieces, texts, tokens, capacity):
    """Every id once, gapless sequences within the capacity; returns the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    copies = Counter(i for i, _ in texts)
    wanted = {i: [*tokens(t), 1] for i, t in texts}
    for i, ids in wanted.items():
        spans = Counter((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_doc.pop(i))
        assert set(spans.values()) == {copies[i]}
        at = 0
        for start, length, check, total in sorted(spans):
            assert (start, check, total) == (at, crc(ids[at : at + length]), len(ids))
            at += length
        assert at == len(ids)
    assert not by_doc
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing_odd_rows(documents, odd_rows, tokens):
    rows = [r for r in odd_rows if r[0] is not None]
    pieces = packing.pack_documents(documents(rows)).collect()
    assert check_packing(pieces, [r[:2] for r in rows], tokens, 2048) <= 2048
    assert packing.pack_documents(documents([])).count() == 0


def test_null_ids_are_packed_too(documents, odd_rows):
    pieces = packing.pack_documents(documents(odd_rows)).filter("doc_id IS NULL").collect()
    assert sorted(p["doc_tokens"] for p in pieces if p["start"] == 0)[0] == 1


def test_little_padding_over_many_tasks(documents, tokens):
    rng = random.Random(5)
    rows = [(i, " ".join(f"t{rng.randint(0, 99)}" for _ in range(rng.randint(0, 400))), "en", "a") for i in range(300)]
    pieces = packing.pack_documents(documents(rows).repartition(7), capacity=256, grid=16).collect()
    padding = check_packing(pieces, [r[:2] for r in rows], tokens, 256)
    assert padding < 0.02 * sum(p["length"] for p in pieces)


def test_cut_lengths():
    assert packing.cut_lengths(5000, 2048, 32) == [2048, 2048, 512, 256, 128, 8]
    for total in range(1, 5000, 7):
        lengths = packing.cut_lengths(total)
        assert sum(lengths) == total and min(lengths) > 0 and max(lengths) <= 2048


def test_mixed_lengths_in_a_class(spark):
    """The general operator takes pieces of any length: bins hold a fixed count per class."""
    rng = random.Random(6)
    rows = [(i, 0, rng.randint(1, 100), 0, 0) for i in range(500)]
    rows = [(*r, 100 // r[2], i % 3) for i, r in enumerate(rows)]
    numbers, seen = [], Counter()
    for r in rows:
        numbers.append((*r, seen[r[5], r[6]]))
        seen[r[5], r[6]] += 1
    out = packing.pack(spark.createDataFrame(numbers, packing.PIECES), 100).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(500))
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append(r)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 100


def edited(text, edits):
    for start, length, new in edits:
        start = min(max(start or 0, 0), len(text))
        text = text[:start] + (new or "") + text[start + max(length or 0, 0) :]
    return text


def test_recounts_equal_whole_encodings(spark, documents, odd_rows, tokens):
    rng = random.Random(7)
    rows = [(i, t) for i, t, _, _ in odd_rows] + [(100 + i, random_text(rng, 900)) for i in range(20)]
    kind = "array<struct<start:int,length:int,text:string>>"
    plan = []
    for number, (i, text) in enumerate(rows):
        size, edits = len(text or ""), []
        for _ in range(rng.randint(0, 6)):
            edits.append((rng.randint(-2, size + 5), rng.choice([0, 1, 3, 700]), rng.choice([None, "", " ", "x", "\n", random_text(rng, rng.choice([3, 2000]))])))
        plan.append((number, i, text, edits if number != 2 else None))
    df = spark.createDataFrame(plan, f"number long, doc_id long, text string, edits {kind}")
    trees = recount.build_trees(df.withColumn("doc_id", F.col("number"))).join(df.select(F.col("number").alias("doc_id"), "edits"), "doc_id")
    for r in recount.apply_edits(trees).collect():
        _, _, text, edits = plan[r["doc_id"]]
        after = edited(text or "", edits or [])
        assert r["text"] == after and r["tokens_before"] == len(tokens(text)) and r["n_tokens"] == len(tokens(after))
        assert r["token_tree"][1] == r["n_tokens"] and r["char_tree"][1] == len(after)


def test_small_edits_encode_little(spark, documents, odd_rows):
    trees = recount.build_trees(documents(odd_rows)).filter("doc_id = 5").withColumn("edits", recount.sample_edits(F.col("text")))
    row = recount.apply_edits(trees).first()
    assert row["encoded_chars"] < 0.02 * len(row["text"])
    assert recount.build_trees(documents([])).count() == 0


def test_queries(spark, tokens):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    start = 0
    for r in tokenfiles.op3_token_files(spark, sf_dir).orderBy("doc_id").collect():
        ids = [*tokens(docs[r["doc_id"]]), 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert check_packing(packing.op4_packing(spark, sf_dir).collect(), list(docs.items()), tokens, 2048) < 2048
    for r in recount.op5_token_counts(spark, sf_dir).collect():
        text = docs[r["doc_id"]] or ""
        n = len(text)
        span = text[n // 4 : n // 4 + 12]
        after = edited(text, [(n // 4, 12, span + span), (n // 2, 0, text[:40]), (max(n - 20, 0), 20, "")])
        assert (r["n_tokens"], r["edited_tokens"], r["edited_chars"]) == (len(tokens(text)), len(tokens(after)), len(after))


def test_ids_beyond_doubles_beside_null_ids(spark, documents):
    ids = [None, 2**53 + 1, 2**53 + 3, -(2**62) - 1, None]
    pieces = packing.pack_documents(documents([(i, f"few words {n}", "en", "a") for n, i in enumerate(ids)])).collect()
    assert sorted({r["doc_id"] for r in pieces}, key=str) == sorted(set(ids), key=str)
