"""Token-id files and packing: exact round trips."""

import random
import zlib

import numpy as np
import pytest

from turnfold.llm import idcoder, idfile, packing, queries
from turnfold.llm.idtokens import Encoder, tokenizer_path
from turnfold.session import scratch_path

from .conftest import SF_BIG


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def plain_ids(encoder, texts, end):
    return [e.ids + [end] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_encode_as_whole_texts(encoder):
    rng = random.Random(3)
    texts = ["", "  a  b", "a\n\n\nb c\n", "\ta b\t\n c", "don't 'll  x's y", "a \n b \n\n  c", "<|endoftext|> q", "x\x1cy !\x1cz"]
    texts += ["".join(rng.choice(" \n\t ab'1.é日s \x85 !") for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    ids, n = encoder.encode(texts)
    ends = np.cumsum(n)
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [w.ids for w in want]


def test_added_tokens_as_by_the_library(encoder):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokenizer_path())
    texts = ["x <|endoftext|> y", "a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|>\n<|endoftext|> <|endoftext| >", "plain words", ""]
    ids, n = encoder.encode(texts)
    ends = np.cumsum(n)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[:n[0]].tolist() == [87, 220, 50256, 331]


def test_encoder_forgets_when_full(encoder, monkeypatch):
    import turnfold.llm.idtokens as m

    monkeypatch.setattr(m, "REMEMBERED", 3)
    for text in ("a b c d e f", "g h i j k l", "a b c d e f"):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["random", "zipf", "runs", "edges"])
def test_coder_round_trip(kind):
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 63, 64, 65, 700, 4096]
    make = {"random": lambda n: rng.integers(0, 65_536, n), "zipf": lambda n: np.minimum(rng.zipf(1.3, n), 65_535),
            "runs": lambda n: np.repeat(rng.integers(0, 50_257, n // 8 + 1), 8)[:n],
            "edges": lambda n: rng.choice([0, 3, 4, 255, 256, 1279, 1280, 5375, 5376, 65_535], n)}[kind]
    blocks = [make(n).astype(np.uint32) for n in sizes]
    coded = idcoder.encode_blocks(blocks)
    for got, want in zip(idcoder.decode_blocks(coded), blocks, strict=True):
        assert (got == want).all() and len(got) == len(want)
    # any block alone, in any order
    assert (idcoder.decode_blocks([coded[6]])[0] == blocks[6]).all()
    if kind in ("zipf", "runs"):
        assert len(coded[-1]) < 2 * sizes[-1]


def test_coder_tells_damage():
    block = idcoder.encode_blocks([np.arange(500, dtype=np.uint32)])[0]
    for bad in (block[:10], block[:-4], b"XXXX" + block[4:], block[:40] + bytes([block[40] ^ 1]) + block[41:]):
        with pytest.raises(ValueError):
            idcoder.decode_blocks([bad])
    with pytest.raises(ValueError):
        idcoder.encode_blocks([np.array([70_000], np.uint32)])


def test_carry_runs_through_full_words():
    words = np.array([[1, 2**32 - 1, 2**32 - 1, 0]], np.uint32)
    idcoder._carry(words, np.array([3]), np.array([0]))
    assert words.tolist() == [[2, 0, 0, 0]]


def test_crc_shift():
    x, y = bytes(range(200)), bytes(range(50, 250)) * 70
    assert zlib.crc32(x + y) == idfile.crc_shift(zlib.crc32(x), len(y)) ^ zlib.crc32(y)


def test_op1_is_the_plain_encoding(spark, encoder):
    docs = spark.read.parquet(f"{SF_BIG}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in queries.op1_token_ids(spark, SF_BIG).collect()}
    start = 0
    for d, ids in zip(docs, plain_ids(encoder, [d["text"] for d in docs], 0), strict=True):
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


def test_file_of_odd_rows(spark, odd_rows, no_rows, encoder):
    folder = scratch_path(spark, "odd-ids")
    idfile.write_documents(odd_rows, folder, shard_rows=4, block=512)
    rows = odd_rows.collect()
    got = idfile.read_documents(spark, folder).collect()
    ids = plain_ids(encoder, [r["text"] for r in rows], 0)
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))
                  for r, i in zip(rows, ids, strict=True))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    place = 0  # starts are gapless and ascend with the key, null first
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    back = idfile.read_ids(spark, folder).collect()
    long_doc = sorted((r for r in back if r["doc_id"] == 11), key=lambda r: r["doc_start"])
    assert [i for r in long_doc for i in r["ids"]] == ids[11]
    empty = scratch_path(spark, "no-ids")
    idfile.write_documents(no_rows, empty)
    assert idfile.read_documents(spark, empty).count() == 0


def test_differencing_is_balanced_and_fits():
    rng = np.random.default_rng(2)
    assert sorted(np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    for n in (1, 2, 40, 900):
        sizes = rng.integers(1, 513, n)
        window = packing.pack_sizes(sizes)
        sums = np.bincount(window, weights=sizes)
        assert sums.max() <= packing.WINDOW and len(sums) <= -(-sizes.sum() // packing.WINDOW) * 1.05 + 2


def check_packing(rows, ids_of):
    """Each id in exactly one piece, sequences gapless from 0 and not too long."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= packing.WINDOW
    for doc, own in pieces.items():
        variants = ids_of[doc]
        for ids in {tuple(v) for v in variants}:
            mine = [r for r in own if r["doc_tokens"] == len(ids)]
            assert mine
            for r in mine:
                part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
                if sum(len(v) == len(ids) for v in variants) == variants.count(list(ids)):
                    assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        assert sum(r["length"] for r in own) == sum(map(len, variants))
    return sequences


def test_op8_against_plain_ids(spark, encoder):
    docs = spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()
    ids_of = {d["doc_id"]: [ids] for d, ids in zip(docs, plain_ids(encoder, [d["text"] for d in docs], 1), strict=True)}
    rows = queries.op8_pack_sequences(spark, SF_BIG).collect()
    sequences = check_packing(rows, ids_of)
    assert {r["doc_id"] for r in rows} == set(ids_of)
    total = sum(len(v[0]) for v in ids_of.values())
    assert len(sequences) * packing.WINDOW < 1.03 * total


def test_packing_of_odd_rows(spark, odd_rows, no_rows, encoder):
    rows = odd_rows.collect()
    ids_of = {}
    for r, ids in zip(rows, plain_ids(encoder, [r["text"] for r in rows], 1), strict=True):
        ids_of.setdefault(r["doc_id"], []).append(ids)
    check_packing(packing.pack_documents(odd_rows, group=8).collect(), ids_of)
    assert packing.pack_documents(no_rows).count() == 0
