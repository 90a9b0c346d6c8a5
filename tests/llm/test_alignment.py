"""Token alignment against a token-by-token version."""

import collections
import hashlib
import json

import sentencepiece
from tokenizers import Tokenizer

from turnfold.llm import alignment, queries
from turnfold.llm.idtokens import tokenizer_path

from .conftest import SF


def tokens_of(texts):
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    alphabet = alignment.byte_level_alphabet()
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        names = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    for text in texts:
        a, b = [], []
        if text:
            ids = tok.encode(" " + text, add_special_tokens=False).ids
            a = [(i, bytes(alphabet[c] for c in names[i])) for i in ids]
            for i in model.encode(text):
                piece = model.id_to_piece(i)
                raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
                b.append((i, raw))
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a, b = [], []
        yield a, b


def brute(texts):
    rows, corpus = [], collections.Counter()
    for a, b in tokens_of(texts):
        groups, links, i, j = [], [], 0, 0
        at_a = at_b = 0
        ga, gb = [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b and i < len(a):
                ga.append(a[i][0])
                at_a += len(a[i][1])
                i += 1
            else:
                gb.append(b[j][0])
                at_b += len(b[j][1])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                links.append((ga[-1], gb[-1]))
                ga, gb = [], []
        corpus.update(links)
        rows.append((len(a), len(b), groups, links))
    top = collections.Counter()
    for (_, y), n in corpus.items():
        top[y] = max(top[y], n)
    return [(na, nb, len(g), len(x), sum(corpus[p] == top[p[1]] for p in x), sum(corpus[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, g, x in rows]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op13_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = collections.Counter((d["doc_id"], *r) for d, r in zip(docs, brute([d["text"] for d in docs]), strict=True))
    got = collections.Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in queries.op13_token_alignment(spark, SF).collect())
    assert got == want
    assert sum(r[4] for r in want) > 0


def test_odd_texts(spark, odd_rows, no_rows, monkeypatch):
    more = ["▁ piece mark", "x <|endoftext|> y <s> </s> <0x41>", "tab\tand\r\n\x00 null", " lead", "日本語 emoji 👩‍👩‍👧", "á é", "  "]
    docs = odd_rows.select("doc_id", "text", "node").unionByName(
        spark.createDataFrame([(100 + i, t, None) for i, t in enumerate(more)], "doc_id long, text string, node string"))
    rows = docs.collect()
    want = collections.Counter((d["doc_id"], *r) for d, r in zip(rows, brute([d["text"] for d in rows]), strict=True))
    got = collections.Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in alignment.align_documents(docs).collect())
    assert got == want
    assert next(r for r in want if r[0] == 100)[1:] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.align_documents(no_rows).count() == 0


def test_a_blank_at_the_end_is_a_token(spark):
    texts = ["a ", "two words ", " ", "é ", "x " * 700, "line\n ", "a  ", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = collections.Counter((i, *r) for i, r in enumerate(brute(texts)))
    got = collections.Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in alignment.align_documents(docs).collect())
    assert got == want
    assert all(r[4] > 0 for r in want if r[0] < 7)


def test_counts_over_many_blocks(spark, monkeypatch):
    """Blocks of one text each: pairs are counted over all of them."""
    monkeypatch.setattr(alignment, "slices_by", lambda sizes: ((i, i + 1) for i in range(len(sizes))))
    monkeypatch.setattr(alignment, "SLICES", 1)
    texts = ["the cat and the dog ", "the dog", "the cat", "", None, "the dog ran"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = collections.Counter((i, *r) for i, r in enumerate(brute(texts)))
    got = collections.Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in alignment.align_documents(docs).collect())
    assert got == want


def test_slices_hold_every_text_once():
    texts = ["abc", None, "x" * 50, "", "yy"]
    cut = list(alignment.slices_of(texts, 10))
    assert [i for lo, hi in cut for i in range(lo, hi)] == list(range(5))
    assert (2, 3) in cut or any(hi - lo == 1 and lo == 2 for lo, hi in cut)
