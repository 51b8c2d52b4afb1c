"""Encoding and decoding against the tokenizers library, on the same vocabulary file."""

import hashlib
import json
import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradmesh.llm import word_bpe as B
from gradmesh.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aAbBéÉ ΣσςİıßẞǺ̧ͅ'sS'RE\t\n​\u0085\x1c1２३²Ⅷ漢字한국😀👍🏽՘Ᲊﬁ①-_,.!?ǅ"
TEXTS = [
    "", " \n", "Hello, world! It's 12.5", "ΑΣ ΑΣΑ Σ", "<|startoftext|>Hi<|endoftext|><|ENDOFTEXT|> <|endoftext", "a" * 5000, "xy" * 3000 + "é" * 999, "we'll they've I'm 'S --'s 'x",
    "ab'" * 40, "\U0001fae9 ꟎\U00016ea0 new signs", "é é", "각", "a\x1cb\x1fc", "Ⅷ²½ ٣", "word " * 3000,
]


def odd_texts(n):
    random.seed(9)
    for k in range(n):
        text = "".join(random.choice(SIGNS) for _ in range(random.randint(0, 24)))
        if k % 5 == 0:
            text = text.replace("a", "<|startoftext|>")
        if k % 3 == 0:
            text = "".join(chr(random.choice([random.randint(0, 0x2FFF), random.randint(0, 0xD7FF), random.randint(0xE000, 0x10FFFF)])) for _ in range(12))
        yield text


def test_equals_the_library():
    library, bpe = Tokenizer.from_file(PATH), B.WordBPE(PATH, cached=50)  # a cache that is turned over
    for text in [*TEXTS, *odd_texts(8000)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == ids, text
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert len(bpe) <= 50 and len(bpe.older) <= 50


def test_every_character_alone():
    library, bpe = Tokenizer.from_file(PATH), B.WordBPE(PATH)
    signs = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(signs), 4096):
        texts = [f"a{s}b1{s}{s}-" for s in signs[at : at + 4096]]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert bpe.encode(text) == want.ids, hex(ord(text[1]))


def test_merges_follow_rank_then_place():
    """Against the plain rule: again and again the lowest rank, leftmost first."""
    bpe = B.WordBPE(PATH)
    rank = {(a, b): r for a, f in enumerate(bpe.follow) for b, r in f.__self__.items()}

    def plain(symbols):
        while ranked := [(rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in rank]:
            r, i = min(ranked)
            symbols = symbols[:i] + [bpe.results[r]] + symbols[i + 2 :]
        return symbols

    random.seed(2)
    for _ in range(2000):
        symbols = [random.choice(bpe.inner[97:105]) for _ in range(random.randint(1, 30))]
        assert B.merged([*symbols], bpe.follow, bpe.results) == plain(symbols)


def test_frames(spark):
    rows = [(k, t, "x", k) for k, t in enumerate([None, *TEXTS])] + [(None, "null id", "x", 0), (3, TEXTS[2], "x", 0), (2**60 + 1, "far", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n int").repartition(3)
    bpe = B.WordBPE(PATH)
    want = sorted(((i, bpe.encode(t or ""), bpe.decode(bpe.encode(t or ""))) for i, t, *_ in rows), key=str)
    both = B.encoded(docs, PATH, with_decoded=True)
    assert sorted(((r["doc_id"], r["ids"], r["text"]) for r in both.collect()), key=str) == want
    again = B.decoded(B.encoded(docs, PATH), PATH)
    assert sorted(((r["doc_id"], r["text"]) for r in again.collect()), key=str) == [(i, t) for i, _, t in want]
    assert B.encoded(docs.limit(0), PATH).count() == 0
    odd = spark.createDataFrame([(1, [10**6, 320]), (2, None)], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in B.decoded(odd, PATH).collect()} == {1: bpe.strings[320], 2: ""}


def test_query_digests(spark):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op13_word_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids, r = library.encode(d["text"], add_special_tokens=False).ids, got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_vocabulary_file_needs_nothing_else(tmp_path):
    """A small vocabulary made by hand: the path is a parameter."""
    signs = B.byte_signs()
    vocab = {s: i for i, s in enumerate(signs + [s + "</w>" for s in signs] + ["ab", "abc</w>"])}
    made = {"added_tokens": [], "model": {"vocab": vocab, "merges": [["a", "b"], ["ab", "c</w>"]]}}
    (tmp_path / "v.json").write_text(json.dumps(made))
    bpe = B.WordBPE(str(tmp_path / "v.json"))
    assert [bpe.strings[i] for i in bpe.encode("ABC abab")] == ["abc</w>", "ab", "a", "b</w>"]
