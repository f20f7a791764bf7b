"""The prefix encoder against two public libraries; edits against encoding anew."""

import base64
import os
import random

import pytest
import tiktoken
from tokenizers import Tokenizer

from phasemill.llm import tokens
from phasemill.llm.tokens import PATTERN, TOKENIZERS, EditableEncoding, encode_corpus, load_bpe

pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizer files")
HARD = ["", " ", "\n\n  x", "don't WE'LL they've'd", "a" * 3000, " " * 700 + "b", "\t\r\n", "naïve café ½ №", "漢字かな交じり文。", "🙂👩‍🌾🏞️", "x\u0000\u0007\x1b[0m", "<|endoftext|> <unk>", "​‍﻿", "1234567890" * 60, "ab" * 2000 + "'s", "مرحبا ‫متن‬", "}}{{[[|]]", "é́"]


def reference(name="byte_bpe_50k"):
    with open(f"{TOKENIZERS}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed, n=300):
    rng = random.Random(seed)
    return HARD + ["".join(rng.choice("abcdeEstTh ,.'\n\t0189éß漢🙂") for _ in range(rng.randint(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_encoder(name):
    mine, ref = load_bpe(name), reference(name)
    for t in texts(1):
        assert mine.encode(t) == ref.encode_ordinary(t), t


def test_encoder_equals_the_json_form():
    other = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    for t in texts(2, 100):
        assert load_bpe().encode(t) == other.encode(t, add_special_tokens=False).ids, t


def test_every_prefix_has_its_last_token():
    bpe, ref, data = load_bpe(), reference(), b"internationalisation"
    last = bpe.extend(data, [])
    for i in range(1, len(data) + 1):
        assert bpe.walk(last[:i]) == ref.encode_ordinary(data[:i].decode())


@pytest.mark.parametrize("seed", range(4))
def test_edits(seed):
    rng, bpe, ref = random.Random(seed), load_bpe(), reference()
    pick = lambda n: "".join(rng.choice("ab 'slre \n9漢.tTh") for _ in range(n))
    e = EditableEncoding(bpe, pick(rng.randint(0, 200)))
    for _ in range(60):
        i = rng.randint(0, len(e.text))
        j = min(len(e.text), i + rng.choice([0, 0, 1, 4, 30]))
        e.replace(i, j, pick(rng.choice([0, 1, 5, 20])))
        assert e.ids() == ref.encode_ordinary(e.text)


def test_edits_are_local():
    e = EditableEncoding(load_bpe(), "the quick brown fox " * 500)
    e.replace(5000, 5005, "lazy")
    assert 0 < e.recoded < 60
    e.append(" jumps")
    assert 0 < e.recoded < 60


def test_corpus(spark, monkeypatch):
    rows = [(i, t, "s") for i, t in enumerate(texts(3, 200))] + [(9_000, None, None), (9_001, "", "s"), (0, "again", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ref = reference()
    got = encode_corpus(df.repartition(3), ["doc_id"], "text")
    assert dict(got.dtypes) == {"doc_id": "bigint", "ids": "array<int>"}
    want = sorted((i, ref.encode_ordinary(t or "")) for i, t, _ in rows)
    assert sorted((r["doc_id"], r["ids"]) for r in got.collect()) == want
    counts = encode_corpus(df, ["doc_id"], "text", count_only=True)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in counts.collect()) == sorted((i, len(x)) for i, x in want)
    assert encode_corpus(df.limit(0), ["doc_id"], "text").count() == 0


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 50)
    monkeypatch.setattr(tokens, "CACHED_PAIRS", 50)
    bpe, ref = tokens.PrefixBPE(load_bpe().ranks), reference()
    for t in texts(4, 100):
        assert bpe.encode(t) == ref.encode_ordinary(t)
    assert 0 < len(bpe._pieces) <= 50 and 0 < len(bpe._pairs) <= 50
