import random
from hashlib import sha256

import public_tokenizers as P
import pytest
import tiktoken

from eventwatch.llm import bpe
from fixtures import empty, frame, rows

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.parse_ranks(bpe.load_ranks(PATH))


@pytest.fixture(scope="module")
def peer(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_tiktoken_on_random_texts(ranks, peer):
    m, rnd = bpe.MergeReplay(ranks, P.PATTERN), random.Random(1)
    alphabet = "aaaabcd   \n\t12'stéß漢字😀 \x1c\x00\x85 ñ́ABC<|>."
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 3000, " " * 2000, "ab" * 1500, "the" * 700 + "  ", "<|endoftext|>", "don't we'll"]
    for text, tokens in zip(texts, m.encode_batch(texts)):
        ids = [i for _, part, _ in tokens for i in part]
        assert b"".join(raw for *_, raw in tokens) == text.encode()
        assert " ".join(t for t, *_ in tokens) == " ".join(map(str, ids))
        assert ids == peer.encode_ordinary(text), text
        assert m.decode(ids) == text.encode()


def test_known_pieces_stay_bounded_and_right(ranks, peer, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 400)
    monkeypatch.setattr(bpe, "TEXT_BATCH", 50)
    m = bpe.MergeReplay(ranks, P.PATTERN)
    for text in [f"word{i} and more{i} of the same" for i in range(50)]:
        assert m.encode(text) == peer.encode_ordinary(text)
        assert len(m.known) <= 40


def test_round_trip_and_digests_in_spark(spark, peer):
    df = bpe.with_decoded(bpe.with_tokens(frame(spark), PATH, P.PATTERN), PATH, P.PATTERN)
    got = bpe.with_token_digest(df, PATH, P.PATTERN).select("doc_id", "text", "tokens", "decoded", "bpe.*").collect()
    assert len(got) == len(rows())
    for r in got:
        ids = peer.encode_ordinary(r.text or "")
        assert list(r.tokens) == ids and bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256((r.text or "").encode()).hexdigest()


def test_empty_table_and_unknown_id(spark, ranks):
    assert bpe.with_token_digest(empty(spark), PATH, P.PATTERN).count() == 0
    with pytest.raises(KeyError):
        bpe.MergeReplay(ranks, P.PATTERN).decode([10**9])


def test_query_equals_tiktoken(spark, peer):
    from eventwatch.llm import queries
    sf = "/root/testdata/sf0.001"
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    got = queries.op1_bpe(spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = peer.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == sha256((texts[r.doc_id] or "").encode()).hexdigest()
