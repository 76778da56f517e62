import base64
import hashlib

import public_tokenizers
import tiktoken

from sundial.llm import bpe
from sundial.llm.queries import BPE_PATTERN, BPE_RANKS

TEXTS = ["", "a", "  hello   world\n\n  x \t\r\n y", "don't we'll 's ''s", "x" * 3000, "ab" * 70, "\x1c\x1d a\x1c b", "\xa0\xa0a   b", "日本語 テスト 123abc١٢",
         "é \U0001f600\U0001f600", " \n \n", "a​b", "'re're", "᠎ x", "hello hello hello", None]


def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(spark):
    expected = reference()
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, decoding string")
    rows = bpe.decode(bpe.encode(df, BPE_RANKS, BPE_PATTERN), BPE_RANKS, BPE_PATTERN).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id] or ""
        assert list(r.token_ids) == expected.encode_ordinary(text) and bytes(r.decoded) == text.encode() and r.decoding == "kept"
    for r in bpe.digests(df, BPE_RANKS, BPE_PATTERN).collect():
        ids = expected.encode_ordinary(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()


def test_single_and_many_merges_agree():
    own = bpe.codec(BPE_RANKS, BPE_PATTERN)
    pieces = [w.encode() for w in ("onhehe", "thntion", "zzzzzzzz", "qwxyzkjhgf", "éèêëñ", "1234567890123")]
    for piece in pieces:
        many = bpe.merge_many([piece], own.letters, own.table)[0]
        assert list(memoryview(many).cast("i")) == bpe.merge(piece, {k: v for k, v in own.ranks.items() if k != piece}, own.table.one) or piece in own.ranks


def test_remembered_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own, expected = bpe.Codec(BPE_RANKS, BPE_PATTERN), reference()
    for n in range(20):
        text = f"word{n} again word{n - 1} a b c d e"
        assert own.encode(text) == expected.encode_ordinary(text)
        assert len(own.runs.new) <= 4 and len(own.runs.old) <= 4


def test_few_pieces_are_merged_at_once(monkeypatch):
    seen, merged = [], bpe.merge_many
    monkeypatch.setattr(bpe, "merge_many", lambda pieces, *rest: seen.append(len(pieces)) or merged(pieces, *rest))
    own, expected = bpe.Codec(BPE_RANKS, BPE_PATTERN), reference()
    text = " ".join(f"zq{i}xk{chr(97 + i % 26)}w{chr(97 + i // 26 % 26)}vq{chr(97 + i // 676 % 26)}jx" for i in range(9000))
    assert own.encode(text) == expected.encode_ordinary(text)
    assert 1 < len(seen) and max(seen) <= 4096


def test_empty_table_and_taken_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, BPE_RANKS, BPE_PATTERN).count() == 0
    try:
        bpe.encode(spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, Token_Ids string"), BPE_RANKS, BPE_PATTERN)
    except ValueError:
        return
    raise AssertionError("a column of that name must be refused")
