"""WARC round trip and BPE against the tokenizers library."""

import gzip
import hashlib
import struct

import pytest
from helpers import awkward_texts, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabready.llm import bpe, warc
from tabready.llm.common import scratch_path
from tabready.llm.queries import vocabulary


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS refers_to", "'y' AS digest")


def test_round_trip(spark):
    big = "<p>é" * 400
    rows = [(1, "http://a/\r\nx", big), (2, None, big), (7, "http://c", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""),
            (8, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (7, "http://c", big), (None, "u", big), (None, "u", "z" * 2000)]
    got = sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc.round_trip(pages(spark, rows)).collect())
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = len(data) >= 1000 and h == big and i != 7
        want.append((i if i is not None else -1, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    assert got == sorted(want, key=lambda x: x[:3])


def test_payloads_come_back_and_files_are_gzip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "text %d " % i * (i * 50)) for i in range(60)]
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages(spark, rows).repartition(3), path)
    got = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, path).collect()}
    assert got == {f"urn:x-page:{i}": h.encode() for i, _, h in rows}
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert b"".join(map(gzip.decompress, files)).count(b"WARC/1.1\r\n") == 60


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_member_longer_than_its_last_byte():
    data = b"q" * (17 << 20)
    assert warc.member(data)[-1] == 0
    assert b"".join(warc.Members(warc.member(data) + warc.member(b"x"))) == data + b"x"


def test_broken_records():
    good = warc.record("urn:a", "http://a", b"hello")
    assert warc.parse(good)["payload"] == b"hello"
    for broken in (good.replace(b"hello", b"jello"), good[:-3], good + b"x", b"HTTP" + good,
                   good.replace(b"Content-Length: ", b"Content-Length: x", 1).replace(b"Content-Length: ", b"Content-Length: x")):
        with pytest.raises(warc.WarcError):
            warc.parse(broken)
    with pytest.raises(warc.WarcError):
        list(warc.Members(warc.member(good)[:-20]))


@pytest.fixture(scope="module")
def both():
    return Tokenizer.from_file(vocabulary()), bpe.load(vocabulary())


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=50), st.text(alphabet="aeinrst'lvdm <|>endoftx2ΣİßÉ\x85\x1c\n", max_size=80)))
def test_same_as_library(both, text):
    library, own = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_rank_tree_is_leftmost_lowest():
    import random

    rng = random.Random(3)
    for _ in range(200):
        ranks = [rng.choice([bpe.NO_PAIR, *range(5)]) for _ in range(rng.randint(1, 20))]
        tree = bpe.RankTree(ranks[:])
        for _ in range(10):
            low = min(ranks)
            assert tree.first_lowest() == (-1 if low == bpe.NO_PAIR else ranks.index(low))
            k, v = rng.randrange(len(ranks)), rng.choice([bpe.NO_PAIR, *range(5)])
            ranks[k] = v
            tree.put(k, v)


def test_short_words_need_no_tree(both, monkeypatch):
    """Nearly all words are short: a tree a word cost more than the merges themselves."""
    library, own = both
    words = ["a", "thstinnthalyti", "überheitschkeiten", "x" * bpe.SHORT_WORD]
    monkeypatch.setattr(bpe, "RankTree", None)
    for word in words:
        assert own.merge_word(word) == library.encode(word, add_special_tokens=False).ids
    with pytest.raises(TypeError):
        own.merge_word("x" * (bpe.SHORT_WORD + 1))


@settings(max_examples=300, deadline=None)
@given(word=st.text(alphabet="aeinrsthßé", min_size=1, max_size=150))
def test_long_words_merge_as_short_ones_do(both, word):
    library, own = both
    ids = [own.inner[b] for b in word.encode()[:-1]] + [own.last[word.encode()[-1]]]
    assert own._merge_short(ids[:]) == own._merge_long(ids[:])
    assert own.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_digests(spark, both):
    library, _ = both
    texts = awkward_texts() + ["<|startoftext|> a <|endoftext|>"]
    docs = table(spark, texts)
    rows = bpe.digest_texts(docs, vocabulary()).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[10 + i].n_tokens == len(ids)
        assert got[10 + i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[10 + i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    full = {r.doc_id: r for r in bpe.encode_texts(docs, vocabulary()).collect()}
    assert full[13].ids == library.encode("one", add_special_tokens=False).ids
    assert bpe.digest_texts(docs.where("false"), vocabulary()).count() == 0


def test_words_go_when_a_task_ends():
    """Workers are shared by all stages: a task leaves the vocabulary behind, not the words of its texts."""
    text = awkward_texts()[5]
    with bpe.tokenizer(vocabulary()) as own:
        ids = own.encode(text)
        assert own._kept
    assert not own._kept and not own._before
    with bpe.tokenizer(vocabulary()) as again:
        assert again is own and again.encode(text) == ids
    with pytest.raises(ZeroDivisionError), bpe.tokenizer(vocabulary()) as own:
        assert own.encode(text) == ids
        1 / 0  # noqa: B018
    assert not own._kept
