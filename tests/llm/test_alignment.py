"""Cross-tokenizer alignment against both libraries and a plain count of overlaps."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabready.llm import token_alignment
from tests.llm.helpers import awkward_texts, table

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["two  spaces", " leading", "trailing ", "   ", " ", "a\n\nb\t c \n", "x▁y", "▁", "<|endoftext|> plain <s> </s> text",
       "naïve café — “quotes” … ﬁ ½", "日本語のテキスト、改行\nなし", "é   　 x", "\x00\x01 \x7f", "😀👍🏽 flags 🇩🇪",
       "\U0001fae8 new ͸ none", "don't we'LL 123 4567 8.90%", "word " * 3000, "tab\tsep\r\nline", "­​ zero", "the the the"]


def side(ids, token_bytes):
    spans, at = [], 0
    for i in ids:
        spans.append((i, at, at + len(token_bytes(i))))
        at += len(token_bytes(i))
    return spans, b"".join(map(token_bytes, ids))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = [x for x in range(256) if x not in plain]
    byte = {**{chr(x): x for x in plain}, **{chr(256 + k): x for k, x in enumerate(extra)}}
    a_bytes = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: side(a.encode(" " + t, add_special_tokens=False).ids, a_bytes), lambda t: side(b.encode(t), b_bytes)


def brute(texts, libraries):
    rows, linked = [], []
    for t in texts:
        (a, a_text), (b, b_text) = ([x(t) for x in libraries] if t else [([], b""), ([], b"")])
        if not t or a_text != b_text or a_text != (" " + t).encode():
            a, b = [], []
        links, j = [], 0
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, ga, gb = [], iter(a), iter(b)
        for c in cuts:
            parts = []
            for it in (ga, gb):
                own = []
                for i, _, e in it:
                    own.append(str(i))
                    if e == c:
                        break
                parts.append(",".join(own))
            groups.append("|".join(parts))
        rows.append([len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
        linked.append(links)
    n = Counter(p for links in linked for p in set(links))
    most = {}
    for (a, _), k in n.items():
        most[a] = max(most.get(a, 0), k)
    return [(r[0], r[1], r[2], len(x), sum(n[p] == most[p[0]] for p in x), sum(n[p] for p in x), r[3]) for r, x in zip(rows, linked)]


def got(df):
    return [tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 700])
def test_equals_brute_force(spark, libraries, monkeypatch, chunk_bytes):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(token_alignment, "KEPT_STRETCHES", 50)
    texts = awkward_texts() + ODD
    df = table(spark, texts).repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = [(i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], libraries))]
    assert sorted(map(str, got(token_alignment.align_tokenizers(df, *PATHS)))) == sorted(map(str, want))
    assert sum(w[1] == 0 for w in want) >= 4


def test_whole_table(spark, libraries):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    want = [(r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows], libraries))]
    assert sorted(got(token_alignment.align_tokenizers(df, *PATHS))) == sorted(want)


def test_empty_table(spark):
    assert got(token_alignment.align_tokenizers(table(spark, []), *PATHS)) == []


def test_pieces_across_spaces_are_an_error():
    v = token_alignment.load(*PATHS)
    assert all(b" " not in x.lstrip(b" ") for x in v.bytes[1].to_pylist())
