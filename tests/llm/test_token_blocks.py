import random
import zlib

import numpy as np
import pytest

from stallwise.llm import token_blocks as tb


def library(special_as_text=False):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tb.tokenizer_json())
    tokenizer.encode_special_tokens = special_as_text
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def plain():
    return library()


@pytest.mark.parametrize("top", [0, 1, 2, 100, 50257, 2**31, 2**60 - 1, 2**64 - 1])
def test_pack_and_back(top):
    rnd = random.Random(top)
    for n in (0, 1, 2, 59, 60, 61, 1000):
        values = np.array([rnd.randint(0, top) if rnd.random() < 0.3 else rnd.randint(0, min(top, 3)) for _ in range(n)], dtype=np.uint64)
        words, escapes = tb.pack(values)
        assert (tb.unpack(words, escapes) == values).all()
        assert len(escapes) == (values >= 2**60).sum()
        assert len(words) <= max(n, 1)


def test_words_are_full():
    words, _ = tb.pack(np.ones(6000, dtype=np.uint64))
    assert len(words) == 100
    words, _ = tb.pack(np.full(4000, 30000, dtype=np.uint64))
    assert len(words) == 1000


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "\n\n a\t b", "it's 'tis ' s", "été à l'é 12 34,5 !!", "x y  z",
    "a \x1c b", "a  b  c", "<|endoftext|> a <|endoftext|>", "日本 語 🙂 🙂🙂", "Ġ Ġa aĠ", "a" * 300 + " " + " b" * 400, "end. \n",
    "\u0085 x \u0085", "a ​ b", "q\r\n r",
]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_pieces_equal_the_tokenizer(special_as_text, monkeypatch):
    plain = library(special_as_text)
    monkeypatch.setattr(tb, "_STRETCH", 97)
    rnd = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "ab", "Cd's", "12", "…", "é", "'", " ", "🙂", "the", "<|endoftext|>", "Ġ", "\x1f"]
    texts = TEXTS + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 200))) for _ in range(400)]
    encoder = tb.Encoder(tb.defined(tb.tokenizer_json(), special_as_text))
    assert encoder.by_pieces
    assert (50256 in encoder.encode(["hello <|endoftext|> world"])[0]) != special_as_text
    for at in range(0, len(texts), 37):
        some = texts[at : at + 37]
        assert [x.tolist() for x in encoder.encode(some)] == [plain(t) for t in some]
    for text in texts[:60]:
        assert encoder.encode([text])[0].tolist() == plain(text)


def test_whole_texts_with_another_tokenizer():
    encoder = tb.Encoder(tb.defined(tb.tokenizer_json("word_bpe_49k.json")))
    assert not encoder.by_pieces
    assert encoder.encode(["A  b"])[0].tolist() == encoder._plain("A  b").tolist()


def expected(rows, plain):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*plain(text or ""), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_tokenizer(spark, sf, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = tb.op3_token_output(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows, plain)


def test_odd_rows_and_small_blocks(spark, plain):
    rows = [(i * 7 % 50, t, "x") for i, t in enumerate(TEXTS)] + [(None, "n", "x"), (3, None, "x"), (3, "z", None), (3, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    blocks = tb.saved(tb.blocks_of(docs, tb.tokenizer_json(), block_ids=40), "t")
    assert blocks.count() > 3
    got = tb.digests_of(blocks).collect()
    want = expected([r[:2] for r in rows], plain)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    whole = {(r.start, tuple(r.ids)) for r in tb.documents_of(blocks).collect()}
    assert len(whole) == len(rows) and all(ids[-1] == 0 for _, ids in whole)
    none = tb.token_digests(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_widths_that_fit_nowhere_are_not_tried(monkeypatch):
    tried = set()

    class Bits(tuple):
        def __getitem__(self, selector):
            tried.add(selector)
            return super().__getitem__(selector)

    monkeypatch.setattr(tb, "BITS", Bits(tb.BITS))
    tb.pack(np.full(1000, 30000, dtype=np.uint64))
    assert min(tried) >= 10


def test_pack_takes_as_many_as_fit():
    rnd = random.Random(7)
    values = [rnd.choice([0, 1, 3, 60, 900, 30000, 2**40, 2**62]) if rnd.random() < 0.3 else rnd.randint(0, 7) for _ in range(3000)]
    at, words = 0, 0
    while at < len(values):
        fitting = [c for c, b in zip(tb.COUNTS[1:].tolist(), tb.BITS[1:]) if c <= len(values) - at and max(values[at : at + c]) < 1 << b]
        at, words = at + max(fitting, default=1), words + 1
    packed, escapes = tb.pack(np.array(values, dtype=np.uint64))
    assert len(packed) == words and tb.unpack(packed, escapes).tolist() == values


def test_known_words_are_not_encoded_again(plain):
    encoder = tb.Encoder(tb.defined(tb.tokenizer_json()))
    sent, joined = [], encoder._joined
    encoder._joined = lambda pieces: sent.extend(pieces) or joined(pieces)
    text = f"first of many, many words. {'x' * 65} été 日本 of"
    assert encoder.encode([text])[0].tolist() == plain(text)
    assert "words" in sent and len(sent) == len(set(sent))
    sent.clear()
    again = f"{text} and many new, words"
    assert encoder.encode([again])[0].tolist() == plain(again)
    assert sorted(sent) == sorted(["and", "new", "x" * 65])


def test_few_known_words(plain, monkeypatch):
    monkeypatch.setattr(tb, "KEPT_WORDS", 7)
    monkeypatch.setattr(tb, "KEPT_TAILS", 2)
    encoder = tb.Encoder(tb.defined(tb.tokenizer_json()))
    rnd = random.Random(11)
    bits = [*TEXTS, "often", "often,", "often.", "the", "été!", "a" * 70, *(f"w{i}." for i in range(9)), *(chr(97 + i) * 3 for i in range(9))]
    encoder.encode(["x often"])
    for _ in range(40):
        texts = [" ".join(rnd.choices(bits, k=rnd.randint(0, 12))) + " often" for _ in range(5)]
        assert [x.tolist() for x in encoder.encode(texts)] == [plain(t) for t in texts]
        assert all(len(k.lengths) == len(k.pieces) <= k.most and k.lengths.sum() == len(k.ids) for k in encoder.known)
    assert "often" in encoder.known[0].pieces.to_pylist()


def test_steps():
    rnd = random.Random(5)
    for n in (0, 1, 2, 31, 32, 33, 1000):
        for most in (1, 4, 60):
            sizes = np.array([rnd.randint(1, most) for _ in range(n)], dtype=np.int64)
            at, want = 0, []
            while at < n:
                want.append(at)
                at += int(sizes[at])
            assert tb._steps(sizes).tolist() == want
