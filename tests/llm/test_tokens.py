"""SentencePiece by chunks and packing against the libraries."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fundflow.llm import packing, sentencepiece_codec
from fundflow.llm.common import tokenizer_path

PIECES, WORDS = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("word_bpe_49k.json")
TEXTS = [None, "", " ", "  ", "a", "a ", "\n", "\n\n a\n", "a\n b  \n\nc▁d ▁ e", "▁", "▁▁x", "\t x\r\ny", "Ünï code 漢字 🙂 \x00 ​ é é ﬁ",
         "ΑΣ ΑΣ. İ it's I'LL 12,3 <|endoftext|>x a\xa0b \x1c z", "a" * 30_000, "word " * 3000, "one two", "one two",
         "THE END!! end|end <s> </s> <unk> <0x0A>"]
SCHEMA = "doc_id long, text string, n_tokens string, start int"


def table(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None), (3, "  ", "x", 1)], SCHEMA)


def expected_ids(sp, text):
    return [sp.bos_id(), *sp.encode(text or ""), sp.eos_id()]


def test_ids_and_decoding_as_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert sentencepiece_codec.codec(PIECES).by_chunk
    got = sentencepiece_codec.round_trip(table(spark), PIECES).collect()
    want = []
    for i, t in [*enumerate(TEXTS), (None, "no id"), (3, "  ")]:
        ids = expected_ids(sp, t)
        back = sp.decode(ids)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest(), back == (t or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    ids = sentencepiece_codec.encode_documents(table(spark), PIECES)
    assert sorted(r["ids"] for r in ids.collect()) == sorted(expected_ids(sp, t) for t in [*TEXTS, "no id", "  "])
    texts = sentencepiece_codec.decode_documents(ids, PIECES).collect()
    assert sorted(r["text"] for r in texts) == sorted(sp.decode(expected_ids(sp, t)) for t in [*TEXTS, "no id", "  "])


def test_full_table_changes_nothing():
    small, sp = sentencepiece_codec.ChunkCodec(PIECES, table_words=3), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(texts)] == [sp.encode(t) for t in texts]


def test_packing_covers_every_id_once(spark):
    library = Tokenizer.from_file(WORDS)
    docs = table(spark).repartition(2)
    got = packing.pack(docs, WORDS, window=64, with_ids=True).collect()
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64 and (at == 64 or at & (at - 1) == 0)  # no padding at all
    want = collections.Counter()
    for i, t in [*enumerate(TEXTS), (None, "no id"), (3, "  ")]:
        want[(i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2]))] += 1
    have = collections.Counter()
    for (i, _), rs in by_doc.items():
        rs = sorted(rs, key=lambda r: r["start"])
        if i == 3:  # the repeated row
            have[i, (2,)] += len(rs)
            continue
        assert [r["start"] for r in rs] == np.cumsum([0] + [r["length"] for r in rs[:-1]]).tolist()
        have[i, tuple(x for r in rs for x in r["ids"])] += 1
    assert have == want


@pytest.mark.parametrize("max_open", [1, 5, 10_000])
def test_sum_of_squares_placing(max_open):
    rng = np.random.default_rng(1)
    p = packing.Packer(32, max_open)
    sizes = rng.integers(1, 80, 400)
    for i, n in enumerate(sizes):
        before = p.counts.copy()
        was = p.n_open
        p.add(i, np.full(n, i, np.uint32))
        size = n % 32
        if size and max_open == 10_000:
            # Brute force over all levels: the sum of squared counts is the least possible.
            best = []
            for level in [0] + [h for h in range(1, 33 - size) if before[h]]:
                c = before.copy()
                if level:
                    c[level] -= 1
                if level + size < 32:
                    c[level + size] += 1
                best.append(int((c[1:32] ** 2).sum()))
            assert int((p.counts[1:32] ** 2).sum()) == min(best)
        assert p.n_open <= max(max_open, was)
    p.finish()
    fill, tokens = collections.Counter(), collections.Counter()
    for doc, _, ids, _, s, _ in p.out:
        fill[s] += len(ids)
        tokens[doc] += len(ids)
    assert [tokens[i] for i in range(400)] == sizes.tolist()
    assert all(f == 32 or f & (f - 1) == 0 for f in fill.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sentencepiece_codec.round_trip(none, PIECES).count() == 0
    assert packing.pack(none, WORDS).count() == 0


def library_ids(texts):
    return [np.array(x.ids, "<u4").tobytes() for x in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


def test_full_word_tables_change_no_ids():
    texts = [t or "" for t in TEXTS] + ["Don't STOP... x-1 £5!? <|ENDOFTEXT|> ŉa ǅ ĳ ª º × ɏ ɐ́ é.é", "THE the. The, the"]
    for table_words in (1, 5, 1000):
        small = packing.WordTokenizer(WORDS, table_words=table_words)
        assert small.by_word and small.encode([]) == []
        for _ in range(2):
            assert small.encode(texts) == library_ids(texts)


def test_frequent_words_outlive_a_full_table(monkeypatch):
    def name(i):
        return "".join(chr(97 + int(c)) for c in f"{i:06d}")

    t, asked = packing.WordTokenizer(WORDS, table_words=100), collections.Counter()
    real = t._pre_tokens
    monkeypatch.setattr(t, "_pre_tokens", lambda new: (asked.update(new), real(new))[1])
    frequent = [name(i) for i in range(60)]
    for block in range(8):  # each block: the frequent words, and as many of its own
        texts = [" ".join(frequent), " ".join(name(1000 * (block + 1) + i) for i in range(60))]
        assert t.encode(texts) == library_ids(texts)
    assert {asked[w] for w in frequent} == {1} and len(asked) == 60 * 9
