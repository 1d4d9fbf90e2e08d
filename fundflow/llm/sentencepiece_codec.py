"""SentencePiece encoding and decoding through a distinct-chunk table.

When no piece of a model has the whitespace marker behind another character,
merges never cross the border in front of a run of markers. A text is then a
sequence of *marked words* (a run of markers and the characters after it), and
the pieces of a text are the pieces of its marked words in a row. So each
distinct marked word is segmented once, into a table ``word -> ids``, and the
ids are joined back by position.

The table is kept by worker, not by corpus: a corpus-wide table needs three
shuffles (distinct words, ids back to blocks, blocks back to documents), which
move more bytes than the text has, while a worker's table reaches nearly the
same rate of hits, because words are frequent by Zipf's law. It is bounded
(``TABLE_WORDS``): when full, further words are still segmented once per
block, in a table of that block.

A model that doesn't have the property (checked at load) is used whole.

Results: null text counts as empty (begin and end ids alone); repeated rows
and repeated ids give one result row each; other columns are left out unless
asked for; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fundflow.llm.common import blocks, local_tokenizer, text_column

MARK = "▁"
#: Entries kept by a worker (about 200 bytes each).
TABLE_WORDS = 600_000


class ChunkCodec:
    """Encode and decode by the distinct-chunk table of one model."""

    def __init__(self, model_path: str, table_words: int = TABLE_WORDS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        prefix = self.sp.encode("a") == [self.sp.piece_to_id(MARK + "a")] and MARK + "a" in pieces
        identity = self.sp.encode("a  a", out_type=str)
        plain = "".join(identity) == f"{MARK}a{MARK}{MARK}a"
        self.newline = newline = self.sp.piece_to_id("<0x0A>")
        #: Markers only at the front of pieces, newlines only as bytes, and a
        #: normalizer that adds the first marker and changes nothing else.
        self.by_chunk = (prefix and plain
                         and not any(MARK in p.lstrip(MARK) for p in pieces)
                         and not any("\n" in p for p in pieces)
                         and self.sp.encode("\n") == [self.sp.piece_to_id(MARK), newline]
                         and self.sp.encode("ÅÅ ﬁ\t", out_type=str)[0] in (MARK, MARK + "Å")
                         and self.sp.decode(self.sp.encode("Å ﬁ\t")) == "Å ﬁ\t")
        self.words = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.table: dict[str, bytes] = {"\n": np.array([newline], "<u4").tobytes(),
                                        MARK: np.array([self.sp.piece_to_id(MARK)], "<u4").tobytes()}
        self.table_words = table_words

    def _segment(self, words: list[str]) -> list[bytes]:
        """Ids of marked words. Words go to the library in lines of one text:
        a newline is always a byte piece, so its id parts the words' ids."""
        out = []
        for i in range(0, len(words), 200):
            ids = np.array(self.sp.encode("\n" + "\n".join(words[i:i + 200]), num_threads=1), "<u4")
            cuts = np.flatnonzero(ids == self.newline)
            raw, ends = ids.tobytes(), [*(cuts[1:] * 4).tolist(), len(ids) * 4]
            out += [raw[a:b] for a, b in zip((cuts * 4 + 4).tolist(), ends, strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text, no begin or end id."""
        if not self.by_chunk:
            return [np.array(x, "<u4").tobytes() for x in self.sp.encode(texts, num_threads=1)]
        split = [self.words.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        table = self.table
        new = {w for ws in split for w in ws if w not in table}
        if new:
            new = list(new)
            found = dict(zip(new, self._segment(new), strict=True))
            if len(table) + len(found) <= self.table_words:
                table.update(found)
            else:
                table = _Both(table, found)
        get = table.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(np.frombuffer(ids, "<u4").tolist())


class _Both(dict):
    """The worker's table first, then the block's."""

    def __init__(self, table: dict, found: dict):
        super().__init__(found)
        self.first = table

    def __missing__(self, word: str) -> bytes:
        return self.first[word]


_CODECS: dict[tuple[str, int], ChunkCodec] = {}


def codec(model_path: str, table_words: int = TABLE_WORDS) -> ChunkCodec:
    """The worker's codec of a model; it outlives a task where workers are reused."""
    key = (model_path, table_words)
    if key not in _CODECS:
        _CODECS[key] = ChunkCodec(local_tokenizer(model_path), table_words)
    return _CODECS[key]


def encode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     table_words: int = TABLE_WORDS) -> DataFrame:
    """``doc_id, ids`` with begin and end ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model_path, table_words)
        for pdf in blocks(batches, "text"):
            ids = [np.frombuffer(_closed(c, x), "<u4").astype("int32") for x in c.encode(pdf["text"].tolist())]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids})

    return text_column(df, id_col, text_col).mapInPandas(run, "doc_id long, ids array<int>")


def decode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ids (null ids: empty text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model_path)
        for pdf in batches:
            texts = [c.decode(np.asarray(x if x is not None else [], "<u4").tobytes()) for x in pdf["ids"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": texts})

    return (df.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{ids_col}` as array<int>) ids")
            .mapInPandas(run, "doc_id long, text string"))


def _closed(c: ChunkCodec, ids: bytes) -> bytes:
    return c.sp.bos_id().to_bytes(4, "little") + ids + c.sp.eos_id().to_bytes(4, "little")


def round_trip(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
               table_words: int = TABLE_WORDS) -> DataFrame:
    """Encode, decode and digest each text in one pass over the documents:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256, exact`` (exact: the
    decoded text is the given one). No shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model_path, table_words)
        for pdf in blocks(batches, "text"):
            texts = pdf["text"].tolist()
            rows = []
            for text, ids in zip(texts, c.encode(texts), strict=True):
                ids = _closed(c, ids)
                back = c.decode(ids)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(back.encode()).hexdigest(), back == text))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "exact"])
            out.insert(0, "doc_id", pdf["doc_id"].array)
            yield out

    return text_column(df, id_col, text_col).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean")
