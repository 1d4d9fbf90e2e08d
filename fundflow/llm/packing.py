"""Sum-of-squares packing of documents into fixed windows.

Each document's ids (with an end id behind them) are cut at the window size;
its full windows are sequences at once. The rest of a document is *placed
online*: among a new window and all fill levels at which a partly filled
window stands and the piece fits, the level is taken for which the sum of the
squared counts of partly filled windows by level grows least (ties: the
fullest level). The counts are one array with an entry for each level.

What stands open at the end of a task (or beyond ``max_open`` windows, which
bounds memory) is closed by cutting: the fullest windows are topped up with
pieces of the emptiest, and the last window's tokens are dealt into sequences
whose lengths are powers of two, which need no padding.

One pass over the documents, no shuffle; each input partition packs its own
rows and numbers its own sequences (partition number in the upper half of
``sequence_id``), so a lost executor's partition is packed again by itself.

Results: a null or empty text is the end id alone; repeated rows and ids are
packed as often as they come; an empty table gives no pieces; other columns
are left out. Every id of a document lies in exactly one piece.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fundflow.llm.common import blocks, local_tokenizer, take_worker, text_column

WINDOW = 4096
END_ID = 2
#: Partly filled windows that a task keeps open at most.
MAX_OPEN = 8192
#: Entries of each of a worker's two tables of ids, about.
TABLE_WORDS = 600_000


class WordTokenizer:
    """A ``tokenizers`` file whose pre-tokenizer never crosses white space,
    used through a table of distinct pre-tokens. A block of texts is split at
    blanks into words and these are numbered; what follows is done once for
    each distinct word, and the ids of a text are gathered by its words'
    numbers. Words outside plain Latin go to the library as they are; a file
    of another kind is used whole."""

    PLAIN = re.compile("[!-~¡-ɏ]+")
    MARKS = ".,;:!?"
    #: Letters among them that lower-case one by one, and marks behind: two pre-tokens.
    SIMPLE = "^[" + "".join(c for c in map(chr, range(0x21, 0x250)) if c.isalpha() and c != "İ") + "]+[" + MARKS + "]*$"
    PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, table_words: int = TABLE_WORDS):
        import json

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = (steps[0].get("pattern", {}).get("Regex") == self.PRE_TOKEN and steps[0].get("invert") is True
                        and kinds == ["NFC", "Replace", "Lowercase"] and bool(suffix))
        self.pre = regex.compile(self.PRE_TOKEN)
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        if self.by_word:
            vocab = self.library.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
            #: The same model for pre-tokens: normalized and split already.
            self.model = Tokenizer(self.library.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit()] + [self.library.pre_tokenizer[i] for i in range(1, len(steps))])
        self.recent: dict[str, bytes]
        self.older: dict[str, bytes]
        self.forget()
        #: No added token could be found in letters and marks.
        self.marks_are_plain = not any(x.rstrip(self.MARKS).isalpha() for x in self.added)
        self.table_words = table_words

    def forget(self) -> None:
        """Empty the tables."""
        self.recent, self.older = {}, {}

    @staticmethod
    def _encoded(library, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]

    def _pre_tokens(self, new: list[str]) -> Iterator[bytes]:
        """Ids of pre-tokens, a line of them at a time: each ends with an end-of-word id."""
        for i in range(0, len(new), 200):
            part = new[i:i + 200]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(part):  # a pre-token that the model splits
                yield from self._encoded(self.model, part)
                continue
            raw, a = ids.tobytes(), 0
            for b in cuts.tolist():
                yield raw[a:b]
                a = b

    def _other_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words that aren't letters with marks behind."""
        plain = [bool(self.PLAIN.fullmatch(w)) and not any(x in w for x in self.added) for w in words]
        split = [self.pre.findall(unicodedata.normalize("NFC", w).lower()) if p else () for w, p in zip(words, plain, strict=True)]
        wanted = list(set().union(*split))
        tokens = dict(zip(wanted, self._known(wanted, self._pre_tokens), strict=True))
        whole = iter(self._encoded(self.library, [w for w, p in zip(words, plain, strict=True) if not p]))
        for p, ts in zip(plain, split, strict=True):
            yield b"".join(map(tokens.__getitem__, ts)) if p else next(whole)

    def _known(self, names: list[str], find: Callable[[list[str]], Iterable[bytes]], key: str = "") -> list[bytes]:
        """Ids of distinct names by the tables; ``find`` gives those of new ones. What is used stays in the recent table,
        which becomes the older one when it is full."""
        keys = [key + x for x in names] if key else names
        out = list(map(self.recent.get, keys))
        at = [i for i, x in enumerate(out) if x is None]
        for i in at:
            out[i] = self.older.get(keys[i])
        lost = [i for i in at if out[i] is None]
        for i, x in zip(lost, find([names[i] for i in lost]), strict=True):
            out[i] = x
        self.recent.update((keys[i], out[i]) for i in at)
        if len(self.recent) > self.table_words:
            self.older, self.recent = self.recent, {}
            if len(self.older) > 2 * self.table_words:  # a block with more words than that
                self.older = {}
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        if not self.by_word:
            return self._encoded(self.library, texts)
        clean = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ") for t in texts]
        split = pc.split_pattern(pa.array(clean, pa.large_string()), " ")
        words = split.flatten().dictionary_encode()
        first, second, ids = self._word_ids(words.dictionary)
        # Ids of the distinct words, then of the texts' words.
        refs = np.stack([first, second], axis=1).ravel()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = _gathered(np.frombuffer(b"".join(ids), "<u4"), sizes, refs)
        sizes = sizes[first] + sizes[second]
        at = words.indices.to_numpy()
        flat = _gathered(flat, sizes, at)
        ends = np.concatenate([[0], np.cumsum(sizes[at])])[split.offsets.to_numpy()].tolist()
        return [flat[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    def _word_ids(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Two places for each of the distinct words, and what stands at the places: the ids of a word's two parts."""
        simple = pc.match_substring_regex(words, self.SIMPLE).to_numpy(zero_copy_only=False) & self.marks_are_plain
        other = ~simple & (pc.binary_length(words).to_numpy() > 0)
        first, second = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        whole = words.filter(pa.array(simple))
        heads = pc.utf8_rtrim(whole, self.MARKS)
        marked = (pc.binary_length(whole).to_numpy() > pc.binary_length(heads).to_numpy())
        heads = pc.utf8_lower(heads).dictionary_encode()
        marks = pc.replace_substring_regex(whole.filter(pa.array(marked)), "^[^" + self.MARKS + "]+", "").dictionary_encode()
        ids = [b""]
        for places, names, numbers, find, key in (
                (np.flatnonzero(simple), heads.dictionary, heads.indices, self._pre_tokens, ""),
                (np.flatnonzero(simple)[marked], marks.dictionary, marks.indices, self._pre_tokens, ""),
                (np.flatnonzero(other), words.filter(pa.array(other)), None, self._other_words, " ")):
            at = np.arange(len(places)) if numbers is None else numbers.to_numpy()
            (second if names is marks.dictionary else first)[places] = at + len(ids)
            ids += self._known(names.to_numpy(zero_copy_only=False).tolist(), find, key)
        return first, second, ids


def _gathered(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs (of these sizes, one behind the other in ``flat``) with the numbers ``at``, joined."""
    starts, n = np.cumsum(sizes) - sizes, sizes[at]
    return flat[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of a file; it outlives a task where workers are reused, until another
    operator takes the worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(local_tokenizer(path))
    return _TOKENIZERS[path]


class Packer:
    """Online packing of (document, ids) into windows; ``out`` takes closed pieces as
    ``(document, start, ids, doc_tokens, sequence, offset)``."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)  # partly filled windows by level
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open, self.sequences = 0, 0
        self.out: list[tuple] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        full = n - n % w
        for a in range(0, full, w):
            self._close([(doc, a, ids[a:a + w], n)])
        if full < n:
            self._place((doc, full, ids[full:].copy(), n))
        if self.n_open > self.max_open:
            self.finish()

    def _place(self, piece: tuple) -> None:
        size, w, counts = len(piece[2]), self.window, self.counts
        level, least = 0, 2 * counts[size] + 1
        at = counts[1:w - size + 1]
        if len(at) and self.n_open:
            grown = 2 * (counts[1 + size:w + 1] - at) + 2
            grown[-1] -= 1  # that level is full: it leaves the array
            grown[at == 0] = np.iinfo(np.int64).max
            best = len(grown) - 1 - int(np.argmin(grown[::-1]))
            if grown[best] <= least:
                level = best + 1
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == w:
            self._close(pieces)
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1
            self.n_open += 1

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, n in pieces:
            self.out.append((doc, start, ids, n, self.sequences, at))
            at += len(ids)
        self.sequences += 1

    def finish(self) -> None:
        """Close what stands open, by cutting pieces of the emptiest windows."""
        w = self.window
        left = [(level, pieces) for level in range(w - 1, 0, -1) for pieces in self.open[level]]
        self.open = [[] for _ in range(w)]
        self.counts[:] = 0
        self.n_open = 0
        i, spare = 0, []
        j = len(left)
        while i < j or spare:
            if i < j:
                level, pieces = left[i]
                i += 1
            else:
                pieces, spare, level = spare, [], sum(len(p[2]) for p in spare)
            pieces = list(pieces)
            while level < w:
                if not spare:
                    if i >= j:
                        break
                    j -= 1
                    spare = list(left[j][1])
                doc, start, ids, n = spare.pop()
                take = min(w - level, len(ids))
                pieces.append((doc, start, ids[:take], n))
                level += take
                if take < len(ids):
                    spare.append((doc, start + take, ids[take:], n))
            if level == w:
                self._close(pieces)
            else:
                self._powers(pieces, level)

    def _powers(self, pieces: list[tuple], total: int) -> None:
        """Deal the last tokens into sequences of a power of two each."""
        pieces = pieces[::-1]
        for bit in range(total.bit_length() - 1, -1, -1):
            room = total & (1 << bit)
            here = []
            while room:
                doc, start, ids, n = pieces.pop()
                take = min(room, len(ids))
                here.append((doc, start, ids[:take], n))
                room -= take
                if take < len(ids):
                    pieces.append((doc, start + take, ids[take:], n))
            if here:
                self._close(here)


def pack(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, max_open: int = MAX_OPEN, with_ids: bool = False) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``)."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, packer = tokenizer(tokenizer_file), Packer(window, max_open)
        take_worker("packing", t.forget)
        base = TaskContext.get().partitionId() << 32
        end = np.array([end_id], "<u4").tobytes()

        def closed() -> pd.DataFrame:
            rows = [(doc, start, len(ids), zlib.crc32(ids.tobytes()), n, base + s, at)
                    + ((ids.astype("int32"),) if with_ids else ()) for doc, start, ids, n, s, at in packer.out]
            packer.out.clear()
            out = pd.DataFrame(rows, columns=columns)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for pdf in blocks(batches, "text"):
            docs = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
            for doc, ids in zip(docs, t.encode(pdf["text"].tolist()), strict=True):
                packer.add(doc, np.frombuffer(ids + end, "<u4"))
            if packer.out:
                yield closed()
        packer.finish()
        if packer.out:
            yield closed()

    return text_column(df, id_col, text_col).mapInPandas(run, kinds + ", ids array<int>" * with_ids)
