"""Byte-pair encoding by a pair occurrence index, and decoding.

A block's distinct words are laid out as one linked list of symbols.  An index maps each active merge rank to the
positions of its pair.  Ranks are applied in ascending order; each application rewrites all positions of the pair at
once and enters the pairs that arise into the index.  That gives the usual greedy result because every merge makes a
token of its own out of tokens made by earlier merges (checked at load), so no merge can wake a lower rank.

Texts are normalised and cut into words as the vocabulary file says.  Common Latin texts take a fast pattern; any
other text goes through the file's own normaliser and pre-tokeniser, so both give the same words.
Null texts count as empty; an empty text has no ids and decodes to the empty text.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import WordNumbers, map_arrow, ranges, table, text_blocks

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Latin text and common punctuation: NFC leaves it as it is, and case and classes are the same in every Unicode version.
_SAFE = "\t\n\r -~¡-įı-ſ–—‘’“”„•…€"
_UNSAFE = re.compile(f"[^{_SAFE}]|<\\|")


def _pattern() -> re.Pattern:
    chars = [chr(c) for c in range(0x180)]
    letters = "".join(c for c in chars if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in chars if unicodedata.category(c)[0] == "N")
    # the file's pattern, with the alternative that matches most put first: no other one starts with a letter
    return re.compile(f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{letters}{numbers}]+")


def vocabulary_path(name: str) -> str:
    """A vocabulary's file: a path as it is, or the name of one of the installed public files."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class Rows:
    """Rows of ids of any length, appended in blocks."""

    def __init__(self) -> None:
        self.sizes, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.used = 0

    def __len__(self) -> int:
        return len(self.sizes)

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, self.used + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.used = len(self.ids)

    def take(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows in order, and the ids' number for each run of ``counts`` rows."""
        sizes = self.sizes[rows]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.cumsum(counts)
        return self.ids[ranges(self.starts[rows], sizes)], total[ends] - total[ends - counts]


class PairIndexBPE:
    """Encoder and decoder for a vocabulary with word ends; remembers the words it has met, up to a bound."""

    def __init__(self, path: str, remembered: int = 400_000) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.byte_char = _byte_chars()
        self.char_byte = {c: b for b, c in enumerate(self.byte_char)}
        self.inner = np.array([vocab[c] for c in self.byte_char], np.int32)
        self.last = np.array([vocab[c + suffix] for c in self.byte_char], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = set(self.inner.tolist()) | set(self.last.tolist())
        for a, b in merges:
            new = vocab[a + b]
            if new in made or vocab[a] not in made or vocab[b] not in made:
                raise ValueError("merges must each make a new token out of earlier ones")
            made.add(new)
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.new = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = self.left << 20 | self.right
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        self.find = _pattern().findall
        self.limit = remembered
        self._forget()

    def _forget(self) -> None:
        self.words, self.word_ids = WordNumbers(), Rows()

    def _split(self, text: str) -> list[str]:
        if not _UNSAFE.search(text):
            return self.find(text.lower())
        out: list[str] = []
        for piece in self.special_cut.split(text):
            if piece in self.special:
                out.append(piece)
            elif piece:
                normal = self.library.normalizer.normalize_str(piece)
                out += [bytes(map(self.char_byte.__getitem__, w)).decode()
                        for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of symbols, or -1."""
        keys = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], -1)

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and each word's number of ids."""
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(b) for b in raw])
        n = len(flat)
        symbol = self.inner[flat]
        symbol[ends - 1] = self.last[flat[ends - 1]]
        following = np.arange(1, n + 1)
        following[ends - 1] = -1
        previous = np.arange(-1, n - 1)
        previous[0] = -1
        previous[ends[:-1]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            rank = self._ranks(symbol[at], symbol[following[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            firsts = [0, *cuts.tolist(), len(at)]
            for k, r in enumerate(rank[firsts[:-1]].tolist()):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(at[firsts[k]:firsts[k + 1]])

        enter(np.flatnonzero(following >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.sort(np.concatenate(lists))
            at = at[alive[at]]
            after = following[at]
            same = (after >= 0) & (symbol[at] == self.left[r])
            same &= symbol[after] == self.right[r]
            at = at[same]
            if self.left[r] == self.right[r] and len(at) > 1:
                # of overlapping places the leftmost counts: every second one of a chain
                chained = np.concatenate(([False], following[at[:-1]] == at[1:]))
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            if not len(at):
                continue
            gone = following[at]
            symbol[at] = self.new[r]
            alive[gone] = False
            beyond = following[gone]
            following[at] = beyond
            inside = beyond >= 0
            previous[beyond[inside]] = at[inside]
            before = previous[at]
            enter(np.unique(np.concatenate((before[before >= 0], at[inside]))))
        kept = np.concatenate(([0], np.cumsum(alive)))
        return symbol[alive], kept[ends] - kept[np.concatenate(([0], ends[:-1]))]

    def _learn(self) -> None:
        new = self.words.since(len(self.word_ids))
        if not new:
            return
        special = np.array([w in self.special for w in new])
        size = np.ones(len(new), np.int64)
        ids = np.zeros(0, np.int32)
        if not special.all():
            ids, size[~special] = self._merge([w for w in new if w not in self.special])
        if special.any():
            at = (np.cumsum(size) - size)[special]
            ids = np.insert(ids, at - np.arange(len(at)), [self.special[w] for w in new if w in self.special])
        self.word_ids.extend(ids, size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other (int32), and each text's number of ids."""
        if len(self.words) > self.limit or self.word_ids.used > 16 * self.limit:
            self._forget()
        at, counts = self.words.number(texts, self._split)
        self._learn()
        return self.word_ids.take(at, counts)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, joined by blanks: the vocabulary file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _byte_chars() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others for code points from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@lru_cache(maxsize=2)
def coder(vocabulary: str = DEFAULT_VOCABULARY) -> PairIndexBPE:
    """One coder per worker process."""
    return PairIndexBPE(vocabulary_path(vocabulary))


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     vocabulary: str = DEFAULT_VOCABULARY, decoded: bool = False) -> DataFrame:
    """(id, ids[, text]): ids as packed little-endian unsigned 32-bit integers, four bytes a token.

    With ``decoded``, ``text`` is what the ids decode to, made in the same pass.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary)
        for rows, texts in text_blocks(batches, "text"):
            ids, sizes = bpe.encode(texts)
            ids, ends = ids.astype("<u4"), np.cumsum(sizes)
            parts = [ids[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
            columns, names = [rows.column(0), pa.array([p.tobytes() for p in parts], pa.binary())], ["id", "ids"]
            if decoded:  # several times as long as the ids
                columns, names = [*columns, pa.array(map(bpe.decode, parts), pa.string())], [*names, "text"]
            yield pa.record_batch(columns, names=names)

    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, ids binary" + ", text string" * decoded
    return map_arrow(source, encode, schema).withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
                     vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(id, text): the text of packed ids; null ids count as none."""
    source = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # decoded texts are several times their ids
                rows = batch.slice(at, 500)
                texts = [bpe.decode(np.frombuffer(i or b"", "<u4")) for i in rows.column(1).to_pylist()]
                yield pa.record_batch([rows.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, decode, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = encode_documents(docs, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
