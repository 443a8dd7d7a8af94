"""Packs tokenised documents into sequences whose attention cost is even.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``. Documents are placed from the longest
down, each into the cheapest sequence that still has room for it. What fits nowhere
whole is cut, which leaves at most one sequence's worth of padding in a block.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Tokens that a task packs together; it holds no more of them in memory at once.
BLOCK_TOKENS = 1 << 22
#: Words whose ids a task remembers, their longest length, and the documents it looks up at a time.
WORDS, WORD_CHARS, DOCS = 1_000_000, 64, 256

#: In such texts the tokenizer's normaliser only lower-cases, and no token crosses a blank.
_PLAIN = re.compile("[\\t\\n\\r\\x20-;=-~¡-įı-ſ]*")
#: The tokenizer's own pattern for what gets ids apart, fixed by its file.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes; remembers the ids of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the task its cores
        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word; many words share a call, and the tokens that end a part tell them apart."""
        found = {}
        groups = [words[i:i + 50] for i in range(0, len(words), 50)]
        for group, ids in zip(groups, self.ids([" ".join(g) for g in groups])):
            ends = 4 * np.flatnonzero(self.ends[ids]) + 4
            parts = np.cumsum([1 if w.isalpha() else len(_PARTS.findall(w)) for w in group]) - 1
            data, start = ids.tobytes(), 0
            for word, end in zip(group, ends[parts].tolist()):
                found[word], start = data[start:end], end
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) >= WORDS:
            self.known.clear()
        rows, new = [], {}
        for text in texts:
            if not _PLAIN.fullmatch(text):
                rows.append(([self.ids([text])[0].tobytes()], [], []))
                continue
            words = text.lower().split()
            ids = list(map(self.known.get, words))
            missing = [i for i, x in enumerate(ids) if x is None]
            rows.append((ids, missing, [words[i] for i in missing]))
            new.update(dict.fromkeys(rows[-1][2]))
        learned = self.learn(list(new))
        self.known.update((w, ids) for w, ids in learned.items() if len(w) <= WORD_CHARS)
        for ids, missing, words in rows:
            for i, word in zip(missing, words):
                ids[i] = learned[word]
        return [b"".join(ids) for ids, _, _ in rows]


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def pack(lengths: list[int], capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that cover the documents.

    As many sequences as all tokens need. Sequences with room for the current piece are on a heap
    by cost; as pieces get shorter, those that were too full come back from a heap by room.
    """
    whole, waiting = 0, []
    for doc, length in enumerate(lengths):
        for start in range(0, length - length % capacity, capacity):
            yield doc, start, capacity, whole, 0
            whole += 1
        if length % capacity:
            waiting.append((-(length % capacity), doc, length - length % capacity))
    count = -(-sum(-x[0] for x in waiting) // capacity)
    heapq.heapify(waiting)
    used, ready, full = [0] * count, [(0.0, s) for s in range(count)], []
    spent = [0.0] * count
    while waiting:
        length, doc, start = heapq.heappop(waiting)
        length = -length
        while full and capacity - full[0][0] >= length:
            _, s = heapq.heappop(full)
            heapq.heappush(ready, (spent[s], s))
        while ready and capacity - used[ready[0][1]] < length:
            _, s = heapq.heappop(ready)
            heapq.heappush(full, (used[s], s))
        _, s = heapq.heappop(ready) if ready else heapq.heappop(full)
        take = min(length, capacity - used[s])
        yield doc, start, take, whole + s, used[s]
        used[s], spent[s] = used[s] + take, spent[s] + cost(take)
        if take < length:
            heapq.heappush(waiting, (take - length, doc, start + take))
        if used[s] < capacity:
            heapq.heappush(full, (used[s], s))


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. Every
    document ends with ``end_id``, an empty or null text has that alone. A task packs its own
    rows, in blocks of a bounded number of tokens, so nothing is shuffled; sequence ids are
    the task's number and a count. Rows that repeat a doc_id or a text are packed each for
    itself, a null doc_id stays null, an empty table gives an empty result, and
    extra columns are ignored.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, first = Encoder(tokenizer), TaskContext.get().partitionId() << 40
        held = []
        for pdf in batches:
            for at in range(0, len(pdf), DOCS):
                some = pdf.iloc[at:at + DOCS]
                held += zip(some["doc_id"], (ids + end for ids in encode(some["text"].tolist())))
                tokens = sum(len(ids) // 4 for _, ids in held)
                if tokens >= BLOCK_TOKENS:
                    yield (out := block(held, first))
                    first, held = int(out["sequence_id"].max()) + 1, []
        if held:
            yield block(held, first)

    def block(held: list, first: int) -> pd.DataFrame:
        rows = [
            (held[d][0], start, length, held[d][1][4 * start:4 * (start + length)], len(held[d][1]) // 4, first + s, offset)
            for d, start, length, s, offset in pack([len(ids) // 4 for _, ids in held], capacity)
        ]
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        return out.astype({"doc_id": "Int64"})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
