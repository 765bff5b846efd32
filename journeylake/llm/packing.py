"""Packing token sequences by vector bin packing.

Every document becomes the ids of a public tokenizer and an end id. Whole windows of
``max_tokens`` ids are sequences of their own. What is left of each document is an item with
three sizes: tokens, segments (one) and loss-bearing tokens. A task keeps a pool of items and
fills one sequence after another: of the items that fit under all three limits it takes the
one whose sizes have the largest dot product with the room that is left, all measured against
the limits. When none fits and room for tokens is left, an item is cut to fill it. What a task
holds at its end goes into sequences whose lengths are powers of two, which need no padding.

There is no shuffle: a task packs its own documents, and holds one pool and one document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import documents_of, free_memory, worker_cache

#: Bytes of words and their ids, and of the objects around them, that a Python worker remembers.
CACHED_BYTES, ENTRY_BYTES = 96 << 20, 200
POOL_ITEMS = 1024
#: A text without such a character is unchanged by composing (NFC), lower-cased letter by letter
#: and split at the same white space by Python and the tokenizer. No token spans white space,
#: so such texts can be put together from words; all others go to the tokenizer whole.
UNUSUAL = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-įı-ňŊ-ž‐-‧]")


#: How the tokenizer's own file cuts lower-cased text of such characters (fixed value).
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^\\sa-zß-öø-ž0-9]+")


class WordIds(dict):
    """Ids of lower-cased words, found when first asked for. Two generations: when the young
    one is full it becomes the old one, and words still in use come back from there."""

    def __init__(self, tokenizer, most: int = CACHED_BYTES):
        super().__init__()
        from tokenizers import pre_tokenizers

        self.model, self.old, self.room = tokenizer.model, {}, most // 2
        self.most = most
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            pieces = [word] if word.isalpha() else PIECE.findall(word)
            if not word.isascii():
                pieces = [self.as_bytes(p)[0][0] for p in pieces]
            ids = b"".join([t.id.to_bytes(4, "little") for p in pieces for t in self.model.tokenize(p)])
        self[word] = ids
        self.room -= len(word) + len(ids) + ENTRY_BYTES
        if self.room <= 0:
            self.old, self.room = dict(self), self.most // 2
            self.clear()
        return ids


class WordTokenizer:
    """Ids of texts, as little-endian unsigned 32-bit bytes, through a cache of words."""

    def __init__(self, path: str, end_id: int | None = 1, cached_bytes: int = CACHED_BYTES):
        from tokenizers import Tokenizer

        kept = worker_cache("packing")
        if path not in kept:
            kept[path] = Tokenizer.from_file(path)
        if (path, cached_bytes) not in kept:
            kept[path, cached_bytes] = WordIds(kept[path], cached_bytes)
        self.tokenizer, self.words = kept[path], kept[path, cached_bytes]
        self.end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def by_words(self, text: str) -> bool:
        return UNUSUAL.search(text) is None and not any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        if self.by_words(text):
            return b"".join(map(self.words.__getitem__, text.lower().split())) + self.end
        return self.whole(text) + self.end


class Packer:
    """Fills sequences from one task's items; rows of finished pieces gather in ``out``.

    An item is [doc_id, start, ids, doc_tokens, prompt]: the ids still to be placed begin at
    ``start``; those before ``prompt`` bear no loss.
    """

    def __init__(self, task: int, max_tokens: int, max_segments: int, max_loss: int):
        if min(max_tokens, max_segments, max_loss) < 1:
            raise ValueError("limits must be positive")
        self.limits = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.next_id, self.out, self.items = task << 33, [], []
        # Sizes of the items, row by row; the pool never holds more.
        self.sizes, self.tokens = np.zeros((POOL_ITEMS, 3)), 0

    @staticmethod
    def loss(item) -> int:
        return max(0, item[1] + len(item[2]) // 4 - max(item[1], item[4]))

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total, prompt in pieces:
            n = len(ids) // 4
            self.out.append((doc_id, start, n, ids, total, self.loss((doc_id, start, ids, total, prompt)), self.next_id, offset))
            offset += n
        self.next_id += 1

    @staticmethod
    def _cut(item, n: int):
        head = [item[0], item[1], item[2][: 4 * n], item[3], item[4]]
        tail = [item[0], item[1] + n, item[2][4 * n :], item[3], item[4]]
        return head, tail

    def add(self, doc_id, ids: bytes, prompt: int) -> None:
        item = [doc_id, 0, ids, len(ids) // 4, prompt]
        width = int(min(self.limits[0], self.limits[2]))
        while len(item[2]) // 4 >= width:
            # A window that bears less loss may be longer than the loss limit allows others to be.
            free = max(0, item[4] - item[1])
            n = int(min(self.limits[0], self.limits[2] + free, len(item[2]) // 4))
            head, item = self._cut(item, n)
            self._emit([head])
        if item[2]:
            self._keep(len(self.items), item)
            self.tokens += len(item[2]) // 4
            if len(self.items) >= POOL_ITEMS:
                self.pack(keep=POOL_ITEMS // 2)

    def _keep(self, at: int, item) -> None:
        self.items[at : at + 1] = [item]
        self.sizes[at] = len(item[2]) // 4, 1, self.loss(item)

    def _drop(self, at: int) -> None:
        """The last item takes the place."""
        last = self.items.pop()
        if at < len(self.items):
            self.items[at], self.sizes[at] = last, self.sizes[len(self.items)]

    def _fill(self, room: np.ndarray) -> list:
        """Pieces for one sequence with this room, taken off the pool."""
        left, pieces = room.copy(), []
        while self.items and left[0] >= 1 and left[1] >= 1:
            sizes = self.sizes[: len(self.items)]
            score = sizes @ (left / self.limits**2)
            score[(sizes > left).any(axis=1)] = -1.0
            best = int(score.argmax())
            if score[best] < 0:
                break
            pieces.append(self.items[best])
            left -= sizes[best]
            self._drop(best)
        if self.items and left[0] >= 1 and left[1] >= 1:
            # Cut the longest item that is left, as far as tokens and loss allow.
            best = int(self.sizes[: len(self.items), 0].argmax())
            item = self.items[best]
            n = int(min(left[0], left[2] + max(0, item[4] - item[1]), len(item[2]) // 4))
            if n:
                head, tail = self._cut(item, n)
                pieces.append(head)
                if tail[2]:
                    self._keep(best, tail)
                else:
                    self._drop(best)
        self.tokens -= sum(len(p[2]) // 4 for p in pieces)
        return pieces

    def pack(self, keep: int = 0) -> None:
        while len(self.items) > keep and self.tokens >= self.limits[0]:
            self._emit(self._fill(self.limits))

    def finish(self) -> None:
        """Whole sequences while they last, then lengths that are powers of two."""
        self.pack()
        while self.items:
            room = self.limits.copy()
            room[0] = min(int(self.limits[0]), 1 << (self.tokens.bit_length() - 1))
            self._emit(self._fill(room))

    def take(self) -> list:
        out, self.out = self.out, []
        return out


OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                 ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_documents(
    docs: DataFrame, tokenizer: str, max_tokens: int = 2048, max_segments: int = 512, max_loss: int = 2048,
    end_id: int | None = 1, prompt_tokens: str | None = None, cached_bytes: int = CACHED_BYTES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    loss_tokens, sequence_id, offset.

    ``tokenizer`` is the path of the word BPE file, the same on every machine. ``prompt_tokens``
    names a column with the number of leading tokens that bear no loss (null: none). A null or
    empty text is the end id alone; without ``end_id`` it makes no piece. Each row is packed on
    its own, repeated ids and texts too. sequence_id is unique, not dense; offsets in a sequence
    have no gaps. An empty table gives no pieces; further columns are ignored.
    """
    prompt = F.coalesce(F.col(prompt_tokens), F.lit(0)) if prompt_tokens else F.lit(0)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        words = WordTokenizer(tokenizer, end_id, cached_bytes)
        packer = Packer(TaskContext.get().partitionId(), max_tokens, max_segments, max_loss)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = map(words.encode, part["text"].to_pylist())
                for row in zip(part["doc_id"].to_pylist(), ids, part["prompt"].to_pylist()):
                    packer.add(*row)
                if packer.out:
                    yield _batch(packer.take())
        packer.finish()
        if packer.out:
            yield _batch(packer.take())

    kinds = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
    return documents_of(docs, prompt.cast("long").alias("prompt")).mapInArrow(step, kinds)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT)


