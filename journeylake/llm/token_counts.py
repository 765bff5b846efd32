"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A task puts the distinct pre-tokens of a slice of its texts into a trie and computes the best
score of every trie node once, level by level: all pre-tokens that share a prefix share its
scores. A node's score comes from its ancestors through the pieces that end there, with the
fewest tokens among equal scores. The node where a pre-token ends stores its token count, and
a text's count is the sum over its pre-tokens. Nothing is shuffled; memory is bounded by the
slice and a cache of words.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SLICE_BYTES, documents_of, worker_cache

#: Distinct pre-tokens whose counts a Python worker remembers.
CACHED_WORDS = 1_000_000
_CHARS = 0x110000
#: What a byte outside the vocabulary scores below the least likely piece.
BYTE_PENALTY = 10.0


def zipf_scores(model_path: str) -> dict[str, float]:
    """Log-probabilities of a public SentencePiece file's pieces, by Zipf's law from their rank
    (such files list pieces in the order in which they were found, the frequent ones first)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = np.log(np.sum(1.0 / (np.arange(len(pieces)) + 1.0)))
    return {p: float(-np.log(r + 1.0) - total) for r, p in enumerate(pieces)}


class Vocabulary:
    """The pieces as a transition table: (state, character) to state, and scores of states."""

    def __init__(self, scores: Mapping[str, float]):
        states, keys, score = {"": 0}, [], [-np.inf]
        for piece in scores:
            for end in range(1, len(piece) + 1):
                prefix = piece[:end]
                if prefix not in states:
                    states[prefix] = len(states)
                    keys.append((states[prefix[:-1]] * _CHARS + ord(prefix[-1]), states[prefix]))
                    score.append(-np.inf)
            if piece:
                score[states[piece]] = float(scores[piece])
        keys.sort()
        # A last key that nothing equals, so that a search never points past the end.
        self.keys = np.array([k for k, _ in keys] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([s for _, s in keys] + [0], np.int64)
        self.score = np.array(score)
        self.byte_score = min((float(s) for s in scores.values()), default=0.0) - BYTE_PENALTY

    def token_counts(self, words: list[str]) -> np.ndarray:
        """Tokens of the best segmentation of each of ``words``, which are distinct and not empty.
        Characters that no piece covers count one token for each byte."""
        order = sorted(range(len(words)), key=words.__getitem__)
        length = np.array([len(words[i]) for i in order], np.int64)
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        chars = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        result = np.zeros(len(words), np.int64)
        alive, node_of = np.arange(len(words)), np.zeros(len(words), np.int64)
        # Nodes of the last level, and for each its open pieces: state, score and count at their start.
        score, count = np.zeros(1), np.zeros(1, np.int64)
        state, at_score, at_count, start = np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.array([0, 1])
        depth = 0
        while len(alive):
            c = chars[first[alive] + depth]
            fresh = np.ones(len(alive), bool)
            fresh[1:] = (node_of[1:] != node_of[:-1]) | (c[1:] != c[:-1])
            parent, char = node_of[fresh], c[fresh]
            node_of = np.cumsum(fresh) - 1
            open_ = start[parent + 1] - start[parent]
            node = np.repeat(np.arange(len(parent)), open_)
            item = np.arange(len(node)) + np.repeat(start[parent] - (np.cumsum(open_) - open_), open_)
            key = state[item] * _CHARS + char[node]
            hit = np.searchsorted(self.keys, key)
            ok = self.keys[hit] == key
            node, item, state = node[ok], item[ok], self.to[hit[ok]]
            ends = self.score[state] > -np.inf
            n_bytes = 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)
            to = np.concatenate([node[ends], np.arange(len(parent))])
            s = np.concatenate([at_score[item[ends]] + self.score[state[ends]], score[parent] + n_bytes * self.byte_score])
            n = np.concatenate([at_count[item[ends]] + 1, count[parent] + n_bytes])
            best = np.lexsort((n, -s, to))
            best = best[np.concatenate([[True], to[best][1:] != to[best][:-1]])]
            score, count = s[best], n[best]
            owner = np.concatenate([node, np.arange(len(parent))])
            by_node = np.argsort(owner, kind="stable")
            state = np.concatenate([state, np.zeros(len(parent), np.int64)])[by_node]
            at_score = np.concatenate([at_score[item], score])[by_node]
            at_count = np.concatenate([at_count[item], count])[by_node]
            start = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(parent)))])
            depth += 1
            done = length[alive] == depth
            result[np.array(order)[alive[done]]] = count[node_of[done]]
            alive, node_of = alive[~done], node_of[~done]
        return result


class Counter:
    """Counts texts through a cache of pre-tokens with two generations."""

    def __init__(self, vocabulary: Vocabulary, known: dict):
        self.vocabulary, self.young, self.old = vocabulary, known.setdefault("young", {}), known.setdefault("old", {})

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        young = self.young
        split = [t.split() for t in texts]
        missing = list(set().union(*split).difference(young))
        if missing:
            found = {w: n for w in missing if (n := self.old.get(w)) is not None}
            missing = [w for w in missing if w not in found]
            young.update(found)
            if missing:
                young.update(zip(missing, self.vocabulary.token_counts(["▁" + w for w in missing]).tolist()))
        result = [sum(map(young.__getitem__, words)) for words in split]
        if len(young) >= CACHED_WORDS // 2:
            self.old.clear()
            self.old.update(young)
            young.clear()
        return result, [len(words) for words in split]


def token_counts(docs: DataFrame, scores: Mapping[str, float]) -> DataFrame:
    """doc_id, n_tokens and n_pretokens of every row.

    ``scores`` maps pieces to log-probabilities; a pre-token is a run of characters other than
    white space, led by U+2581. Null, empty and blank texts have no tokens. Repeated rows are
    counted each; an empty table gives an empty table; further columns are ignored. The
    vocabulary, some 32,000 pieces, travels with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(scores))
    name = f"token counts {hash(frozenset(scores.items()))}"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value, worker_cache(name))
        for batch in batches:
            rows = max(1, int(batch.num_rows * 4 * SLICE_BYTES / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                tokens, words = counter.count(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(tokens, pa.int64()), pa.array(words, pa.int64())],
                    ["doc_id", "n_tokens", "n_pretokens"])

    return documents_of(docs).mapInArrow(step, "doc_id long, n_tokens long, n_pretokens long")
