"""BPE encoding by a prefix trie of distinct words, and decoding.

A word's encoding is found symbol by symbol: the state of a prefix is the last
token of its encoding and the length of what stands before that token. It depends
on the states of shorter prefixes alone, so words that share a prefix share its
states, and each is computed once, depth first, when the trie reaches it.

The last token of a prefix is the only token that ends there, is itself a result
of merging, and can follow the last token of what stands before it: no merge
across their border would have come earlier than the merges that made the two.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from quotemill.llm.shared import Chunks, cuts_letters, hold, map_batches, parts, texts_of

#: Trie nodes and encoded words that a task holds before it starts both anew.
MAX_NODES = 500_000
MAX_WORDS = 600_000
MAX_PAIRS = 300_000

NEVER = 1 << 60
END_SHIFT = 0x10000

#: The character that the byte-level rule writes for each byte: itself if it is visible in Latin-1, else one from 256 on.
_seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_unseen = [b for b in range(256) if b not in _seen]
SPELLING = "".join(chr(b if b in _seen else 256 + _unseen.index(b)) for b in range(256))

#: Spaces, separators and marks that start a chunk might reach over its border.
UNUSUAL = re.compile(r"^[^\x21-\x7e\xa1-\u02ff]|[\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]").search


class Merges:
    """Ranks of merges, the two halves of each token that a merge makes, and where tokens end.

    The last symbol of a word, which carries the end mark, is one shifted character here,
    so a token is a string of one character for each symbol.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        #: Whether letters and marks are words apart.
        self.apart = cuts_letters(content)
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.ids[left], self.ids[right]
            self.rank[a, b] = rank
            self.made.setdefault(self.ids[left + right], (rank, a, b))
        self.known: dict[int, bool] = {}
        usable: dict[int, bool] = {}
        for token, (rank, a, b) in sorted(self.made.items(), key=lambda x: x[1][0]):
            usable[token] = usable.get(a, True) and usable.get(b, True) and self._border(a, b, rank)
        end = model["end_of_word_suffix"]
        self._endings({
            last_shifted(t.removesuffix(end)) if t.endswith(end) else t: i
            for t, i in self.ids.items() if usable.get(i, True)
        })

    def _endings(self, tokens: dict[str, int]) -> None:
        """An automaton over symbols. Its state is the longest end of what was read that starts a
        token; ``token`` is the token that the state spells, or -1; ``shorter`` leads to the
        longest state with a token among the proper ends of a state, 0 if there is none."""
        self.step: list[dict[str, int]] = [{}]
        self.token, self.size = [-1], [0]
        for text, i in tokens.items():
            state = 0
            for symbol in text:
                after = self.step[state].get(symbol)
                if after is None:
                    after = self.step[state][symbol] = len(self.step)
                    self.step.append({})
                    self.token.append(-1)
                    self.size.append(self.size[state] + 1)
                state = after
            self.token[state] = i
        self.fall, self.shorter = [0] * len(self.step), [0] * len(self.step)
        todo = deque(self.step[0].values())
        while todo:
            state = todo.popleft()
            for symbol, after in self.step[state].items():
                fall = self.fall[after] = self.advance(self.fall[state], symbol)
                self.shorter[after] = fall if self.token[fall] >= 0 else self.shorter[fall]
                todo.append(after)

    def advance(self, state: int, symbol: str) -> int:
        step = self.step
        while state and symbol not in step[state]:
            state = self.fall[state]
        return step[state].get(symbol, 0)

    def _border(self, left: int, right: int, before: int) -> bool:
        """Whether no merge across the border comes before the merges that make the two sides.

        The sides are taken apart from the last merge back. ``before`` is the rank that a
        merge across the border has to beat; of equal ranks the one further left comes first.
        """
        while True:
            if self.rank.get((left, right), NEVER) < before:
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                before, left = a[0], a[2]
            else:
                before, right = b[0] + 1, b[1]

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` can stand after ``left``; the answer is kept in ``known``."""
        if len(self.known) > MAX_PAIRS:
            self.known.clear()
        found = self.known[left << 20 | right] = self._border(left, right, NEVER)
        return found


def last_shifted(word: str) -> str:
    return word[:-1] + chr(ord(word[-1]) + END_SHIFT)


class Trie:
    """Prefixes of all inserted words with their last-token states."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.state, self.token, self.back = [0], [-1], [0]

    def encode(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of each distinct word. Sorted words walk the trie depth first."""
        out: dict[str, list[int]] = {}
        path, last = [0], ""
        child, state, token, back = self.child, self.state, self.token, self.back
        for word in sorted(words):
            if len(token) > MAX_NODES:
                self.clear()
                path, last = [0], ""
                child, state, token, back = self.child, self.state, self.token, self.back
            shared, most = 0, min(len(word), len(last)) - 1
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del path[shared + 1 :]
            node = path[-1]
            for symbol in word[shared:-1]:
                key = node << 21 | ord(symbol)
                node = child.get(key)
                if node is None:
                    after, end, start = self._last_token(path, symbol)
                    node = child[key] = len(token)
                    state.append(after)
                    token.append(end)
                    back.append(path[start])
                path.append(node)
            last = word
            _, end, start = self._last_token(path, chr(ord(word[-1]) + END_SHIFT))
            ids, node = [end], path[start]
            while node:
                ids.append(token[node])
                node = back[node]
            ids.reverse()
            out[word] = ids
        return out

    def _last_token(self, path: list[int], symbol: str) -> tuple[int, int, int]:
        """For the prefix at the end of ``path`` and one more symbol: the automaton's state, the
        last token, and the length of what stands before that token."""
        merges, token, depth = self.merges, self.token, len(path)
        step, ends, size, known = merges.step, merges.token, merges.size, merges.known
        state = self.state[path[-1]]
        while state and symbol not in step[state]:
            state = merges.fall[state]
        at = state = step[state].get(symbol, 0)
        if ends[at] < 0:
            at = merges.shorter[at]
        while at:
            end, start = ends[at], depth - size[at]
            if not start:
                return state, end, 0
            left = token[path[start]]
            found = known.get(left << 20 | end)
            if merges.follows(left, end) if found is None else found:
                return state, end, start
            at = merges.shorter[at]
        raise ValueError(f"no token ends with {symbol!r}")


class Encoder:
    """Ids and decoded text of whole texts.

    White space never gets a token and no rule of the tokenizer looks across ASCII
    white space, so a text is the run of its space-separated chunks. A chunk is
    normalised and cut into words by the tokenizer's own rules, once for all texts
    of a batch that hold it.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {
            t.content: i for i, t in self.library.get_added_tokens_decoder().items()
        }
        self.merges = Merges(path)
        self.trie = Trie(self.merges)
        named = {**self.merges.ids, **self.special}
        self.name = [""] * (max(named.values()) + 1)
        for text, i in named.items():
            self.name[i] = text
        self.digits = [str(i) for i in range(len(self.name))]
        self.chunks = Chunks()
        #: Of each chunk by its number: ids as text, and decoded ids.
        self.ids: list[str] = []
        self.decoded: list[str] = []

    def _words(self, chunks: list[str]) -> list[list[str]]:
        """Words of each chunk, cut in one call: chunks hold no white space and no special token,
        so the normal form has one space between two of them."""
        normal = self.library.normalizer.normalize_str(" ".join(chunks))
        words = iter(self.library.pre_tokenizer.pre_tokenize_str(normal))
        out, end, word = [], -1, next(words, None)
        for chunk in normal.split(" "):
            end += len(chunk) + 1
            own = []
            while word is not None and word[1][0] < end:
                own.append(word[0])
                word = next(words, None)
            out.append(own)
        return out

    def _cut(self, chunk: str) -> list[str | int]:
        """Words of a chunk of any kind, and ids of special tokens that it spells out."""
        marks = [(chunk.find(s), s) for s in self.special if s in chunk]
        if not marks:
            normal = self.library.normalizer.normalize_str(chunk)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        at, mark = min(marks)
        rest = chunk[at + len(mark) :]
        head = self._cut(chunk[:at]) if at else []
        return [*head, self.special[mark], *(self._cut(rest) if rest else [])]

    def _learn(self) -> None:
        """Letters and marks are learned apart, so a chunk that differs from another in case or in
        marks at its end is put together from what is known."""
        chunks, ids, decoded = self.chunks, self.ids, self.decoded
        words, others, made = chunks.parted() if self.merges.apart else ([], chunks.new, [])
        ids.extend([""] * (len(chunks) - len(ids)))
        decoded.extend([""] * (len(chunks) - len(decoded)))
        self._learn_cut(others, {w: [w.decode() if w.isascii() else w.decode("latin-1").translate(SPELLING)] for w in words})
        for number, letters, marks in made:
            if marks >= 0:
                ids[number] = f"{ids[letters]} {ids[marks]}"
                decoded[number] = f"{decoded[letters]} {decoded[marks]}"
            else:
                ids[number], decoded[number] = ids[letters], decoded[letters]
        chunks.new = []

    def _learn_cut(self, chunks: list[bytes], cut: dict[bytes, list[str | int]]) -> None:
        """Learn ``chunks``, and those that ``cut`` has the words of."""
        plain = []
        for chunk in chunks:
            text = chunk.decode("utf-8")
            if len(text.split()) == 1 and b"<|" not in chunk and not UNUSUAL(text):
                plain.append(text)
            else:
                cut[chunk] = self._cut(text)
        if plain:
            cut.update(zip((t.encode("utf-8") for t in plain), self._words(plain)))
        words = {w for ws in cut.values() for w in ws if isinstance(w, str)}
        spelt: dict[str | int, str] = {i: str(i) for i in self.special.values()}
        named: dict[str | int, str] = {i: text for text, i in self.special.items()}
        for word, ids in self.trie.encode(words).items():
            spelt[word] = " ".join([self.digits[i] for i in ids])
            named[word] = " ".join([self.name[i] for i in ids])
        for chunk, own in cut.items():
            number = self.chunks[chunk]
            if len(own) == 1:
                self.ids[number], self.decoded[number] = spelt[own[0]], named[own[0]]
            else:
                self.ids[number] = " ".join([spelt[w] for w in own])
                self.decoded[number] = " ".join([named[w] for w in own])

    def encode(self, texts: list[bytes]) -> Iterator[tuple[str, str]]:
        """For each text its ids, as decimals joined by spaces, and the decoded ids.

        Tokens are decoded as themselves, joined by spaces: the tokenizer names no decoder.
        """
        chunks, ids, decoded = self.chunks, self.ids, self.decoded
        for a, b in parts(texts):
            runs = [list(map(chunks.__getitem__, t.split())) for t in texts[a:b]]
            if chunks.new:
                self._learn()
            if len(chunks) > MAX_WORDS:
                runs = chunks.keep(runs, ids, decoded)
            for run in runs:
                yield " ".join(filter(None, map(ids.__getitem__, run))), " ".join(filter(None, map(decoded.__getitem__, run)))


def count_ids(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file in each Python worker, until another operator works there."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        hold(__name__, _encoders.clear)
    return _encoders[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A null or
    empty text has no ids. Rows are independent: repeated rows and null ids stay,
    extra columns are ignored, and an empty table gives no rows.
    """

    def make(batch: pa.RecordBatch) -> dict:
        coder = encoder(tokenizer)
        ids, decoded = zip(*coder.encode(texts_of(batch.column(1))))
        n = np.array([count_ids(x) for x in ids], dtype=np.int64)
        flat = " ".join(filter(None, ids))
        values = np.array(flat.split(), dtype="U8").astype(np.int32) if flat else np.zeros(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return {
            "doc_id": batch.column(0), "n_tokens": n,
            "ids": pa.ListArray.from_arrays(offsets, values), "decoded": pa.array(decoded),
        }

    chosen = docs.select(docs["doc_id"].cast("long"), "text")
    return map_batches(chosen, "doc_id long, n_tokens long, ids array<int>, decoded string", make)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """As ``encode_documents``, with SHA-256 of ids and decoded text in place of both.

    The digests are taken where the texts are encoded, so neither leaves its task.
    """

    def make(batch: pa.RecordBatch) -> dict:
        coder = encoder(tokenizer)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids, decoded in coder.encode(texts_of(batch.column(1))):
            out["n_tokens"].append(count_ids(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        return {"doc_id": batch.column(0), **out}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(docs["doc_id"].cast("long"), "text"), schema, make)
