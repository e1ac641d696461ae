"""Byte-level BPE encoding by a depth-first walk of a prefix trie.

A text is cut into words; the distinct words of a batch, in byte order, are the
depth-first order of their trie, whose nodes are the words' prefixes. Each node
keeps one state: the last token of its prefix's encoding. A prefix is encoded
as a shorter prefix's encoding plus one token, and that token is the one whose
bytes end the prefix and which the merges leave beside the shorter prefix's
last token. A node's state follows from its ancestors' states, so a prefix that
many words share is worked out once. Encodings are read off the states
backwards from a word's end.

Null text is empty text: no tokens. Strings of special tokens in a text become
their ids, as the library does it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from lakegauge.llm.common import NEAR, held, near_class, per_batch

# White space, in the range where words are cut here.
_S = r"\t-\r \x85\xa0"
_L, _N = near_class("L"), near_class("N")
_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
    rf"|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_FAR = re.compile(rf"[^\x00-{chr(NEAR - 1)}]")
# Entries that a worker's tables may hold before what is rare goes.
MAX_ENTRIES = 200_000


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies:
    printable Latin-1 characters for themselves, the rest from 256 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    named = {chr(b): b for b in plain}
    return named | {chr(256 + k): b for k, b in enumerate(others)}


class TrieEncoder:
    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        self._byte_of = byte_characters()
        self.id_of = {self._bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.id_of.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self._rank = {
            (self._bytes(a), self._bytes(b)): rank for rank, (a, b) in enumerate(merges)
        }
        self._parts = {a + b: (rank, a, b) for (a, b), rank in self._rank.items()}
        self._longest = max(map(len, self.id_of))
        self._specials = re.compile(
            "(" + "|".join(map(re.escape, self.special)) + ")"
        )
        self._library = Tokenizer.from_str(vocabulary).pre_tokenizer
        self._stable: dict[bytes, bool] = {}
        self._beside: dict[int, bool] = {}  # by both ids

    def _bytes(self, token: str) -> bytes:
        return bytes(map(self._byte_of.__getitem__, token))

    def merged(self, word: bytes) -> list[bytes]:
        """Tokens by applying merges in order of rank, for a single token."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min(
                (self._rank.get(pair, len(self._rank)), i)
                for i, pair in enumerate(zip(parts, parts[1:]))
            )
            if rank == len(self._rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stands_alone(self, token: bytes) -> bool:
        if token not in self._stable:
            self._stable[token] = len(self.merged(token)) == 1
        return self._stable[token]

    def _stand_together(self, left: bytes, right: bytes) -> bool:
        key = self.id_of[left] << 32 | self.id_of[right]
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) > MAX_ENTRIES:
                self._beside.clear()
            known = self._beside[key] = self._never_merge(left, right)
        return known

    def _never_merge(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border while both tokens form.

        Goes back in time: the token that was formed last is taken apart, and
        the two parts then at the border must have no merge of an earlier
        rank. Of equal merges the left one comes first.
        """
        limit = len(self._rank)
        while self._rank.get((left, right), limit) >= limit:
            if len(left) == 1 and len(right) == 1:
                return True
            of_left, of_right = self._formed(left), self._formed(right)
            if of_left[0] > of_right[0]:
                limit, _, left = of_left
            else:
                limit, right, _ = of_right
                limit += 1
        return False

    def _formed(self, token: bytes) -> tuple[int, bytes, bytes]:
        """Rank and parts of the merge that makes a token."""
        return self._parts.get(token, (-1, token, token))

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, by one depth-first walk of their trie."""
        found = {}
        states: list[bytes] = [b""]  # of the prefixes on the way from the root
        before = b""
        tokens, longest = self.id_of, self._longest
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = word[start:end]
                    if token in tokens and (
                        self._stand_together(states[start], token)
                        if start
                        else self._stands_alone(token)
                    ):
                        states.append(token)
                        break
            ids, end = [], len(word)
            while end:
                ids.append(tokens[states[end]])
                end -= len(states[end])
            found[word] = ids[::-1]
            before = word
        return found

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if _FAR.search(text):
            parts = self._library.pre_tokenize_str(text)
            return [self._bytes(part).decode() for part, _ in parts]
        return _WORDS.findall(text)

    def pieces(self, text: str) -> list[str]:
        """Texts and, at odd places, the special tokens between them."""
        return self._specials.split(text)


class Cache:
    """Encoded words of a worker: ids as text, and what is decoded from them
    where that is not the word itself."""

    def __init__(self, trie: TrieEncoder) -> None:
        self.trie = trie
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def add(self, words: set[str]) -> None:
        if len(self.ids) > MAX_ENTRIES:
            # What this group has again is what most groups have.
            kept = words.intersection(self.ids)
            self.ids = {word: self.ids[word] for word in kept}
            self.decoded = {w: self.decoded[w] for w in kept if w in self.decoded}
        new = {word.encode(): word for word in words.difference(self.ids)}
        for data, ids in self.trie.encode_words(new).items():
            self.ids[new[data]] = ",".join(map(str, ids))
            decoded = b"".join(map(self.trie.bytes_of.__getitem__, ids))
            if decoded != data:
                self.decoded[new[data]] = decoded

    def decode(self, words: list[str]) -> bytes:
        if self.decoded:
            return b"".join([self.decoded.get(w, w.encode()) for w in words])
        return "".join(words).encode()


def cache_of(vocabulary: str) -> Cache:
    """One per worker process, which Spark uses for many tasks."""
    return held(("bpe", vocabulary), lambda: Cache(TrieEncoder(vocabulary)))


def round_trip(
    cache: Cache, texts: list[str | None], with_ids: bool
) -> list[tuple]:
    """What each text of a group gives; the group's new words share one trie."""
    cut = [
        [
            piece if number % 2 else cache.trie.cut(piece)
            for number, piece in enumerate(cache.trie.pieces(text or ""))
        ]
        for text in texts
    ]
    cache.add(
        {word for pieces in cut for words in pieces[::2] for word in words}
    )
    made = []
    for pieces in cut:
        ids: list[str] = []
        decoded: list[bytes] = []
        for number, words in enumerate(pieces):
            if number % 2:
                ids.append(str(cache.trie.special[words]))
                decoded.append(words.encode())
            else:
                ids += map(cache.ids.__getitem__, words)
                decoded.append(cache.decode(words))
        joined = ",".join(ids)
        back = b"".join(decoded).decode("utf-8", errors="replace")
        made.append(
            (
                joined.count(",") + 1 if joined else 0,
                hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest(),
                list(map(int, joined.split(","))) if with_ids and joined else [],
                back if with_ids else None,
            )
        )
    return made


def encode_and_decode(
    docs: DataFrame, vocabulary_path: str, with_ids: bool = True
) -> DataFrame:
    """Per document the number of tokens, digests of the ids and of the text
    decoded from them, and (``with_ids``) both themselves."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()

    def start():
        cache = cache_of(vocabulary)
        return lambda texts: round_trip(cache, texts, with_ids)

    return per_batch(
        docs,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
        "ids array<bigint>, decoded string",
        start,
        holds=True,
    )
