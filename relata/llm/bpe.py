"""Byte-pair encoding and decoding by a walk over a trie of distinct words.

The encoding of a text piece is determined by the last token of each of its prefixes: the encoding of a
prefix is that of the prefix without its last token, followed by that token. Which token is last depends only
on the prefix, so all words that begin alike share it. The distinct words of a piece of input go into a trie;
a depth-first walk hands the last tokens down and gives every node its own, once for all words below it.

Two neighbouring tokens are *compatible* if merging their joint bytes gives just these two again. A sequence is
an encoding exactly if all its neighbours are compatible, so the last token of a node is the one token that ends
there and is compatible with the last token of the node where it begins.

Defined results: a null text is an empty one; an empty text has no tokens; repeated rows, equal ids and null ids
are kept; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from relata.llm.frames import map_texts

# How the byte-level vocabulary cuts a text into words before any merge.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The letters below U+02B0. A text without characters beyond, rare digits and separators is cut by a plainer, equal pattern.
LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af"
PLAIN_PATTERN = rf""" ?[{LETTERS}]++| ?[0-9]++|'(?:[stmd]|re|ve|ll)| ?[^\s{LETTERS}0-9]++|\s+(?!\S)|\s+"""
ODD_PATTERN = r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u02af]"

#: Words whose encodings a worker keeps between pieces; beyond it starts afresh.
KEPT_WORDS = 250_000
#: Pairs of tokens whose compatibility a worker keeps.
KEPT_PAIRS = 200_000

NEVER = 1 << 60


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(prints)]
    return {chr(byte): byte for byte in prints} | {chr(256 + place): byte for place, byte in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = printable_bytes()
        ids = content["model"]["vocab"]
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.bytes_of = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, number in ids.items():
            self.bytes_of[number] = bytes(byte_of[character] for character in token)
        for token, number in special.items():
            self.bytes_of[number] = token.encode()
        self.special = special
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (ids[left], ids[right])
            self.rank[pair] = rank
            self.parts.setdefault(ids[left + right], (rank, *pair))
        self.id_of = {self.bytes_of[number]: number for number in ids.values() if number in self.parts or len(self.bytes_of[number]) == 1}
        self.openings = {token[:end] for token in self.id_of for end in range(1, len(token) + 1)}
        self.packed = [number.to_bytes(4, "little") for number in range(len(self.bytes_of))]
        self.endings = functools.lru_cache(KEPT_PAIRS)(self._endings)
        self.compatible = functools.lru_cache(KEPT_PAIRS)(self._compatible)
        self.right_edge = functools.cache(lambda token: self._edge(token, 2))
        self.left_edge = functools.cache(lambda token: self._edge(token, 1))

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stood at one edge of ``token`` while it was built, each with the rank of the merge that ended it."""
        found, until = [], NEVER
        while True:
            found.append((token, until))
            if token not in self.parts:
                return found
            until, token = self.parts[token][0], self.parts[token][side]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges that build both tokens.

        Ranks grow while merging goes on. A border pair merges if its rank is below that of the merge that takes the
        left token inwards; against the right one it also wins a tie, as equal pairs merge from the left.
        """
        for a, a_until in self.right_edge(left):
            for b, b_until in self.left_edge(right):
                rank = self.rank.get((a, b))
                if rank is not None and rank < a_until and rank <= b_until:
                    return False
        return True

    def _endings(self, opening: bytes) -> list[tuple[int, int]]:
        """The tokens that end ``opening``, longest first, with their lengths."""
        found = ((len(opening) - start, self.id_of.get(opening[start:])) for start in range(len(opening)))
        return [(length, token) for length, token in found if token is not None]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Token ids of distinct words, as little-endian 32-bit integers, from one walk over their trie.

        The trie is held as the sorted words: in that order its nodes come depth first, and what two neighbours
        share is the branch that stays. For each node of the current branch there is its last token and the length of
        the longest opening of a token that ends there; tokens that end there are endings of that opening.
        """
        found: dict[str, bytes] = {}
        openings, endings, compatible, packed, bytes_of = self.openings, self.endings, self.compatible, self.packed, self.bytes_of
        last, reach = [0], [0]
        before = b""
        for word, name in sorted((name.encode(), name) for name in words):
            size = len(word)
            shared, most = 0, min(size, len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], reach[shared + 1 :]
            for end in range(shared + 1, size + 1):
                length = reach[-1] + 1
                while word[end - length : end] not in openings:
                    length -= 1
                reach.append(length)
                for held, token in endings(word[end - length : end]):
                    if held == end or compatible(last[end - held], token):
                        last.append(token)
                        break
                else:
                    raise ValueError("the vocabulary lacks single bytes")
            tokens, place = [], size
            while place:
                token = last[place]
                tokens.append(packed[token])
                place -= len(bytes_of[token])
            tokens.reverse()
            found[name] = b"".join(tokens)
            before = word
        return found


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_kept: dict[str, dict[str, bytes]] = {}


def encode_texts(path: str, texts: list[str]) -> list[bytes]:
    """Token ids of each text as little-endian 32-bit integers."""
    vocab = vocabulary(path)
    kept = _kept.setdefault(path, {})
    find_any, find_plain, is_odd = regex.compile(WORD_PATTERN).findall, re.compile(PLAIN_PATTERN).findall, re.compile(ODD_PATTERN).search
    split = vocab.special_pattern.split if vocab.special_pattern else lambda text: [text]
    rows = []
    for text in texts:
        parts = split(text)
        find = find_any if is_odd(text) else find_plain
        words = find(parts[0])
        for place in range(1, len(parts), 2):
            words.append(vocab.special[parts[place]])
            words += find(parts[place + 1])
        rows.append(words)
    wanted = {word for words in rows for word in words}
    new = [word for word in wanted if word not in kept]
    if len(kept) + len(new) > KEPT_WORDS:
        kept.clear()
        new = list(wanted)
    numbers = [word for word in new if isinstance(word, int)]
    kept.update((number, np.array([number], "<u4").tobytes()) for number in numbers)
    kept.update(vocab.encode_words([word for word in new if isinstance(word, str)]))
    return [b"".join(map(kept.__getitem__, words)) for words in rows]


def decode_ids(path: str, ids: np.ndarray) -> str:
    """The text of token ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(vocabulary(path).bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and ``token_ids`` of each row's whole text, by the byte-level vocabulary file ``path``.

    The strings of special tokens in a text become their ids, as the usual library does it.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> list:
        packed = encode_texts(path, piece.column(1).to_pylist())
        counts = np.fromiter((len(x) // 4 for x in packed), np.int64, len(packed))
        marks = np.zeros(len(packed) + 1, np.int32)
        np.cumsum(counts, out=marks[1:])
        ids = pa.ListArray.from_arrays(pa.array(marks), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
        return [piece.column(0), pa.array(counts), ids]

    return map_texts(docs, [key, text], f"{key} {kind}, n_tokens long, token_ids array<int>", work)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", with_digests: bool = False) -> DataFrame:
    """``key`` and the ``text`` its ``token_ids`` stand for (null ids: empty text).

    ``with_digests`` gives ``n_tokens`` and the SHA-256 of ids (little-endian, 32 bits) and text instead of the text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = encoded.schema[key].dataType.simpleString()
    rest = "n_tokens long, ids_sha256 string, decoded_sha256 string" if with_digests else "text string"
    schema = f"{key} {kind}, {rest}"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                lists = part.column(1)
                rows = [np.asarray(lists[i].values if lists[i].is_valid else [], "<u4") for i in range(len(lists))]
                texts = [decode_ids(path, row) for row in rows]
                if with_digests:
                    found = [
                        [len(row) for row in rows],
                        [hashlib.sha256(row.tobytes()).hexdigest() for row in rows],
                        [hashlib.sha256(text.encode()).hexdigest() for text in texts],
                    ]
                else:
                    found = [texts]
                arrays = [pa.array(x, field.type) for x, field in zip(found, list(out)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(out.field(0).type), *arrays], schema=out)

    return encoded.select(key, "token_ids").mapInArrow(run, schema)
