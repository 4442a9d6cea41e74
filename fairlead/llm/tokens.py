"""Token ids of many texts at once.

The word-end BPE vocabulary never joins characters across white space, so each distinct
word of a block is encoded once and the ids are dealt out by index.
"""

from __future__ import annotations

import json
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed values of the vocabulary: its way to cut words, and its two special tokens.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
END_OF_TEXT = 49407
VOCABULARY = 49408
#: Bytes of distinct pieces and their ids that a worker remembers, about; then it starts anew.
MEMORY = 24 << 20
#: Bytes of a remembered piece beside its letters and ids: two objects and their place.
ENTRY = 200

_MARKS = string.punctuation.replace("'", "")
_PLAIN = "^[!-~¡-¬®-įı-ſ]+$"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids as the `tokenizers` library gives them with add_special_tokens=False.

    Plain words go through a faster merge table in which byte FF stands for the end of a
    word (FF is in no UTF-8 text); all others go to the library itself, word by word.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        byte = _byte_of()
        ranks = {}
        with open(path, encoding="utf-8") as f:
            for token, i in json.load(f)["model"]["vocab"].items():
                ends = token.endswith("</w>") and token != "</w>"
                raw = bytes(byte[c] for c in (token[:-4] if ends else token))
                ranks[raw + b"\xff" * ends] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.encode = self.merge._core_bpe.encode_single_piece
        self.pieces = regex.compile(PIECES)
        self.seen: dict[str, bytes] = {}
        self.size = 0

    def _piece(self, piece: str) -> bytes:
        ids = self.seen.get(piece)
        if ids is None:
            ids = array("I", self.encode(piece.encode() + b"\xff")).tobytes()
            self.seen[piece] = ids
            self.size += ENTRY + len(piece) + len(ids)
        return ids

    def _word(self, word: str) -> bytes:
        return b"".join([self._piece(p) for p in self.pieces.findall(word)])

    def _foreign(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per distinct word and all their ids, in the order of the words."""
        if self.size > MEMORY:
            self.seen, self.size = {}, 0
        plain = pc.match_substring_regex(words, _PLAIN)
        for token in SPECIAL:
            plain = pc.and_(plain, pc.invert(pc.match_substring(words, token)))
        lower = pc.utf8_lower(words)
        # letters, then marks: the usual word
        heads = pc.utf8_rtrim(lower, _MARKS)
        usual = pc.and_(plain, pc.match_substring_regex(heads, "^\\p{L}+$")).to_numpy(zero_copy_only=False)
        got: list[bytes | None] = [None] * len(words)
        simple = np.flatnonzero(usual)
        if len(simple):
            some, chosen = pa.array(simple), heads.take(pa.array(simple))
            distinct = chosen.dictionary_encode()
            pieces = np.empty(len(distinct.dictionary), object)
            pieces[:] = [*map(self._piece, distinct.dictionary.to_numpy(zero_copy_only=False))]
            dealt = pieces[distinct.indices.to_numpy()]
            tailed = np.flatnonzero(pc.not_equal(pc.binary_length(chosen), pc.binary_length(lower.take(some))).to_numpy(zero_copy_only=False))
            whole = lower.take(some.take(pa.array(tailed))).to_numpy(zero_copy_only=False)
            head = chosen.take(pa.array(tailed)).to_numpy(zero_copy_only=False)
            for i, w, h in zip(tailed.tolist(), whole, head):
                dealt[i] += self._piece(w[len(h) :])
            for i, ids in zip(simple.tolist(), dealt):
                got[i] = ids
        usual = pa.array(usual)
        odd = np.flatnonzero(~usual.to_numpy(zero_copy_only=False))
        if len(odd):
            at = pa.array(odd)
            for i, ok, low, raw in zip(odd.tolist(), plain.take(at).to_pylist(), lower.take(at).to_pylist(), words.take(at).to_pylist()):
                got[i] = (self._word(low) if ok else self._foreign(raw)) if raw else b""
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        return sizes, np.frombuffer(b"".join(got), np.uint32)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text (null: none), and the ids of all texts one after the other."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        words = lists.flatten().dictionary_encode()
        if not len(words.indices):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint32)
        sizes, ids = self._distinct(words.dictionary)
        index = words.indices.to_numpy()
        n = sizes[index]
        ends = np.cumsum(n)
        starts = (np.cumsum(sizes) - sizes)[index]
        flat = ids[np.arange(ends[-1]) + np.repeat(starts - (ends - n), n)] if ends[-1] else ids[:0]
        total = np.concatenate([[0], ends])
        return total[offsets[1:]] - total[offsets[:-1]], flat


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
